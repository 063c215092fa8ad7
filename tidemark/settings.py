"""Settings passed explicitly to operators and flows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


_LOCAL: dict[str, str] = {}
# How Parquet files of records and tables are packed: change records take half of what they do by default.
CODEC = "zstd"


@dataclass(frozen=True)
class SkewLimits:
    """When a group is too big for one task.

    A group is hot once it holds more than ``rows`` rows and more than a
    ``1 / groups`` share of its input, so at most ``groups`` groups are ever hot
    and they are cut into at most twice as many pieces, whatever the data is.
    """

    rows: int = 1_000_000
    groups: int = 20_000

    def threshold(self, total: int) -> int:
        return max(self.rows, total // self.groups)


@dataclass(frozen=True)
class Settings:
    """Everything a flow needs to know about its surroundings.

    ``source`` names the brokers of a Kafka source, or for a file format the
    folder that holds a folder per topic.
    ``broadcast_rows`` bounds the dimension sides that may be broadcast; larger
    ones take the shuffle path. ``buckets`` is fixed over the life of a table; a
    bucket is rewritten whole once it has ``rewrite_every`` folders, and a staged run
    keeps the newest ``keep_versions`` versions readable. ``topic_prefix`` is what a topic's name has
    before the table's; ``max_records`` bounds a batch read from Kafka.
    Aggregates are named in the catalog under ``database``, if one is given. With ``maintain`` a staged run keeps
    them up from change feeds; otherwise it computes them anew.
    """

    source_format: str = "kafka"
    source: str = ""
    topic_prefix: str = ""
    max_records: int | None = None
    min_partitions: int | None = None
    buckets: int = 16
    broadcast_rows: int = 100_000
    rewrite_every: int = 50
    keep_versions: int = 100
    database: str = ""
    maintain: bool = False
    skew: SkewLimits = SkewLimits()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only where the session names none and all tasks run on this machine (a test) is
    a temporary folder used, one per session, removed when it ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
        shared = _LOCAL[app]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
