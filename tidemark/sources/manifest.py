"""What files a version of a table is made of, and what they hold.

Each version has one manifest, ``<table>/_manifest/<version>.json``. It is written
beside and renamed into place once the version's data is there, so a version either
is whole or does not exist, and readers list nothing but this folder. A file's entry carries its bucket,
rows, bytes and the range of sequence numbers at which its rows start and end; readers
skip files by those ranges.
"""

from __future__ import annotations

import json
import uuid
import zlib
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FOLDER = "_manifest"


# The file system the cluster uses -------------------------------------------------


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, fetched as one text; asking for each would take a call apiece."""
    files, path = _system(spark, pattern)
    found = spark._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(files, path)
    return found.mkString("\n").splitlines()


def delete_path(spark: SparkSession, path: str) -> None:
    files, target = _system(spark, path)
    files.delete(target, True)


def bytes_below(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder; none where there is no folder."""
    files, target = _system(spark, path)
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def _read_bytes(spark: SparkSession, path: str) -> bytes:
    files, target = _system(spark, path)
    stream = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def _put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Make ``path`` hold ``data``, at once or not at all."""
    files, target = _system(spark, path)
    _, beside = _system(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(files.makeQualified(beside), files.makeQualified(target), how)


# Manifests ------------------------------------------------------------------------


@dataclass(frozen=True)
class DataFile:
    """A data file: where it is, what it is part of, and the sequence numbers in it.

    ``first`` and ``last`` bound where its rows start, ``end`` is the greatest
    at which one ends; None where sequences are not whole numbers.
    """

    path: str  # below the table's folder
    version: int
    kind: str
    bucket: int
    rows: int
    bytes: int
    first: int | None
    last: int | None
    end: int | None

    def starts_by(self, sequence: int) -> bool:
        """Whether a row can have started at ``sequence``."""
        return self.first is None or self.first <= sequence

    def ends_after(self, sequence: int) -> bool:
        """Whether a row can end later than ``sequence``."""
        return self.end is None or self.end > sequence


@dataclass(frozen=True)
class Manifest:
    """A version: its number, who wrote it, the columns of its files, the files, and the writer's own notes."""

    version: int
    writer: str | None
    columns: str  # a schema as JSON
    files: list[DataFile] = field(default_factory=list)
    note: dict = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.columns))


def _place(path: str, version: int) -> str:
    return f"{path}/{FOLDER}/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were committed, oldest first."""
    found = list_paths(spark, f"{path}/{FOLDER}/*.json")
    return sorted(int(p.rsplit("/", 1)[1].split(".")[0]) for p in found)


def load(spark: SparkSession, path: str, version: int) -> Manifest:
    found = json.loads(zlib.decompress(_read_bytes(spark, _place(path, version))))
    names = list(DataFile.__dataclass_fields__)
    files = [DataFile(**dict(zip(names, entry))) for entry in found.pop("files")]
    return Manifest(files=files, **found)


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a version count."""
    plain = {k: v for k, v in vars(manifest).items() if k != "files"}
    plain["files"] = [list(asdict(f).values()) for f in manifest.files]
    _put_bytes(spark, _place(path, manifest.version), zlib.compress(json.dumps(plain).encode()))


def forget(spark: SparkSession, path: str, version: int) -> None:
    delete_path(spark, _place(path, version))


def written_files(written: DataFrame, folder: str, version: int, start: str, end: str) -> list[DataFile]:
    """Entries for the files just written below ``folder``, partitioned by kind and bucket.

    Reads their sequence columns only; one row per file comes to the driver.
    """
    whole = written.schema[start].dataType.typeName() in ("byte", "short", "integer", "long")

    def bound(function, name: str):
        value = function(name) if whole and name in written.columns else F.lit(None)
        return value.cast("bigint")

    found = (
        written.groupBy("kind", "bucket", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count(F.lit(1)).alias("rows"), bound(F.min, start).alias("first"), bound(F.max, start).alias("last"), bound(F.max, end).alias("end"))
        .collect()
    )
    return [
        DataFile(r["path"][r["path"].index(f"{folder}/kind=") :], version, r["kind"], r["bucket"], r["rows"], r["bytes"], r["first"], r["last"], r["end"])
        for r in sorted(found, key=lambda r: r["path"])
    ]
