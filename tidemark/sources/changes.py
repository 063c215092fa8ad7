"""Change topics as batch or streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.settings import CODEC
from tidemark.sources.tables import complete_versions

# The columns a Kafka source yields.
RAW_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def kafka_options(
    bootstrap: str, topic: str, max_records: int | None = None, min_partitions: int | None = None
) -> dict:
    """Options that read a topic from its first record.

    ``max_records`` bounds a batch, so that a first run over a long topic is many batches;
    ``min_partitions`` cuts few topic partitions into more tasks.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_changes(spark: SparkSession, source_format: str, **options) -> DataFrame:
    """Stream a change topic with its columns as they are.

    Any format yielding the Kafka source's columns will do; file formats get the
    schema declared, as streams do not infer one.
    """
    reader = spark.readStream.format(source_format).options(**options)
    if source_format != "kafka":
        reader = reader.schema(RAW_SCHEMA)
    return reader.load()


def stream_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream a raw table that :func:`land_raw` fills.

    Only append-only tables may be streamed, so this takes raw tables and
    rejects change targets and published tables, which are made of versions.
    """
    if complete_versions(spark, path):
        raise ValueError(f"{path} changes in place and cannot be streamed; read its raw feed")
    return spark.readStream.schema(RAW_SCHEMA).options(**options).parquet(path)


def land_raw(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a topic to its raw table until all available records are in."""
    return (
        changes.writeStream.format("parquet")
        .outputMode("append")
        .option("compression", CODEC)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def encode_changes(
    rows: DataFrame, keys: list[str], columns: list[str], topic: str, *, op: str = "op",
    sequence: str = "lsn",
) -> DataFrame:
    """Write flat change rows as envelope records with the source's columns.

    The inverse of decoding, for replaying a change log through the flows. A
    delete carries its key in ``before`` and has a null ``after``. Decimals are
    written as strings to keep them exact.
    """
    exact = {f.name for f in rows.schema.fields if f.dataType.typeName() == "decimal"}

    def wire(name: str) -> Column:
        return F.col(name).cast("string").alias(name) if name in exact else F.col(name)

    deleted = F.col(op) == "d"
    image = F.struct(*[wire(c) for c in columns])
    key_image = F.struct(*[wire(c) for c in keys])
    payload = F.struct(
        F.when(~deleted, image).alias("after"),
        F.when(deleted, key_image).alias("before"),
        F.col(op).alias("op"),
        F.struct(F.col(sequence).alias("lsn")).alias("source"),
    )
    return rows.select(
        F.to_json(key_image).cast("binary").alias("key"),
        F.to_json(F.struct(payload.alias("payload"))).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(sequence).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
