"""Triggered streams from raw change records into tables.

Each flow streams an append-only raw table with a checkpoint of its own and runs
until all available records are applied. A batch is decoded once; its id is the
version its target commits, so a batch that runs again after a failure replaces
what it wrote before.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc, quality
from tidemark.operators.decode import CAST_ERRORS, LOG_POSITION, RAW_TEXT, decode_changes
from tidemark.plans import marts
from tidemark.plans.entities import ORDERS, READABLE_AMOUNTS, EntitySpec
from tidemark.settings import CODEC, Settings
from tidemark.sources.changes import stream_raw
from tidemark.sources.manifest import delete_path, list_paths
from tidemark.sources.tables import CdcTable

# A run is at most about so many batches, however much has landed.
MAX_BATCHES = 3
# A part of a table's buckets takes up to so many bytes of a batch's records, as they are stored.
PART_BYTES = 1 << 30
_PART = "_part"
# Lets go of a query's shuffle files once it is done; by default they stay until the driver happens to collect garbage.
_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def route_changes(
    changes: DataFrame, spec: EntitySpec, null_policy: str = "pass_deletes"
) -> DataFrame:
    """Mark decoded changes as valid or not, and say why.

    Rows without a key or sequence number cannot be applied and are rejects too.
    """
    if spec.quarantine_rules:
        rules = {**spec.quarantine_rules, **READABLE_AMOUNTS}
        routed = quality.route_rows(
            changes, rules, null_policy, keys=spec.keys, delete_when=spec.delete_when
        )
    else:
        # A row that fails a drop rule goes nowhere; unreadable amounts are set aside.
        rules = {**spec.drop_rules, **READABLE_AMOUNTS}
        keep = F.coalesce(quality.all_rules(spec.drop_rules), F.lit(False))
        readable = F.coalesce(quality.all_rules(READABLE_AMOUNTS), F.lit(True))
        routed = changes.withColumn(
            quality.ROUTE,
            F.when(keep & readable, quality.VALID).when(keep, quality.QUARANTINE),
        )
    route, unsequenced = F.col(quality.ROUTE), F.col(spec.sequence_by).isNull()
    missing = F.when(unsequenced, F.array(F.lit("sequence_present"))).otherwise(F.array())
    return (
        routed.withColumn(
            quality.ROUTE,
            F.when(unsequenced & (route == quality.VALID), quality.QUARANTINE).otherwise(route),
        )
        .withColumn("reasons", F.concat(quality.failed_rules(rules), missing))
        # The text is for inspecting rejects; valid rows need not carry it.
        .withColumn(RAW_TEXT, F.when(route == quality.QUARANTINE, F.col(RAW_TEXT)))
    )


def valid_events(routed: DataFrame, spec: EntitySpec) -> DataFrame:
    """The valid ones of routed changes, as events of the target."""
    return cdc.to_events(
        routed.filter(F.col(quality.ROUTE) == quality.VALID),
        spec.keys,
        spec.sequence_by,
        spec.delete_when,
        [*spec.except_columns, CAST_ERRORS, RAW_TEXT, quality.ROUTE, "reasons"],
        LOG_POSITION,
    )


def _decoded(batch: DataFrame, spec: EntitySpec) -> DataFrame:
    return decode_changes(batch, spec.row, spec.keys, position=True, diagnostics=True)


def _writer(batch: DataFrame) -> str | None:
    """The id of the streaming query a batch belongs to; its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def files_per_batch(spark: SparkSession, raw: str, wanted: int) -> int:
    """The files a batch takes: as wanted, but no less than a third of those landed.

    A merge reads the last events of the buckets it touches, which any large batch touches all of. With batches
    of a fixed size a long backlog would cost its square; as shares of it they cost a few times its size. Spark
    cuts a batch into tasks whatever its size.
    """
    landed = len(list_paths(spark, f"{raw}/*.parquet"))
    return max(wanted, -(-landed // MAX_BATCHES))


def parts_of(batch: DataFrame, buckets: int) -> int:
    """In how many parts to merge a batch, by the size of its files; no more than there are buckets."""
    size = int(batch._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, min(buckets, -(-size // PART_BYTES)))


def _run(
    stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]
) -> None:
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_entity(
    spark: SparkSession,
    spec: EntitySpec,
    raw: str,
    table: CdcTable,
    checkpoint: str,
    *,
    rejects: str | None = None,
    null_policy: str = "pass_deletes",
    max_files_per_batch: int = 1000,
    on_metrics: Callable[[int, dict], None] | None = None,
) -> None:
    """Apply a raw table to its target, setting rejects aside.

    Rejects of a batch go to a folder of its own, which a repeated batch
    overwrites. ``on_metrics`` gets each batch's rule outcomes.

    A batch is decoded once, into files by route and part of the table's buckets. Parts are merged one after
    another and their files deleted, so a batch of any size needs room for little more than its records and the
    table: what is decoded makes way for what is stored, and only a part is shuffled at a time.
    """
    decoded = f"{table.path}/_decoded"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session, parts = batch.sparkSession, parts_of(batch, table.buckets)
        session.conf.set(_LET_GO, "true")
        observation = Observation(f"{spec.name}-{batch_id}")
        watched = quality.observe_rules(
            _decoded(batch, spec), spec.warn_rules, observation, spec.delete_when
        )
        valid = F.col(quality.ROUTE) == quality.VALID
        # What is neither valid nor set aside has been counted and goes nowhere.
        routed = (
            route_changes(watched, spec, null_policy)
            .filter(F.col(quality.ROUTE).isNotNull())
            .withColumn(_PART, F.when(valid, table.part(parts)).otherwise(0))
        )
        try:
            (
                routed.write.mode("overwrite")
                .option("compression", CODEC)
                .option("parquet.enable.dictionary", "false")  # read once or twice; takes as much room and less time
                .partitionBy(quality.ROUTE, _PART)
                .parquet(decoded)
            )
            kept = session.read.schema(routed.schema).parquet(decoded)

            def events() -> Iterator[DataFrame]:
                for part in range(parts):
                    yield valid_events(kept.filter(F.col(_PART) == part).drop(_PART), spec)
                    delete_path(session, f"{decoded}/{quality.ROUTE}={quality.VALID}/{_PART}={part}")

            table.merge_parts(events(), parts, batch_id, writer=_writer(batch))
            if rejects is not None:
                (
                    kept.filter(F.col(quality.ROUTE) == quality.QUARANTINE)
                    .drop(quality.ROUTE, _PART)
                    .write.mode("overwrite")
                    .option("compression", CODEC)
                    .parquet(f"{rejects}/batch={batch_id}")
                )
            if on_metrics is not None:
                on_metrics(batch_id, observation.get)
        finally:
            delete_path(session, decoded)

    _run(stream_raw(spark, raw, maxFilesPerTrigger=files_per_batch(spark, raw, max_files_per_batch)), checkpoint, on_batch)


def run_order_enriched(
    spark: SparkSession,
    raw: str,
    table: CdcTable,
    customers: CdcTable,
    restaurants: CdcTable,
    checkpoint: str,
    *,
    settings: Settings = Settings(),
    max_files_per_batch: int = 1000,
) -> None:
    """Feed the serving table from the raw order changes.

    A second, independent consumer of the same feed as the order history. Each
    batch reads the dimensions anew: a DataFrame keeps the files it was made of.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        routed = route_changes(_decoded(batch, ORDERS), ORDERS)
        events = valid_events(routed, ORDERS)
        # Only the last event of an order is served, so only that is looked up.
        last = cdc.latest(events, ORDERS.keys).persist()
        served = marts.enrich_orders(
            last, customers.current(), restaurants.current(), settings
        ).persist()
        try:
            table.merge(served, batch_id, one_per_key=True, writer=_writer(batch))
        finally:
            served.unpersist()
            last.unpersist()

    _run(stream_raw(spark, raw, maxFilesPerTrigger=files_per_batch(spark, raw, max_files_per_batch)), checkpoint, on_batch)
