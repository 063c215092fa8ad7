"""The whole flow in stages: land, transform, publish, sync."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.plans import entities
from tidemark.plans.maintained import MAINTAINED, Maintained
from tidemark.plans.marts import MARTS
from tidemark.settings import Settings
from tidemark.sources.changes import kafka_options, land_raw, read_changes
from tidemark.sources.manifest import bytes_below
from tidemark.sources.tables import (
    CdcTable,
    complete_versions,
    expire_published,
    name_published,
    publish,
    sync_table,
)
from tidemark.streaming.flows import run_entity, run_order_enriched

# Topics of which more has landed are applied in turn: each fills the cores, and leaves its room to the next.
SIDE_BY_SIDE_BYTES = 1 << 30


@dataclass(frozen=True)
class Layout:
    """Where the parts of a run live under one shared root."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def state(self, name: str) -> str:
        return f"{self.root}/tables/state_{name}"

    def rejects(self, name: str) -> str:
        return f"{self.root}/tables/{name}_quarantine"

    def metrics(self, name: str) -> str:
        return f"{self.root}/metrics/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def maintained(self, name: str) -> str:
        return f"{self.root}/tables/maintained_{name}"

    def checkpoint(self, flow: str) -> str:
        return f"{self.root}/checkpoints/{flow}"


def entity_table(
    spark: SparkSession, layout: Layout, spec: entities.EntitySpec, settings: Settings
) -> CdcTable:
    return CdcTable(
        spark,
        layout.state(spec.name),
        spec.keys,
        spec.scd_type,
        settings.buckets,
        settings.skew,
        settings.rewrite_every,
    )


def serving_table(spark: SparkSession, layout: Layout, name: str, settings: Settings) -> CdcTable:
    return CdcTable(
        spark,
        layout.state(name),
        ["order_id"],
        1,
        settings.buckets,
        settings.skew,
        settings.rewrite_every,
    )


def topic_options(settings: Settings, name: str) -> dict:
    topic = settings.topic_prefix + name
    if settings.source_format == "kafka":
        return kafka_options(
            settings.source, topic, settings.max_records, settings.min_partitions
        )
    return {"path": f"{settings.source}/{topic}"}


SERVING = "order_enriched"


def tables_for(targets: Collection[str]) -> set[str]:
    """The entity tables that targets are, or are made of."""
    inputs = {**{spec.name: (spec.name,) for spec in entities.ENTITIES}, **{m.name: m.inputs for m in MARTS}}
    inputs[SERVING] = (entities.CUSTOMERS.name, entities.RESTAURANTS.name)
    return {name for target in targets for name in inputs[target]}


def topics_for(targets: Collection[str]) -> set[str]:
    """The topics that targets are made of; the serving table reads the raw orders, not their history."""
    return tables_for(targets) | ({entities.ORDERS.name} if SERVING in targets else set())


ALL_TARGETS = frozenset({*(spec.name for spec in entities.ENTITIES), *(mart.name for mart in MARTS), SERVING})


def land_all(
    spark: SparkSession, layout: Layout, settings: Settings, targets: Collection[str] = ALL_TARGETS
) -> None:
    """Bring every topic's new records into its raw table, topics side by side."""
    wanted = topics_for(targets)
    running = [
        land_raw(
            read_changes(spark, settings.source_format, **topic_options(settings, spec.name)),
            layout.raw(spec.name),
            layout.checkpoint(f"raw_{spec.name}"),
        )
        for spec in entities.ENTITIES
        if spec.name in wanted
    ]
    for query in running:
        query.awaitTermination()


def _keep_metrics(spark: SparkSession, path: str):
    """Store the rule outcomes of each batch in a folder of its own."""

    def keep(batch_id: int, outcomes: dict) -> None:
        rows = [(rule, int(count or 0)) for rule, count in outcomes.items()]
        (
            spark.createDataFrame(rows, "measure string, rows long")
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{path}/batch={batch_id}")
        )

    return keep


def transform_all(
    spark: SparkSession, layout: Layout, settings: Settings, targets: Collection[str] = ALL_TARGETS
) -> None:
    """Apply raw changes to all tables, then to the serving table.

    Small topics are applied side by side, then large ones in turn, the largest first.
    """
    wanted = tables_for(targets)
    sizes = {name: bytes_below(spark, layout.raw(name)) for name in wanted}
    specs = [spec for spec in entities.ENTITIES if spec.name in wanted]
    large = [spec for spec in specs if sizes[spec.name] > SIDE_BY_SIDE_BYTES]
    small = [spec for spec in specs if spec not in large]

    def run(spec: entities.EntitySpec) -> None:
        run_entity(
            spark,
            spec,
            layout.raw(spec.name),
            entity_table(spark, layout, spec, settings),
            layout.checkpoint(spec.name),
            rejects=layout.rejects(spec.name),
            on_metrics=_keep_metrics(spark, layout.metrics(spec.name)),
        )

    with ThreadPoolExecutor(max(1, len(small))) as pool:
        list(pool.map(run, small))  # raises what any of them raised
    for spec in sorted(large, key=lambda spec: -sizes[spec.name]):
        run(spec)
    if SERVING not in targets:
        return
    run_order_enriched(
        spark,
        layout.raw("orders"),
        serving_table(spark, layout, SERVING, settings),
        entity_table(spark, layout, entities.CUSTOMERS, settings),
        entity_table(spark, layout, entities.RESTAURANTS, settings),
        layout.checkpoint("order_enriched"),
        settings=settings,
    )


def publish_marts(
    spark: SparkSession, layout: Layout, settings: Settings, targets: Collection[str] = ALL_TARGETS
) -> None:
    """Publish the aggregates over current versions as a new version each.

    Those that are kept up are refreshed from what changed; one in which nothing did is not published again.
    """
    by_name = {spec.name: spec for spec in entities.ENTITIES}

    def table(name: str) -> CdcTable:
        return entity_table(spark, layout, by_name[name], settings)

    for mart in MARTS:
        if mart.name not in targets:
            continue
        path = layout.mart(mart.name)
        done = complete_versions(spark, path)
        version = done[-1] + 1 if done else 0
        if settings.maintain:
            kept = maintained_mart(spark, layout, mart.name, settings)
            before = kept.result.newest()
            after = kept.refresh({name: table(name) for name in mart.inputs})
            if after is None or (after == before and after in done):
                continue
            # Published under the result's own version, so that one whose publishing failed is seen.
            version = max(version, after)
            result = kept.read()
        else:
            result = mart.build(*[table(name).current() for name in mart.inputs], settings)
        publish(result, path, version, mart.cluster_by, mart.keys)
        if settings.database:
            name_published(
                spark, path, version, f"{settings.database}.{mart.name}", mart.comment
            )


def maintained_mart(spark: SparkSession, layout: Layout, name: str, settings: Settings) -> Maintained:
    return Maintained(spark, MAINTAINED[name], layout.maintained(name), settings)


def sync_serving(spark: SparkSession, layout: Layout, settings: Settings) -> int | None:
    return sync_table(
        serving_table(spark, layout, "order_enriched", settings),
        serving_table(spark, layout, "order_enriched_synced", settings),
    )


def expire_all(spark: SparkSession, layout: Layout, settings: Settings) -> None:
    """Let go of versions older than the newest ``keep_versions``.

    The serving table keeps what its copy has still to be synced from, and every table what an aggregate
    that is kept up has still to take in.
    """
    unread: dict[str, int] = {}
    derived = []
    if settings.maintain:
        for mart in MARTS:
            kept = maintained_mart(spark, layout, mart.name, settings)
            derived += [kept.sums, kept.result]
            newest = kept.result.newest()
            seen = kept.result.manifest(newest).note if newest is not None else dict.fromkeys(mart.inputs, -1)
            for name, version in seen.items():
                path = layout.state(name)
                unread[path] = min(version, unread.get(path, version))
    tables = [entity_table(spark, layout, spec, settings) for spec in entities.ENTITIES]
    served = serving_table(spark, layout, "order_enriched", settings)
    copy = serving_table(spark, layout, "order_enriched_synced", settings)
    synced = copy.newest()
    for table in [*tables, served, copy, *derived]:
        versions = complete_versions(spark, table.path)
        if len(versions) > settings.keep_versions:
            oldest = versions[-settings.keep_versions]
            if table is served and synced is not None:
                oldest = min(oldest, synced)
            table.expire(min(oldest, unread.get(table.path, oldest)))
    for mart in MARTS:
        expire_published(spark, layout.mart(mart.name), settings.keep_versions)


def run_stages(
    spark: SparkSession,
    layout: Layout,
    settings: Settings,
    targets: Collection[str] = ALL_TARGETS,
    on_landed: Callable[[], None] | None = None,
) -> None:
    """One triggered run; a stage that fails stops those after it.

    ``targets`` names tables, aggregates or the serving table; what they are made of is brought up to date
    as well, and the rest is left as it was. ``on_landed`` is called once all records are in the raw tables.
    """
    land_all(spark, layout, settings, targets)
    if on_landed is not None:
        on_landed()
    transform_all(spark, layout, settings, targets)
    publish_marts(spark, layout, settings, targets)
    if SERVING in targets:
        sync_serving(spark, layout, settings)
    expire_all(spark, layout, settings)
