"""Streams give the batch answer, also when stopped and started or failing."""

import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from support import SF_DIR, rows_of

from tidemark.operators import cdc, quality
from tidemark.operators.decode import decode_changes
from tidemark.plans import entities, marts, stages
from tidemark.settings import Settings
from tidemark.sources.changes import RAW_SCHEMA, encode_changes
from tidemark.sources.manifest import list_paths
from tidemark.sources.tables import CdcTable, complete_versions, read_published
from tidemark.streaming import flows
from tidemark.streaming.flows import route_changes, run_entity, run_order_enriched, valid_events
from workload import derive
from workload import queries as registered

COLUMNS = ["order_id", "customer_id", "restaurant_id", "status", "total_amount", "created_at"]


@pytest.fixture(scope="module")
def log(spark):
    return derive.log_orders(spark, SF_DIR).persist()


@pytest.fixture(scope="module")
def expected(log):
    valid, rejects = quality.split_by_rules(
        log, entities.ORDERS.quarantine_rules, "pass_deletes", keys=["order_id"]
    )
    state = cdc.apply_changes(
        None,
        valid,
        keys=["order_id"],
        sequence_by="lsn",
        delete_when="op = 'd'",
        except_columns=["op", "lsn"],
        scd_type=2,
    )
    return rows_of(cdc.visible(state)), rows_of(rejects.select("lsn", *COLUMNS))


def land(log, path, part, files=3):
    chosen = log.filter(F.pmod(F.xxhash64("lsn"), F.lit(2)) == part)
    encode_changes(chosen, ["order_id"], COLUMNS, "orders").repartition(files).write.mode(
        "append"
    ).parquet(path)


def run(spark, folder, **more):
    table = CdcTable(spark, f"{folder}/state_orders", ["order_id"], 2, buckets=4)
    run_entity(
        spark,
        entities.ORDERS,
        f"{folder}/raw",
        table,
        f"{folder}/checkpoint",
        rejects=f"{folder}/rejects",
        max_files_per_batch=2,
        **more,
    )
    return table


def stored(spark, folder, table):
    rejects = spark.read.parquet(f"{folder}/rejects")
    return rows_of(table.read().drop("updated_at")), rows_of(rejects.select("lsn", *COLUMNS))


def test_stopped_and_started_stream_equals_batch(spark, log, expected, tmp_path):
    seen = {}
    land(log, f"{tmp_path}/raw", 0)
    run(spark, tmp_path, on_metrics=seen.__setitem__)
    land(log, f"{tmp_path}/raw", 1)
    table = run(spark, tmp_path, on_metrics=seen.__setitem__)
    assert stored(spark, tmp_path, table) == expected
    assert sorted(seen) == list(range(len(seen))) and len(seen) >= 4
    assert sum(m["rows"] for m in seen.values()) == log.count()
    unknown = log.filter("status = 'pending_sync'").count()
    assert sum(m["known_status.writes.failed"] for m in seen.values()) == unknown
    assert sum(m["known_status.deletes.unknown"] for m in seen.values()) == (
        log.filter("op = 'd'").count()
    )


def test_a_batch_that_failed_is_repeated_without_trace(spark, log, expected, tmp_path):
    def fail(batch_id, _):
        if batch_id == 1:
            raise RuntimeError("lost")

    land(log, f"{tmp_path}/raw", 0)
    land(log, f"{tmp_path}/raw", 1)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, on_metrics=fail)
    table = run(spark, tmp_path)
    assert stored(spark, tmp_path, table) == expected


def test_broken_records_do_not_stop_the_stream(spark, tmp_path):
    def record(offset, text):
        return (None, bytearray(text.encode()) if text else None, "t", 0, offset, None, 0)

    def order(lsn, ident, amount):
        return json.dumps(
            {"payload": {"after": {"order_id": ident, "total_amount": amount}, "before": None,
                         "op": "c", "source": {"lsn": lsn}}}
        )

    records = [
        record(0, order(1, 1, "5.00")), record(1, "{oops"), record(2, None),
        record(3, order(2, 2, "abc")), record(4, order(3, 3, "123456789012.00")),
        record(5, order(1, 1, "6.00")), record(6, order(None, 4, "1.00")),
    ]
    spark.createDataFrame(records, RAW_SCHEMA).write.parquet(f"{tmp_path}/raw")
    table = run(spark, tmp_path)
    # Of two events with one sequence number the later in the log counts.
    assert [(r["order_id"], str(r["total_amount"])) for r in table.read().collect()] == [(1, "6.00")]
    rejects = spark.read.parquet(f"{tmp_path}/rejects").collect()
    assert len(rejects) == 5
    assert all(r["reasons"] for r in rejects)


def test_enriched_orders_see_dimensions_of_their_batch(spark, tmp_path):
    """A later change of a dimension shows in later orders only."""
    customers = CdcTable(spark, f"{tmp_path}/c", ["customer_id"], 1, buckets=2)
    restaurants = CdcTable(spark, f"{tmp_path}/r", ["restaurant_id"], 2, buckets=2)
    served = CdcTable(spark, f"{tmp_path}/o", ["order_id"], 1, buckets=2)
    arguments = dict(sequence_by="lsn", delete_when="op = 'd'", except_columns=["op", "lsn"])

    def dimensions(version, name):
        customers.apply(
            spark.createDataFrame(
                [(7, name, "1", "A", version, "u")],
                "customer_id bigint, full_name string, phone string, city string, lsn bigint, op string",
            ),
            version,
            **arguments,
        )
        restaurants.apply(
            spark.createDataFrame(
                [(3, name, "B", version, "u")],
                "restaurant_id bigint, name string, city string, lsn bigint, op string",
            ),
            version,
            **arguments,
        )

    def orders(*rows):
        df = spark.createDataFrame(
            [(*r, "created", "1.00", "2026-07-01T01:30:00Z") for r in rows],
            "op string, lsn bigint, order_id bigint, customer_id bigint, restaurant_id bigint, "
            "status string, total_amount string, created_at string",
        )
        encode_changes(df, ["order_id"], COLUMNS, "orders").coalesce(1).write.mode(
            "append"
        ).parquet(f"{tmp_path}/raw")
        run_order_enriched(
            spark, f"{tmp_path}/raw", served, customers, restaurants, f"{tmp_path}/k"
        )

    def names():
        return {
            r["order_id"]: (r["customer_name"], r["restaurant_name"])
            for r in served.read().collect()
        }

    dimensions(0, "old")
    orders(("c", 1, 1, 7, 3), ("c", 2, 2, 7, 99), ("c", 3, 3, None, 3), ("c", 4, 4, 7, 3))
    assert names() == {1: ("old", "old"), 2: ("old", None), 3: (None, "old"), 4: ("old", "old")}
    dimensions(1, "new")
    orders(("u", 11, 2, 7, 3), ("d", 12, 4, 7, 3))
    assert names() == {1: ("old", "old"), 2: ("new", "new"), 3: (None, "old")}


@pytest.fixture(scope="module")
def topics(spark, tmp_path_factory):
    """All five topics as files, in two halves."""
    folder = tmp_path_factory.mktemp("topics")
    logs = derive.topics(spark, SF_DIR)

    def write(half):
        for name, (rows, key) in logs.items():
            part = rows.filter(F.pmod(F.xxhash64("lsn"), F.lit(2)) == half)
            columns = [c for c in rows.columns if c not in ("op", "lsn")]
            encode_changes(part, [key], columns, name).coalesce(1).write.mode("append").parquet(
                f"{folder}/delivery.public.{name}"
            )

    return folder, write, logs


def test_staged_run_equals_batch(spark, topics, tmp_path):
    folder, write, logs = topics
    settings = Settings(
        source_format="parquet", source=str(folder), topic_prefix="delivery.public.", buckets=4,
        database="default",
    )
    layout, kept = stages.Layout(str(tmp_path / "anew")), stages.Layout(str(tmp_path / "kept"))
    for half in (0, 1):
        write(half)
        stages.run_stages(spark, layout, settings)
        stages.run_stages(spark, kept, replace(settings, maintain=True, database=""))
    versions = {m.name: complete_versions(spark, kept.mart(m.name)) for m in marts.MARTS}
    assert all(v == [0, 1] for v in versions.values())
    stages.publish_marts(spark, kept, replace(settings, maintain=True, database=""))  # nothing new
    assert versions == {m.name: complete_versions(spark, kept.mart(m.name)) for m in marts.MARTS}

    def now(name):
        rows, key = logs[name]
        if name == "orders":
            rows, _ = quality.split_by_rules(
                rows, entities.ORDERS.quarantine_rules, "pass_deletes", keys=[key]
            )
        events = cdc.to_events(rows, [key], "lsn", "op = 'd'", ["op", "lsn"])
        return cdc.visible(cdc.latest(events, [key]))

    for mart in marts.MARTS:
        published = read_published(spark, layout.mart(mart.name))
        assert rows_of(published) == rows_of(mart.build(*[now(n) for n in mart.inputs]))
        assert rows_of(read_published(spark, kept.mart(mart.name))) == rows_of(published)
        assert rows_of(spark.table(f"default.{mart.name}")) == rows_of(published)
        described = spark.catalog.getTable(f"default.{mart.name}")
        assert described.description == mart.comment
        keys = published.groupBy(*mart.keys).count().filter("count > 1").count()
        assert keys == 0
    source = stages.serving_table(spark, layout, "order_enriched", settings)
    copy = stages.serving_table(spark, layout, "order_enriched_synced", settings)
    assert copy.newest() == source.newest() == 1
    assert rows_of(copy.read()) == rows_of(source.read())
    assert rows_of(source.read().select("order_id", "status", "total_amount")) == rows_of(
        now("orders").select("order_id", "status", "total_amount")
    )
    rejects = spark.read.parquet(layout.rejects("orders"))
    assert rejects.count() == logs["orders"][0].filter("total_amount < 0").count()


def test_decoding_reads_the_kafka_columns(spark, log):
    raw = encode_changes(log, ["order_id"], COLUMNS, "orders")
    assert raw.columns == ["key", "value", "topic", "partition", "offset", "timestamp",
                           "timestampType"]
    back = decode_changes(raw, entities.ORDERS.row, ["order_id"]).drop("updated_at")
    assert rows_of(back) == rows_of(log)


def test_a_long_backlog_takes_few_batches(spark, log, expected, tmp_path):
    land(log, f"{tmp_path}/raw", 0, files=7)
    land(log, f"{tmp_path}/raw", 1, files=7)
    seen = {}
    table = run(spark, tmp_path, on_metrics=seen.__setitem__)
    assert sorted(seen) == [0, 1, 2]
    assert stored(spark, tmp_path, table) == expected


def test_filters_do_not_parse_again(spark, log):
    raw = encode_changes(log, ["order_id"], COLUMNS, "orders")
    decoded = decode_changes(raw, entities.ORDERS.row, ["order_id"], position=True, diagnostics=True)
    events = valid_events(route_changes(decoded, entities.ORDERS), entities.ORDERS)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_staged_queries_run_anew_what_they_need(spark, monkeypatch):
    layouts, whole = [], registered.run_stages

    def run_stages(spark, layout, *rest):
        layouts.append(layout)
        whole(spark, layout, *rest)

    monkeypatch.setattr(registered, "run_stages", run_stages)
    expected = rows_of(registered.revenue_by_city(spark, SF_DIR))
    for _ in range(2):
        assert rows_of(registered.staged_revenue_by_city(spark, SF_DIR)) == expected
    assert len(layouts) == 2
    names = [spec.name for spec in entities.ENTITIES]
    assert [n for n in names if list_paths(spark, f"{layouts[1].raw(n)}/*.parquet")] == ["restaurants", "orders"]
    assert stages.topics_for({stages.SERVING}) == {"customers", "restaurants", "orders"}
    assert stages.topics_for(stages.ALL_TARGETS) == set(names)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").splitlines() if "/shuffle_" in f}


def test_a_large_batch_makes_room_part_by_part(spark, log, expected, tmp_path, monkeypatch):
    """Merged by parts of the buckets, with late events too; what was decoded and shuffled is let go of."""
    left, merge_parts = [], CdcTable.merge_parts

    def watch(table, events, parts, *rest, **more):
        def watched():
            for part in events:
                left.append(len(list_paths(spark, f"{table.path}/_decoded/_route=valid/_part=*")))
                yield part

        merge_parts(table, watched(), parts, *rest, **more)

    monkeypatch.setattr(CdcTable, "merge_parts", watch)
    monkeypatch.setattr(flows, "PART_BYTES", 1)
    for half in (0, 1):
        land(log, f"{tmp_path}/raw", half)
        table = run(spark, tmp_path)
    assert left == [4, 3, 2, 1] * (len(left) // 4) and len(left) >= 16
    assert stored(spark, tmp_path, table) == expected
    assert rows_of(table.current().drop("updated_at")) == rows_of(
        cdc.current_versions(table.read()).drop("updated_at")
    )
    assert not list_paths(spark, f"{table.path}/_decoded*")
    # Only a first batch is without shuffles that stay in a cache until they are collected.
    first = CdcTable(spark, f"{tmp_path}/first", ["order_id"], 2, buckets=4)
    before = shuffle_files(spark)
    run_entity(spark, entities.ORDERS, f"{tmp_path}/raw", first, f"{tmp_path}/first_checkpoint")
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert rows_of(first.read().drop("updated_at")) == expected[0]


def test_an_empty_batch_in_parts_is_a_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows, "PART_BYTES", 1)
    spark.createDataFrame([], RAW_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/raw")
    rejected = [(None, bytearray(b"{oops"), "t", 0, 1, None, 0)]
    spark.createDataFrame(rejected, RAW_SCHEMA).write.mode("append").parquet(f"{tmp_path}/raw")
    seen = {}
    table = run(spark, tmp_path, on_metrics=seen.__setitem__)
    assert table.read().count() == 0 and sum(m["rows"] for m in seen.values()) == 1
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 1


def test_large_topics_are_applied_in_turn(spark, topics, tmp_path, monkeypatch):
    folder, write, _ = topics
    if not list_paths(spark, f"{folder}/*"):
        write(0)
    running, most, order, apply = [], [], [], stages.run_entity

    def watch(spark, spec, *rest, **more):
        running.append(spec.name)
        order.append(spec.name)
        most.append(len(running))
        apply(spark, spec, *rest, **more)
        running.remove(spec.name)

    monkeypatch.setattr(stages, "run_entity", watch)
    monkeypatch.setattr(stages, "SIDE_BY_SIDE_BYTES", 0)
    settings = Settings(source_format="parquet", source=str(folder), topic_prefix="delivery.public.", buckets=4)
    names = {"customers", "restaurants", "products"}
    stages.run_stages(spark, stages.Layout(str(tmp_path)), settings, names)
    assert max(most) == 1 and set(order) == names and order[-1] == "restaurants"


def test_staged_topics_make_room_once_landed(spark, monkeypatch):
    layouts, whole = [], registered.run_stages

    def run_stages(spark, layout, *rest):
        layouts.append(layout)
        whole(spark, layout, *rest)

    monkeypatch.setattr(registered, "run_stages", run_stages)
    registered.staged_revenue_by_city(spark, SF_DIR)
    root = layouts[0].root.rsplit("/", 1)[0]
    assert not list_paths(spark, f"{root}/topic.*")
    for name in ("restaurants", "orders"):
        raw = spark.read.parquet(layouts[0].raw(name))
        assert raw.count() == derive.topics(spark, SF_DIR)[name][0].count()
        packed = list_paths(spark, f"{layouts[0].raw(name)}/*.parquet")
        packed += list_paths(spark, f"{layouts[0].state(name)}/version=*/*/*/*.parquet")
        assert packed and all(p.endswith(".zstd.parquet") for p in packed)
