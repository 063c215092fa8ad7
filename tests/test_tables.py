"""Stored versions, change feeds, sync, and what a failed write leaves."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from support import rows_of

from tidemark.operators import cdc
from tidemark.operators.changefeed import CHANGE, apply_feed, change_feed
from tidemark.sources import manifest
from tidemark.sources.changes import stream_raw
from tidemark.sources.tables import (
    CdcTable,
    complete_versions,
    publish,
    published_feed,
    read_published,
    sync_table,
)

ARGUMENTS = dict(sequence_by="lsn", delete_when="op = 'd'", except_columns=["op", "lsn"])
SCHEMA = "id bigint, lsn bigint, op string, v int"


def changes(spark, seed, rows=300, ids=60, since=0):
    rng = random.Random(seed)
    data = [
        (rng.randrange(ids), since + i, "d" if rng.random() < 0.2 else "u", rng.randrange(4))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=4)


def kinds(path, version):
    return {p.name for p in (path / f"version={version}").glob("kind=*")}


def test_ended_versions_are_not_rewritten(spark, table, tmp_path):
    """Newer events add to them, and late ones patch them."""
    table.apply(changes(spark, 1), 0, **ARGUMENTS)
    table.apply(changes(spark, 2, since=1000), 1, **ARGUMENTS)
    assert kinds(tmp_path / "t", 1) == {"kind=delta", "kind=add"}
    table.apply(changes(spark, 3, rows=5, since=500), 2, **ARGUMENTS)
    assert kinds(tmp_path / "t", 2) == {"kind=add", "kind=patch"}
    assert sum(f.rows for f in table.manifest(2).files if f.version == 2) == 2 * 5
    every = changes(spark, 1).union(changes(spark, 2, since=1000)).union(
        changes(spark, 3, rows=5, since=500)
    )
    expected = cdc.visible(cdc.apply_changes(None, every, keys=["id"], scd_type=2, **ARGUMENTS))
    assert rows_of(table.read()) == rows_of(expected)
    assert rows_of(table.current()) == rows_of(cdc.current_versions(expected))


def test_data_without_its_manifest_is_ignored_and_replaced(spark, table, tmp_path):
    table.apply(changes(spark, 1), 0, **ARGUMENTS)
    before = rows_of(table.read())
    table.apply(changes(spark, 2, since=1000), 1, **ARGUMENTS)
    after = rows_of(table.read())
    next((tmp_path / "t" / "_manifest").glob("*1.json")).unlink()
    assert table.newest() == 0 and rows_of(table.read()) == before
    table.apply(changes(spark, 2, since=1000), 1, **ARGUMENTS)
    assert rows_of(table.read()) == after


def test_periodic_rewrite_keeps_the_rows(spark, tmp_path):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=4, rewrite_every=2)
    plain = CdcTable(spark, str(tmp_path / "p"), ["id"], 2, buckets=4)
    for version in range(3):
        part = changes(spark, version, since=version * 1000)
        table.apply(part, version, **ARGUMENTS)
        plain.apply(part, version, **ARGUMENTS)
    assert "kind=base" in kinds(tmp_path / "t", 2)
    assert rows_of(table.read()) == rows_of(plain.read())
    files = list((tmp_path / "t" / "version=2").rglob("*.parquet"))
    assert len(files) <= 4 * 2 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_expire_keeps_later_versions_readable(spark, tmp_path):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=4, rewrite_every=1)
    for version in range(3):
        table.apply(changes(spark, version, since=version * 1000), version, **ARGUMENTS)
    expected = {2: rows_of(table.read(2))}
    folders = len(list((tmp_path / "t").glob("*/*/*")))
    table.expire(2)
    assert len(list((tmp_path / "t").glob("*/*/*"))) < folders
    assert rows_of(table.read()) == expected[2]
    with pytest.raises(ValueError):
        table.read(1)
    table.apply(changes(spark, 3, since=3000), 3, **ARGUMENTS)
    assert rows_of(table.read(2)) == expected[2]


def test_an_empty_batch_commits_an_equal_version(spark, table):
    table.apply(changes(spark, 1), 0, **ARGUMENTS)
    before = rows_of(table.read())
    table.apply(changes(spark, 1).filter("false"), 1, **ARGUMENTS)
    assert table.newest() == 1 and rows_of(table.read()) == before


def test_a_first_batch_of_nothing(spark, table):
    table.apply(changes(spark, 1).filter("false"), 0, **ARGUMENTS)
    table.apply(changes(spark, 1), 1, **ARGUMENTS)
    assert table.read().count() > 0


def test_lookup_reads_one_bucket(spark, tmp_path):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 1, buckets=4)
    table.apply(changes(spark, 1), 0, **ARGUMENTS)
    live = {r["id"]: r["v"] for r in table.read().collect()}
    for ident in range(0, 60, 13):
        found = table.lookup(id=ident)
        assert [r["v"] for r in found.collect()] == ([live[ident]] if ident in live else [])
        assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id" in plan


def test_feed_leads_from_one_version_to_the_other(spark, tmp_path):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 1, buckets=4)
    table.apply(changes(spark, 1), 0, **ARGUMENTS)
    table.apply(changes(spark, 2, rows=40, since=1000), 1, **ARGUMENTS)
    feed = table.feed(0, 1)
    assert rows_of(feed) == rows_of(change_feed(table.read(0), table.read(1), ["id"]))
    assert {r[CHANGE] for r in feed.select(CHANGE).distinct().collect()} == {
        "insert", "delete", "update_preimage", "update_postimage",
    }
    start = apply_feed(None, table.feed(None, 0), ["id"], 0)
    moved = cdc.visible(apply_feed(start, feed, ["id"], 1))
    assert rows_of(moved) == rows_of(table.read(1))


def test_feed_sees_nulls_as_values(spark):
    before = spark.createDataFrame([(1, None), (2, 5), (3, None)], "id int, v int")
    after = spark.createDataFrame([(1, None), (2, None), (3, 7)], "id int, v int")
    got = rows_of(change_feed(before, after, ["id"]), [CHANGE, "id", "v"])
    assert set(got) == {
        ("update_preimage", 2, 5), ("update_postimage", 2, None),
        ("update_preimage", 3, None), ("update_postimage", 3, 7),
    }


def test_sync_follows_its_source(spark, tmp_path):
    source = CdcTable(spark, str(tmp_path / "s"), ["id"], 1, buckets=4)
    target = CdcTable(spark, str(tmp_path / "c"), ["id"], 1, buckets=2)
    assert sync_table(source, target) is None
    for version in range(4):
        source.apply(
            changes(spark, version, rows=80, since=version * 1000), version, **ARGUMENTS
        )
        if version != 1:  # a run may cover several versions
            assert sync_table(source, target) == version
            assert rows_of(target.read()) == rows_of(source.read())
    assert sync_table(source, target) == 3


def test_published_versions_and_their_feed(spark, tmp_path):
    path = str(tmp_path / "m")
    first = spark.range(100).withColumn("n", F.col("id") % 7)
    second = first.filter("id > 3").withColumn("n", F.when(F.col("id") == 9, 99).otherwise(F.col("n")))
    publish(first, path, 0, ["n"], ["id"])
    publish(second, path, 1, ["n"], ["id"])
    assert complete_versions(spark, path) == [0, 1]
    assert rows_of(read_published(spark, path)) == rows_of(second)
    assert published_feed(spark, path, ["id"], 0, 1).count() == 6


def test_feed_of_unchanged_null_keys_is_empty(spark):
    rows = [(None, 2), (1, 1), (2, None)]
    before = spark.createDataFrame([*rows, (3, 3)], "id int, v int")
    after = spark.createDataFrame([*rows, (4, 4)], "id int, v int")
    got = rows_of(change_feed(before, after, ["id"]), [CHANGE, "id", "v"])
    assert set(got) == {("delete", 3, 3), ("insert", 4, 4)}
    assert set(rows_of(change_feed(before, after.filter("id > 3"), ["id"]), ["id"])) == {
        (None,), (1,), (2,), (3,), (4,),
    }


def test_changing_tables_are_not_streamed(spark, tmp_path):
    """By what a folder holds, not by its name."""
    table = CdcTable(spark, str(tmp_path / "served-1"), ["id"], 1, buckets=2)
    table.apply(changes(spark, 1), 0, **ARGUMENTS)
    publish(spark.range(3), str(tmp_path / "mart"), 0, ["id"], ["id"])
    for name in ("served-1", "mart"):
        with pytest.raises(ValueError):
            stream_raw(spark, str(tmp_path / name))
    (tmp_path / "state_x").mkdir()
    assert stream_raw(spark, str(tmp_path / "state_x")).isStreaming


@pytest.mark.parametrize("scd_type", [1, 2])
def test_lower_and_foreign_versions_are_refused(spark, tmp_path, scd_type):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], scd_type, buckets=4)
    table.apply(changes(spark, 1), 0, writer="a", **ARGUMENTS)
    table.apply(changes(spark, 2, since=1000), 1, writer="a", **ARGUMENTS)
    before = rows_of(table.read())
    for version, writer in ((0, "a"), (0, "b"), (1, "b")):  # a lost checkpoint starts at 0 again
        with pytest.raises(ValueError):
            table.apply(changes(spark, 9), version, writer=writer, **ARGUMENTS)
    assert rows_of(table.read()) == before
    table.apply(changes(spark, 2, since=1000), 1, writer="a", **ARGUMENTS)
    assert rows_of(table.read()) == before


def test_a_failure_between_data_and_manifest_leaves_the_old_version(spark, table, monkeypatch):
    """Also when the newest version is written again: its files stay until then."""
    table.apply(changes(spark, 1), 0, writer="a", **ARGUMENTS)
    before = rows_of(table.read())
    for version in (0, 1):
        with monkeypatch.context() as m:
            m.setattr(manifest, "commit", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                table.apply(changes(spark, 2, since=1000), version, writer="a", **ARGUMENTS)
        assert table.newest() == 0 and rows_of(table.read()) == before
    table.apply(changes(spark, 2, since=1000), 1, writer="a", **ARGUMENTS)
    table.apply(changes(spark, 3, since=2000), 2, writer="a", **ARGUMENTS)
    every = changes(spark, 1).union(changes(spark, 2, since=1000)).union(changes(spark, 3, since=2000))
    expected = cdc.visible(cdc.apply_changes(None, every, keys=["id"], scd_type=2, **ARGUMENTS))
    assert rows_of(table.read()) == rows_of(expected)
    table.expire(2)
    assert rows_of(table.read()) == rows_of(expected)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_small_batch_writes_what_it_changes(spark, tmp_path, scd_type):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], scd_type, buckets=35)
    base = spark.range(20_000).selectExpr("id", "id AS lsn", "'u' AS op", "cast(id % 7 AS int) AS v")
    table.apply(base, 0, **ARGUMENTS)
    batch = spark.range(0, 20_000, 50).selectExpr("id", "id + 100000 AS lsn", "'u' AS op", "9 AS v")
    table.apply(batch, 1, **ARGUMENTS)
    folder = tmp_path / "t" / "version=1"
    assert spark.read.parquet(str(folder)).count() <= 3 * 400
    folders = list(folder.glob("kind=*/bucket=*"))
    assert len(list(folder.rglob("*.parquet"))) <= 2 * len(folders)
    assert table.current().filter("v = 9").count() == 400


def test_buckets_are_folded_by_what_has_piled_up(spark, tmp_path):
    """However the batches are numbered."""
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=2, rewrite_every=3)
    plain = CdcTable(spark, str(tmp_path / "p"), ["id"], 2, buckets=2)
    for k, version in enumerate(range(1, 21, 2)):
        for t in (table, plain):
            t.apply(changes(spark, version, rows=60, since=k * 1000), version, **ARGUMENTS)
        layers = {(f.bucket, f.kind in ("open", "delta"), f.version) for f in table.manifest(version).files}
        assert max(Counter((b, side) for b, side, _ in layers).values()) <= 4
    assert rows_of(table.read()) == rows_of(plain.read())
    assert rows_of(table.current()) == rows_of(plain.current())


def test_a_filter_on_the_clustering_column_skips_files(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(50_000).selectExpr("id", "cast(id % 100 AS int) AS day")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish(rows, path, 0, ["day"], ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    import pyarrow.parquet as pq

    bounds = []
    for file in (tmp_path / "m" / "version=0").glob("*.parquet"):
        stats = pq.ParquetFile(file).metadata.row_group(0).column(1).statistics
        bounds.append((stats.min, stats.max))
    assert len(bounds) > 1 and sum(a <= 7 <= b for a, b in bounds) < len(bounds)


def history_of(logs, **more):
    every = logs[0]
    for log in logs[1:]:
        every = every.union(log)
    return cdc.visible(cdc.apply_changes(None, every, keys=["id"], scd_type=2, **ARGUMENTS, **more))


def test_late_events_write_the_versions_they_split(spark, tmp_path):
    """A batch in which 1 of 1000 events is late."""
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=8)
    logs = [spark.range(4_000).selectExpr("id", f"id + {k * 100_000} AS lsn", "'u' AS op", f"cast({k} AS int) AS v") for k in range(3)]
    for version, log in enumerate(logs):
        table.apply(log, version, **ARGUMENTS)
    fresh = spark.range(2_000).selectExpr("id", "id + 300000 AS lsn", "'u' AS op", "3 AS v")
    late = spark.createDataFrame([(5, 50_000, "u", 9), (3_000, 50_000, "d", None)], SCHEMA)
    table.apply(fresh.union(late), 3, **ARGUMENTS)
    written = [f for f in table.manifest(3).files if f.version == 3]
    # 2000 new rows, the 2000 they end, and for each late event itself and the version it splits.
    assert sum(f.rows for f in written) == 2 * 2_000 + 2 * 2
    assert sum(f.rows for f in written if f.kind == "patch") == 2
    assert rows_of(table.read()) == rows_of(history_of([*logs, fresh, late]))


@pytest.mark.parametrize("seed", range(3))
def test_patched_history_equals_all_events_at_once(spark, tmp_path, seed):
    """Batches in any order, with repeats and equal sequences; folded buckets; earlier versions stay readable."""
    rng = random.Random(seed)
    data = [(rng.randrange(9), rng.randrange(40), rng.choice("uuud"), rng.randrange(5)) for _ in range(120)]
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=3, rewrite_every=rng.choice([2, 50]))
    logs, seen = [], {}
    for version in range(5):
        part = [r for r in data if rng.random() < 0.3] or data[:1]
        logs.append(spark.createDataFrame(part, SCHEMA))
        table.apply(logs[-1], version, **ARGUMENTS)
        expected = history_of(logs)
        seen[version] = rows_of(expected)
        assert rows_of(table.read()) == seen[version]
        for sequence in (rng.randrange(40), 100) if version % 2 else ():
            assert rows_of(table.as_of(sequence)) == rows_of(cdc.versions_as_of(expected, sequence)), (version, sequence)
    assert rows_of(table.read(1)) == seen[1] and rows_of(table.read(3)) == seen[3]


def test_patches_with_log_positions(spark, tmp_path):
    """Equal sequences are ordered by log position, also against stored versions."""
    schema = "id bigint, lsn bigint, op string, v int, position bigint"
    batches = [
        [(1, 10, "u", 1, 5), (1, 20, "u", 2, 6), (1, 30, "u", 3, 7)],
        [(1, 20, "u", 22, 9), (1, 10, "u", 11, 1)],  # the first comes after what is stored, the second before
        [(1, 30, "u", 33, 1), (1, 20, "u", 2, 6), (1, 15, "u", 15, 1)],
    ]
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=2)
    logs = [spark.createDataFrame(b, schema) for b in batches]
    for version, log in enumerate(logs):
        table.apply(log, version, tie_by=["position"], **ARGUMENTS)
    got = rows_of(table.read(), ["v", "__START_AT", "__END_AT"])
    assert set(got) == {(1, 10, 15), (15, 15, 20), (22, 20, 30), (3, 30, None)} and sum(got.values()) == 4


def test_an_early_as_of_read_opens_few_files(spark, tmp_path):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=4)
    logs = [spark.range(400).selectExpr("id", f"id + {k * 1_000} AS lsn", "'u' AS op", f"cast({k} AS int) AS v") for k in range(6)]
    for version, log in enumerate(logs):
        table.apply(log, version, **ARGUMENTS)
    early = table.as_of(1_500)
    opened, every = set(early.inputFiles()), {f.path for f in table.manifest(5).files}
    # Of six batches the first two hold rows that had started, the next one those that end later.
    assert len({p.split("version=")[1].split("/")[0] for p in opened}) == 3 and 2 * len(opened) < len(every)
    assert rows_of(early) == rows_of(cdc.versions_as_of(history_of(logs), 1_500))


def test_a_read_lists_one_manifest(spark, tmp_path, monkeypatch):
    table = CdcTable(spark, str(tmp_path / "t"), ["id"], 2, buckets=4)
    for version in range(3):
        table.apply(changes(spark, version, since=version * 1000), version, **ARGUMENTS)
    asked = []
    listed, loaded = manifest.list_paths, manifest._read_bytes
    monkeypatch.setattr(manifest, "list_paths", lambda s, p: (asked.append(p), listed(s, p))[1])
    monkeypatch.setattr(manifest, "_read_bytes", lambda s, p: (asked.append(p), loaded(s, p))[1])
    table.read(2)
    assert [p.rsplit("/", 1)[1] for p in asked] == ["*.json", "000000000002.json"]


def test_a_feed_of_layers_compares_only_their_keys(spark, tmp_path):
    """Buckets with new layers by the keys in those, folded ones as a whole."""
    for every in (50, 1):
        table = CdcTable(spark, str(tmp_path / f"t{every}"), ["id"], 1, buckets=4, rewrite_every=every)
        table.apply(changes(spark, 1), 0, **ARGUMENTS)
        for version in (1, 2, 3):
            table.apply(changes(spark, 1 + version, rows=9, since=900 - 300 * version), version, **ARGUMENTS)
        for start in (0, 1, 2):
            assert rows_of(table.feed(start, 3)) == rows_of(change_feed(table.read(start), table.read(3), ["id"]))


def test_huge_keys_are_counted_without_reading_last_events(spark, tmp_path, monkeypatch):
    table = CdcTable(spark, f"{tmp_path}/t", ["id"], 2, buckets=2)
    rows = lambda *more: spark.createDataFrame(list(more), "id long, v string, lsn long, op string")
    arguments = dict(sequence_by="lsn", delete_when="op = 'd'", except_columns=["op", "lsn"])
    table.apply(rows((1, "a", 10, "c"), (2, "b", 11, "c")), 0, **arguments)
    read, history = [], cdc.history

    def watched(events, keys, limits, measured_on=None, *more, **named):
        read.extend((events if measured_on is None else measured_on).inputFiles())
        return history(events, keys, limits, measured_on, *more, **named)

    monkeypatch.setattr(cdc, "history", watched)
    table.apply(rows((1, "c", 20, "u"), (2, "z", 5, "u"), (3, "d", 21, "c")), 1, **arguments)
    assert not [f for f in read if "kind=open" in f]
    got = {(r["id"], r["v"], r["__START_AT"], r["__END_AT"]) for r in table.read().collect()}
    assert got == {(1, "a", 10, 20), (1, "c", 20, None), (2, "z", 5, 11), (2, "b", 11, None), (3, "d", 21, None)}
