"""Aggregates kept up from feeds against ones computed anew."""

import random

import pytest
from support import rows_of

from tidemark.operators import signed
from tidemark.plans import marts
from tidemark.plans.maintained import MAINTAINED, Maintained
from tidemark.settings import Settings
from tidemark.sources import manifest
from tidemark.sources.tables import CdcTable

ARGUMENTS = dict(sequence_by="lsn", delete_when="op = 'd'", except_columns=["op", "lsn"])
SCHEMAS = {
    "orders": ("order_id bigint, restaurant_id bigint, total_amount decimal(10,2), created_at string", 2),
    "restaurants": ("restaurant_id bigint, name string, city string", 2),
    "products": ("product_id bigint, restaurant_id bigint, name string, price decimal(10,2)", 2),
    "order_items": ("order_item_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)", 2),
}
BUILD = {
    "daily_orders_by_restaurant": (marts.daily_orders_by_restaurant, ["orders", "restaurants"]),
    "revenue_by_city": (marts.revenue_by_city, ["orders", "restaurants"]),
    "top_products": (marts.top_products, ["order_items", "products", "restaurants"]),
}


def some_changes(rng, name: str, n: int, since: int) -> list[tuple]:
    """Random upserts and deletes of few keys, with NULLs, unreadable dates and renames."""
    from decimal import Decimal

    amount = lambda: rng.choice([None, Decimal(rng.randrange(-500, 9999)) / 100])
    place = lambda: rng.choice([None, 1, 2, 3, 4, 99])
    make = {
        "orders": lambda: (rng.randrange(25), place(), amount(), rng.choice([None, "2026-01-05T10:00:00Z", "2026-01-06T00:00:00Z", "no date"])),
        "restaurants": lambda: (rng.randrange(1, 5), rng.choice(["Ann", "Bob", "Cem", None]), rng.choice(["X", "Y", None])),
        "products": lambda: (rng.randrange(9), place(), rng.choice(["tea", "rye", None]), amount()),
        "order_items": lambda: (rng.randrange(25), rng.choice([None, *range(9)]), rng.choice([None, 1, 2, 5]), amount()),
    }[name]
    return [(*make(), "d" if rng.random() < 0.2 else "u", since + rng.randrange(-30, 60)) for _ in range(n)]


def inputs(spark, path):
    return {n: CdcTable(spark, f"{path}/{n}", [s.split()[0]], t, buckets=4) for n, (s, t) in SCHEMAS.items()}


def change(spark, tables, name, rows, version):
    df = spark.createDataFrame(rows, SCHEMAS[name][0] + ", op string, lsn bigint")
    tables[name].apply(df, version, **ARGUMENTS)


@pytest.mark.parametrize("name", sorted(BUILD))
def test_kept_up_equals_computed_anew(spark, tmp_path, name):
    """After batches with updates, deletes, late events, renames and moves; some runs skip a batch."""
    rng = random.Random(name)
    tables, (build, used) = inputs(spark, tmp_path), BUILD[name]
    kept = Maintained(spark, MAINTAINED[name], str(tmp_path / "kept"), Settings(buckets=4))
    assert kept.refresh(tables) is None
    for version in range(4):
        for t in used:
            if version == 0 or rng.random() < 0.8:
                change(spark, tables, t, some_changes(rng, t, rng.choice([3, 25]), version * 40), version)
        if version != 1:
            kept.refresh(tables)
            expected = build(*[tables[t].current() for t in used], Settings())
            assert rows_of(kept.read()) == rows_of(expected), version
            assert [f.dataType for f in kept.read().schema] == [f.dataType for f in expected.schema]
    newest = kept.result.newest()
    assert kept.refresh(tables) == newest == kept.result.newest()  # nothing new, nothing written


def test_a_refresh_that_failed_halfway_is_carried_on(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    tables = inputs(spark, tmp_path)
    kept = Maintained(spark, MAINTAINED["revenue_by_city"], str(tmp_path / "kept"), Settings(buckets=4))
    for version in range(2):
        for t in ("orders", "restaurants"):
            change(spark, tables, t, some_changes(rng, t, 25, version * 40), version)
        if version == 0:
            kept.refresh(tables)
    commit = manifest.commit

    def fails(spark, path, m):
        if path.endswith("/result"):
            raise RuntimeError("lost")
        commit(spark, path, m)

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", fails)
        with pytest.raises(RuntimeError):
            kept.refresh(tables)
    assert kept.sums.newest() == 1 and kept.result.newest() == 0
    # More has come in the meantime; the run that failed is ended first, then the rest is taken in.
    change(spark, tables, "orders", some_changes(rng, "orders", 10, 90), 2)
    kept.refresh(tables)
    assert kept.sums.newest() == kept.result.newest() == 1
    kept.refresh(tables)
    expected = marts.revenue_by_city(tables["orders"].current(), tables["restaurants"].current(), Settings())
    assert rows_of(kept.read()) == rows_of(expected)


def test_a_small_batch_reads_and_writes_only_its_buckets(spark, tmp_path, monkeypatch):
    tables = {
        "orders": CdcTable(spark, str(tmp_path / "orders"), ["order_id"], 2, buckets=64),
        "restaurants": CdcTable(spark, str(tmp_path / "restaurants"), ["restaurant_id"], 2, buckets=64),
    }
    orders = spark.range(20_000).selectExpr(
        "id AS order_id", "id % 200 AS restaurant_id", "cast(id % 50 AS decimal(10,2)) AS total_amount",
        "'2026-01-05' AS created_at", "'u' AS op", "id AS lsn")
    places = spark.range(200).selectExpr("id AS restaurant_id", "concat('r', id) AS name", "concat('c', id % 7) AS city", "'u' AS op", "id AS lsn")
    tables["orders"].apply(orders, 0, **ARGUMENTS)
    tables["restaurants"].apply(places, 0, **ARGUMENTS)
    kept = Maintained(spark, MAINTAINED["daily_orders_by_restaurant"], str(tmp_path / "kept"), Settings(buckets=64))
    kept.refresh(tables)
    tables["orders"].apply(orders.filter("restaurant_id = 7").selectExpr("order_id", "restaurant_id", "cast(1 AS decimal(10,2)) AS total_amount", "created_at", "op", "lsn + 100000 AS lsn"), 1, **ARGUMENTS)
    tables["restaurants"].apply(places.filter("restaurant_id = 9").selectExpr("restaurant_id", "'new' AS name", "city", "op", "lsn + 100000 AS lsn"), 1, **ARGUMENTS)
    read = []
    load = CdcTable._load
    monkeypatch.setattr(CdcTable, "_load", lambda self, files, columns: (read.extend((self.path, f.bucket) for f in files), load(self, files, columns))[1])
    kept.refresh(tables)
    touched = {b for path, b in read if path.endswith("/sums")}
    assert 1 <= len(touched) <= 2  # where the one and the other restaurant's sums lie
    for table in (kept.sums, kept.result):
        assert len({f.bucket for f in table.manifest(1).files if f.version == 1}) <= 3
    changed = {b for path, b in read if path.endswith("/orders")}
    assert len(changed) < 64  # 100 orders' buckets
    monkeypatch.undo()
    expected = marts.daily_orders_by_restaurant(tables["orders"].current(), tables["restaurants"].current(), Settings())
    assert rows_of(kept.read()) == rows_of(expected)


def test_signed_rows_cancel(spark):
    rows = spark.createDataFrame([(1, None, 1), (1, None, -1), (2, "a", 1), (2, "a", 1)], "k int, v string, __sign bigint")
    assert rows_of(signed.netted(rows), ["k", "v", "__sign"]) == {(2, "a", 2): 1}
