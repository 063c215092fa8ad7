"""Published tables that are laid out along a curve through several columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from support import rows_of

from tidemark.operators.curve import with_curve_key
from tidemark.sources.tables import (
    expire_published,
    files_between,
    find_published,
    publish,
    published_versions,
    read_published,
)

DAY = dt.date(2024, 1, 1)


def days(spark, n=40_000, seed=1):
    """A third of all rows in one restaurant; some days and restaurants unknown."""
    rng = random.Random(seed)
    data = [
        (
            None if rng.random() < 0.01 else DAY + dt.timedelta(rng.randrange(365)),
            None if rng.random() < 0.01 else 7 if rng.random() < 0.33 else rng.randrange(500),
            i,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, "day date, restaurant bigint, id bigint")


def test_filters_on_either_column_skip_most_files(spark, tmp_path):
    rows, path = days(spark), str(tmp_path / "mart")
    publish(rows, path, 0, ["day", "restaurant"], ["id"], files=64)
    assert rows_of(read_published(spark, path)) == rows_of(rows)
    for column, value in (("day", DAY + dt.timedelta(200)), ("restaurant", 333)):
        opened = files_between(spark, path, column, value, value)
        assert 0 < len(opened) <= 64 / 3
        found = find_published(spark, path, column, value, value)
        assert set(p.rsplit("/", 1)[1] for p in opened) == {p.rsplit("/", 1)[1] for p in found.inputFiles()}
        assert rows_of(found) == rows_of(rows.filter(F.col(column) == value))
    # Files are of like size although one value has a third of the rows.
    sizes = [r["count"] for r in read_published(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 3 * rows.count() / 64


def test_ranges_of_the_hot_value_and_of_none(spark, tmp_path):
    rows, path = days(spark, 5_000), str(tmp_path / "mart")
    publish(rows, path, 0, ["day", "restaurant"], ["id"], files=8)
    assert rows_of(find_published(spark, path, "restaurant", 7, 7)) == rows_of(rows.filter("restaurant = 7"))
    assert files_between(spark, path, "restaurant", 900, 950) == []
    assert find_published(spark, path, "restaurant", 900, 950).count() == 0
    # Without ranges for a column, or where a run ended before they were kept, all files are read.
    assert files_between(spark, path, "id", 3, 4) is None
    assert find_published(spark, path, "id", 3, 4).count() == 2
    for part in (tmp_path / "mart" / "_ranges" / "version=0").glob("*SUCCESS*"):
        part.unlink()
    assert files_between(spark, path, "day", DAY, DAY) is None
    assert rows_of(find_published(spark, path, "day", DAY, DAY)) == rows_of(rows.filter(F.col("day") == DAY))


def test_versions_written_again_and_expired(spark, tmp_path):
    path = str(tmp_path / "mart")
    for version, seed in ((0, 1), (1, 2), (1, 3)):
        publish(days(spark, 500, seed), path, version, ["day", "restaurant"], ["id"], files=4)
    again = days(spark, 500, 3).filter("restaurant = 7")
    assert rows_of(find_published(spark, path, "restaurant", 7, 7)) == rows_of(again)
    expire_published(spark, path, 1)
    assert published_versions(spark, path) == [1]
    assert [p.name for p in (tmp_path / "mart" / "_ranges").iterdir()] == ["version=1"]


@pytest.mark.parametrize("n", [0, 1, 300])
def test_all_types_empty_tables_and_nulls(spark, tmp_path, n):
    rows = spark.range(n).select(
        "id", F.lit(None).cast("bigint").alias("none"), F.concat(F.lit("name "), "id").alias("s"),
        (F.col("id") % 2 == 0).alias("b"), F.when(F.col("id") % 3 > 0, F.lit(float("nan"))).alias("f"),
        F.timestamp_seconds("id").alias("t"), (F.col("id") / 7).cast("decimal(20,4)").alias("d"),
    )
    path = str(tmp_path / "mart")
    publish(rows, path, 0, ["none", "s", "b", "f", "t", "d"], ["id"], files=3)
    back = read_published(spark, path)
    assert rows_of(back.drop("f")) == rows_of(rows.drop("f")) and back.filter("isnan(f)").count() == rows.filter("isnan(f)").count()
    assert find_published(spark, path, "s", "name 1", "name 1").count() == (n > 1)


def test_key_rises_with_each_column_alone(spark):
    rows = spark.range(1000).select("id", F.format_string("%05d", "id").alias("s"), F.lit(1).alias("one"))
    for column in ("id", "s"):
        keys = [r.k for r in with_curve_key(rows, [column, "one"], "k").orderBy("id").collect()]
        assert keys == sorted(keys) and len(set(keys)) >= 200
    with pytest.raises(ValueError):
        with_curve_key(rows, [], "k")
