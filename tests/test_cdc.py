"""Laws of change application, on random logs checked against plain Python."""

import random

import pytest
from pyspark.sql import functions as F
from support import rows_of

from tidemark.operators import cdc, ordered
from tidemark.settings import SkewLimits
from tidemark.sources.tables import CdcTable

KEYS = ["log", "id"]
SCHEMA = "log int, id int, lsn bigint, op string, a int, b string, _partition int, _offset bigint"
ARGUMENTS = dict(sequence_by="lsn", delete_when="op = 'd'", except_columns=["op", "lsn"])
TIE = ["_partition", "_offset"]
TIGHT = SkewLimits(rows=6, groups=100_000)
ROOMY = SkewLimits()


def random_log(log, rng):
    """Events of a few keys, with repeated sequences, deletes and redelivery."""
    events, offset = [], 0
    for _ in range(rng.randint(1, 25)):
        offset += 1
        deleted = rng.random() < 0.2
        events.append(
            (
                log,
                rng.randint(1, 3),
                rng.randint(1, 15),
                "d" if deleted else "u",
                None if deleted else rng.randint(0, 2),
                None if deleted else rng.choice(["x", "y", None]),
                rng.randint(0, 1),
                offset,
            )
        )
    return events + rng.sample(events, len(events) // 4)


def expected_history(events, tie):
    """(log, id, a, b, start, end) of every version, by brute force."""
    last = {}
    for e in events:
        order = (e[6], e[7]) if tie else (e[3] == "d", _null_first(e[4]), _null_first(e[5]))
        key = (e[0], e[1], e[2])
        if key not in last or order > last[key][0]:
            last[key] = (order, e)
    by_key = {}
    for log, ident, lsn in sorted(last):
        by_key.setdefault((log, ident), []).append(last[log, ident, lsn][1])
    versions = []
    for run in by_key.values():
        for e, after in zip(run, [*run[1:], None]):
            if e[3] != "d":
                versions.append((e[0], e[1], e[4], e[5], e[2], after[2] if after else None))
    return sorted(versions, key=str)


def _null_first(value):
    return (0, "") if value is None else (1, str(value))


def listed(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def logs():
    rng = random.Random(7)
    return [e for log in range(250) for e in random_log(log, rng)]


@pytest.fixture(scope="module")
def batches(logs):
    """The same events cut at random into batches, shuffled, a part of them twice."""
    rng = random.Random(8)
    parts = [[], [], []]
    for e in logs:
        for i in rng.sample(range(3), 1 if rng.random() < 0.9 else 2):
            parts[i].append(e)
    for part in parts:
        rng.shuffle(part)
    return parts


VERSION_COLUMNS = ["log", "id", "a", "b", cdc.START, cdc.END]


@pytest.mark.parametrize("tie", [None, TIE])
@pytest.mark.parametrize("limits", [ROOMY, TIGHT])
def test_history_equals_brute_force(spark, logs, tie, limits):
    df = spark.createDataFrame(logs, SCHEMA)
    if tie is None:
        df = df.drop(*TIE)
    hot = ordered.find_hot_groups(df, KEYS, "lsn", limits)
    assert (hot is None) == (limits is ROOMY)
    state = cdc.apply_changes(
        None, df, keys=KEYS, scd_type=2, tie_by=tie, limits=limits, **ARGUMENTS
    )
    assert listed(cdc.visible(state), VERSION_COLUMNS) == expected_history(logs, tie)


@pytest.mark.parametrize("tie", [None, TIE])
def test_latest_is_the_open_version(spark, logs, tie):
    df = spark.createDataFrame(logs, SCHEMA)
    if tie is None:
        df = df.drop(*TIE)
    state = cdc.apply_changes(None, df, keys=KEYS, scd_type=1, tie_by=tie, **ARGUMENTS)
    expected = [v[:4] for v in expected_history(logs, tie) if v[5] is None]
    assert listed(cdc.visible(state), ["log", "id", "a", "b"]) == sorted(expected, key=str)


@pytest.mark.parametrize("tie", [None, TIE])
@pytest.mark.parametrize("scd_type", [1, 2])
def test_batches_in_any_order_equal_one_shot(spark, logs, batches, scd_type, tie, tmp_path):
    """Law (a), through stored versions; each batch is also replayed once."""
    columns = VERSION_COLUMNS if scd_type == 2 else ["log", "id", "a", "b"]
    expected = expected_history(logs, tie)
    if scd_type == 1:
        expected = sorted((v[:4] for v in expected if v[5] is None), key=str)
    for turn, order in enumerate([(0, 1, 2), (2, 0, 1)]):
        table = CdcTable(
            spark, str(tmp_path / f"t{turn}"), KEYS, scd_type, buckets=4, limits=TIGHT
        )
        for version, part in enumerate(order):
            df = spark.createDataFrame(batches[part], SCHEMA)
            if tie is None:
                df = df.drop(*TIE)
            table.apply(df, version, tie_by=tie, **ARGUMENTS)
        table.apply(df, version, tie_by=tie, **ARGUMENTS)
        assert listed(table.read(), columns) == expected
        # Replaying an earlier batch as a new one changes nothing.
        again = spark.createDataFrame(batches[order[0]], SCHEMA)
        again = again.drop(*TIE) if tie is None else again
        table.apply(again, 3, tie_by=tie, **ARGUMENTS)
        assert listed(table.read(), columns) == expected


def test_pure_merge_equals_one_shot(spark, logs, batches):
    state = None
    for part in batches[:2]:
        df = spark.createDataFrame(part, SCHEMA)
        state = cdc.apply_changes(
            state, df, keys=KEYS, scd_type=2, tie_by=TIE, limits=TIGHT, **ARGUMENTS
        )
    expected = expected_history(batches[0] + batches[1], TIE)
    assert listed(cdc.visible(state), VERSION_COLUMNS) == expected


def test_intervals_do_not_overlap_and_one_is_open(spark, logs):
    df = spark.createDataFrame(logs, SCHEMA)
    versions = cdc.visible(
        cdc.apply_changes(None, df, keys=KEYS, scd_type=2, tie_by=TIE, **ARGUMENTS)
    )
    per_key = {}
    for row in versions.collect():
        per_key.setdefault((row["log"], row["id"]), []).append((row[cdc.START], row[cdc.END]))
    for intervals in per_key.values():
        intervals.sort()
        for (_, end), (start, _) in zip(intervals, intervals[1:]):
            assert end is not None and end <= start
    newest = max(e[2] for e in logs)
    as_of = rows_of(cdc.versions_as_of(versions, newest))
    assert as_of == rows_of(cdc.current_versions(versions))


@pytest.mark.parametrize("sequence", [3, 8])
def test_as_of_equals_history_of_a_prefix(spark, logs, sequence):
    df = spark.createDataFrame(logs, SCHEMA)

    def history(changes):
        return cdc.visible(
            cdc.apply_changes(None, changes, keys=KEYS, scd_type=2, tie_by=TIE, **ARGUMENTS)
        )

    early = cdc.current_versions(history(df.filter(F.col("lsn") <= sequence)))
    at = cdc.versions_as_of(history(df), sequence)
    assert rows_of(at.drop(cdc.END)) == rows_of(early.drop(cdc.END))


@pytest.mark.parametrize("limits", [ROOMY, TIGHT])
def test_collapse_unchanged(spark, logs, limits):
    df = spark.createDataFrame(logs, SCHEMA)
    versions = cdc.visible(
        cdc.apply_changes(None, df, keys=KEYS, scd_type=2, tie_by=TIE, **ARGUMENTS)
    )
    expected = []
    for v in sorted(expected_history(logs, TIE), key=lambda v: (v[0], v[1], v[4])):
        last = expected[-1] if expected else None
        if last and last[:2] == v[:2] and last[2] == v[2] and last[5] == v[4]:
            expected[-1] = (*last[:5], v[5])
        else:
            expected.append(v)
    got = cdc.collapse_unchanged(versions, KEYS, ["a"], limits)
    assert listed(got, VERSION_COLUMNS) == sorted(expected, key=str)


def test_rows_without_key_or_sequence_are_set_aside(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, "u"), (None, 2, 6, "u"), (1, 3, None, "u")],
        "log int, id int, lsn bigint, op string",
    )
    assert cdc.usable_changes(df, KEYS, "lsn").count() == 1
    assert cdc.unusable_changes(df, KEYS, "lsn").count() == 2
    state = cdc.apply_changes(None, df, keys=KEYS, scd_type=2, **ARGUMENTS)
    assert state.count() == 1


def test_unknown_history_type_is_refused(spark):
    df = spark.createDataFrame([(1, 1, 5, "u")], "log int, id int, lsn bigint, op string")
    with pytest.raises(ValueError):
        cdc.apply_changes(None, df, keys=KEYS, scd_type=3, **ARGUMENTS)


@pytest.mark.parametrize("keys, rows", [(["id"], 300), (["id"], 10), ([], 300), ([], 20)])
def test_a_key_with_most_rows_is_cut_into_segments(spark, keys, rows):
    """A hot key gives the same history, and no task gets all of its rows."""
    n = 4000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("id"),
        (F.col("id") * 7 % n).alias("lsn"),
        F.lit(1).alias("v"),
    )
    limits = SkewLimits(rows=rows)
    hot = ordered.find_hot_groups(df, keys, "lsn", limits)
    assert hot.count() == 1
    cold, cut = ordered._split_hot(df, keys, "lsn", hot)
    assert cold.count() + cut.count() == n
    biggest = cut.groupBy(*keys, ordered.SEGMENT).count().agg(F.max("count")).first()[0]
    assert biggest <= 2 * limits.threshold(n)
    counted = cut.join(F.broadcast(hot.select("__bounds"))).filter(
        F.col(ordered.SEGMENT) != F.size(F.filter("__bounds", lambda b: b <= F.col("lsn")))
    )
    assert counted.count() == 0
    wanted = {"after": ("lsn", 1), "before": ("lsn", -1)}
    got = ordered.with_neighbours(df, keys, ["lsn"], wanted, limits)
    plain = ordered.with_neighbours(df, keys or [], ["lsn"], wanted, SkewLimits())
    assert rows_of(got) == rows_of(plain)
    total = ordered.with_running_total(df, "lsn", "v", "total", limits)
    assert total.filter(F.col("total") != F.col("lsn") + 1).count() == 0
    assert total.count() == n
