"""Decoding and rules on records that are odd in every way known."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType
from support import rows_of

from tidemark.operators import quality
from tidemark.operators.decode import CAST_ERRORS, decode_changes
from tidemark.plans.entities import ORDERS, READABLE_AMOUNTS
from tidemark.sources.changes import RAW_SCHEMA, encode_changes
from tidemark.streaming.flows import route_changes

ROW = StructType().add("order_id", LongType()).add("total_amount", StringType())
RULES = {"valid_key": "order_id IS NOT NULL", "non_negative_amount": "total_amount >= 0"}


def event(lsn, after, before=None, op="c"):
    payload = {"after": after, "before": before, "op": op, "source": {"lsn": lsn}}
    return json.dumps({"payload": payload})


def order(ident, amount):
    return {"order_id": ident, "total_amount": amount}


# name, value, decoded (op, lsn, order_id, total_amount), flag
EDGES = [
    ("insert", event(10, order(1, "135.00")), ("c", 10, 1, Decimal("135.00")), False),
    ("negative", event(11, order(2, "-5.00")), ("c", 11, 2, Decimal("-5.00")), True),
    ("delete", event(12, None, order(1, "135.00"), "d"), ("d", 12, 1, None), None),
    ("null value", None, (None, None, None, None), True),
    ("malformed", "{oops", (None, None, None, None), True),
    ("no payload", "{}", (None, None, None, None), True),
    ("bad id", event(13, order("abc", "1.00")), ("c", 13, None, Decimal("1.00")), True),
    ("null amount", event(14, order(5, None)), ("c", 14, 5, None), None),
    ("extra scale", event(15, order(6, "1.005")), ("c", 15, 6, Decimal("1.01")), False),
]


def raw_records(spark, values):
    rows = [
        (None, None if v is None else bytearray(v.encode()), "t", 0, i, None, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


@pytest.fixture(scope="module")
def decoded(spark):
    raw = raw_records(spark, [value for _, value, _, _ in EDGES])
    return decode_changes(raw, ROW, ["order_id"], position=True)


def by_offset(df, *columns):
    rows = df.select("_offset", *columns).collect()
    return {EDGES[r["_offset"]][0]: tuple(r)[1:] for r in rows}


def test_decoding(decoded):
    got = by_offset(decoded, "op", "lsn", "order_id", "total_amount")
    assert got == {name: row for name, _, row, _ in EDGES}
    assert dict(decoded.dtypes)["total_amount"] == "decimal(10,2)"


def test_flag_is_three_valued(decoded):
    got = by_offset(decoded.withColumn("f", quality.quarantine_flag(RULES)), "f")
    assert got == {name: (flag,) for name, _, _, flag in EDGES}


@pytest.mark.parametrize(
    "policy, delete, null_amount",
    [
        ("three_valued", None, None),
        ("quarantine", "quarantine", "quarantine"),
        ("pass_deletes", "valid", "quarantine"),
    ],
)
def test_policies(decoded, policy, delete, null_amount):
    routed = quality.route_rows(decoded, RULES, policy, keys=["order_id"])
    expected = {name: "quarantine" if flag else "valid" for name, _, _, flag in EDGES}
    expected.update({"delete": delete, "null amount": null_amount})
    assert by_offset(routed, quality.ROUTE) == {n: (v,) for n, v in expected.items()}
    valid, rejects = quality.split_by_rules(decoded, RULES, policy, keys=["order_id"])
    assert set(by_offset(valid)) == {n for n, v in expected.items() if v == "valid"}
    assert set(by_offset(rejects)) == {n for n, v in expected.items() if v == "quarantine"}


def test_unknown_policy_is_refused(decoded):
    with pytest.raises(ValueError):
        quality.route_rows(decoded, RULES, "guess")


@pytest.mark.parametrize("amount", ["abc", "123456789012.00"])
def test_unreadable_amounts_are_set_aside_with_a_reason(spark, amount):
    after = {"order_id": 1, "total_amount": amount, "status": "created"}
    raw = raw_records(spark, [event(1, after)])
    changes = decode_changes(raw, ORDERS.row, ORDERS.keys, position=True, diagnostics=True)
    row = route_changes(changes, ORDERS).collect()[0]
    assert row["total_amount"] is None and row[CAST_ERRORS] == ["total_amount"]
    assert row[quality.ROUTE] == quality.QUARANTINE
    assert row["reasons"] == ["non_negative_amount", *READABLE_AMOUNTS]
    assert amount in row["_raw"]


def test_a_change_without_sequence_is_a_reject(spark):
    raw = raw_records(spark, [event(None, {"order_id": 1, "total_amount": "1.00"})])
    changes = decode_changes(raw, ORDERS.row, ORDERS.keys, position=True, diagnostics=True)
    row = route_changes(changes, ORDERS).collect()[0]
    assert (row[quality.ROUTE], row["reasons"]) == (quality.QUARANTINE, ["sequence_present"])


def test_expect_or_drop_drops_undecided_rows(decoded):
    assert set(by_offset(quality.expect_or_drop(decoded, RULES))) == {"insert", "extra scale"}


def test_observed_counts_equal_the_report(decoded):
    seen = Observation("q")
    quality.observe_rules(decoded, RULES, seen).write.format("noop").mode("overwrite").save()
    counts = seen.get
    assert counts["rows"] == len(EDGES)
    report = {(r["op"], r["rule"]): r for r in quality.rule_report(decoded, RULES).collect()}
    for rule in RULES:
        for outcome in ("passed", "failed", "unknown"):
            assert counts[f"{rule}.deletes.{outcome}"] == report["d", rule][outcome]
            writes = sum(report[op, rule][outcome] for op in ("c", None))
            assert counts[f"{rule}.writes.{outcome}"] == writes
    assert counts["non_negative_amount.deletes.unknown"] == 1


def test_reasons(decoded):
    _, rejects = quality.split_by_rules(decoded, RULES, "quarantine")
    got = {r["reason"]: r["rejects"] for r in quality.reason_counts(rejects, RULES).collect()}
    # Three unreadable records and the bad id lack a key; the former, the
    # delete, the negative and the null amount fail on the amount.
    assert got == {"valid_key": 4, "non_negative_amount": 6}


def test_encoding_round_trip_keeps_composite_keys_and_deletes(spark):
    rows = spark.createDataFrame(
        [("c", 1, 1, 7, "1.50"), ("d", 2, 1, 7, None)],
        "op string, lsn bigint, order_id bigint, line bigint, total_amount string",
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
    row = (
        StructType().add("order_id", LongType()).add("line", LongType())
        .add("total_amount", StringType())
    )
    keys = ["order_id", "line"]
    back = decode_changes(encode_changes(rows, keys, row.names, "t"), row, keys)
    assert rows_of(back) == rows_of(rows)
