"""Named data-quality rules: drop, count, or set rejects aside.

Rules are a dict of name to SQL predicate. Predicates are three-valued; every
function says what it does with NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROUTE = "_route"
VALID, QUARANTINE = "valid", "quarantine"
NULL_POLICIES = ("three_valued", "quarantine", "pass_deletes")


def all_rules(rules: dict[str, str]) -> Column:
    """Conjunction of the rules, NULL where it is undecided."""
    return F.expr(" AND ".join(f"({r})" for r in rules.values()) or "TRUE")


def quarantine_flag(rules: dict[str, str]) -> Column:
    """Negated conjunction: true, false, or NULL where undecided."""
    return ~all_rules(rules)


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Keep the rows that pass every rule; NULL does not pass."""
    return df.filter(F.coalesce(all_rules(rules), F.lit(False)))


def _outcomes(rule: str, among: Column | None = None) -> dict[str, Column]:
    """Counters of passing, failing and undecided rows."""
    verdict = F.expr(rule)
    every = F.lit(True) if among is None else among
    return {
        "passed": F.count_if(every & verdict),
        "failed": F.count_if(every & ~verdict),
        "unknown": F.count_if(every & verdict.isNull()),
    }


def observe_rules(
    df: DataFrame,
    rules: dict[str, str],
    observation: Observation | str,
    delete_when: str = "op = 'd'",
) -> DataFrame:
    """Count rule outcomes as rows pass by; no row is changed or dropped.

    Deletes carry no data columns, so they are counted apart. A batch reads the
    counts from its Observation, a stream from its progress under that name.
    """
    deleted = F.coalesce(F.expr(delete_when), F.lit(False))
    metrics = [F.count(F.lit(1)).alias("rows")]
    for name, rule in rules.items():
        for part, among in (("writes", ~deleted), ("deletes", deleted)):
            for outcome, counter in _outcomes(rule, among).items():
                metrics.append(counter.alias(f"{name}.{part}.{outcome}"))
    return df.observe(observation, *metrics)


def rule_report(df: DataFrame, rules: dict[str, str], by: str = "op") -> DataFrame:
    """Outcomes per rule and value of ``by``, from one aggregation."""
    counters = [
        F.struct(
            F.lit(name).alias("rule"),
            *[c.alias(outcome) for outcome, c in _outcomes(rule).items()],
        )
        for name, rule in rules.items()
    ]
    return (
        df.groupBy(by)
        .agg(F.array(*counters).alias("outcomes"))
        .select(by, F.explode("outcomes").alias("o"))
        .select(by, "o.rule", "o.passed", "o.failed", "o.unknown")
    )


def route_rows(
    df: DataFrame,
    rules: dict[str, str],
    null_policy: str,
    *,
    keys: list[str] | None = None,
    delete_when: str = "op = 'd'",
) -> DataFrame:
    """Mark each row as valid, quarantined, or neither (NULL).

    ``three_valued`` leaves undecided rows in neither feed, which loses deletes;
    ``quarantine`` sets them aside; ``pass_deletes`` lets deletes with a key
    through and sets the others aside.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    flag = quarantine_flag(rules)
    route = F.when(flag, QUARANTINE).when(~flag, VALID)
    if null_policy == "quarantine":
        route = route.otherwise(QUARANTINE)
    elif null_policy == "pass_deletes":
        keyed = F.coalesce(F.expr(delete_when), F.lit(False))
        for key in keys or []:
            keyed = keyed & F.col(key).isNotNull()
        route = F.when(keyed, VALID).otherwise(F.coalesce(route, F.lit(QUARANTINE)))
    return df.withColumn(ROUTE, route)


def split_by_rules(
    df: DataFrame,
    rules: dict[str, str],
    null_policy: str,
    *,
    keys: list[str] | None = None,
    delete_when: str = "op = 'd'",
) -> tuple[DataFrame, DataFrame]:
    """The valid and the quarantined rows."""
    routed = route_rows(df, rules, null_policy, keys=keys, delete_when=delete_when)
    return (
        routed.filter(F.col(ROUTE) == VALID).drop(ROUTE),
        routed.filter(F.col(ROUTE) == QUARANTINE).drop(ROUTE),
    )


def failed_rules(rules: dict[str, str]) -> Column:
    """Names of the rules a row does not pass, undecided ones included."""
    return F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name))
                for name, rule in rules.items()
            ]
        )
    )


def reason_counts(rejects: DataFrame, rules: dict[str, str]) -> DataFrame:
    """How many rejects each rule accounts for; a row may count for several."""
    return (
        rejects.select(F.explode(failed_rules(rules)).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejects"))
    )
