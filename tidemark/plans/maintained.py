"""The published aggregates, kept up from change feeds instead of computed anew.

Each has two stored tables: sums of the facts by their own group, bucketed by the key that
leads to the dimensions, and the joined result. A run reads what changed since the versions it has
seen: fact rows add and retract sums; sums meet the dimensions as they were, and changed dimension rows meet
the sums as they are, so that a renamed restaurant's orders leave the old name and join
the new one. Only buckets with something changed are read or written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc, signed
from tidemark.operators.lookup import join_dimension
from tidemark.settings import Settings
from tidemark.sources.tables import CdcTable


@dataclass(frozen=True)
class Dimension:
    """A table to join to: ``link`` is the column before it that holds its ``key``."""

    table: str
    link: str
    key: str
    columns: dict[str, str]  # new name to the table's name


@dataclass(frozen=True)
class MaintainedSpec:
    """An aggregate: facts, their groups and measures in SQL, dimensions in turn, and the result."""

    name: str
    facts: str
    groups: dict[str, str]
    measures: dict[str, str]
    kinds: dict[str, str]
    dimensions: tuple[Dimension, ...]
    keys: list[str]
    outputs: dict[str, str] = field(default_factory=dict)  # result column to measure
    count: str | None = None  # result column for the number of rows

    @property
    def link(self) -> str:
        return self.dimensions[0].link

    @property
    def inputs(self) -> list[str]:
        return [self.facts, *[d.table for d in self.dimensions]]


RESTAURANT = Dimension("restaurants", "restaurant_id", "restaurant_id", {"restaurant_name": "name"})
MAINTAINED = {
    spec.name: spec
    for spec in (
        MaintainedSpec(
            "daily_orders_by_restaurant",
            "orders",
            {"order_date": "try_cast(created_at AS date)", "restaurant_id": "restaurant_id"},
            {"revenue": "total_amount"},
            {"revenue": "decimal(20,2)"},
            (RESTAURANT,),
            ["order_date", "restaurant_id", "restaurant_name"],
            {"revenue": "revenue"},
            "order_count",
        ),
        MaintainedSpec(
            "revenue_by_city",
            "orders",
            {"restaurant_id": "restaurant_id"},
            {"revenue": "total_amount"},
            {"revenue": "decimal(20,2)"},
            (Dimension("restaurants", "restaurant_id", "restaurant_id", {"city": "city"}),),
            ["city"],
            {"revenue": "revenue"},
            "order_count",
        ),
        MaintainedSpec(
            "top_products",
            "order_items",
            {"product_id": "product_id"},
            {"quantity": "quantity", "amount": "quantity * unit_price"},
            {"quantity": "bigint", "amount": "decimal(31,2)"},
            (
                Dimension("products", "product_id", "product_id", {"product_name": "name", "restaurant_id": "restaurant_id"}),
                RESTAURANT,
            ),
            ["product_id", "product_name", "restaurant_id", "restaurant_name"],
            {"total_quantity": "quantity", "total_revenue": "amount"},
        ),
    )
}


@dataclass(frozen=True)
class Maintained:
    """The stored tables of an aggregate, below one folder."""

    spark: SparkSession
    spec: MaintainedSpec
    path: str
    settings: Settings = Settings()

    def _table(self, name: str, keys: list[str], bucket_by: list[str] | None = None) -> CdcTable:
        s = self.settings
        return CdcTable(self.spark, f"{self.path}/{name}", keys, 1, s.buckets, s.skew, s.rewrite_every, bucket_by)

    @property
    def sums(self) -> CdcTable:
        return self._table("sums", list(self.spec.groups), [self.spec.link])

    @property
    def result(self) -> CdcTable:
        return self._table("result", self.spec.keys)

    def read(self) -> DataFrame:
        """The aggregate as of its last refresh."""
        spec = self.spec
        count = [F.col(signed.ROWS).alias(spec.count)] if spec.count else []
        values = [signed.value_of(m).alias(out) for out, m in spec.outputs.items()]
        return self.result.read().select(*spec.keys, *count, *values)

    def refresh(self, inputs: dict[str, CdcTable]) -> int | None:
        """Take in what changed in the inputs since the last run; returns the version of the result.

        The sums are committed before the result, each with the input versions it has taken in. A run
        that failed in between is carried on to those same versions.
        """
        spec, sums, result = self.spec, self.sums, self.result
        done, ahead = result.newest(), sums.newest()
        seen = result.manifest(done).note if done is not None else {}
        version = 0 if done is None else done + 1
        resumed = ahead is not None and ahead == version
        found = {name: inputs[name].newest() for name in spec.inputs}
        upto = sums.manifest(ahead).note if resumed else found
        if any(v is None for v in upto.values()) or upto == seen:
            return done

        def before(name: str) -> DataFrame:
            """The rows as of the versions taken in; none at first."""
            if seen.get(name) is None:
                return inputs[name].current(upto[name]).limit(0)
            return inputs[name].current(seen[name])

        def change(name: str) -> DataFrame:
            return signed.signed(inputs[name].feed(seen.get(name), upto[name]))

        groups = {n: F.expr(e) for n, e in spec.groups.items()}
        values = {n: F.expr(e) for n, e in spec.measures.items()}
        facts = signed.grouped(change(spec.facts), groups, values, spec.kinds).persist()
        moved = self._dimension_change(inputs, before, change, upto).persist()
        try:
            if not resumed:
                self._add(sums, facts, list(spec.groups), version, upto)
            measures = list(spec.measures)
            link = spec.link
            met = join_dimension(
                facts, self._dimension(before), link, "__link", "inner", self.settings, may_be_hot=False
            )
            rows = met.select(*spec.keys, *signed._parts(measures))
            kind = sums.manifest(version).schema[link].dataType  # a hash depends on the type
            buckets = sums.bucket_ids(moved.select(F.col("__link").cast(kind).alias(link)))
            held = sums.state(version, buckets=buckets, open_only=True) if buckets else None
            if held is not None:
                changed = moved.withColumnRenamed("__link", "__to")
                again = cdc.visible(held).join(changed, F.col(link) == F.col("__to")).drop("__to")
                again = signed.weighted(again, measures).select(*spec.keys, *signed._parts(measures))
                rows = rows.unionByName(again)
            joined = signed.regrouped(rows, spec.keys, measures, spec.kinds)
            self._add(result, joined, spec.keys, version, upto)
        finally:
            facts.unpersist()
            moved.unpersist()
        return version

    def _add(self, table: CdcTable, change: DataFrame, keys: list[str], version: int, note: dict) -> None:
        """Commit a table with signed sums added to its groups; a group without rows is deleted."""
        measures, change = list(self.spec.measures), change.persist()
        try:
            touched = table.bucket_ids(change)
            newest = table.version_before(version)
            stored = table.state(newest, buckets=touched, open_only=True) if newest is not None else None
            stored = change.limit(0) if stored is None else cdc.visible(stored)
            now = signed.added(stored, change, keys, measures, self.spec.kinds)
            events = now.withColumns({
                cdc.START: F.lit(version).cast("bigint"), cdc.DELETED: F.col(signed.ROWS) == 0,
            }).persist()
            try:
                table.merge(events, version, one_per_key=True, note=note)
            finally:
                events.unpersist()
        finally:
            change.unpersist()

    def _columns(self, rows: DataFrame, d: Dimension, *more: str) -> DataFrame:
        return rows.select(F.col(d.key).alias("__key"), *[F.col(c).alias(n) for n, c in d.columns.items()], *more)

    def _dimension(self, read) -> DataFrame:
        """The dimensions joined, one row per ``__link``."""
        first, *rest = self.spec.dimensions
        rows = self._columns(read(first.table), first).withColumnRenamed("__key", "__link")
        for d in rest:
            side = self._columns(read(d.table), d)
            rows = join_dimension(rows, side, d.link, "__key", "inner", self.settings)
        return rows

    def _dimension_change(self, inputs: dict[str, CdcTable], before, change, upto: dict) -> DataFrame:
        """Signed rows of the joined dimensions, by the product rule from one to the next."""
        first, *rest = self.spec.dimensions
        delta = self._columns(change(first.table), first, signed.SIGN).withColumnRenamed("__key", "__link")
        after = self._columns(inputs[first.table].current(upto[first.table]), first).withColumnRenamed("__key", "__link")
        for d in rest:
            old = self._columns(before(d.table), d)
            news = self._columns(change(d.table), d, signed.SIGN)
            on = F.col(d.link) == F.col("__key")
            # A dimension's changes are few beside it; Spark splits a link that many rows share.
            met = join_dimension(delta, old, d.link, "__key", "inner", self.settings)
            again = after.join(news, on).drop("__key")
            delta = met.unionByName(again)
            after = join_dimension(after, self._columns(inputs[d.table].current(upto[d.table]), d), d.link, "__key", "inner", self.settings)
        return signed.netted(delta)
