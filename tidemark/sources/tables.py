"""Tables on plain Parquet that change batch by batch.

A published table is written whole: a batch writes the folder ``<table>/version=<batch>``, which counts
once Spark's committer has put ``_SUCCESS`` there.

A change target is split by a hash of its keys into a fixed number of buckets. A batch writes only into
buckets it touches, and a manifest then lists the files its version is made of (see
:mod:`tidemark.sources.manifest`). Within a bucket, rows are kept as

* ``delta``  last events of the keys a batch changed,
* ``open``   last event of each key of the bucket: what deltas are folded into,
* ``add``    ended versions a batch added to those before,
* ``patch``  ended versions that a late event split or replaced, as they are since,
* ``base``   ended versions, all of them: what adds and patches are folded into.

Readers take the latest of a bucket's newest ``open`` rows and the deltas since, and of ended versions
with one key and start the newest patch, or else the row as it was. A batch thus writes what it changes,
a late event the one or two versions it splits. A bucket is rewritten whole once it has so many layers.

Versions only go up. The newest one may be written again, by the writer that wrote it: that
is how a batch is repeated after a failure. Anything else would lose rows and is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType
from pyspark.sql.window import Window

from tidemark.operators import cdc
from tidemark.operators.changefeed import FEED_ARGUMENTS, change_feed, feed_as_changes
from tidemark.operators.curve import with_curve_key
from tidemark.settings import CODEC, SkewLimits
from tidemark.sources import manifest
from tidemark.sources.manifest import DataFile, Manifest, delete_path, list_paths

OPEN, DELTA, BASE, ADD, PATCH = "open", "delta", "base", "add", "patch"
# Up to so many rows, or bytes on disk, a patch or the keys of late events are broadcast.
BROADCAST_ROWS, BROADCAST_FILE_BYTES = 100_000, 16_000_000
_WRITTEN, _PREVIOUS, _FROM = "__written", "__previous", "__from"
RANGES = "_ranges"
_CURVE, _FILE = "__curve", "__file"


def _version_of(path: str) -> int:
    """The version in a folder named ``version=<number>`` or, if written again, ``version=<number>-<mark>``."""
    named = next(part for part in path.split("/") if part.startswith("version="))
    return int(named.removeprefix("version=").split("-")[0])


def published_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a published table whose write was committed, oldest first."""
    return sorted(_version_of(p) for p in list_paths(spark, f"{path}/version=*/_SUCCESS"))


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a change target or a published table, oldest first."""
    return manifest.versions(spark, path) or published_versions(spark, path)


def publish(
    df: DataFrame, path: str, version: int, cluster_by: list[str], keys: list[str], files: int | None = None
) -> None:
    """Write a whole table version, laid out so that filters on any clustering column skip files.

    Rows are placed along a curve through all clustering columns (see :mod:`tidemark.operators.curve`). The
    columns and the keys follow it, so a value that most rows share is still spread over tasks.
    The range of every clustering column in every file is kept beside the version, for :func:`find_published`.
    ``files`` fixes their number; Spark chooses it by size otherwise.
    """
    layout = list(dict.fromkeys([*cluster_by, *keys]))
    rows = df.persist()  # finding quantiles and ranges reads the rows once more
    ranges = f"{path}/{RANGES}/version={version}"
    delete_path(df.sparkSession, ranges)  # those of an earlier write of this version
    try:
        placed = rows
        if len(cluster_by) > 1:
            placed, layout = with_curve_key(rows, cluster_by, _CURVE), [_CURVE, *layout]
        dealt = placed.repartitionByRange(files, *layout) if files else placed.repartitionByRange(*layout)
        (
            dealt.sortWithinPartitions(*layout)
            .drop(_CURVE)
            .write.mode("overwrite")
            .parquet(f"{path}/version={version}")
        )
    finally:
        rows.unpersist()
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/version={version}")
    bounds = [f(c).alias(f"{end}_{c}") for c in cluster_by for end, f in (("least", F.min), ("most", F.max))]
    found = written.groupBy(F.col("_metadata.file_name").alias(_FILE)).agg(*bounds)
    found.coalesce(1).write.mode("overwrite").parquet(ranges)  # one row per file


def files_between(
    spark: SparkSession, path: str, column: str, low, high, version: int | None = None
) -> list[str] | None:
    """The files of a published version that can hold a value of a clustering column from ``low`` to ``high``.

    None where the ranges of that column were not kept.
    """
    if version is None:
        version = published_versions(spark, path)[-1]
    ranges = f"{path}/{RANGES}/version={version}"
    if not list_paths(spark, f"{ranges}/_SUCCESS"):
        return None
    known = spark.read.parquet(ranges)
    if f"least_{column}" not in known.columns:
        return None
    inside = (F.col(f"least_{column}") <= F.lit(high)) & (F.col(f"most_{column}") >= F.lit(low))
    names = known.filter(inside).select(_FILE).orderBy(_FILE).collect()
    return [f"{path}/version={version}/{r[0]}" for r in names]


def find_published(
    spark: SparkSession, path: str, column: str, low, high, version: int | None = None
) -> DataFrame:
    """The rows of a published version whose ``column`` lies from ``low`` to ``high``; opens only files that can hold one."""
    if version is None:
        version = published_versions(spark, path)[-1]
    names = files_between(spark, path, column, low, high, version)
    rows = read_published(spark, path, version)
    if names:
        rows = spark.read.schema(rows.schema).parquet(*names)
    elif names is not None:
        rows = rows.limit(0)
    return rows.filter(F.col(column).between(F.lit(low), F.lit(high)))


def expire_published(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` versions of a published table."""
    for version in published_versions(spark, path)[:-keep]:
        delete_path(spark, f"{path}/version={version}")
        delete_path(spark, f"{path}/{RANGES}/version={version}")


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A published table at a version, the newest by default."""
    if version is None:
        version = published_versions(spark, path)[-1]
    return spark.read.parquet(f"{path}/version={version}")


def name_published(spark: SparkSession, path: str, version: int, name: str, comment: str) -> None:
    """Point a catalog name, with its description, at a published version."""
    quoted = comment.replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT '{quoted}' "
        f"AS SELECT * FROM parquet.`{path}/version={version}`"
    )


def published_feed(
    spark: SparkSession, path: str, keys: list[str], start: int, end: int
) -> DataFrame:
    """Row changes between two versions of a published table."""
    return change_feed(
        read_published(spark, path, start), read_published(spark, path, end), keys
    )


@dataclass(frozen=True)
class CdcTable:
    """A target of change events, stored as described above.

    ``buckets`` stays the same over the life of a table, as does ``bucket_by``: the keys
    that are hashed, all of them by default. Fewer keep rows together that are looked for together.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    scd_type: int
    buckets: int = 16
    limits: SkewLimits = SkewLimits()
    rewrite_every: int = 50
    bucket_by: list[str] | None = None
    _kept: list = field(default_factory=list, init=False, repr=False, compare=False)

    # Reading

    def versions(self) -> list[int]:
        return manifest.versions(self.spark, self.path)

    def version_before(self, version: int) -> int | None:
        earlier = [v for v in self.versions() if v < version]
        return earlier[-1] if earlier else None

    def newest(self) -> int | None:
        versions = self.versions()
        return versions[-1] if versions else None

    def manifest(self, version: int) -> Manifest:
        """The files of a version; the only thing a read looks up."""
        if version not in self.versions():
            raise ValueError(f"{self.path} has no complete version {version}")
        return manifest.load(self.spark, self.path, version)

    @staticmethod
    def _sides(files: list[DataFile]) -> tuple[dict[int, list[DataFile]], dict[int, list[DataFile]]]:
        """Files by bucket: those of last events, and those of ended versions."""
        opened: dict[int, list[DataFile]] = {}
        ended: dict[int, list[DataFile]] = {}
        for f in files:
            (opened if f.kind in (OPEN, DELTA) else ended).setdefault(f.bucket, []).append(f)
        return opened, ended

    def _load(self, files: list[DataFile], columns: StructType) -> DataFrame | None:
        if not files:
            return None
        return self.spark.read.schema(columns).parquet(*[f"{self.path}/{f.path}" for f in files])

    def _open(self, parts: dict[int, list[DataFile]], columns: StructType) -> DataFrame | None:
        """Last events of the keys of some buckets: of rows and deltas the latest."""
        layers = {b: len({f.version for f in files}) for b, files in parts.items()}
        single = self._load([f for b in sorted(parts) if layers[b] == 1 for f in parts[b]], columns)
        layered = self._load([f for b in sorted(parts) if layers[b] > 1 for f in parts[b]], columns)
        if layered is None:
            return single
        merged = cdc.latest(layered, self.keys)
        return merged if single is None else single.unionByName(merged)

    def _ended(self, files: list[DataFile], columns: StructType) -> DataFrame | None:
        """Ended versions: the newest patch of each key and start, and rows without one."""
        patches = [f for f in files if f.kind == PATCH]
        plain = self._load([f for f in files if f.kind != PATCH], columns)
        marked = self._load(patches, StructType([*columns.fields]).add(_WRITTEN, LongType()))
        if marked is None:
            return plain
        version = [*self.keys, cdc.START]
        newest = Window.partitionBy(*version).orderBy(F.col(_WRITTEN).desc())
        patched = marked.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1")
        patched = patched.select(*columns.names)
        if plain is None:
            return patched
        # Only buckets with patches are looked through.
        buckets = {f.bucket for f in patches}
        beside = [f for f in files if f.kind != PATCH and f.bucket not in buckets]
        within = [f for f in files if f.kind != PATCH and f.bucket in buckets]
        out = patched
        if beside:
            out = out.unionByName(self._load(beside, columns))
        if within:
            replaced = marked.select(*version).distinct()
            small = sum(f.rows for f in patches) <= BROADCAST_ROWS and sum(f.bytes for f in patches) <= BROADCAST_FILE_BYTES
            left = self._load(within, columns)
            out = out.unionByName(left.join(F.broadcast(replaced) if small else replaced, version, "left_anti"))
        return out

    def state(
        self,
        version: int | None = None,
        *,
        buckets: set[int] | None = None,
        open_only: bool = False,
    ) -> DataFrame | None:
        """Stored rows with their bookkeeping, or None where there are none."""
        version = self.newest() if version is None else version
        if version is None:
            return None
        found = self.manifest(version)
        opened, ended = self._sides([f for f in found.files if buckets is None or f.bucket in buckets])
        loaded = [self._open(opened, found.schema)]
        if not open_only:
            loaded.append(self._ended([f for files in ended.values() for f in files], found.schema))
        rows = [df for df in loaded if df is not None]
        if not rows:
            # Nothing but the columns, which an empty version has, too.
            return self.spark.createDataFrame([], found.schema)
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as its readers see it."""
        state = self.state(version)
        if state is None:
            raise ValueError(f"{self.path} is empty")
        return cdc.visible(state)

    def current(self, version: int | None = None) -> DataFrame:
        """One row per live key; reads no ended versions."""
        state = self.state(version, open_only=True)
        if state is None:
            raise ValueError(f"{self.path} is empty")
        return cdc.visible(state)

    def lookup(self, **key) -> DataFrame:
        """Current rows of one key, from its bucket alone."""
        version = self.newest()
        if version is None:
            raise ValueError(f"{self.path} is empty")
        found = self.manifest(version)
        values = [F.lit(key[k]).cast(found.schema[k].dataType) for k in self.keys]
        hashed = [v for k, v in zip(self.keys, values) if k in (self.bucket_by or self.keys)]
        bucket = self.spark.range(1).select(F.pmod(F.hash(*hashed), self.buckets)).first()[0]
        opened, _ = self._sides([f for f in found.files if f.bucket == bucket])
        rows = self._open(opened, found.schema)
        if rows is None:
            rows = self.spark.createDataFrame([], found.schema)
        rows = cdc.visible(rows)
        for name, value in zip(self.keys, values):
            rows = rows.filter(F.col(name) == value)
        return rows

    def files_as_of(self, sequence: int, version: int | None = None) -> list[DataFile]:
        """The files that can hold a row current once ``sequence`` was applied, by their ranges.

        A patch is needed for what it replaces, even where it ended before.
        """
        version = self.newest() if version is None else version
        return [
            f
            for f in self.manifest(version).files
            if f.starts_by(sequence) and (f.kind in (OPEN, DELTA, PATCH) or f.ends_after(sequence))
        ]

    def as_of(self, sequence: int, version: int | None = None) -> DataFrame:
        """The rows of a history that were current once ``sequence`` was applied.

        Opens only files whose range covers it. Where a bucket's later layers are left out, a row can look
        open that has ended since; of a key's rows that have started by then the last one counts, and of the same
        row read open and ended the ended one.
        """
        if self.scd_type != 2:
            raise ValueError(f"{self.path} keeps no history")
        version = self.newest() if version is None else version
        found = self.manifest(version)
        chosen = self.files_as_of(sequence, version)
        layers: dict[int, set[int]] = {}
        for f in found.files:
            if f.kind in (OPEN, DELTA):
                layers.setdefault(f.bucket, set()).add(f.version)
        layered = {b for b, versions in layers.items() if len(versions) > 1}

        def read(inside: bool) -> DataFrame | None:
            opened, ended = self._sides([f for f in chosen if (f.bucket in layered) == inside])
            parts = [
                self._load([f for files in opened.values() for f in files], found.schema),
                self._ended([f for files in ended.values() for f in files], found.schema),
            ]
            parts = [cdc.versions_as_of(df, sequence) for df in parts if df is not None]
            if not parts:
                return None
            rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            if inside:
                order = [F.col(c).desc() for c in cdc._order(rows, self.keys)]
                last = Window.partitionBy(*self.keys).orderBy(order[0], F.col(cdc.END).isNull(), *order[1:])
                rows = rows.withColumn("__rank", F.row_number().over(last)).filter("__rank = 1").drop("__rank")
            return rows

        rows = [df for df in (read(False), read(True)) if df is not None]
        if not rows:
            return cdc.visible(self.spark.createDataFrame([], found.schema))
        return cdc.visible(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]))

    # Writing

    def _bucket(self) -> Column:
        """The hash Spark partitions by.

        A merge hashes rows into a multiple of as many partitions as there are
        buckets, so each task writes one bucket and a version has few files.
        """
        return F.pmod(F.hash(*(self.bucket_by or self.keys)), F.lit(self.buckets))

    def part(self, parts: int) -> Column:
        """Which of so many parts of the buckets a row falls into."""
        return F.pmod(self._bucket(), F.lit(parts))

    def _partitions(self, parts: int = 1) -> int:
        """As many that all cores are busy, if only a part of the buckets has rows."""
        wanted = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if parts > 1:
            wanted = max(wanted, parts * self.spark.sparkContext.defaultParallelism)
        return self.buckets * max(1, -(-wanted // self.buckets))

    def bucket_ids(self, rows: DataFrame) -> set[int]:
        """Buckets that rows fall into; never more than the table has."""
        found = rows.select(self._bucket().alias("b")).distinct().collect()
        return {row["b"] for row in found}

    def apply(
        self,
        changes: DataFrame,
        version: int,
        *,
        sequence_by: Column | str,
        delete_when: str,
        except_columns: list[str],
        scd_type: int | None = None,
        tie_by: list[str] | None = None,
        writer: str | None = None,
    ) -> None:
        """Apply change rows and commit the outcome as ``version``."""
        if scd_type not in (None, self.scd_type):
            raise ValueError(f"{self.path} is of type {self.scd_type}")
        events = cdc.to_events(
            changes, self.keys, sequence_by, delete_when, except_columns, tie_by
        ).persist()
        try:
            self.merge(events, version, writer=writer)
        finally:
            events.unpersist()

    def _check_version(self, version: int, writer: str | None) -> None:
        newest = self.newest()
        if newest is None or version > newest:
            return
        if version < newest:
            raise ValueError(
                f"{self.path} is at version {newest}; version {version} would drop what followed. "
                "A new checkpoint needs an empty target."
            )
        wrote = self.manifest(version).writer
        if wrote not in (None, writer):
            raise ValueError(f"version {version} of {self.path} was written by {wrote}, not {writer}")

    def merge(
        self,
        events: DataFrame,
        version: int,
        *,
        one_per_key: bool = False,
        writer: str | None = None,
        note: dict | None = None,
    ) -> None:
        """Merge events in the shape of a state and commit as ``version``.

        Reads the events several times; :meth:`apply` keeps them for that.
        ``one_per_key`` says that they are the last of their key already. ``writer``
        names who writes, such as a streaming query; only it may write the version again. ``note`` is
        kept in the version's manifest.
        """
        self.merge_parts([events], 1, version, one_per_key=one_per_key, writer=writer, note=note)

    def merge_parts(
        self,
        events: Iterable[DataFrame],
        parts: int,
        version: int,
        *,
        one_per_key: bool = False,
        writer: str | None = None,
        note: dict | None = None,
    ) -> None:
        """As :meth:`merge`, a part of the buckets after another, see :meth:`part`.

        What a part is shuffled and sorted with is let go of before the next, which is asked for then. The
        version counts once all are written.
        """
        self._check_version(version, writer)
        before = self.version_before(version)
        stored = self.manifest(before) if before is not None else None
        layers: dict[int, int] = {}
        for bucket, _, _ in {(f.bucket, f.version, f.kind in (OPEN, DELTA)) for f in stored.files} if stored else ():
            layers[bucket] = layers.get(bucket, 0) + 1
        again = version in self.versions()
        name = f"version={version}" + (f"-{uuid.uuid4().hex[:8]}" if again else "")
        rewritten: set[int] = set()
        state = None
        for part in events:
            touched = self.bucket_ids(part) if stored else set()
            folded = {b for b in touched if layers.get(b, 0) > self.rewrite_every}
            mode = "overwrite" if state is None else "append"
            if self.scd_type == 1:
                fresh = part if one_per_key else cdc.latest(part, self.keys)
                state = self._merged_latest(fresh, stored, folded, parts)
            else:
                state = self._merged_history(part, stored, touched, folded, parts)
            schema = self._write(state, f"{self.path}/{name}", mode, version)
            rewritten |= folded
        written = state.sparkSession.read.schema(schema).parquet(f"{self.path}/{name}")
        new = manifest.written_files(written, name, version, cdc.START, cdc.END)
        kept = [f for f in stored.files if f.bucket not in rewritten] if stored else []
        columns = state.drop("kind").schema.json()
        manifest.commit(self.spark, self.path, Manifest(version, writer, columns, [*kept, *new], note or {}))

    def _inside(self, rows: DataFrame, buckets: set[int], *, inverse: bool = False) -> DataFrame:
        if not buckets:
            return rows if inverse else rows.limit(0)
        inside = self._bucket().isin(*buckets)
        return rows.filter(~inside if inverse else inside)

    def _merged_latest(
        self, fresh: DataFrame, stored: Manifest | None, folded: set[int], parts: int
    ) -> DataFrame:
        """What the batch changes, and the folded buckets whole; late rows lose on reading."""
        kind = self._kind(OPEN, DELTA, stored, folded)
        opened = None
        if folded:
            files, _ = self._sides([f for f in stored.files if f.bucket in folded])
            opened = self._open(files, stored.schema)
        if opened is None:
            return fresh.repartition(self._partitions(parts), *(self.bucket_by or self.keys)).withColumn("kind", kind)
        both = opened.select(*fresh.columns).unionByName(fresh)
        merged = cdc.latest(both.repartition(self._partitions(parts), *(self.bucket_by or self.keys)), self.keys)
        return merged.withColumn("kind", kind)

    def _kind(self, whole: str, part: str, stored: Manifest | None, folded: set[int]) -> Column:
        """Rows of a bucket written whole, as all are at first, or a part of one."""
        if stored is None:
            return F.lit(whole)
        return F.when(self._bucket().isin(*folded), whole).otherwise(part) if folded else F.lit(part)

    def _merged_history(
        self, events: DataFrame, stored: Manifest | None, touched: set[int], folded: set[int], parts: int
    ) -> DataFrame:
        """What the batch changes, and the folded buckets whole.

        Stored rows enter marked with where they ended; those that come out unchanged are not written again.
        """
        columns = events.columns
        opened = None
        if touched:
            files, _ = self._sides([f for f in stored.files if f.bucket in touched])
            opened = self._open(files, stored.schema)
        if opened is None:
            closed = cdc.history(events, self.keys, self.limits, partitions=self._partitions(parts))
            ended = self._kind(BASE, ADD, stored, folded)
            kind = F.when(F.col(cdc.END).isNull(), self._kind(OPEN, DELTA, stored, folded)).otherwise(ended)
            return closed.withColumn("kind", kind)

        def marked(rows: DataFrame, is_stored: bool) -> DataFrame:
            end = F.col(cdc.END) if cdc.END in rows.columns else F.lit(None)
            kind = events.schema[cdc.START].dataType
            return rows.select(*columns, F.lit(is_stored).alias(cdc.STORED), end.cast(kind).alias(cdc.OLD_END))

        # Outside of buckets rewritten whole, only rows of keys in the batch play a part. They are looked up once.
        first = events.groupBy(*self.keys).agg(F.min(cdc.START).alias(_FROM))
        known = self._inside(opened, folded, inverse=True).join(first, self.keys).persist()
        self._kept.append(known)
        inputs = marked(events, False).unionByName(marked(known, True))
        # A key has one last event at most, so huge keys show without those.
        counted = [events]
        late = known.filter(F.col(_FROM) < F.col(cdc.START)).select(*self.keys, _FROM)
        # One row per bucket that late events fall into, with the earliest of them.
        reached = {
            r["bucket"]: (r["n"], r["least"])
            for r in late.groupBy(self._bucket().alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(_FROM).alias("least"))
            .collect()
        }
        if reached:
            chosen = [
                f
                for f in stored.files
                if f.bucket in reached
                and f.kind not in (OPEN, DELTA)
                and (f.kind == PATCH or not isinstance(reached[f.bucket][1], int) or f.ends_after(reached[f.bucket][1]))
            ]
            ended = self._ended(chosen, stored.schema)
            if ended is not None:
                few = sum(n for n, _ in reached.values()) <= BROADCAST_ROWS
                split = ended.join(F.broadcast(late) if few else late, self.keys).filter(F.col(cdc.END) > F.col(_FROM))
                inputs = inputs.unionByName(marked(split, True))
                counted.append(split)
        if folded:
            inputs = inputs.unionByName(marked(self._inside(opened, folded), True))
            counted.append(self._inside(opened, folded))
            whole = self._ended([f for f in stored.files if f.bucket in folded and f.kind not in (OPEN, DELTA)], stored.schema)
            if whole is not None:
                inputs = inputs.unionByName(marked(whole, True))
                counted.append(whole)
        measured = counted[0].select(*self.keys, cdc.START)
        for rows in counted[1:]:
            measured = measured.unionByName(rows.select(*self.keys, cdc.START))
        closed = cdc.history(
            inputs, self.keys, self.limits, measured, self._partitions(parts), previous=_PREVIOUS
        )
        whole = self._bucket().isin(*folded) if folded else F.lit(False)
        changed = ~(F.col(cdc.STORED) & F.col(cdc.END).eqNullSafe(F.col(cdc.OLD_END)))
        # A stored version that ends elsewhere now, or an event in place of one of the same start.
        replaces = F.when(F.col(cdc.STORED), F.col(cdc.OLD_END).isNotNull()).otherwise(
            F.coalesce(F.col(_PREVIOUS) == F.col(cdc.START), F.lit(False))
        )
        is_open = F.col(cdc.END).isNull()
        kind = (
            F.when(whole & is_open, OPEN).when(whole, BASE)
            .when(is_open, DELTA).when(replaces, PATCH).otherwise(ADD)
        )
        return closed.filter(whole | changed).withColumn("kind", kind).drop(cdc.STORED, cdc.OLD_END, _PREVIOUS)

    def _write(self, state: DataFrame, folder: str, mode: str, version: int) -> StructType:
        """Write rows by kind and bucket; they count once a manifest names them. Gives their columns."""
        placed = state.withColumn(_WRITTEN, F.lit(version).cast("long")).withColumn("bucket", self._bucket())
        try:
            (
                placed.sortWithinPartitions("kind", "bucket", *self.keys, cdc.START)
                .write.mode(mode)
                .option("compression", CODEC)
                .partitionBy("kind", "bucket")
                .parquet(folder)
            )
        finally:
            while self._kept:
                self._kept.pop().unpersist()
        return placed.schema

    # Changes between versions

    def feed(self, start: int | None, end: int) -> DataFrame:
        """Row changes of current rows.

        Where a bucket only got layers since, just the keys in those are compared; a bucket that
        was folded in between is compared whole.
        """
        after_manifest = self.manifest(end)
        columns = after_manifest.schema
        ended, _ = self._sides(after_manifest.files)
        started, _ = self._sides(self.manifest(start).files) if start is not None else ({}, {})
        hidden = [cdc.START, cdc.END]
        fresh: dict[int, list[DataFile]] = {}
        whole = set()
        for bucket, files in ended.items():
            old = set(started.get(bucket, []))
            new = [f for f in files if f not in old]
            if old and old <= set(files):
                if new:
                    fresh[bucket] = new
            elif new:
                whole.add(bucket)
        # Of buckets with new layers: the keys named there, as they were and with what came.
        news = self._load([f for files in fresh.values() for f in files], columns)
        before = self._open({b: f for b, f in started.items() if b in whole or b in fresh}, columns)
        after = self._open({b: f for b, f in ended.items() if b in whole}, columns)
        if news is not None:
            names = news.select(*self.keys).distinct()
            on = [before[k].eqNullSafe(names[k]) for k in self.keys]
            known = before.join(names, on, "left_semi")
            if whole:
                known = known.unionByName(self._inside(before, whole))
            since = self._inside(known, whole, inverse=True).unionByName(news)
            since = cdc.latest(since, self.keys)
            before, after = known, since if after is None else since.unionByName(after)
        if after is None:
            after = self.spark.createDataFrame([], columns)
        after = cdc.visible(after).drop(*hidden)
        before = after.limit(0) if before is None else cdc.visible(before).drop(*hidden)
        return change_feed(before, after, self.keys)

    def expire(self, keep_from: int) -> None:
        """Delete files that no version from ``keep_from`` on is made of.

        Earlier versions cannot be read afterwards, nor what a failed write has left.
        """
        versions = self.versions()
        needed = set()
        for version in versions:
            if version >= keep_from:
                needed.update(f.path.rsplit("/", 1)[0] for f in self.manifest(version).files)
        for version in versions:
            if version < keep_from:
                manifest.forget(self.spark, self.path, version)
        for path in list_paths(self.spark, f"{self.path}/version=*/kind=*/bucket=*"):
            below = path[path.rindex("/version=") + 1 :]
            if _version_of(below) < max(versions, default=0) and below not in needed:
                delete_path(self.spark, path)


def sync_table(source: CdcTable, target: CdcTable) -> int | None:
    """Bring a keyed copy up to the newest version of its source.

    The target's versions are the source's, so each run carries on from the last
    one; the first run copies everything. Returns the version synced to.
    """
    newest, last = source.newest(), target.newest()
    if newest is None or newest == last:
        return last
    feed = source.feed(last, newest)
    target.apply(feed_as_changes(feed, newest), newest, **FEED_ARGUMENTS)
    return newest
