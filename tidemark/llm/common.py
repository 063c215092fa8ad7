"""What the text operators share: tables, scratch tables, column names, spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.settings import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint folder and read it back.

    Later steps read the files, so a lost executor costs no recomputation and
    the rows are the same however often they are read.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_remainder(column: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; a null id counts as empty text."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % modulus


def partitions_for(df: DataFrame, at_least: int = 1) -> int:
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], salt: Column, salts: int = 32, most: int = 50_000) -> DataFrame:
    """Left join of rows to one row per group, null keys included.

    Up to ``most`` groups are broadcast, after counting them. More are shuffled, each repeated for
    ``salts`` values of ``salt``, so that a group with a third of all rows is spread over as many keys.
    """
    names = {k: f"__key_{k}" for k in keys}
    side = groups.withColumnsRenamed(names)
    on = F.lit(True)
    for k, other in names.items():
        on = on & F.col(k).eqNullSafe(F.col(other))
    if groups.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(side), on, "left").drop(*names.values())
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    side = side.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = on & (F.col("__salt") == F.col("__copy"))
    return salted.join(side, on, "left").drop("__salt", "__copy", *names.values())
