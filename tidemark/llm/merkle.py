"""A Merkle manifest of a dataset: a tree of hashes per group, and one over the groups.

Each row is a leaf. Leaves of a group are numbered in order; every eight neighbours
become the hash of their hashes until one is left, and the groups' last hashes make a tree of
the same kind.

A superblock is an aligned run of 512 nodes, three rounds of that. Upwards, each
superblock is reduced by itself and its last hash is a node of the level above,
so a tree over 10^10 leaves takes four such levels. Downwards, the nodes of a superblock are
cogrouped with the one row they need from outside, the siblings on the way from the
superblock to the root. One function then reduces the superblock, joins each leaf's proof
and folds a leaf back to the root. No task sees more than a superblock and its outer row, and no
text is shuffled, only hashes.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, partitions_for, stored

ARITY = 8
ROUNDS = 3
BLOCK = ARITY**ROUNDS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODES = "grp string, pos long, n long, node string"
PATHS = "grp string, pos long, name string, befores array<string>, afters array<string>"


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A column as part of a leaf: ``-`` for null, else its size in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


# Numbering --------------------------------------------------------------------


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, a row's place in its ``grp`` by ``order``, and ``n``, the group's rows.

    A range shuffle spreads a group over as many partitions as it fills; counts per partition and
    group, running sums over them and a row number within each give every row its place.
    """
    spread = rows.repartitionByRange(partitions_for(rows), "grp", *order)
    ranked = stored(spread.withColumn("__part", F.spark_partition_id()), "ranges")
    totals = ranked.groupBy("__part", "grp").agg(F.count(F.lit(1)).alias("__rows"))
    # A group has a row per partition it lies in.
    group = Window.partitionBy("grp")
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__part", "grp", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(group).alias("n"),
    )
    inside = Window.partitionBy("__part", "grp").orderBy(*order)
    return (
        ranked.withColumn("__number", F.row_number().over(inside))
        .join(offsets, ["__part", "grp"])
        .withColumn("pos", F.col("__before") + F.col("__number") - 1)
        .drop("__part", "__before", "__number")
    )


# Within a superblock ------------------------------------------------------------


def rounds_of(n: int) -> int:
    """Rounds that a superblock of a level with ``n`` nodes takes."""
    taken = 0
    while n > 1 and taken < ROUNDS:
        n, taken = -(-n // ARITY), taken + 1
    return taken


def reduced(nodes: list[str], rounds: int) -> list[list[str]]:
    """The nodes, and what each round makes of them."""
    levels = [nodes]
    for _ in range(rounds):
        last = levels[-1]
        levels.append([_hash("".join(last[i : i + ARITY])) for i in range(0, len(last), ARITY)])
    return levels


def siblings(levels: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """For each round, what stands before and after each node in its run."""
    out = []
    for nodes in levels[:-1]:
        before, after = [], []
        for i in range(len(nodes)):
            first = i - i % ARITY
            before.append("".join(nodes[first:i]))
            after.append("".join(nodes[i + 1 : first + ARITY]))
        out.append((before, after))
    return out


def _reduce(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    n = int(pdf["n"].iloc[0])
    levels = reduced(pdf["node"].tolist(), rounds_of(n))
    return pd.DataFrame({
        "grp": [pdf["grp"].iloc[0]], "pos": [int(pdf["pos"].iloc[0]) // BLOCK],
        "n": [-(-n // BLOCK)], "node": [levels[-1][0]],
    })


def _own_paths(nodes: pd.DataFrame, outer: pd.DataFrame):
    """The nodes in order, and each one's siblings from its own round to the root."""
    nodes = nodes.sort_values("pos")
    rounds = rounds_of(int(nodes["n"].iloc[0]))
    local = siblings(reduced(nodes["node"].tolist(), rounds))
    above = outer.iloc[0]
    befores, afters = list(above["befores"]), list(above["afters"])
    paths = []
    for i in range(len(nodes)):
        at = [i // ARITY**r for r in range(rounds)]
        paths.append((
            [b[k] for (b, _), k in zip(local, at)] + befores,
            [a[k] for (_, a), k in zip(local, at)] + afters,
        ))
    return nodes, paths


def _descend(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Paths of a superblock's nodes; nothing for an outer row without nodes."""
    if not len(nodes):
        return pd.DataFrame({"grp": [], "pos": [], "name": [], "befores": [], "afters": []})
    nodes, paths = _own_paths(nodes, outer)
    return pd.DataFrame({
        "grp": nodes["grp"], "pos": nodes["pos"], "name": nodes["name"],
        "befores": [b for b, _ in paths], "afters": [a for _, a in paths],
    })


def fold(node: str, befores: list[str], afters: list[str]) -> str:
    """The root that a node and its siblings give."""
    for before, after in zip(befores, afters):
        node = _hash(before + node + after)
    return node


# Levels -------------------------------------------------------------------------


def _blocked(level: DataFrame) -> DataFrame:
    return level.withColumn("block", F.floor(F.col("pos") / BLOCK))


def levels_above(nodes: DataFrame) -> list[DataFrame]:
    """The levels over ``nodes`` (grp, pos, n, node), each 512 times smaller, until each group has one node."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, level = [], nodes.select("grp", "pos", "n", "node")
    while most > 1:
        level = stored(_blocked(level).groupBy("grp", "block").applyInPandas(_reduce, NODES), "level")
        levels.append(level)
        most = -(-most // BLOCK)
    return levels


def _exchanged(nodes: DataFrame, outer: DataFrame, finish, schema: str) -> DataFrame:
    """Cogroup the nodes of each superblock with the path of the superblock itself."""
    inner = _blocked(nodes).groupBy("grp", "block")
    return inner.cogroup(outer.withColumn("block", F.col("pos")).groupBy("grp", "block")).applyInPandas(finish, schema)


def _paths_down(nodes: DataFrame, levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the superblocks of ``nodes``, from those of each group's last node."""
    paths = top
    for level in reversed(levels[:-1]):
        unnamed = level.withColumn("name", F.lit(None).cast("string"))
        paths = stored(_exchanged(unnamed, paths, _descend, PATHS), "paths")
    return paths


def manifest(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    group_column: str = "lang",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: Column | None = None,
    tampered_fields: tuple[Column, ...] | None = None,
) -> DataFrame:
    """Leaf, subroot, root, proof and the outcome of checking each row.

    Where ``tampered`` holds, the leaf that is folded is made of ``tampered_fields`` instead of ``fields``;
    the siblings are always the original ones. ``proof_sha256`` is the hash of a leaf's
    siblings from its own round to the root, each round's left to right.

    Null fields are ``-``. A null group is a group of its own and comes first; a null id comes first in its group.
    Rows with one id are ordered by their leaf, so equal rows are interchangeable; they are leaves each. Other
    columns are not read. A group with one row has its leaf as subroot, and a single group's subroot is the
    root. An empty table gives no rows.
    """
    kind = docs.schema[id_column].dataType
    columns = [F.col(c) for c in fields]
    own = leaf(*columns)
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    other = own if tampered_fields is None else F.when(changed, leaf(*tampered_fields)).otherwise(own)
    leaves = docs.select(
        # Sorts by UTF-8 bytes with nulls first.
        F.coalesce(F.concat(F.lit("="), F.col(group_column).cast("string")), F.lit("")).alias("grp"),
        F.col(id_column).alias("id"), own.alias("node"), other.alias("offered"),
    )
    leaves = stored(leaves, "leaves")  # texts are read once
    nodes = stored(numbered(leaves, ["id", "node"]).withColumn("id", F.col("id").cast("string")), "nodes")
    levels = levels_above(nodes)
    subroots = (levels[-1] if levels else nodes).filter("pos = 0").select("grp", "node")

    # The tree over the groups; its leaves remember which group they are.
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    crown = stored(numbered(named, ["name"]), "crown")
    upper = levels_above(crown)
    top = (upper[-1] if upper else crown).select("node").first()
    root = top[0] if top else ""
    none = F.array().cast("array<string>")
    start = crown.filter("pos = 0").select("grp", F.lit(0).cast("long").alias("pos"), F.lit("").alias("name"), none.alias("befores"), none.alias("afters"))
    over = _paths_down(crown, upper, start)
    crowned = _exchanged(crown, over, _descend, PATHS) if upper else start.drop("name").join(crown.select("grp", "name"), "grp")
    bases = stored(crowned.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), F.lit("").alias("name"), "befores", "afters"), "bases")

    outer = _paths_down(nodes, levels, bases)
    outer = outer.join(subroots.withColumnRenamed("node", "subroot"), "grp")

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Reduce a superblock, join its leaves' proofs and fold what is offered for each leaf."""
        names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        if not len(nodes):
            return pd.DataFrame({c: [] for c in names})
        nodes, paths = _own_paths(nodes, outer)
        folded = [fold(offered, *path) for offered, path in zip(nodes["offered"], paths)]
        return pd.DataFrame({
            "id": nodes["id"], "leaf": nodes["node"], "subroot": outer["subroot"].iloc[0], "root": root,
            "proof_sha256": [_hash("".join(b + a for b, a in zip(*path))) for path in paths],
            "folded_root": folded, "verified": [f == root for f in folded],
        })

    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    done = _exchanged(nodes, outer, finish, schema)
    return done.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_column)


def lower_cased_thirds(docs: DataFrame) -> dict:
    """Tampering of a third of the rows, by their id: the text's capital letters become small ones.

    A null id counts as empty text, whose checksum 3 divides.
    """
    text = F.translate(F.col("text"), UPPER, LOWER)
    return {
        "tampered": id_remainder("doc_id", 3) == 0,
        "tampered_fields": tuple(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")) + (text,),
    }
