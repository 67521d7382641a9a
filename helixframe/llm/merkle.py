"""Merkle manifests: each row a leaf, a tree of runs for each group, a tree of their roots, and proofs checked row by row.

Rows get their place in their group through sorted ranges. Blocks of 16 ** k leaves are reduced where a shuffle puts them;
the driver builds the small tree above the blocks and broadcasts it, and the blocks finish each leaf's proof with it.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import small
from .common import checkpointed

#: Children of a node.
ARITY = 16
#: Blocks have ARITY ** k leaves, with the least k of these that keeps whole blocks at most FEW_BLOCKS (the last one else).
BLOCK_POWERS = (2, 3, 4, 5)
FEW_BLOCKS = 65_536
#: More blocks than this (5e11 rows, or as many groups), or an upper tree of more bytes, are an error: it wouldn't fit a broadcast.
MOST_BLOCKS = 524_288
MOST_BYTES = 64 << 20


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def leaf_of(columns: list[Column]) -> Column:
    """The digest of a row: each column `-` if null, else its UTF-8 bytes, `:` and itself (numbers in decimal)."""
    whole = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in whole]).cast("binary"), 256)


def reduced(nodes: list[str], levels: int | None = None) -> list[list[str]]:
    """`nodes` and the levels above them: so many, or until one node is left."""
    tree = [nodes]
    while levels is None and len(tree[-1]) > 1 or levels is not None and len(tree) <= levels:
        below = tree[-1]
        tree.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return tree


class Step(NamedTuple):
    """A run's other nodes, as hex text, left and right of the one that is proven."""

    left: str
    right: str


def siblings(level: list[str], i: int) -> Step:
    run = i - i % ARITY
    return Step("".join(level[run:i]), "".join(level[i + 1 : run + ARITY]))


def fold(leaf: str, proof: list[Step]) -> str:
    """The root that a leaf and its proof give."""
    for step in proof:
        leaf = digest(step.left + leaf + step.right)
    return leaf


def height(rows: int) -> int:
    """Levels above so many leaves."""
    up = 0
    while rows > 1:
        rows, up = -(-rows // ARITY), up + 1
    return up


class UpperTree:
    """The trees above blocks, by group, and the tree above the groups' roots (null first, others by their bytes)."""

    def __init__(self, blocks: dict[str | None, list[str]]):
        self.of_group = {g: reduced(b) for g, b in blocks.items()}
        order = sorted(blocks, key=lambda g: (g is not None, (g or "").encode()))
        self.place = {g: i for i, g in enumerate(order)}
        self.top = reduced([self.of_group[g][-1][0] for g in order])

    @classmethod
    def of(cls, parts: dict) -> UpperTree:
        """The tree whose parts (`vars`) were sent: executors may not have this class to read it by."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    @property
    def root(self) -> str | None:
        return self.top[-1][0] if self.place else None

    def subroot(self, group: str | None) -> str:
        return self.of_group[group][-1][0]

    def suffix(self, group: str | None, block: int) -> list[Step]:
        """The proof of a block, by way of its group's root to the root."""
        steps = []
        for levels, i in ((self.of_group[group], block), (self.top, self.place[group])):
            for level in levels[:-1]:
                steps.append(siblings(level, i))
                i //= ARITY
        return steps


def placed(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`leaves` (a written table) with their place (`_at`, from 0) in their group by `order`, and `_size`, the group's rows.

    Rows go to ranges of group and order, which are written to the shared folder. The number of equal rows doesn't matter:
    the last of the order columns should tell all apart.
    """
    by = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    ranged = leaves.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = checkpointed(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    # a row for each range and group in it: at most as many as ranges and groups together
    held = ranged.groupBy("_range", F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    of_group = Window.partitionBy("_g")
    held = held.select(
        F.col("_range").alias("_r"), "_g", F.sum("_n").over(of_group).alias("_size"),
        (F.coalesce(F.sum("_n").over(of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    held = small(checkpointed(held))
    there = (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g"))
    return ranged.join(held, there).withColumn("_at", F.col("_row") + F.col("_shift")).drop("_range", "_row", "_r", "_g", "_shift")


def manifest(leaves: DataFrame, key: str, group: str, leaf: str = "leaf", claimed: str = "claimed", powers: tuple[int, ...] = BLOCK_POWERS, few: int = FEW_BLOCKS) -> DataFrame:
    """`key`, leaf, subroot, root, proof, folded_root, verified for every row of `leaves`.

    In each group, leaves ascend by `key` (null first; equal keys by leaf, equal leaves in any order); every ARITY nodes,
    and what is left over, become one, until one is left, the subroot. Subroots, by group (null first, then by bytes),
    likewise give the root. proof has the other nodes of each run on the way to the root (left and right of the way), and
    folded_root is what `claimed` gives with it, worked out for each row; verified tells whether that is the root.
    A group is any string; it may hold any share of the rows. An empty table gives no rows.
    """
    spark = leaves.sparkSession
    # written, as ranges are sampled: digests are worked out once
    kept = checkpointed(leaves.select(F.col(key).alias("_key"), F.col(group).alias("_group"), F.col(leaf).alias("_leaf"), F.col(claimed).alias("_claimed"), F.monotonically_increasing_id().alias("_tie")))
    rows = placed(kept, "_group", ["_key", "_leaf", "_tie"])
    n = kept.count()
    power = next((k for k in powers if n / ARITY**k <= few), powers[-1])
    blocks = rows.withColumn("_block", F.expr(f"_at div {ARITY**power}"))

    def tree(t: pa.Table) -> tuple[pa.Table, list[list[str]]]:
        t = t.sort_by("_at")
        return t, reduced(t["_leaf"].to_pylist(), min(power, height(t["_size"][0].as_py())))

    def up(keys: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        _, levels = tree(t)
        return pa.table({"_group": pa.array([keys[0].as_py()], "string"), "_block": pa.array([keys[1].as_py()], "int64"), "_digest": levels[-1]})

    found = checkpointed(blocks.groupBy("_group", "_block").applyInArrow(up, "_group string, _block long, _digest string"))
    if found.limit(MOST_BLOCKS + 1).count() > MOST_BLOCKS:
        raise ValueError(f"more than {MOST_BLOCKS} blocks and groups")
    by_group: dict[str | None, list[tuple[int, str]]] = {}
    for r in found.toArrow().to_pylist():
        by_group.setdefault(r["_group"], []).append((r["_block"], r["_digest"]))
    upper = UpperTree({g: [d for _, d in sorted(b)] for g, b in by_group.items()})
    if len(pickle.dumps(vars(upper))) > MOST_BYTES:
        raise ValueError(f"the tree above the blocks takes over {MOST_BYTES} bytes")
    sent = spark.sparkContext.broadcast(vars(upper))
    step = pa.struct([("left", pa.string()), ("right", pa.string())])

    def down(keys: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block = keys[0].as_py(), keys[1].as_py()
        t, levels = tree(pa.Table.from_batches(tables))
        upper = UpperTree.of(sent.value)
        above, root, subroot = upper.suffix(group, block), upper.root, upper.subroot(group)
        proven = t["_claimed"].to_pylist()
        for begin in range(0, t.num_rows, 1024):  # a leaf's proof has some kilobytes
            proofs, roots = [], []
            for i in range(begin, min(begin + 1024, t.num_rows)):
                proof = [siblings(level, i // ARITY**j) for j, level in enumerate(levels[:-1])] + above
                proofs.append([{"left": s.left, "right": s.right} for s in proof])
                roots.append(fold(proven[i], proof))
            part = t.slice(begin, 1024).combine_chunks()
            made = [part["_key"], part["_leaf"], pa.array([subroot] * len(roots)), pa.array([root] * len(roots)), pa.array(proofs, pa.list_(step)), pa.array(roots), pa.array([r == root for r in roots])]
            yield from pa.table(made, names=["_key", "leaf", "subroot", "root", "proof", "folded_root", "verified"]).to_batches()

    kind = kept.schema["_key"].dataType.simpleString()
    out = blocks.groupBy("_group", "_block").applyInArrow(down, f"_key {kind}, leaf string, subroot string, root string, proof array<struct<left: string, right: string>>, folded_root string, verified boolean")
    return out.withColumnRenamed("_key", key)


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's nodes, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
