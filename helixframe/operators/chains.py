"""Alignment chains: coordinates, gaps, and patches spliced into them.

chains: chain_id, score, t_name, t_start, t_end, q_name, q_size, q_strand, q_start, q_end.
blocks: chain_id, block_no, size, dt, dq; dt and dq are null on a chain's last block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Blocks of a chain that are summed together; longer chains are many tasks.
BIN = 1 << 16


def coordinates(blocks: DataFrame, starts: DataFrame | None = None, bin: int = BIN) -> DataFrame:
    """`blocks` with t_pos and q_pos: where each begins, from 0 or from the t_start and q_start of `starts` (by chain_id).

    Sums run within bins of block numbers; what comes before a bin is added from the sums of the chain's bins, which only
    chains of more than one have.
    """
    binned = blocks.withColumn("_bin", F.floor(F.col("block_no") / bin))
    step = lambda gap: F.col("size") + F.coalesce(F.col(gap), F.lit(0))
    before = Window.partitionBy("chain_id", "_bin").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = binned.withColumn("t_pos", F.coalesce(F.sum(step("dt")).over(before), F.lit(0))).withColumn("q_pos", F.coalesce(F.sum(step("dq")).over(before), F.lit(0)))
    long = blocks.filter(F.col("block_no") >= bin).select(F.col("chain_id").alias("_long")).distinct()
    sums = binned.join(long, F.col("chain_id") == F.col("_long"), "left_semi").groupBy("chain_id", "_bin").agg(F.sum(step("dt")).alias("_dt"), F.sum(step("dq")).alias("_dq"))
    bins = Window.partitionBy("chain_id").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col("chain_id").alias("_chain"), F.col("_bin").alias("_b"), F.sum("_dt").over(bins).alias("_t"), F.sum("_dq").over(bins).alias("_q"))
    rows = rows.join(carried, (F.col("chain_id") == F.col("_chain")) & (F.col("_bin") == F.col("_b")), "left")
    rows = rows.withColumn("t_pos", F.col("t_pos") + F.coalesce("_t", F.lit(0))).withColumn("q_pos", F.col("q_pos") + F.coalesce("_q", F.lit(0))).drop("_bin", "_chain", "_b", "_t", "_q")
    if starts is None:
        return rows
    own = starts.select("chain_id", F.col("t_start").alias("_t"), F.col("q_start").alias("_q"))
    return rows.join(own, "chain_id").withColumn("t_pos", F.col("t_pos") + F.col("_t")).withColumn("q_pos", F.col("q_pos") + F.col("_q")).drop("_t", "_q")


def wanted(chains: DataFrame, least_score: int = 0, least_target: int = 0, least_query: int = 0) -> DataFrame:
    return chains.filter((F.col("score") >= least_score) & (F.col("t_end") - F.col("t_start") >= least_target) & (F.col("q_end") - F.col("q_start") >= least_query))


def gaps(blocks: DataFrame, least_t: int = 10, most_t: int = 100_000, least_q: int = 10, most_q: int = 100_000) -> DataFrame:
    """Blocks whose gaps after them are within both ranges, ends included."""
    return blocks.filter(F.col("dt").between(least_t, most_t) & F.col("dq").between(least_q, most_q))


def gap_jobs(chains: DataFrame, blocks: DataFrame, **limits) -> DataFrame:
    """What an aligner needs of each gap: 1-based gap starts, ends, and on a minus query the coordinates of its other strand."""
    placed = gaps(coordinates(blocks, chains), **limits).join(chains.select("chain_id", "t_name", "q_name", "q_strand", "q_size"), "chain_id")
    t0, q0 = F.col("t_pos") + F.col("size"), F.col("q_pos") + F.col("size")
    q1 = q0 + F.col("dq")
    minus = F.col("q_strand") == "-"
    return placed.select(
        "chain_id", "block_no", "size", "t_name", "q_name", "q_strand", (t0 + 1).alias("t_lo"), (t0 + F.col("dt")).alias("t_hi"),
        F.when(minus, F.col("q_size") - q1 + 1).otherwise(q0 + 1).alias("q_lo"), F.when(minus, F.col("q_size") - q0).otherwise(q1).alias("q_hi"),
        t0.alias("t0"), (t0 + F.col("dt")).alias("t1"), q0.alias("q0"), q1.alias("q1"),
    )


def best_patches(patches: DataFrame, least_score: int = 2000) -> DataFrame:
    """Of each gap's patches the first by rank, if its score is `least_score` or more."""
    first = Window.partitionBy("chain_id", "block_no").orderBy("rank", F.desc("score"))
    return patches.withColumn("_r", F.row_number().over(first)).filter((F.col("_r") == 1) & (F.col("score") >= least_score)).drop("_r")


def patched(blocks: DataFrame, patches: DataFrame) -> DataFrame:
    """chain_id, block_no, part, size, dt, dq: blocks with the patch of their gap, if any, in its place.

    blocks need t_pos and q_pos. patches: chain_id, block_no, t_start, t_end, q_start, q_end and blocks (array of size,
    dt, dq), one a gap. The block's gap ends where the patch begins, and the patch's last block has the rest of it.
    """
    own = patches.select("chain_id", "block_no", F.struct("t_start", "t_end", "q_start", "q_end", F.col("blocks").alias("inner")).alias("p"))
    rows = blocks.join(own, ["chain_id", "block_no"], "left")
    t0, q0 = F.col("t_pos") + F.col("size"), F.col("q_pos") + F.col("size")
    t1, q1 = t0 + F.col("dt"), q0 + F.col("dq")
    part = lambda size, dt, dq: F.struct(size.cast("bigint").alias("size"), dt.cast("bigint").alias("dt"), dq.cast("bigint").alias("dq"))
    inner = F.col("p.inner")
    n = F.size(inner)
    middle = F.when(n > 1, F.transform(F.slice(inner, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda b: part(b["size"], b["dt"], b["dq"]))).otherwise(F.array().cast("array<struct<size:bigint,dt:bigint,dq:bigint>>"))
    spliced = F.concat(
        F.array(part(F.col("size"), F.col("p.t_start") - t0, F.abs(F.col("p.q_start") - q0))), middle, F.array(part(F.element_at(inner, -1)["size"], t1 - F.col("p.t_end"), F.abs(q1 - F.col("p.q_end"))))
    )
    parts = F.when(F.col("p").isNotNull() & F.col("dt").isNotNull(), spliced).otherwise(F.array(part(F.col("size"), F.col("dt"), F.col("dq"))))
    return rows.select("chain_id", "block_no", F.posexplode(parts).alias("part", "x")).select("chain_id", "block_no", "part", "x.size", "x.dt", "x.dq")


def realigned(jobs: DataFrame, align: Callable[[str, str], list[tuple]], t_seq: str = "t_seq", q_seq: str = "q_seq") -> DataFrame:
    """Patches of gaps (with their two sequences) by an aligner of the caller's (alignment.aligned_gaps has our own): a function from two sequences to rows of
    (score, t_start, t_end, q_start, q_end, [(size, dt, dq), ...]), positions from 0 within the two."""
    schema = "chain_id long, block_no int, rank int, score long, t_start long, t_end long, q_start long, q_end long, blocks array<struct<size:long,dt:long,dq:long>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                for rank, (score, ts, te, qs, qe, inner) in enumerate(align(getattr(r, t_seq), getattr(r, q_seq))):
                    cells = [{"size": s, "dt": dt, "dq": dq} for s, dt, dq in inner]
                    rows.append((r.chain_id, r.block_no, rank, score, r.t0 + ts, r.t0 + te, r.q0 + qs, r.q0 + qe, cells))
            yield pd.DataFrame(rows, columns=["chain_id", "block_no", "rank", "score", "t_start", "t_end", "q_start", "q_end", "blocks"])

    return jobs.select(F.col("chain_id").cast("long"), F.col("block_no").cast("int"), F.col("t0").cast("long"), F.col("q0").cast("long"), t_seq, q_seq).mapInPandas(run, schema)
