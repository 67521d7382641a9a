"""python -m helixframe COMMAND ...: the entry points on files. Scorers are named module:function."""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from .plans import pipelines


def named(spec: str) -> Callable:
    module, _, function = spec.partition(":")
    return getattr(importlib.import_module(module), function)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="helixframe")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple[str, dict]) -> None:
        one = sub.add_parser(name)
        for flag, how in options:
            one.add_argument(flag, **how)

    need, whole, text, real = {"required": True}, {"type": int}, {}, {"type": float}
    command("join-junctions", ("--junctions", need | {"nargs": "+"}), ("--min-length", whole | {"default": 50}), ("--min-coverage", whole | {"default": 5}), ("--outdir", text | {"default": "."}))
    command("chunk", ("--sequence", text | {"default": "-"}), ("--chunk", whole | {"default": 6_000_000}), ("--flank", whole | {"default": 50_000}), ("--min-contig", whole | {"default": 500}), ("--gzip", {"action": "store_true"}), ("--outdir", text | {"default": "."}))
    command("predict", ("--sequence", need), ("--scorer", need), ("--round", whole | {"default": 4}), ("--min-prob", real | {"default": 0.001}), ("--flank", whole | {"default": 50_000}), ("--outdir", text | {"default": "."}))
    command("derive", ("--bigwigs", need), ("--sequence", text | {"default": "-"}), ("--regions", need), ("--prefix", text | {"default": "spliceai"}), ("--outdir", text | {"default": "."}), ("--floor", whole | {"default": -4}), ("--ceiling", whole | {"default": 13}))
    command("chunk-utrs", ("--bed", need), ("--genome", need), ("--upstream", whole | {"default": 100}), ("--downstream", whole | {"default": 100}), ("--max-size", whole | {"default": 500}), ("--chunks", whole), ("--prefix", text | {"default": "part"}), ("--gzip", {"action": "store_true"}), ("--out", need))
    command("predict-utrs", ("--windows", need), ("--scorer", need), ("--prefix", text | {"default": "peaks"}), ("--mode", {"choices": ["bedgraph", "bed"], "default": "bedgraph"}), ("--threshold", real | {"default": 0.01}), ("--outdir", text | {"default": "."}))
    numbers = [("--min-score", 0), ("--min-target", 0), ("--min-query", 0), ("--gap-min-t", 10), ("--gap-max-t", 100_000), ("--gap-min-q", 10), ("--gap-max-q", 100_000), ("--min-patch", 2000)]
    command("fill-gaps", ("--chain", need), ("--target", need), ("--query", need), ("--out", need), ("--aligner", text), ("--unmask", {"action": "store_true"}), *((f, whole | {"default": d}) for f, d in numbers))
    return p


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    c = a.command
    if c == "join-junctions":
        pipelines.join_junctions(spark, a.junctions, a.outdir, a.min_length, a.min_coverage)
    elif c == "chunk":
        pipelines.chunk_genome(spark, a.sequence, a.outdir, a.chunk, a.flank, a.min_contig, a.gzip)
    elif c == "predict":
        pipelines.predict_sites(spark, a.sequence, named(a.scorer), a.outdir, a.flank, a.min_prob, a.round)
    elif c == "derive":
        pipelines.derive_scores(spark, a.bigwigs, a.sequence, a.regions, a.outdir, a.prefix, a.floor, a.ceiling)
    elif c == "chunk-utrs":
        pipelines.chunk_utrs(spark, a.bed, a.genome, a.out, a.upstream, a.downstream, a.max_size, a.chunks, a.prefix, a.gzip)
    elif c == "predict-utrs":
        pipelines.predict_polya(spark, a.windows, named(a.scorer), a.outdir, a.prefix, a.mode, a.threshold)
    else:
        gaps = {"least_t": a.gap_min_t, "most_t": a.gap_max_t, "least_q": a.gap_min_q, "most_q": a.gap_max_q}
        pipelines.fill_gaps(spark, a.chain, a.target, a.query, a.out, named(a.aligner) if a.aligner else None, a.unmask, a.min_patch, a.min_score, a.min_target, a.min_query, **gaps)


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"helixframe {a.command}").getOrCreate()
    try:
        run(spark, a)
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
