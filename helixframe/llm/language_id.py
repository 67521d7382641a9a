"""Language by prediction by partial matching: a byte context tree for each language, frozen, scores exact code lengths.

The trees of all languages share their contexts (up to three bytes), so that a byte's context is looked up once; each
language has its own statistics. What a byte costs after a context, by way of escapes to shorter contexts, is worked out
beforehand for all bytes, so that a text's code length is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name

#: The sample that trees are fitted to: at most so many different texts of a language, and of each so many characters.
SAMPLE_ROWS, SAMPLE_CHARS = 1_000, 4_096
#: Bytes of context.
ORDER = 3
#: What stands before each text, so that its first bytes have contexts.
START = "\n" * ORDER
#: Code lengths are whole numbers of this part of a bit, so that sums are exact in any order.
UNIT = 1 << 16
#: Entries of the code length table (32 MB); the contexts seen most are kept, as many as it holds for the languages there are.
MOST_CELLS = 1 << 23
#: More languages than this are an error: the trees would be too small to tell them apart.
MOST_LANGS = 256
#: Bytes that are scored at once.
PIECE = 1 << 21


class Trees(NamedTuple):
    """Frozen trees: languages, a symbol for each byte, contexts by their last two bytes and by the one before, code lengths by (context, symbol) for each language."""

    langs: list[str]
    symbol: np.ndarray
    pair: np.ndarray
    longer: np.ndarray
    cost: np.ndarray
    symbols: int


def coded(text: str | Column) -> Column:
    """A text as it is scored: in small letters, behind START."""
    return F.concat(F.lit(START), F.lower(text))


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each byte of the texts with the three before it, as one number."""
    if len(data) <= ORDER:
        return np.empty(0, np.uint32)
    wide = data.astype(np.uint32)
    found = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts + ORDER, 1)
    np.add.at(inside, ends, -1)
    return found[np.cumsum(inside)[ORDER:-1] > 0]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, and the bounds of its texts."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def sample(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """_lang, _text: at most `rows` different texts of each language, and of each its first `chars` characters.

    Texts with the least hashes are taken, wherever they are; copies count once, combined before they are shuffled.
    """
    told = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), F.xxhash64(text).alias("_h"))
    counts = {r["_lang"]: r.n for r in told.groupBy("_lang").agg(F.approx_count_distinct("_h").alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    # hashes are uniform: this part of them has twice the rows that are wanted, of which the least are taken
    least = {g: min(1.0, 2 * rows / n + 1e-12) if n > 4 * rows else 1.0 for g, n in counts.items()}
    bound = F.lit(None).cast("double")
    for g, part in sorted(least.items()):
        bound = F.when(F.col("_lang") == g, F.lit(part)).otherwise(bound)
    few = told.filter((F.col("_h").cast("double") / 2.0**64 + 0.5) <= bound).groupBy("_lang", "_h").agg(F.first(F.substring("_text", 1, chars)).alias("_text"))
    return few.withColumn("_row", F.row_number().over(Window.partitionBy("_lang").orderBy("_h"))).filter(F.col("_row") <= rows).select("_lang", "_text")


def window_counts(texts: DataFrame) -> DataFrame:
    """_lang, _window, _n: how often four bytes follow each other in the texts of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch["_lang"].dictionary_encode()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                data, bounds = texts_of(batch["_text"].filter(pa.array(langs.indices.to_numpy(zero_copy_only=False) == k)))
                found, n = np.unique(windows(data, bounds[:-1], bounds[1:]), return_counts=True)
                yield pa.record_batch([pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], names=["_lang", "_window", "_n"])

    each = texts.select("_lang", coded("_text").alias("_text")).mapInArrow(count, "_lang string, _window long, _n long")
    return each.groupBy("_lang", "_window").agg(F.sum("_n").alias("_n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, most_cells: int = MOST_CELLS) -> Trees:
    """Trees of the languages of `docs`, fitted to a bounded sample of its rows that have one.

    What comes to the driver are counts of the sample's windows, at most as many as its bytes: languages * rows * chars
    characters. Nulls in either column are left out; without any row that is left there are no languages.
    """
    counts = window_counts(sample(docs, text, lang, rows, chars)).toArrow()
    return grow(counts["_lang"].to_numpy(), counts["_window"].to_numpy().astype(np.uint32), counts["_n"].to_numpy().astype(np.int64), most_cells)


def grow(lang: np.ndarray, window: np.ndarray, n: np.ndarray, most_cells: int = MOST_CELLS) -> Trees:
    """Trees from counts of windows by language.

    Escapes are by method C: after a context that was followed by d different bytes n times, a byte seen there costs its
    count of n + d, an escape d of n + d; bytes seen in the longer context are excluded from the shorter one. Bytes that
    were never seen share what the root's escape leaves, equally. A language that never saw a context begins with the next
    shorter one, at no cost.
    """
    langs = sorted(set(lang.tolist()))
    of = np.searchsorted(np.array(langs, dtype=object), lang) if langs else np.empty(0, np.int64)
    seen = np.unique(window & 0xFF)
    symbol = np.full(256, len(seen), np.int64)
    symbol[seen] = np.arange(len(seen))
    symbols = len(seen) + 1  # the last one is for bytes that were never seen
    # contexts by length, most frequent first; shorter ones are at least as frequent, so suffixes of those kept are kept
    room = max(1, most_cells // (symbols * max(1, len(langs))))
    keys, totals = [], []
    for size in range(ORDER + 1):
        key, at = np.unique((window >> 8) & ((1 << 8 * size) - 1), return_inverse=True)
        keys.append(key)
        totals.append(np.bincount(at, n, len(key)) if len(key) else np.empty(0))
    every = np.sort(np.concatenate(totals))[::-1]
    least = every[room] + 1 if len(every) > room else 0
    keys = [k[t >= least] if size else k for size, (k, t) in enumerate(zip(keys, totals, strict=True))]
    if not langs:
        keys[0] = np.zeros(1, np.uint32)
    first = np.cumsum([0] + [len(k) for k in keys])  # a context's id: its place among all, by length
    cost = np.zeros((len(langs), int(first[-1]), symbols), np.float64)
    for g in range(len(langs)):
        mine = of == g
        w, m = window[mine], n[mine]
        above = rest_above = None  # what bytes cost at the shorter contexts, and what those cost that these exclude
        for size, key in enumerate(keys):
            ctx = (w >> 8) & ((1 << 8 * size) - 1)
            at = np.searchsorted(key, ctx)
            kept = (at < len(key)) & (key[np.minimum(at, len(key) - 1)] == ctx) if len(key) else np.zeros(len(w), bool)
            count = np.zeros((len(key), symbols))
            np.add.at(count, (at[kept], symbol[w[kept] & 0xFF]), m[kept])
            has, total, kinds = count > 0, count.sum(1), (count > 0).sum(1)
            if size == 0:
                # the bytes that this language never saw, each with the same share
                left = np.full((len(key), symbols), np.log2(max(1, 256 - int(kinds[0]))) if len(key) else 0.0)
                below, rest = left, left
            else:
                up = np.searchsorted(keys[size - 1], key & ((1 << 8 * (size - 1)) - 1))
                below, rest = above[0][up], None
                ucount = above[1][up]
                free = np.where(has, 0, ucount)
                new, new_kinds = free.sum(1), (free > 0).sum(1)
                whole = np.maximum(new + new_kinds, 1)[:, None]
                with np.errstate(divide="ignore"):
                    out = np.where(new_kinds > 0, -np.log2(np.maximum(new_kinds, 1) / whole[:, 0]), 0.0)[:, None]
                    rest = np.where(free > 0, -np.log2(np.maximum(free, 1) / whole), out + rest_above[up])
            with np.errstate(divide="ignore"):
                escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)[:, None]
                own = np.where(has, -np.log2(np.maximum(count, 1) / np.maximum(total + kinds, 1)[:, None]), escape + rest)
            own = np.where((total > 0)[:, None], own, below)  # a context that it never saw
            rest = np.where((total > 0)[:, None], rest, rest_above[up] if size else rest)
            cost[g, first[size] : first[size + 1]] = own
            above, rest_above = (own, count), rest
    # the longest kept context of any three bytes: by the last two, then by the one before
    pair = np.zeros(1 << 16, np.int32)
    last = np.zeros(256, np.int32)
    last[keys[1]] = first[1] + np.arange(len(keys[1]))
    pair[:] = last[np.arange(1 << 16) & 0xFF]
    pair[keys[2]] = first[2] + np.arange(len(keys[2]))
    longer = np.repeat(np.arange(first[3], dtype=np.int32)[:, None], 256, 1)
    longer[pair[keys[3] & 0xFFFF], keys[3] >> 16] = first[3] + np.arange(len(keys[3]))
    units = np.rint(cost * UNIT).astype(np.int32).reshape(len(langs), int(first[-1]) * symbols)
    return Trees(langs, symbol.astype(np.int32), pair, longer.reshape(-1), units, symbols)


def code_lengths(trees: Trees, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The code length of each text (its bytes from START on) in each language, in UNITs of a bit: (texts, languages)."""
    out = np.zeros((len(bounds) - 1, len(trees.langs)), np.int64)
    for begin in range(ORDER, len(data), PIECE):
        end = min(begin + PIECE, len(data))
        part = data[begin - ORDER : end]
        back2 = part[1:-2].astype(np.int32)
        context = trees.pair[(back2 << 8) | part[2:-1]]
        # the byte before the pair: contexts that have no longer one stay the same
        cell = trees.longer[context * 256 + part[: -ORDER]] * trees.symbols + trees.symbol[part[ORDER:]]
        here = np.searchsorted(bounds, begin, "right") - 1, np.searchsorted(bounds, end, "left")
        # texts that have bytes here, each from behind its START on
        lo = np.clip(bounds[here[0] : here[1]] + ORDER, begin, end) - begin
        hi = np.clip(bounds[here[0] + 1 : here[1] + 1], begin, end) - begin
        for g in range(len(trees.langs)):
            total = np.concatenate(([0], np.cumsum(trees.cost[g][cell], dtype=np.int64)))
            out[here[0] : here[1], g] += np.where(hi > lo, total[hi] - total[lo], 0)
    return out


def judged(trees: Trees) -> Callable[[pa.Array, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Language number (-1: none), score and bits per byte of coded texts, those of which are left out that `letters` is false for."""

    def judge(texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, bounds = texts_of(texts)
        if not trees.langs:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.full(len(texts), np.nan)
        bits = code_lengths(trees, data, bounds) / UNIT
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        score = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(1)
        size = np.maximum(np.diff(bounds) - ORDER, 1)
        return np.where(letters, best, -1), np.where(letters, score, 0.0), np.where(letters, least / size, np.nan)

    return judge


def predict(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """`docs` without `text`, with lang_pred, score and bits_per_byte.

    lang_pred is the language whose tree gives the whole text the shortest code (ties: the first by name), score its share
    of probability among all of them, each as likely beforehand, and bits_per_byte the code's length. A text that is null
    or has no letter, or any text where there are no trees, is `und` with score 0 and null bits. Only the text is looked at.
    Columns of these names are replaced.
    """
    made = ("lang_pred", "score", "bits_per_byte")
    others = [c for c in docs.columns if c != text and c.lower() not in made]
    whole, has = free_name(docs, "_coded"), free_name(docs, "_letters")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(trees))  # plain, as executors may not have the class
    ready = docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(coded(text), F.lit(START)).alias(whole), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(has))
    schema = ready.select(*[f"`{c}`" for c in others], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*sent.value)
        judge, names = judged(trees), pa.array([*trees.langs, "und"])
        for batch in batches:
            if batch.num_rows:
                k, score, bits = judge(batch.column(len(others)), batch.column(len(others) + 1).to_numpy(zero_copy_only=False))
                lang = names.take(pa.array(np.where(k < 0, len(trees.langs), k)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], lang, pa.array(score), pa.array(bits, from_pandas=True)], names=[*others, *made])

    return ready.mapInArrow(run, schema)
