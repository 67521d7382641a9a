"""Document fingerprints: bottom-k sketches of shingle hashes, mergeable across parts of a document.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

#: Hashes kept; the error of an estimate is about 1/sqrt(K).
K = 128
#: Shingles are of so many words.
WORDS = 5
_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words are runs of other characters than the six ASCII spaces."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def shingle_hashes(words: str, width: int = WORDS) -> Column:
    """XXH64 of each run of `width` words of the array column `words`, repeats included; fewer words make one shingle, none make none."""
    at = lambda i, k: F.get(F.col(words), i + k)
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0))), lambda i: F.xxhash64(*[at(i, k) for k in range(width)]))
    )


def bottom_k(hashes: Column, k: int = K) -> Column:
    """The k least distinct hashes, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together, from the sketches of each."""
    return bottom_k(F.concat(a, b), k)


def merge_parts(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per `key` from the sketches of its parts; no task holds more than the k least hashes of a salted group.

    Each key's hashes are numbered after a first salted cut to k per part group, so a key with a third of all parts is
    cut in many tasks. Null sketches count as empty; keys whose sketches are all empty get an empty sketch.
    """
    least = lambda df, *by: df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_h"))).filter(F.col("_r") <= k).drop("_r")
    one = parts.select(F.col(key), F.explode_outer(sketch).alias("_h")).filter(F.col("_h").isNotNull()).distinct()
    cut = least(one.withColumn("_salt", F.pmod(F.xxhash64("_h"), F.lit(64))), key, "_salt").drop("_salt")
    found = least(cut, key).groupBy(key).agg(F.sort_array(F.collect_list("_h")).alias("sketch"))
    keys = parts.select(F.col(key).alias("_key")).distinct()
    return keys.join(found, F.col("_key").eqNullSafe(F.col(key)), "left").select(F.col("_key").alias(key), F.coalesce("sketch", F.array().cast("array<bigint>")).alias("sketch"))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of two sketched shingle sets; 1 if both are empty."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the largest kept hash as a share of the range."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b, from the likeness and the counts; 1 if a is empty."""
    j, n, m = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (n + m) / ((1 + j) * n)))


def fingerprint_text(sketch: Column) -> Column:
    """A sketch as a string: 16 hex digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def sketch_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, width: int = WORDS) -> DataFrame:
    """`key`, sketch and n_shingles (estimated, distinct) of every row of `docs`; a null text is empty."""
    words = docs.select(key, words_of(text_or_empty(text)).alias("_words"))
    sketched = words.select(key, bottom_k(shingle_hashes("_words", width), k).alias("sketch"))
    return sketched.withColumn("n_shingles", distinct_count(F.col("sketch"), k))


def with_next(docs: DataFrame, key: str, rows_per_bucket: int = 1024, most_buckets: int = 65_536) -> tuple[DataFrame, Column, Window]:
    """Rows dealt into ranges of `key`, with `_bucket` and `_ghost`, and the window in which the next row by descending key stands.

    Range bounds are keys that are in the table, so a range ends at the row which follows the last row of the range
    above: that row is copied there as a ghost. The highest row of all is also copied below the lowest. So one shuffle,
    and no window over the whole table, gives each row its successor. At most `most_buckets` bounds reach the driver.
    Null keys come last; rows with equal keys are ordered by their text's hash and text.
    """
    ids = docs.select(F.col(key).cast("long").alias("_id"))
    n, top, some_null = ids.agg(F.count(F.lit(1)), F.max("_id"), F.coalesce(F.max(F.col("_id").isNull()), F.lit(False))).first()
    buckets = max(1, min(most_buckets, n // rows_per_bucket))
    bounds: list[int] = []
    if buckets > 1 and top is not None:
        at = [k / buckets for k in range(1, buckets)]
        found = ids.agg(F.percentile_approx("_id", at, max(10_000, 4 * buckets)).alias("b")).first().b or []
        bounds = sorted({*found} - {top})
    steps = [1 << s for s in range(len(bounds).bit_length() - 1, -1, -1)] if bounds else []
    edges = F.split(F.lit(",".join(map(str, bounds or [0]))), ",").cast("array<bigint>")
    # how many bounds are under the key, by halving: a row is in bucket i if bound i-1 < key <= bound i
    below = F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), lambda p, s: F.when((p + s <= len(bounds)) & (F.get(edges, p + s - 1) < F.col("_id")), p + s).otherwise(p)) if bounds else F.lit(0)
    placed = docs.withColumn("_id", F.col(key).cast("long"))
    placed = placed.withColumn("_bucket", F.when(F.col("_id").isNull(), F.lit(0)).otherwise(below))
    # a null key is in bucket 0 and last there; the first row of all is above every row of its range and follows the last of bucket 0
    heads_range = F.when(F.col("_bucket") < len(bounds), F.col("_id") == F.get(edges, F.col("_bucket"))).otherwise(F.lit(False)) if bounds else F.lit(False)
    first = F.col("_id") == F.lit(top).cast("long") if top is not None else F.lit(True)
    copies = F.filter(
        F.array(
            F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("ghost")),
            F.when(F.coalesce(heads_range, F.lit(False)), F.struct((F.col("_bucket") + 1).alias("b"), F.lit(1).alias("ghost"))),
            F.when(F.coalesce(first, F.lit(False)), F.struct(F.lit(0).alias("b"), F.lit(2).alias("ghost"))),
        ),
        lambda c: c.isNotNull(),
    )
    dealt = placed.withColumn("_copy", F.explode(copies)).withColumn("_bucket", F.col("_copy.b")).withColumn("_ghost", F.col("_copy.ghost")).drop("_copy")
    order = Window.partitionBy("_bucket").orderBy(F.when(F.col("_ghost") == 2, F.lit(1)).otherwise(F.lit(0)), F.col("_id").desc_nulls_last(), F.xxhash64("_text"), "_text")
    return dealt, F.col("_ghost") == 0, order


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, width: int = WORDS) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how alike they and the next row's are.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of the next row's text,
    rows by descending key, the first after the last. Null texts are empty; an empty text has an empty fingerprint and
    is like another empty text only; very long texts are sketched whole. A lone row is its own next. Rows with null keys
    come last; rows with equal keys follow each other by their text's hash, then text; repeated rows stay; an empty table
    gives none.
    """
    dealt, own, order = with_next(docs.select(F.col(key), text_or_empty(text).alias("_text")), key)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = dealt.withColumn("n_chars", F.length("_text")).withColumn("_next", F.lead("_text").over(order))
    rows = rows.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), F.col("n_chars") - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)))
    rows = rows.withColumn("_words", words_of(F.col("_text"))).withColumn("_edited_words", words_of(F.col("_edited")))
    rows = rows.withColumn("sketch", bottom_k(shingle_hashes("_words", width), k)).withColumn("edited_sketch", bottom_k(shingle_hashes("_edited_words", width), k))
    rows = rows.withColumn("edited_sha256", F.sha2("_edited", 256))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(order)).filter(own)
    return rows.select(
        key,
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("n_shingles"),
    )
