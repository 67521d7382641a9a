"""Filter interaction audit: what five filters remove, together, alone, and in every order.

Words are exploded and aggregated by (row, word) and then by row; the other flags are joined to these counts; each row
then has one of 32 sets of failed filters, and all answers are sums over the 32 counts of a part.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: The filters by letter; a set of failed filters is a number with bit k for the k-th letter.
FILTERS = "ABCDE"
#: A task explodes about this many bytes of text, so that its table of words fits in memory.
TASK_BYTES = 16 << 20
#: More tasks than this are not asked for; from there on (1 TB) word tables grow, and spill where they don't fit.
MOST_TASKS = 65_536


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, _h, _words, _distinct: the words of each text, and how many differ, by the relational pipeline.

    Texts are dealt by row first, so that both aggregations find a row's words in one task, already combined, and no word
    is shuffled. A marker (a space, which no word is) beside the words counts how often a row is repeated; repeated rows of
    one input partition are counted together and divided by that, those of others apart, so that no pile of equal rows is
    one group.
    """
    whole = text_or_empty(text)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(whole)), F.lit(0))).first()[0]
    tasks = min(MOST_TASKS, max(docs.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES + 1))
    rows = docs.select(F.col(key).alias(key), F.xxhash64(whole).alias("_h"), whole.alias("_text"), F.spark_partition_id().alias("_from"))
    dealt = rows.repartition(tasks, key, "_h", "_from")
    words = dealt.select(key, "_h", "_from", F.explode(F.concat(F.array(F.lit(" ")), F.split("_text", r"[ \t-\r]+"))).alias("_word")).filter("_word != ''")
    of_word = words.groupBy(key, "_h", "_from", "_word").agg(F.count(F.lit(1)).alias("_n"))
    is_word = F.col("_word") != " "
    of_row = of_word.groupBy(key, "_h", "_from").agg(
        F.sum(F.when(is_word, F.col("_n")).otherwise(0)).alias("_all"), F.count(F.when(is_word, True)).alias("_distinct"), F.sum(F.when(is_word, 0).otherwise(F.col("_n"))).alias("_times")
    )
    return of_row.groupBy(key, "_h").agg(F.max(F.expr("_all div _times")).alias("_words"), F.max("_distinct").alias("_distinct"))


def failed_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """_part, _failed (bits of FILTERS), _good, _toxic and _rows: how many rows of `docs` agree in these.

    A: under 200 words. B: less than half of the words differ. C: over 3 % capital letters A-Z. D: one of `#$%&*|`. E: a
    lesser `key` has the same text. A null text is empty; a null key is greater than all others, so that it fails E only
    where another key is not null; rows equal in key and text fail alike. A row is good or toxic if any label of its key says so.
    """
    whole = text_or_empty(text)
    rows = docs.select(
        F.col(key).alias(key), F.xxhash64(whole).alias("_h"), F.xxhash64(F.lit(1), whole).alias("_h2"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
        (100 * F.regexp_count(whole, F.lit("[A-Z]")) > 3 * F.char_length(whole)).alias("_c"), whole.rlike("[#$%&*|]").alias("_d"),
    )  # two hashes of 64 bits stand for the text
    rows = rows.groupBy(key, "_h", "_h2", "_part", "_c", "_d").agg(F.count(F.lit(1)).alias("_rows"))
    # one row a text, which meets only the rows with its key: copies are never together in one task
    firsts = rows.groupBy("_h", "_h2").agg(F.min(key).alias("_key")).withColumnsRenamed({"_h": "_g", "_h2": "_g2"})
    rows = rows.join(firsts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_h") == F.col("_g")) & (F.col("_h2") == F.col("_g2")), "left")
    words = word_counts(docs, key, text).withColumnsRenamed({key: "_wkey", "_h": "_wh"})
    rows = rows.join(words, F.col(key).eqNullSafe(F.col("_wkey")) & (F.col("_h") == F.col("_wh")), "left")
    told = labels.groupBy(F.col("doc_id").alias("_lkey")).agg(F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic"))
    rows = rows.join(told, F.col(key) == F.col("_lkey"), "left")
    n, distinct = F.coalesce("_words", F.lit(0)), F.coalesce("_distinct", F.lit(0))
    fails = [n < 200, 100 * distinct < 50 * n, F.col("_c"), F.col("_d"), F.col("_g").isNull()]
    failed = sum((F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    alike = rows.groupBy("_part", failed.alias("_failed"), F.coalesce("_good", F.lit(False)).alias("_good"), F.coalesce("_toxic", F.lit(False)).alias("_toxic"))
    return alike.agg(F.sum("_rows").alias("_rows"))


def _sum_of(counts: str, takes: Column, of: int = 1 << len(FILTERS)) -> Column:
    """The sum of the counts of those sets (an array by set) for which `takes(set)`."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(of - 1)), F.lit(0).cast("long"), lambda got, s: got + F.when(takes(s), F.get(F.col(counts), s)).otherwise(F.lit(0)))


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, filter_order, step, and what the step's filter does there: a row for each part, order of FILTERS and step.

    kept and removed count rows after and at this step; redundant ones fail its filter but went earlier; unique_fails fail
    no other filter; good_lost and toxic_lost are labelled so and go here; shapley sums what its filter removes over all
    orders: of rows with n failed filters, each filter comes first in one of n orders. A null part is the empty string;
    nulls, repeated rows and ties are as in failed_filters; very long texts count whole; other columns aren't read; an
    empty table gives no rows.
    """
    sets = 1 << len(FILTERS)
    failed = failed_filters(docs, labels, key, text, part)

    def columns(name: str, among: Column) -> list[Column]:
        return [F.sum(F.when(among & (F.col("_failed") == s), F.col("_rows")).otherwise(0)).alias(f"{name}{s}") for s in range(sets)]

    counts = failed.groupBy("_part").agg(*columns("_all", F.lit(True)), *columns("_g", F.col("_good")), *columns("_t", F.col("_toxic")))
    counts = counts.select(F.col("_part").alias("part"), *[F.array(*[f"{name}{s}" for s in range(sets)]).alias(name) for name in ("_all", "_g", "_t")])
    steps = [
        F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(sum(1 << FILTERS.index(f) for f in order[:k])).alias("_before"), F.lit(1 << FILTERS.index(order[k])).alias("_bit"))
        for order in permutations(FILTERS)
        for k in range(len(FILTERS))
    ]
    bit, before = F.col("_bit"), F.col("_before")
    orders = factorial(len(FILTERS))
    # what doesn't depend on the order is worked out once a part and filter
    of_filter = counts.select("*", F.explode(F.array(*[F.lit(1 << k) for k in range(len(FILTERS))])).alias("_bit")).select(
        "*", F.get("_all", bit).alias("unique_fails"),
        F.aggregate(F.sequence(F.lit(1), F.lit(sets - 1)), F.lit(0).cast("long"), lambda got, s: got + F.when(s.bitwiseAND(bit) != 0, F.get("_all", s) * (F.lit(orders) / F.bit_count(s)).cast("long")).otherwise(F.lit(0))).alias("shapley"),
    )
    spread = of_filter.select("*", F.explode(F.filter(F.array(*steps), lambda x: x["_bit"] == bit)).alias("_step")).select("*", "_step.filter_order", "_step.step", "_step._before")
    here = lambda s: (s.bitwiseAND(bit) != 0) & (s.bitwiseAND(before) == 0)
    return spread.select(
        "part", "filter_order", "step",
        _sum_of("_all", lambda s: s.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        _sum_of("_all", here).alias("removed"),
        _sum_of("_all", lambda s: (s.bitwiseAND(bit) != 0) & (s.bitwiseAND(before) != 0)).alias("redundant"),
        "unique_fails",
        _sum_of("_g", here).alias("good_lost"),
        _sum_of("_t", here).alias("toxic_lost"),
        "shapley",
    )
