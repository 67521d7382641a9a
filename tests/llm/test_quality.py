import random
import re
from collections import Counter

import duckdb
import public_tokenizers

from helixframe.llm import quality as q


def base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(marked), len(words) < 50 or 100 * len(marked) > 50 * len(words)


def test_counts_against_brute_force(docs, texts):
    got = {r.doc_id: r for r in q.judge_quality(docs).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t)
        assert not (r.kept and r.base_failed) and (r.chars_per_token is None) == r.base_failed


def test_repeats_and_odd_spaces():
    rng = random.Random(8)
    for _ in range(300):
        t = "".join(rng.choices(["a", "b", " ", "\n", "\x1c", "\u00a0", "\v", "#", "é"], k=rng.randrange(60)))
        b = t.encode()
        assert (q.repeat_words(b.split()), q.dup_lines(b)) == (base(t)[4], base(t)[3])


def test_rejects_what_no_language_is_like(spark):
    rng = random.Random(1)
    prose = " ".join(rng.choices("the of and people water through house between something never morning little again where because light story river under keep walked slowly towards old mountain while singing quiet songs about distant places".split(), k=160))
    junk = " ".join("".join(rng.choices("\U00012000\U00012001\U00012abc\U00010900ꙮ𓀀", k=6)) for _ in range(120))
    docs = spark.createDataFrame([(1, prose, None), (2, junk, None), (3, None, "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.kept for r in q.judge_quality(docs).collect()} == {1: True, 2: False, 3: False}


def test_rows(docs, odd_docs, no_docs):
    assert q.judge_quality(odd_docs).count() == odd_docs.count() and q.judge_quality(no_docs).count() == 0
    kept = q.keep_good(docs)
    want = {r.doc_id for r in q.judge_quality(docs).collect() if r.kept}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want and q.keep_good(no_docs).count() == 0


def measured(where):
    """(language, label, measures) of the labelled rows of sf0.1 that pass the base rules."""
    at = "/root/testdata/sf0.1"
    rows = duckdb.connect().execute(f"SELECT text, lang, quality FROM read_parquet('{at}/documents.parquet') d JOIN read_parquet('{at}/labels.parquet') l USING (doc_id) WHERE text IS NOT NULL AND {where}").fetchall()
    model = q.Fertility(open(public_tokenizers.path(q.VOCABULARY), "rb").read(), public_tokenizers.PATTERN)
    return [(g, y, model.measure(t)) for t, g, y in rows if not base(t)[-1]]


def test_bands_are_those_of_the_fitted_rows_and_hold_for_others():
    fitted = [(g, c, e, n) for g, _, (c, _, e, n) in measured("quality = 1 AND doc_id % 2 = 0")]
    assert len(fitted) == 1578 and q.fit_bands(fitted) == (q.BANDS, q.SHARE)
    held = [(y, q.in_band(m, q.BANDS[g])) for g, y, m in measured("doc_id % 2 = 1")]
    good, bad = ([k for y, k in held if y == x] for x in (1, 0))
    assert sum(good) >= 0.998 * len(good) and sum(bad) <= 0.4 * len(bad)
