import random
import re

import duckdb

from helixframe.llm import credentials as c

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    """The contract's words: all matches of each pattern, then the failing ones dropped."""
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return spans + [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def test_base_spans_against_the_plain_patterns():
    rng = random.Random(9)
    bits = ["token", "TOKEN", "to\u212aen", "\u017fecret", "secret", "api_key", "apikey", "passwd", "password", "=", ":", " ", "'", '"', "abc", "abcdef", "0" * 23, "a1" * 12, "AKIA", "AKIAAKIA", "Z9" * 8, "é", "\n", ".", "-x_/"]
    for _ in range(4000):
        t = "".join(rng.choices(bits, k=rng.randrange(12)))
        assert sorted(c.base_spans(t)) == sorted(plain(t)), t


def test_held_out_accuracy():
    ratio = c.fit_models(c.labelled_samples(seed=7))
    held = [x for x in c.labelled_samples(n=1500, seed=1234) if len(x[0]) >= c.FULL]
    right = sum(c.is_random(t, ratio) == bool(y) for t, y in held)
    wrong = sum(c.is_random(t, ratio) for t, y in held if not y)
    assert right >= 0.97 * len(held) and wrong <= 0.01 * len(held)


def test_strings_planted_in_documents_are_found_and_nothing_else():
    rng, ratio = random.Random(31), c.fit_models(c.labelled_samples())
    texts = [t for (t,) in duckdb.connect().execute("SELECT text FROM read_parquet('/root/testdata/sf0.01/documents.parquet') WHERE text IS NOT NULL ORDER BY doc_id").fetchall()]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    found, planted, wrong = 0, 0, 0
    for t in texts:
        own = {x for x in c.all_spans(t, ratio, c.THRESHOLD) if x[2] == 3}
        wrong += len(own)
        words = t.split(" ")
        at = rng.randrange(len(words) + 1)
        new = "".join(rng.choices(rng.choice((letters, letters + "0123456789", letters + "0123456789+/")), k=rng.randint(16, 40)))
        changed = " ".join([*words[:at], new, *words[at:]])
        start = len(" ".join(words[:at])) + (at > 0)
        planted += 1
        found += any(s < start + len(new) and start < e for s, e, _ in c.all_spans(changed, ratio, c.THRESHOLD))
    assert found >= 0.98 * planted and wrong <= 0.001 * len(texts)


def test_what_surrounds_base_spans_is_judged():
    ratio, key = c.fit_models(c.labelled_samples()), "Zx9Kq2LmP0vB7nT4rY8w"
    text = f"{key}{'0a1b' * 8}G{key} a {key}{'0a1b' * 8}"
    assert c.all_spans(text, ratio, c.THRESHOLD) == [(0, 20, 3), (20, 52, 2), (52, 73, 3), (76, 96, 3), (96, 128, 2)]
    one = "Qk8ZpX7vR2mN9tB4wL1c"
    assert c.all_spans(f"token={key} {one}", ratio, c.THRESHOLD) == [(0, 26, 0), (27, 47, 3)]
    long = "a1" * 200_000 + " " + "Ab" * 200_000
    assert c.all_spans(long, ratio, c.THRESHOLD)[0] == (0, 400_000, 2)


def test_rows(docs, odd_docs, no_docs, spark):
    assert c.scan_secrets(odd_docs).count() == odd_docs.count() and c.scan_secrets(no_docs).count() == 0
    extra = spark.createDataFrame([(1, 'é token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'), (2, "key Zx9Kq2LmP0vB7nT4rY8wJ5 ok internationalization_of_everything"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in c.scan_secrets(extra).collect()}
    assert got[1].spans == "assign:2:51,hex:11:51" and (got[1].n_assign, got[1].n_hex) == (1, 1)
    assert got[2].spans == "random:4:26" and got[2].base_sha256 == got[3].base_sha256 == got[4].base_sha256 and got[3].spans == ""
    red = {r.doc_id: r.text for r in c.redact_secrets(extra).collect()}
    assert red == {1: 'é [secret]" end', 2: "key [secret] ok internationalization_of_everything", 3: None, 4: ""}
    kept = c.redact_secrets(docs)
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)
