"""The registered queries over whole small tables: against DuckDB where there is SQL, else against brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import duckdb
import public_tokenizers
import pytest
import tiktoken

from helixframe.llm import credentials, mixing, pieces, quality, queries
from helixframe.llm.fingerprints import K
from tests.llm.test_credentials import plain
from tests.llm.test_fingerprints import edited, jaccard, shingles
from tests.llm.test_quality import base
from tests.llm.test_simhash import components, fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_op1(spark, table):
    got = {r.doc_id: r for r in rows(spark, "op1_fingerprints")}
    assert got.keys() == table.keys()
    wrong = []
    for i, changed, nxt in edited(table):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(table[i]), hashlib.sha256(changed.encode()).hexdigest())
        assert len(r.fingerprint) == 16 * min(K, len(shingles(table[i])))
        wrong += [abs(r.near_edited - jaccard(shingles(table[i]), shingles(changed))), abs(r.near_next - jaccard(shingles(table[i]), shingles(nxt)))]
    assert sum(wrong) / len(wrong) < 0.02 and max(wrong) < 0.16
    same = defaultdict(set)
    for i, t in table.items():
        same[t].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_op2(spark, table):
    got = sorted(rows(spark, "op2_mixing"), key=lambda r: r.position)
    assert Counter(r.doc_id for r in got) == Counter(list(table)) and len({r.position for r in got}) == len(got)
    by = defaultdict(list)
    for r in got:
        assert r.slot == r.position // 16
        by[r.source].append(r.block)
    assert all(b == sorted(b) and set(b) == set(range(-(-len(b) // 16))) for b in by.values())
    # against the weights themselves: less than a block off until a source runs out, and so on from there among the others
    weights = mixing.whole_weights({s: len(b) ** 0.5 for s, b in by.items()}, mixing.PARTS)
    left, ran, t = {s: -(-len(b) // 16) for s, b in by.items()}, Counter(), 0
    for slot, s in sorted({(r.slot, r.source) for r in got}):
        ran[s], t, left[s] = ran[s] + 1, t + 1, left[s] - 1
        total = sum(weights[x] for x in left)
        assert all(abs(ran[x] * total - t * weights[x]) < total for x in left), slot
        if not left[s]:
            del left[s]
            ran, t = Counter(), 0
    assert not left


def test_op3(spark, table):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op3_simhash")}
    fps = {i: fingerprint(t) for i, t in table.items()}
    top = components(fps, 2)
    assert got == {i: (f"{fps[i]:016x}", top[i]) for i in table}


class Article(HTMLParser):
    """Texts of the blocks of a page's only article, by another parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.within, self.lines = False, [""]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.within |= tag == "article"
        if tag == "br":
            self.lines[-1] += " "
        elif tag != "b":
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag == "article":
            self.within = False
        if tag != "b":
            self.lines.append("")

    def handle_data(self, data):
        if self.within:
            self.lines[-1] += data


def test_op5(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in rows(spark, "op5_html")}
    assert got.keys() == pages.keys()
    for i, r in got.items():
        whole = pages[i].html
        assert whole.count("<article>") == 1 and not set(re.findall("<([a-z0-9]+)", whole[whole.index("<article>") :])) - {"article", "h1", "p", "b", "br", "footer"}
        want = [" ".join(x.split()) for x in Article(whole).lines]
        assert (r.url, r.text, r.n_chars) == (pages[i].url, "\n".join(filter(None, want)), len(r.text))


def test_op7(spark, table):
    kinds = ("assign", "access", "hex")
    for r in rows(spark, "op7_secrets"):
        want = sorted(plain(table[r.doc_id]), key=lambda x: (x[0], x[2]))
        listed = [f"{kinds[k]}:{s}:{e}" for s, e, k in want]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[2] == k for x in want) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == listed and len(spans) == len(listed) + r.n_random


def test_op7_random_spans(spark, table):
    """The models' spans: runs that are left once base spans are blanked out, judged one by one."""
    ratio = credentials.fit_models(credentials.labelled_samples())
    rng = random.Random(3)
    planted = {i: f"{t} {''.join(rng.choices('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', k=24))}{'ab12' * 7}" for i, t in table.items()}
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    for r in credentials.scan_secrets(docs).collect():
        text = list(planted[r.doc_id])
        for s, e, _ in plain(planted[r.doc_id]):
            text[s:e] = " " * (e - s)
        runs = re.finditer("[A-Za-z0-9+/_=-]{12,}", "".join(text))
        want = [f"random:{m.start()}:{m.end()}" for m in runs if sum(ratio.get(p, 0.0) for p in zip(["", *m[0]], m[0])) > 12 + 3 * max(0, 16 - len(m[0]))]  # noqa: B905
        assert [x for x in r.spans.split(",") if x.startswith("random")] == want and r.n_random == len(want) >= 1


def test_op8(spark, table):
    found = rows(spark, "op8_quality")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ranks = dict(line.split() for line in open(public_tokenizers.path(quality.VOCABULARY), "rb").read().splitlines())
    tokens = {int(n): base64.b64decode(t) for t, n in ranks.items()}
    coder = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: n for n, t in tokens.items()}, special_tokens={})

    def partial(token):
        return token.decode("utf-8", "ignore").encode() != token

    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(table[r.doc_id])
        if r.base_failed:
            assert not r.kept and r.n_tokens is None
            continue
        ids = coder.encode_ordinary(table[r.doc_id])
        times = Counter(ids)
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in times.values())
        chars, fallback = len(table[r.doc_id]) / len(ids), sum(partial(tokens[x]) for x in ids) / len(ids)
        assert r.n_tokens == len(ids) and math.isclose(r.chars_per_token, chars) and math.isclose(r.fallback_share, fallback, abs_tol=1e-12) and math.isclose(r.token_entropy, entropy, rel_tol=1e-9)
        band = quality.BANDS.get(lang[r.doc_id]) or quality.BANDS[None]
        ends = [(chars, *band["chars"]), (fallback, *band["fallback"]), (entropy, min(band["entropy"][0], quality.SHARE * math.log2(len(ids))), band["entropy"][1])]
        assert r.kept == all(lo <= x <= hi for x, lo, hi in ends)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality}
    clean = [r for r in found if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.97 * len(clean)


def best_scores(text, scores, unknown, longest):
    """The score of the best segmentation of a marked text, by trying every last piece."""
    best = [0.0]
    for end in range(1, len(text) + 1):
        found = [best[k] + scores[t] for k in range(max(0, end - longest), end) if (t := text[k:end]) in scores]
        if text[end - 1] not in scores:
            found.append(best[-1] + unknown)
        best.append(max(found))
    return best[-1]


def test_op9(spark, table):
    got = {r.doc_id: r for r in rows(spark, "op9_pieces")}
    assert {i: r.decoded for i, r in got.items()} == table
    v = pieces.load_vocabulary()
    scores = {k.decode(): s for k, s in zip(v.keys, v.scores, strict=True)}
    by_id, lead = dict(zip(v.ids, v.scores, strict=True)), {i: b for b, i in enumerate(v.byte_ids)}
    for i, text in sorted(table.items())[::2]:
        if text and "\u2581" not in text and len(text) < 20_000:
            own = sum(by_id[x] if x in by_id else v.unknown if lead[x] < 0x80 or lead[x] >= 0xC0 else 0.0 for x in got[i].ids)
            want = best_scores("\u2581" + text.replace(" ", "\u2581"), scores, v.unknown, max(map(len, scores)))
            assert abs(own - want) < 1e-6 * max(1, len(text)), i


def test_op10(spark, table):
    got = rows(spark, "op10_sharding")
    assert Counter(r.doc_id for r in got) == Counter(list(table))
    shard, slots, load = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        t = table[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None)
        shard[t].add(r.shard)
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(len(x) == 1 for x in shard.values()) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    largest = max(Counter({t: (len(t) + 1) * sum(x.encode() == t for x in table.values()) for t in shard}).values())
    assert set(load) == set(range(16)) and max(load.values()) - min(load.values()) <= largest
    # the placement: groups over 1/1,024 of all bytes by themselves, others by bin of their hash, largest first to the least load
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    group = {r.doc_id: r.g for r in docs.selectExpr("doc_id", "xxhash64(coalesce(text, '')) g").collect()}
    size = Counter()
    for r in got:
        size[group[r.doc_id]] += r["size"]
    least = sum(size.values()) / (16 * 64)
    item = {g: (-1, g) if n > least else (g % 16_384, 0) for g, n in size.items()}
    weight = Counter()
    for g, n in size.items():
        weight[item[g]] += n
    loads, place = [0] * 16, {}
    for k in sorted(weight, key=lambda k: (-weight[k], k)):
        place[k] = loads.index(min(loads))
        loads[place[k]] += weight[k]
    assert {r.doc_id: r.shard for r in got} == {i: place[item[g]] for i, g in group.items()}
