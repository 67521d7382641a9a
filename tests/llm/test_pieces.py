import math
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.llm import pieces as p

SMALL = [("▁", -3.0), ("▁▁", -3.5), ("a", -2.0), ("b", -2.1), ("ab", -2.5), ("▁a", -2.2), ("▁ab", -3.1), ("ba", -2.4), ("aba", -2.9), ("é", -4.0), ("日本", -4.2)]


def small():
    return p.Vocabulary([(t, s, 256 + k) for k, (t, s) in enumerate(SMALL)], list(range(256)), 256 + len(SMALL))


def best_score(text, v):
    """The best score over all segmentations, by trying every last piece."""
    scores = {k.decode(): s for k, s in zip(v.keys, v.scores, strict=True)}
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            t = text[start:end]
            if t in scores:
                best[end] = max(best[end], best[start] + scores[t])
            elif len(t) == 1:
                best[end] = max(best[end], best[start] + v.unknown)
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("ab é日本\n▁🙂", max_size=14))
def test_viterbi_is_the_best_path_and_round_trips(text):
    v = small()
    coder = p.Coder(v)
    ids = coder.encode(text)
    assert coder.decode(ids) == text
    if "▁" not in text and text:
        marked = "▁" + text.replace(" ", "▁")
        by_id = dict(zip(v.ids, v.scores, strict=True))
        lead = [b for i in ids if i < 256 for b in [i] if b < 0x80 or b >= 0xC0]  # first bytes of unknown characters
        assert math.isclose(sum(by_id[i] for i in ids if i >= 256) + len(lead) * v.unknown, best_score(marked, v), abs_tol=1e-9)


def test_double_array_holds_its_keys():
    keys = [w.encode() for w in ("a", "ab", "abc", "b", "ba", "é", "日本", "zzz")]
    base, check = p.double_array(keys)

    def find(key):
        state = 0
        for c in key:
            if state + 0 >= len(base) or check[base[state] + c] != state:
                return None
            state = base[state] + c
        leaf = base[state]
        return -base[leaf] - 1 if leaf > 0 and check[leaf] == state else None

    assert [find(k) for k in keys] == list(range(len(keys))) and [find(x) for x in (b"ac", b"zz", b"c", b"abcd")] == [None] * 4


def test_same_as_a_unigram_model_with_the_same_scores():
    pytest.importorskip("google.protobuf")
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    v = p.load_vocabulary()
    model = pb.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for i, s in zip(v.ids, v.scores, strict=True):
        model.pieces[i].score = s
    other, coder = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()), p.Coder(v)
    texts = ["the quick brown fox jumps over the lazy dog", "internationalization of éducation, naïve cafés", "日本語 テキスト 🙂🙂", "x = y + 1;\n\treturn (a[b])", "Haanth reoush hewh onon hahehe", "aaaa" * 30]
    assert [coder.encode(t) for t in texts] == [other.encode(t) for t in texts]


def test_rows(docs, odd_docs, no_docs, texts, spark):
    rows = p.encode_documents(docs)
    got = {r.doc_id: r for r in rows.collect()}
    assert {i: r.decoded for i, r in got.items()} == texts
    assert all(r.n_ids == len(r.ids or []) >= r.n_byte_ids for r in got.values()) and got[15].ids is None and got[14].ids == []
    back = {r.doc_id: r.text for r in p.decode_ids(rows).collect()}
    assert back == texts
    assert p.encode_documents(odd_docs).count() == odd_docs.count() and p.encode_documents(no_docs).count() == 0
    assert p.Coder(small()).decode([0xFF, 256]) == " "  # the first space goes with the mark, here with a bad byte


def test_long_texts_without_spaces_take_linear_time():
    coder, text = p.Coder(p.load_vocabulary()), "".join(chr(97 + k * k % 26) for k in range(400_000))
    began = time.time()
    ids = coder.encode(text)
    assert time.time() - began < 20 and coder.decode(ids) == text
