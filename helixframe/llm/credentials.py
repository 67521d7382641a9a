"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary identifiers."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, map_rows

#: Kinds in the order in which spans that start together are listed; the last is the models'.
KINDS = ("assign", "access", "hex", "random")

# Fixed values of the contract.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # greedy runs, so the same as runs of any length of which the short are dropped
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Strings that the models judge: runs of these characters, without what base spans cover, of LEAST or more.
LEAST = 12
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: What a candidate's log-likelihood ratio must be over, and how much more for each character that it has fewer than FULL.
THRESHOLD, SHORT, FULL = 12.0, 3.0, 16

#: Words that identifiers are made of, for the labelled samples.
_PARTS = (
    "account active address array assert async base batch begin block body buffer build byte cache call cell chain change char check class clean client close code column command config connect content copy count create cursor "
    "data date debug default delete depth detail device dict document domain download edge edit element empty enable encode entry error event example execute export extract factory field file filter final find first flag float format frame function "
    "global graph group handle hash head height hidden host image import index info init input insert integer item iterator join json keep kernel label large last layer layout length level library limit line link list load local lock login loop machine main manager map mask match matrix member memory merge message method middle model module month "
    "name network next node normal notify number object offset open option order output owner package page parent parse part password path pattern player pointer policy position prefix print process product profile project property query queue random range rate read record reference region register release remove render report request reset response result return right root route row rule "
    "sample schedule schema scope search section select sender sequence server service session setting shape share shift signal simple size slice small sort source space split stack stage start state status step storage store stream string style submit suffix summary support switch symbol system table target task template test text thread time title token total trace train transform tree trigger type union unique update upload user valid value variable vector version view visible volume weight width window worker write year zone"
).split()


def labelled_samples(n: int = 4000, seed: int = 7) -> list[tuple[str, int]]:
    """n random strings (1) and n identifiers, paths and slugs (0), from a seeded rule."""
    rng = random.Random(seed)
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    alphabets = (base62, base62 + "+/", base62 + "_-", base62[:52], base62[26:], "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    samples = []
    for _ in range(n):
        samples.append(("".join(rng.choices(rng.choice(alphabets), k=rng.randint(LEAST, 64))), 1))
        words = [rng.choice(_PARTS) for _ in range(rng.randint(3, 7))]
        if rng.random() < 0.25:
            words[rng.randrange(len(words))] = str(rng.choice((rng.randint(0, 99), rng.randint(1990, 2030))))
        shape = rng.randrange(6)
        samples.append(((("_".join, "-".join, "/".join, "".join, lambda w: "".join(x.title() for x in w), lambda w: "_".join(x.upper() for x in w))[shape])(words), 0))
    return samples


def fit_models(samples: list[tuple[str, int]]) -> dict[tuple[str, str], float]:
    """Log-likelihood ratio, random over ordinary, of each character after another ("" begins), with add-one smoothing."""
    if {y for _, y in samples} != {0, 1}:
        raise ValueError("samples of both labels are needed")
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    counts: tuple[dict, dict] = ({}, {})
    for text, label in samples:
        for pair in zip(["", *text], text):  # noqa: B905
            counts[label][pair] = counts[label].get(pair, 0) + 1
    ratio = {}
    for a in ["", *alphabet]:
        totals = [sum(c.get((a, b), 0) for b in alphabet) + len(alphabet) for c in counts]
        for b in alphabet:
            p, q = ((c.get((a, b), 0) + 1) / t for c, t in zip(counts, totals, strict=True))
            ratio[a, b] = math.log(q / p)
    return ratio


def score(text: str, ratio: dict[tuple[str, str], float]) -> float:
    """Log-likelihood ratio of the whole string; the more over 0, the surer is it random."""
    return sum(ratio.get(pair, 0.0) for pair in zip(["", *text], text))  # noqa: B905


def is_random(text: str, ratio: dict[tuple[str, str], float], threshold: float = THRESHOLD) -> bool:
    return score(text, ratio) > threshold + SHORT * max(0, FULL - len(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind, too short matches dropped."""
    low = text.lower() if text.isascii() else None
    spans = []
    if low is None or any(k in low for k in ("passw", "secret", "token", "api_key", "apikey")):
        spans += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return spans + [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]


def all_spans(text: str, ratio: dict[tuple[str, str], float], threshold: float) -> list[tuple[int, int, int]]:
    """Base spans, and candidates that the models call random, by start, then kind. Where base spans lie within a run, what is left of it on either side is judged."""
    base = base_spans(text)
    covered, more, k = sorted(base), [], 0
    for m in _CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(covered) and covered[k][1] <= at:
            k += 1
        j = k
        while at < end:  # covered[j] is the next base span that ends after `at`
            while j < len(covered) and covered[j][1] <= at:
                j += 1
            to = min(end, max(at, covered[j][0])) if j < len(covered) else end
            if to - at >= LEAST and is_random(text[at:to], ratio, threshold):
                more.append((at, to, 3))
            at = covered[j][1] if j < len(covered) else end
    return sorted(base + more, key=lambda x: (x[0], x[2]))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def scan_secrets(docs: DataFrame, samples: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` (a long), n_assign, n_access, n_hex, n_random, base_sha256 and spans of every row.

    Spans are kind:start:end in code points, end exclusive, by start and then kind; base spans that begin together are
    listed as they are in KINDS. A null text is empty; an empty text has no spans; very long ones are scanned whole, in
    linear time; repeated rows are each scanned; an empty table gives none. The models are fitted to `samples`
    (labelled_samples() if None). Strings of under LEAST characters aren't judged: words are as short. The
    log-likelihood ratio of any other must be over `threshold`, and by SHORT more for each character under FULL.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_models(samples or labelled_samples()))

    def start():
        ratio = model.value

        def step(columns):
            out = [[], [], [], [], [], []]
            for t in columns[1]:
                spans = all_spans(t or "", ratio, threshold)
                for k in range(4):
                    out[k].append(sum(x[2] == k for x in spans))
                out[4].append(hashlib.sha256(listed([x for x in spans if x[2] < 3]).encode()).hexdigest())
                out[5].append(listed(spans))
            return [columns[0], *out]

        return step

    return map_rows(docs.select(F.col(key).cast("long"), F.col(text).cast("string")), f"`{key}` long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string", start)


def redact_secrets(docs: DataFrame, samples: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD, mark: str = "[secret]", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """`docs` with every span of its text (overlapping spans as one) replaced by `mark`, and `chars`, if there, as long as the new text.

    Null texts stay null, other columns are as they are, whatever they are called; repeated rows are each done; an empty table gives none.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_models(samples or labelled_samples()))
    at, count = docs.columns.index(text), docs.columns.index(chars) if chars in docs.columns else None

    def start():
        ratio = model.value

        def clean(t: str) -> str:
            parts, done = [], 0
            for s, e, _ in all_spans(t, ratio, threshold):
                if e > done:
                    parts += [t[done:s], mark] if s >= done else []
                    done = e
            return "".join([*parts, t[done:]])

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns, old = list(batch.columns), batch.column(at).to_pylist()
            new = [t if t is None else clean(t) for t in old]
            if count is not None:
                columns[count] = pa.array([n if a == b else len(b) for n, a, b in zip(columns[count].to_pylist(), old, new, strict=True)], columns[count].type)
            columns[at] = pa.array(new, columns[at].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return step

    return map_batches(docs, start)
