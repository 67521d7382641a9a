"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces with log scores."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

MARK = "▁"
#: A vocabulary is broadcast, so that a larger one is refused.
MOST_PIECES = 1_000_000
#: Segments of texts that a worker keeps with their pieces, and the longest kept; beyond that it begins anew, which changes no result.
MOST_KEPT, LONGEST_KEPT = 300_000, 64
#: What an unknown character costs more than the worst piece.
UNKNOWN = 10.0


def log_scores(pieces: list[tuple[str, float, int]], ranked: bool) -> list[tuple[str, float, int]]:
    """Pieces with log scores. ranked: their scores only order them (merge ranks), and a piece gets the log of Zipf's law at its rank."""
    if not ranked:
        return pieces
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    best = sorted(pieces, key=lambda p: (-p[1], p[2]))
    return [(p, -math.log(r + 1) - total, i) for r, (p, _, i) in enumerate(best)]


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """base and check of a trie over distinct, non-empty keys without zero bytes: child c of s is base[s] + c if check is s.

    Child 0 ends a key, and its base is -(number of the key) - 1. The root is 0.
    """
    base, check = [0] * 1024, [-1] * 1024
    check[0] = 0
    order = sorted(range(len(keys)), key=keys.__getitem__)
    todo, free = [(0, 0, len(order), 0)], 1  # state, its keys as a range of order, depth
    while todo:
        state, lo, hi, depth = todo.pop()
        children, at = [], lo
        if len(keys[order[lo]]) == depth:
            children.append((0, lo, lo + 1))
            at = lo + 1
        while at < hi:
            c, to = keys[order[at]][depth], at
            while to < hi and keys[order[to]][depth] == c:
                to += 1
            children.append((c, at, to))
            at = to
        while check[free] >= 0:
            free += 1
            if free + 512 > len(check):
                base += [0] * len(base)
                check += [-1] * len(check)
        put = max(1, free - children[0][0])
        while True:
            while put + 256 >= len(check):
                base += [0] * len(base)
                check += [-1] * len(check)
            if all(check[put + c] < 0 for c, _, _ in children):
                break
            put += 1
        base[state] = put
        for c, a, b in children:
            check[put + c] = state
            if c == 0:
                base[put] = -order[a] - 1
        todo += [(put + c, a, b, depth + 1) for c, a, b in children if c]
    used = max(i for i, c in enumerate(check) if c >= 0) + 257
    check += [-1] * 257
    base += [0] * 257
    return np.array(base[:used], dtype=np.int32), np.array(check[:used], dtype=np.int32)


_NEVER = float("-inf")


class Vocabulary:
    """What encoding and decoding need; made once on the driver and broadcast."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int], size: int) -> None:
        """pieces: (piece, log score, id) of ordinary pieces. byte_ids: ids of the bytes 0 to 255."""
        if size > MOST_PIECES:
            raise ValueError(f"{size} pieces; at most {MOST_PIECES} are broadcast")
        if bad := [p for p, _, _ in pieces if not p or MARK in p.lstrip(MARK) or "\0" in p]:
            raise ValueError(f"pieces must be non-empty, with marks only in front: {bad[:3]}")
        self.keys = [p.encode() for p, _, _ in pieces]
        self.scores, self.ids = [s for _, s, _ in pieces], [i for _, _, i in pieces]
        self.base, self.check = double_array(self.keys)
        self.byte_ids, self.size = byte_ids, size
        self.unknown = min(self.scores, default=0.0) - UNKNOWN
        self.line_ends = any("\n" in p for p, _, _ in pieces)
        self._coder: Coder | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_coder": None}

    def coder(self) -> Coder:
        """The coder of this process: a worker's tasks, which have one broadcast value, share it and the segments that it keeps."""
        if self._coder is None:
            self._coder = Coder(self)
        return self._coder


def load_vocabulary(model: str | None = None, ranked: bool = True) -> Vocabulary:
    """The vocabulary of a SentencePiece model file that the driver reads. ranked: see log_scores; right for BPE models."""
    import sentencepiece

    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    p = sentencepiece.SentencePieceProcessor(model_file=str(model))
    ids = range(p.vocab_size())
    plain = [(p.id_to_piece(i), p.get_score(i), i) for i in ids if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
    return Vocabulary(log_scores(plain, ranked), [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)], len(ids))


class Coder:
    """Encodes and decodes texts."""

    def __init__(self, v: Vocabulary) -> None:
        self.base, self.check = v.base.tolist(), v.check.tolist()
        self.ids, self.unknown = v.ids, v.unknown
        # the score of the key that ends at a state, read off its child 0
        leaf = np.minimum(v.base.clip(0), len(v.check) - 1)
        whole = (v.check[leaf] == np.arange(len(v.base))) & (leaf > 0)
        self.ends = [v.scores[-v.base[b] - 1] if w else None for w, b in zip(whole.tolist(), leaf.tolist(), strict=True)]
        self.singles = {k for k in v.keys if len(k.decode()) == 1}
        self.byte_ids, self.longest = v.byte_ids, max(map(len, v.keys), default=0)
        # no piece has a mark behind another character, or (mostly) a line end, so that texts can be cut there
        self.segments = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if v.line_ends else f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n").findall
        self.known: dict[str, list[int]] = {}
        mark = MARK.encode()
        self.surface = [b""] * v.size
        for key, i in zip(v.keys, v.ids, strict=True):
            self.surface[i] = key.replace(mark, b" ")
        for b, i in enumerate(v.byte_ids):
            self.surface[i] = bytes([b])
        self.is_byte = np.zeros(v.size, dtype=bool)
        self.is_byte[v.byte_ids] = True

    def viterbi(self, segment: bytes) -> list[int]:
        """Ids of the best path; of equal ones, that whose last pieces begin first. Characters without a piece give their bytes."""
        base, check, ends, longest = self.base, self.check, self.ends, self.longest
        n = len(segment)
        best = [_NEVER] * (n + 1)
        came_from, came_by = [0] * (n + 1), [-1] * (n + 1)  # start of the last piece, its number or -1
        best[0] = 0.0
        for at in range(n):
            so_far = best[at]
            if so_far == _NEVER:  # within a character, or not reached
                continue
            state, to = 0, at
            for byte in segment[at : at + longest]:
                child = base[state] + byte
                if check[child] != state:
                    break
                state = child
                to += 1
                if (score := ends[state]) is not None and so_far + score > best[to]:
                    best[to] = so_far + score
                    came_from[to] = at
                    came_by[to] = state
            lead = segment[at]
            end = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            if so_far + self.unknown > best[end] and segment[at:end] not in self.singles:
                best[end], came_from[end], came_by[end] = so_far + self.unknown, at, -1
        out: list[int] = []
        at = n
        while at:
            start, state = came_from[at], came_by[at]
            if state < 0:
                out += [self.byte_ids[b] for b in reversed(segment[start:at])]
            else:
                out.append(self.ids[-base[base[state]] - 1])
            at = start
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, spaces as marks and one mark in front. Marks of the text itself are encoded as bytes, so that decoding gives the text."""
        if not text:
            return []
        if MARK in text:
            out: list[int] = []
            for k, part in enumerate(text.split(MARK)):
                if k:
                    out += [self.byte_ids[b] for b in MARK.encode()]
                out += self._plain(part if k else " " + part)
            return out
        return self._plain(" " + text)

    def _plain(self, text: str) -> list[int]:
        known, out = self.known, []
        for segment in self.segments(text.replace(" ", MARK)):
            ids = known.get(segment)
            if ids is None:
                ids = self.viterbi(segment.encode())
                if len(segment) <= LONGEST_KEPT:
                    if len(known) >= MOST_KEPT:
                        known.clear()
                    known[segment] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, the one in front goes, runs of byte pieces are UTF-8 (U+FFFD where they aren't)."""
        return b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep`, ids, n_ids, n_byte_ids and decoded (the text that the ids give) of every row.

    A null text has null ids and decoded, and counts of 0; an empty text has no ids. Any other text decodes to itself,
    very long ones without a space included, in time that is linear in their length. Of equally good codings that whose
    last pieces begin first is taken. Repeated rows are each encoded; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())

    def start():
        coder = shared.value.coder()

        def step(columns):
            *kept, texts = columns
            ids = [None if t is None else coder.encode(t) for t in texts]
            counts = [0 if x is None else len(x) for x in ids]
            spelled = [int(coder.is_byte[x].sum()) if x else 0 for x in ids]
            return [*kept, ids, counts, spelled, [None if x is None else coder.decode(x) for x in ids]]

        return step

    rows = docs.select(*keep, F.col(text).cast("string"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return map_rows(rows, f"{schema}ids array<int>, n_ids long, n_byte_ids long, decoded string", start)


def decode_ids(rows: DataFrame, vocabulary: Vocabulary | None = None, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """The columns `keep` and text of every row of ids; null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())

    def start():
        coder = shared.value.coder()
        return lambda columns: [*columns[:-1], [None if x is None else coder.decode(x) for x in columns[-1]]]

    got = rows.select(*keep, ids)
    return map_rows(got, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in got.schema.fields[:-1]) + "text string", start)
