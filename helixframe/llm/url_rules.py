"""URL filter: a broadcast trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: A trie is broadcast whole, so a rule list is refused beyond this many entries.
MAX_RULES = 1_000_000

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or where there is no `://`."""
    found = _URL.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class Trie:
    """Rules by host labels from the last on, then by whole path segments, then by the letters of what follows the last slash.

    Nodes are numbers, so that tries of any depth can be sent. A host node leads to the paths that hold there and a segment
    node to the tails that do; tails share edges as far as they are alike, so that one walk over a segment finds the longest.
    """

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.edges: list[dict] = [{}]
        self.below: dict[int, int] = {}  # host node: its paths' root; segment node: its tails' root
        self.ends: dict[int, tuple[str, str]] = {}  # tail node: rule and verdict
        for verdict, host, path in rules:
            at = 0
            for label in reversed(host.translate(_LOWER).split(".")):
                at = self._next(at, label)
            *whole, tail = path.split("/")
            at = self._under(at)
            for segment in whole:
                at = self._next(at, segment)
            self.ends[self._tail(self._under(at), tail)] = f"{host}{path}", verdict

    @classmethod
    def of(cls, parts: dict) -> Trie:
        """The trie whose parts (`vars`) were sent: executors may not have this class to read it by."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def _new(self) -> int:
        self.edges.append({})
        return len(self.edges) - 1

    def _next(self, at: int, key: str) -> int:
        if key not in self.edges[at]:
            self.edges[at][key] = self._new()
        return self.edges[at][key]

    def _under(self, at: int) -> int:
        if at not in self.below:
            self.below[at] = self._new()
        return self.below[at]

    def _tail(self, at: int, tail: str) -> int:
        """The node of a tail; edges are (letters, node) by their first letter, split where a tail leaves them."""
        while tail:
            if tail[0] not in self.edges[at]:
                self.edges[at][tail[0]] = tail, self._new()
                return self.edges[at][tail[0]][1]
            letters, to = self.edges[at][tail[0]]
            if not tail.startswith(letters):
                n = next((k for k, (a, b) in enumerate(zip(letters, tail, strict=False)) if a != b), len(tail))
                middle = self._new()
                self.edges[middle][letters[n]] = letters[n:], to
                self.edges[at][tail[0]] = letters[:n], middle
                letters, to = letters[:n], middle
            at, tail = to, tail[len(letters) :]
        return at

    def longest_tail(self, at: int, segment: str) -> tuple[str, str] | None:
        """Rule and verdict of the longest tail that the segment begins with."""
        best, k = self.ends.get(at), 0
        while k < len(segment) and (edge := self.edges[at].get(segment[k])) and segment.startswith(edge[0], k):
            k, at = k + len(edge[0]), edge[1]
            best = self.ends.get(at, best)
        return best


def build_trie(rules: list[tuple[str, str, str]]) -> Trie:
    """`rules`: (verdict, host, path), in time that grows with their letters. A rule given twice: the last one holds."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    return Trie(rules)


def judge(trie: Trie, host: str, path: str) -> tuple[str | None, str | None]:
    """Rule and verdict of the longest match: most host labels first, then the longest path; (None, None) if none fits."""
    at, hosts = 0, []
    for label in reversed(host.split(".")):
        at = trie.edges[at].get(label)
        if at is None:
            break
        if at in trie.below:
            hosts.append(trie.below[at])
    segments = path.split("/")
    for node in reversed(hosts):
        best = None
        for segment in segments:
            if node in trie.below:
                best = trie.longest_tail(trie.below[node], segment) or best
            node = trie.edges[node].get(segment)
            if node is None:
                break
        if best:
            return best
    return None, None


def filter_urls(df: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """`key` (a long), host, path, rule and verdict of every row of `df`; other columns are not read.

    rules: (allow or block, host, path). `default` is the verdict where no rule fits. Null or malformed urls have an
    empty host and path, so that only the default applies; very long ones are judged whole; of rules that fit, that with
    most host labels wins, then that with the longest path (of two with the same host and path, the later); repeated rows are
    each judged; an empty table gives none.
    """
    trie = df.sparkSession.sparkContext.broadcast(vars(build_trie(rules)))

    def start():
        root = Trie.of(trie.value)

        def step(columns):
            keys, urls = columns
            parts = [split_url(u) for u in urls]
            found = [judge(root, *p) for p in parts]
            return [keys, [p[0] for p in parts], [p[1] for p in parts], [r for r, _ in found], [v or default for _, v in found]]

        return step

    return map_rows(df.select(F.col(key).cast("long"), F.col(url).cast("string")), f"`{key}` long, host string, path string, rule string, verdict string", start)
