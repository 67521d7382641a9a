"""SimHash near-dedup: fingerprints, shards, BK-trees over each shard, and connected classes.

Two fingerprints within `radius` differing bits agree on at least KEPT of radius + KEPT blocks of bits. A shard is the
fingerprints that agree on one choice of KEPT blocks; a BK-tree over a shard finds every link in it. Trees are built
where their shard is, which the shuffle decides: all shards' trees together grow with the corpus, so that they are not
broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, free_name, map_rows

BITS = 64
#: Blocks that a shard's fingerprints agree on: with a radius of 2, 3 of 5, which are 37 to 39 bits, so that 50 billion
#: fingerprints spread over 10 times as many shards.
KEPT = 3
#: A shard of more fingerprints than this isn't given to one tree; `linked_by_centres` does it exactly.
TREE_MOST = 4096


def shingle_spans(words: list[bytes], width: int) -> list[bytes]:
    """Runs of `width` words, joined by a space, repeats included; fewer words give the whole sequence, none give none."""
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    whole = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[: len(words) - width])]
    return [whole[a:b] for a, b in zip(starts, ends[width - 1 :], strict=True)]


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64, seed 42, of each shingle of the text, A-Z lower-cased; words are split at the six ASCII spaces."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingle_spans((text or b"").lower().split(), width)], dtype="<u8")


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the 64-bit hashes; none give 0."""
    if not len(hashes):
        return 0
    set_in = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # so that a very long text needs little memory
        set_in += np.unpackbits(hashes[at : at + (1 << 16)].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` (a long) and fp (a long, the 64 bits) of every row; a null text is empty."""

    def start():
        return lambda columns: [columns[0], [f - (1 << 64) if f >> 63 else f for f in (simhash(shingle_hashes(t, width)) for t in columns[1])]]

    return map_rows(docs.select(F.col(key).cast("long"), F.col(text).cast("binary")), f"`{key}` long, fp long", start)


class BKTree:
    """Children of a node are keyed by their Hamming distance to it. The same fingerprint is kept once."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, fp: int, radius: int) -> list[int]:
        """Put fp into the tree; the fingerprints there within `radius` of it."""
        if self.root is None:
            self.root = (fp, {})
            return []
        found = self.within(fp, radius)
        node = self.root
        while True:
            d = (node[0] ^ fp).bit_count()
            if d == 0:
                return found
            child = node[1].get(d)
            if child is None:
                node[1][d] = (fp, {})
                return found
            node = child

    def within(self, fp: int, radius: int) -> list[int]:
        """Only edges whose distance is within `radius` of the query's distance to their node are followed."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            at, children = todo.pop()
            d = (at ^ fp).bit_count()
            if d <= radius:
                found.append(at)
            if children:
                todo += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
        return found


class Classes:
    """Union-find; a class is named by its least member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        top = x
        while (p := up.get(top, top)) != top:
            top = p
        while (p := up.get(x, x)) != top:
            up[x], x = top, p
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """(fingerprint, least of its class) of a shard's members that have a link; fewer links than members."""
    tree, classes = BKTree(), Classes()
    for fp in members:
        for other in tree.add(fp, radius):
            classes.join(fp, other)
    return [(fp, top) for fp in members if (top := classes.find(fp)) != fp]


def shard_masks(radius: int) -> list[int]:
    """The bits that a shard's fingerprints agree on, for each choice of KEPT of radius + KEPT blocks that make up the 64 bits."""
    edges = [round(k * BITS / (radius + KEPT)) for k in range(radius + KEPT + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, KEPT)]


def linked_by_trees(shards: DataFrame, radius: int) -> DataFrame:
    """a, b: links of the members (fp) of shards (shard), enough to connect what is linked; a task holds one shard at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, a, b = None, [], [], []

        def close() -> None:
            if len(members) > 1:
                for x, y in shard_links(members, radius):
                    a.append(x)
                    b.append(y)

        for batch in batches:
            for shard, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != at:
                    close()
                    at, members = shard, []
                members.append(fp & 0xFFFFFFFFFFFFFFFF)
            if len(a) > 10_000:
                yield _links(a, b)
                a, b = [], []
        close()
        if a:
            yield _links(a, b)

    return shards.repartition("shard").sortWithinPartitions("shard").select("shard", "fp").mapInArrow(run, "a long, b long")


def _links(a: list[int], b: list[int]) -> pa.RecordBatch:
    signed = lambda xs: pa.array(np.array(xs, dtype="<u8").view("<i8"))
    return pa.RecordBatch.from_arrays([signed(a), signed(b)], names=["a", "b"])


def linked_by_centres(fps: DataFrame, radius: int) -> DataFrame:
    """a, b: links that connect what is linked among all fps, for a radius of 1 or 2, exactly and without large groups.

    Two fingerprints within 2 bits have a neighbour in common: a fingerprint within 1 bit of both. Each goes to itself
    and its 64 neighbours, so that a group has at most 65 members, whatever the input; each is linked to the least.
    With a radius of 1, only groups by a member's own bits link.
    """
    one = [1 << k if k < 63 else -(1 << 63) for k in range(BITS)]
    flips = F.array(F.lit(0).cast("long"), *[F.lit(x).cast("long") for x in one])
    near = fps.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("centre"))
    least = near.groupBy("centre").agg(F.min("fp").alias("b"), F.collect_list("fp").alias("all"), F.max((F.col("fp") == F.col("centre"))).alias("there"))
    if radius == 1:
        least = least.filter("there").withColumn("b", F.col("centre"))
    return least.filter(F.size("all") > 1).select(F.explode("all").alias("a"), "b").filter("a <> b").distinct()


def links(fps: DataFrame, radius: int, tree_most: int = TREE_MOST) -> DataFrame:
    """a, b: links between distinct fingerprints (fp) that connect all that are within `radius` (0, 1 or 2) of each other."""
    if radius not in (1, 2):
        if radius == 0:
            return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
        raise ValueError("radius must be 0, 1 or 2: shards over the limit are linked exactly for these only")
    signed = [m - (1 << 64) if m >> 63 else m for m in shard_masks(radius)]
    shard = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])
    placed = fps.select("fp", F.explode(shard).alias("shard"))
    # two choices' shards could have one hash; then they are one shard, which adds no link and loses none
    both = _with_sizes(placed)
    small = both.filter(F.col("n") <= tree_most)
    large = both.filter(F.col("n") > tree_most).select("fp").distinct()
    return linked_by_trees(small, radius).unionByName(linked_by_centres(large, radius)).distinct()


def classes_of(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """fp, top: of every member of `edges` (a, b) the least member (as a signed number) that it is connected with.

    Large-star and small-star in turn until nothing changes; each round is written to the checkpoint folder. Rounds
    grow with the logarithm of the members, not with the length of chains. A large-star's centre is a group that may
    be large, but groups are only ever reduced to their least member and joined back, which can be split.
    """
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == before:
            return now.select(F.col("a").alias("fp"), F.col("b").alias("top"))
        before = tuple(sums)
        # large-star: neighbours above a node go to the least of its neighbours and itself
        around = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))  # see _with_sizes
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small-star: neighbours below a node, and it, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "m").unionByName(low.select(F.col("a").alias("x"), "m")).filter("x <> m")
        now = checkpointed(small.select(F.col("x").alias("a"), F.col("m").alias("b")).distinct())
    raise RuntimeError("classes have not settled")


def near_duplicates(docs: DataFrame, radius: int = 2, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, fingerprint (16 lowercase hex digits) and component_id (the least key reachable by links) of every row.

    Texts without words have fingerprint zero, and are linked like any others. Equal fingerprints are taken together
    before anything is searched; very long texts are hashed whole, in bounded memory. Null keys don't count as least unless all of a class are null; repeated rows stay; an
    empty table gives none. A component is at most what is reachable over links of `radius` bits or fewer.
    """
    rows = checkpointed(fingerprints(docs, width, key, text))
    least = rows.groupBy("fp").agg(F.min(key).alias("least"))
    edges = checkpointed(links(least.select("fp"), radius))
    tops = classes_of(edges)
    named = least.join(tops, "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    ids = checkpointed(named.groupBy("top").agg(F.min("least").alias("component_id")))  # see _with_sizes
    named = named.join(ids, "top").select("fp", "component_id")
    return rows.join(named, "fp").select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near copies by likeness of shingle sets. Fingerprints have 256 bits here: at a likeness of 0.8 about 39 of them
# differ, give or take 6, and among unlike texts 128, give or take 8. Blocks of bits can't shard a search at such a
# radius, so shards are texts that have the least of their shingles in common, by one of ANCHORS orders of shingles:
# at a likeness of 0.8 two texts share at least one of 4 shards in 99.8 % of cases. Each shard has its BK-tree, and
# what the tree finds is checked on whole shingle sets, as 32-bit hashes.
ANCHORS, FAR_BITS, WORDS, LIKENESS = 4, 58, 5, 0.8
#: A shard of more members is dealt into parts of about so many (a sixteenth of it, between the two), and every two parts are compared.
SHARD_MOST, PART_MOST = 512, 8192
#: Hashes of a part, if its members are long texts.
PART_HASHES = 1 << 24
#: Members, and hashes, that are compared at once, and shards for which it pays.
TILE, TILE_HASHES, FEW = 1024, 1 << 20, 32
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) & 0xFFFFFFFFFFFFFFFF for k in range(4 + ANCHORS)], dtype="<u8")


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th of several independent hashes."""
    x = hashes * _ODD[k]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def wide_simhash(hashes: np.ndarray) -> bytes:
    """256 bits, each 1 if set in over half of the hashes; none give zeros."""
    return b"".join(simhash(_mixed(hashes, k)).to_bytes(8, "little") for k in range(4))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets (distinct hashes, in order); empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _narrow(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """key, same (a hash of the shingle set), size (of that), fp (32 bytes) and anchors of every row."""

    def start():
        def one(t: bytes | None) -> tuple:
            distinct = np.unique(shingle_hashes(t, width))  # fingerprints are of sets, as likeness is
            anchors = [int(_mixed(distinct, 4 + k).min()) if len(distinct) else 0 for k in range(ANCHORS)]
            return xxhash.xxh3_128_digest(distinct.tobytes()), len(distinct), wide_simhash(distinct), [a - (1 << 64) if a >> 63 else a for a in anchors]

        return lambda columns: [columns[0], *map(list, zip(*map(one, columns[1]), strict=True))]

    return map_rows(docs.select(F.col(key).cast("long"), F.col(text).cast("binary")), f"`{key}` long, same binary, size long, fp binary, anchors array<long>", start)


def _sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """key and set: the distinct shingles of the whole text as 32-bit hashes, in order."""

    def start():
        whole = lambda t: np.unique((_mixed(shingle_hashes(t, width), 0) >> np.uint64(32)).astype("<u4")).tobytes()
        return lambda columns: [columns[0], [whole(t) for t in columns[1]]]

    return map_rows(docs.select(F.col(key).cast("long"), F.col(text).cast("binary")), f"`{key}` long, set binary", start)


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of `left` has in common with each of `right`, as a matrix.

    Hashes that many sets have are columns of two matrices that are multiplied; pairs that meet in others are counted one by one.
    """
    n, m = len(left), len(right)
    out = np.zeros((n, m), dtype=np.float32)
    sides = []
    for sets in (left, right):
        hashes = np.concatenate(sets) if sets else np.zeros(0, dtype="<u4")
        sides.append((hashes, np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
    both = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    if not len(both):
        return out
    met = []
    for hashes, rows in sides:
        at = np.minimum(np.searchsorted(both, hashes), len(both) - 1)
        kept = both[at] == hashes
        order = np.argsort(at[kept], kind="stable")
        column, row = at[kept][order], rows[kept][order]
        met.append((column, row, np.bincount(column, minlength=len(both))))
    (lc, lr, ln), (rc, rr, rn) = met
    dense = ln * rn > max(1, n * m // 150)
    columns = np.flatnonzero(dense)
    for k in range(0, len(columns), 4096):
        some = np.full(len(both), -1)
        some[columns[k : k + 4096]] = np.arange(len(columns[k : k + 4096]))
        tall = []
        for c, r, size in ((lc, lr, n), (rc, rr, m)):
            own = some[c] >= 0
            matrix = np.zeros((size, min(4096, len(columns) - k)), dtype=np.float32)
            matrix[r[own], some[c[own]]] = 1
            tall.append(matrix)
        out += tall[0] @ tall[1].T
    rare = ~dense[lc]
    times, starts = rn[lc[rare]], np.concatenate([[0], np.cumsum(rn)])[lc[rare]]
    which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(starts, times)
    out += np.bincount(np.repeat(lr[rare], times) * m + rr[which], minlength=n * m).reshape(n, m)
    return out


def alike(left: list[np.ndarray], right: list[np.ndarray], least: float) -> np.ndarray:
    """Whether each set of `left` and each of `right` have a likeness of `least` or more; empty ones are alike."""
    common = common_counts(left, right)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - common
    return np.where(union == 0, True, common >= least * union - 1e-3)  # counts are whole, and least * union isn't off by as much


Member = tuple[int, bytes, np.ndarray]  # key, fingerprint, set


def tiles(members: list[Member]) -> list[slice]:
    """Members in runs of at most TILE, and of at most TILE_HASHES hashes or one member."""
    out, start, hashes = [], 0, 0
    for k, (_, _, own) in enumerate(members):
        if k > start and (k - start == TILE or hashes + len(own) > TILE_HASHES):
            out.append(slice(start, k))
            start, hashes = k, 0
        hashes += len(own)
    return [*out, slice(start, len(members))] if members else out


def own_links(members: list[Member], radius: int, least: float) -> list[tuple[int, int]]:
    """Links (greater key, lesser key) that connect what is linked among a shard's members, found with a BK-tree of their fingerprints."""
    tree, at, classes, links = BKTree(), {}, Classes(), []
    sure = None
    if len(members) > FEW:
        sets, runs = [m[2] for m in members], tiles(members)
        sure = np.block([[alike(sets[a], sets[b], least) for b in runs] for a in runs])
    for k, (key, bits, own) in enumerate(members):
        fp = int.from_bytes(bits, "little")
        for near in tree.within(fp, radius):
            for o in at[near]:
                if classes.find(k) != classes.find(o) and (likeness(own, members[o][2]) >= least if sure is None else sure[k, o]):
                    classes.join(k, o)
                    links.append((max(key, members[o][0]), min(key, members[o][0])))
        if fp not in at:
            tree.add(fp, 0)
        at.setdefault(fp, []).append(k)
    return links


def crossed_links(left: list[Member], right: list[Member], radius: int, least: float) -> list[tuple[int, int]]:
    """Links (greater key, lesser key) that connect what is linked between members of `left` and of `right`; every pair is compared, tile by tile.

    Fingerprints are compared by counting bits: at a radius this wide a tree skips nothing.
    """
    words = [np.frombuffer(b"".join(m[1] for m in side), dtype="<u8").reshape(len(side), -1) for side in (left, right)]
    name = [np.arange(len(left)), np.arange(len(left), len(left) + len(right))]  # of each member's class
    links: list[tuple[int, int]] = []
    for a in tiles(left):
        for b in tiles(right):
            close = np.zeros((a.stop - a.start, b.stop - b.start), dtype=np.uint16)
            for w in range(words[0].shape[1]):
                close += np.bitwise_count(words[0][a, None, w] ^ words[1][None, b, w])
            close = close <= radius
            if not close.any():
                continue
            sure = close & alike([m[2] for m in left[a]], [m[2] for m in right[b]], least)
            for k in np.flatnonzero(sure.any(axis=1)):
                i, near = a.start + k, b.start + np.flatnonzero(sure[k])
                near = near[name[1][near] != name[0][i]]
                for j in near[np.unique(name[1][near], return_index=True)[1]]:  # one of each class
                    gone = name[1][j]
                    for side in name:
                        side[side == gone] = name[0][i]
                    links.append((max(left[i][0], right[j][0]), min(left[i][0], right[j][0])))
    return links


def _checked_links(shards: DataFrame, radius: int, least: float) -> DataFrame:
    """a, b: links between members (id, fp, set) of each shard; a task holds one shard at a time.

    Where side is 0, a shard's members are compared with each other, else those of side 1 with those of side 2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [], [])

        def close() -> list[tuple[int, int]]:
            return own_links(sides[0], radius, least) + (crossed_links(*sides[1:], radius, least) if sides[1] and sides[2] else [])

        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])

        for batch in batches:
            found: list[tuple[int, int]] = []
            for name, key, fp, side, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != at:
                    found += close()
                    at, sides = name, ([], [], [])
                sides[side].append((key, fp, np.frombuffer(own, dtype="<u4")))
            yield links(found)
        yield links(close())

    return shards.repartition("shard").sortWithinPartitions("shard", "id").select("shard", "id", "fp", "side", "set").mapInArrow(run, "a long, b long")


def _with_sizes(placed: DataFrame, *more: Column) -> DataFrame:
    """`placed` with the number n of members of their shard, and `more` (aggregates); members alone in theirs go."""
    # written first, so that both sides of the join are plain exchanges, and a large shard's rows can be split
    sizes = checkpointed(placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), *more).filter("n > 1"))
    return placed.join(sizes, "shard")


def near_copy_classes(docs: DataFrame, least: float = LIKENESS, width: int = WORDS, radius: int = FAR_BITS, key: str = "doc_id", text: str = "text", tree_most: int = SHARD_MOST) -> DataFrame:
    """`key` and component_id (least key of its class) of every key that has near copies.

    Near copies are texts whose sets of `width`-word shingles (words at ASCII spaces, A-Z lower-cased; fewer words make
    one shingle) have a likeness of `least` or more; texts without words are copies of each other. Equal sets are taken
    together before anything is searched. A shard of more than tree_most members is dealt by hash into parts of about a
    sixteenth of it (tree_most to PART_MOST, and about PART_HASHES hashes); each part, and each pair of parts, is a task's
    work, so that every two members of a shard are compared on their whole sets, whatever its size (n members make up to
    16 n rows, or n * n / PART_MOST if that is more). Keys must tell rows apart; rows with a null key have no copies. An empty
    table gives none.
    """
    rows = checkpointed(_narrow(docs, key, text, width).filter(F.col(key).isNotNull()))
    same = rows.groupBy("same").agg(F.min(key).alias("id"), F.min("size").alias("size"), F.min("fp").alias("fp"), F.min("anchors").alias("anchors"))
    reps = checkpointed(same)
    one = reps.select("id", "size", "fp", F.posexplode("anchors").alias("k", "anchor")).select("id", "size", "fp", F.xxhash64("k", "anchor").alias("shard"))
    many = _with_sizes(one, F.sum("size").alias("hashes"))
    part = F.least(F.lit(max(PART_MOST, tree_most)), F.greatest(F.lit(tree_most), F.ceil(F.col("n") / 16)))
    many = many.withColumn("parts", F.when((F.col("n") > tree_most) | (F.col("hashes") > PART_HASHES), F.greatest(F.ceil(F.col("n") / part), F.ceil(F.col("hashes") / PART_HASHES))).otherwise(1).cast("int"))
    large = many.filter("parts > 1").select("id", "fp", "shard", "parts", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"))
    met = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))  # each part with itself and every other
    pair = F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other"))
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    small = many.filter("parts = 1").select("id", "fp", "shard", F.lit(0).alias("side"))
    placed = small.unionByName(met.select("id", "fp", pair.alias("shard"), side.alias("side")))
    members = _sets(docs, key, text, width).withColumnRenamed(key, "id").join(placed, "id")
    edges = checkpointed(_checked_links(members, radius, least).distinct())
    tops = classes_of(edges).withColumnRenamed("fp", "id")
    named = reps.join(tops, "id", "left").select("same", F.coalesce("top", "id").alias("component_id"))
    return rows.join(named, "same").select(key, "component_id")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """`docs` without the rows whose near copy with a lesser key stays; one row of each class stays, all columns as they are.

    Where keys are null or repeated, rows get keys of their own, in the order of `key` (nulls last), which are written
    once with the rows, so that rows are compared by their texts whatever their keys.
    """
    if docs.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).isEmpty():
        return _without_copies(docs, key, text, **how)
    own = free_name(docs, "_place")
    order = [F.col(key).asc_nulls_last(), F.xxhash64(text).asc()]  # rows with one key can be on many tasks
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(own, F.monotonically_increasing_id())
    return _without_copies(checkpointed(placed), own, text, **how).drop(own)


def _without_copies(docs: DataFrame, key: str, text: str, **how) -> DataFrame:
    """`docs`, whose keys are distinct and not null, without the rows that aren't the least of their class."""
    classes = near_copy_classes(docs, key=key, text=text, **how)
    gone = free_name(docs, "_drop")
    drop = checkpointed(classes.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias(gone)))
    return docs.join(drop, F.col(key) == F.col(gone), "left_anti")
