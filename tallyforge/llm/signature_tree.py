"""Documents whose sets of word shingles are alike, by signature trees inside the buckets of a prefix filter.

Two sets link when their Jaccard similarity is at least 0.8. The steps, each over all documents:

1. A set is the distinct 64-bit hashes of a text's 5-word shingles. Equal sets are one node.
2. Leaders: nodes that share one of their three smallest hashes are compared by bitmap with the first of them, and those
   that look linked are checked exactly. This joins most groups of near copies without pairing their members.
3. Prefix filter: with all sets in one order, rare shingles first, linked sets share a shingle among the first
   ``n - ceil(0.8 n) + 1`` of both. Buckets of a shingle in which all nodes are joined already are dropped, and of
   buckets with the same nodes one is kept.
4. Each other bucket gets a signature tree: a node holds the OR of the bitmaps below it, their range of sizes and the
   largest number of shingles that the bitmaps leave out. Two nodes are visited together while their largest possible
   overlap can reach the one needed; what is left are pairs of leaves. A first round checks only a spanning forest of
   the pairs that look linked, so that a group is joined by few checks; the second checks every pair of leaves
   that are still in different components. All checks are exact, on the texts.

No candidate is dropped except by a bound that rules a link out. The list of frequent shingles only decides
the order of step 3, so it changes the work, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.components import UnionFind, components
from tallyforge.llm.frames import grouped, scratch, stored

SHINGLE = 5
SIMILAR = 0.8
#: Smallest hashes of a set that lead to leaders.
LEADS = 3
#: A shingle in more than this share of all set entries is frequent; there are at most 1 / FREQUENT of them (4 MB).
FREQUENT = 2e-6
#: Set entries a task counts at a time to find them, and the least count it reports.
COUNTED, REPORTED = 2_000_000, 3
#: Bytes of words hashed at a time; a longer word than LONG_WORD bytes is replaced by its digest.
PART_BYTES, LONG_WORD = 1 << 20, 1_000
#: Rows of a leader bucket that are compared with each other; the first of each such block meets the next block's.
LEADER_BLOCK = 4_096
#: Bytes of bitmaps a tree compares at a time.
FRONTIER = 8 << 20
#: Parts of the keys that are shuffled one after the other.
TURNS = 4
#: Members of a leader that one task checks.
SPLIT = 500
#: Tables of ids up to this many rows (16 MB) are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for exponents below ``n``."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the ``size``-word shingles; all words as one when there are fewer, none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and white space as the contract has it
    if not words:
        return np.zeros(0, np.uint64)
    if max(map(len, words)) > LONG_WORD:
        words = [b"\0" + hashlib.blake2b(w).digest() if len(w) > LONG_WORD else w for w in words]
    k, parts, at = min(size, len(words)), [], 0
    upto = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    while at < len(words) - k + 1:
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PART_BYTES)))
        own = words[at : stop + k - 1]
        at = stop
        raw = np.frombuffer(b" ".join(own), np.uint8)
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        ends = np.cumsum(lengths + 1) - 1
        first, last = (ends - lengths)[: len(own) - k + 1], ends[k - 1 :]
        up, down = _power_tables(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
        parts.append((sums[last] - sums[first]) * down[first])
    h = np.concatenate(parts)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # all bits depend on all bits
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(h ^ (h >> np.uint64(31)))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets link."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 80 * (len(a) + len(b) - common) and common > 0


def width(n: int) -> int:
    """Bits of the bitmap of a set of ``n``: a power of two from twice to four times ``n``."""
    return max(64, 1 << (2 * n - 1).bit_length())


def bitmap(hashes: np.ndarray) -> bytes:
    """Two planes of bits: where at least one shingle of the set falls, and where at least two do."""
    counts = np.bincount((hashes & np.uint64(width(len(hashes)) - 1)).astype(np.int64), minlength=width(len(hashes)))
    return np.packbits(np.concatenate((counts > 0, counts > 1)), bitorder="little").tobytes()


# ---- passes over the texts


def frequent_shingles(docs: DataFrame, text: str) -> np.ndarray:
    """The sorted hashes of the shingles that fill more than ``FREQUENT`` of all set entries, as far as the tasks see them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, total = [], 0, 0

        def report() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = times >= REPORTED
            return pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(times[often])], ["shingle", "n"])

        for _, texts in grouped(batches, "_text"):
            for t in texts:
                held.append(shingle_set(t))
                n += len(held[-1])
            if n >= COUNTED:
                yield report()
                held, n, total = [], 0, total + n
        yield report()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total + n], pa.int64())], ["shingle", "n"])

    sums = stored(docs.select(F.col(text).alias("_text")).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")), "frequent")
    total = sums.where("shingle is null").agg(F.sum("n")).first()[0] or 0
    rows = sums.where(F.col("shingle").isNotNull() & (F.col("n") > FREQUENT * total)).select("shingle").collect()  # at most 1 / FREQUENT
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per document: id, set size ``n``, digest of the set, smallest hashes, prefix shingles, bitmap; written."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, text))
    kind = docs.schema[key].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value
        for part, texts in grouped(batches, "_text"):
            sizes, digests, leads, prefixes, bits = [], [], [], [], []
            for t in texts:
                h = shingle_set(t)
                n = len(h)
                often = np.zeros(n, bool)
                if n and len(hot):
                    often = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
                sizes.append(n)
                digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if n else None)
                leads.append(h[:LEADS].view(np.int64))
                prefixes.append(np.concatenate((h[~often], h[often]))[: n - -(-4 * n // 5) + 1 if n else 0].view(np.int64))
                bits.append(bitmap(h) if n else b"")
            arrays = [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists(leads), _lists(prefixes), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "digest", "leads", "prefix", "bits"])

    out = docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(sketch, f"id {kind}, n long, digest binary, leads array<long>, prefix array<long>, bits binary")
    written = stored(out, "sketch")
    frequent.destroy()
    return written


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])))


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table of a few numbers a row, marked for broadcast if it is within ``BROADCAST_ROWS``."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


# ---- buckets


def _runs(batches: Iterator[pa.RecordBatch], least: int = 50_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables of whole buckets, with the bounds of the buckets; the first column is the bucket's key."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= least:
            whole = pa.Table.from_batches(held)
            cuts = _bounds(whole)
            if len(cuts) > 2:
                yield whole.slice(0, cuts[-2]), cuts[:-1]
                held, n = whole.slice(cuts[-2]).to_batches(), whole.num_rows - cuts[-2]
    if n:
        whole = pa.Table.from_batches(held)
        yield whole, _bounds(whole)


def _bounds(rows: pa.Table) -> np.ndarray:
    key = rows.column(0).to_numpy()
    return np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))


def _stack(bits: list[bytes], w: int) -> np.ndarray:
    """Both planes of bitmaps of ``w`` bits, or of twice as many folded to ``w``, as a row of 64-bit words each."""
    out = np.zeros((len(bits), w // 32), np.uint64)
    for i, b in enumerate(bits):
        if len(b) == w // 4:
            out[i] = np.frombuffer(b, np.uint64)
        else:  # two bits become one: it holds two shingles if either did, or if both held one
            one, two = np.frombuffer(b, np.uint64).reshape(2, 2, w // 64)
            out[i] = np.concatenate((one[0] | one[1], two[0] | two[1] | (one[0] & one[1])))
    return out


def _popcount(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=-1, dtype=np.int64)


def _classes(n: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
    """For each bitmap width: the rows of that width and those of the next that are small enough to link with them."""
    widths = np.array([width(x) for x in n.tolist()])
    for w in np.unique(widths):
        own = np.flatnonzero(widths == w)
        above = np.flatnonzero((widths == 2 * w) & (4 * n <= 5 * n[own].max()))
        yield int(w), np.concatenate((own, above)), len(own)


def _need(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least common shingles of linked sets of these sizes: ceil(4 / 9 (a + b))."""
    return -(-4 * (a + b) // 9)


def _alike(a: np.ndarray, b: np.ndarray, n: np.ndarray, w: int) -> np.ndarray:
    """Estimated Jaccard similarity of sets with ``n`` entries together, from their first planes of ``w`` bits."""
    both = np.minimum(_popcount(a[..., : w // 64] | b[..., : w // 64]), w - 1)
    return n / (-w * np.log1p(-both / w)) - 1  # the union that fills so many bits on average


def leader_pairs(n: np.ndarray, bits: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of a bucket's rows (sorted by size), each row with the first that it seems to link with by their bitmaps."""
    pairs = []
    for w, rows, own in _classes(n):
        if len(rows) < 2:
            continue
        words, size = _stack([bits[i] for i in rows], w), n[rows]
        free = np.arange(len(rows))
        while len(free) > 1 and free[0] < own:
            a, rest = free[0], free[1:]
            rest_near = rest[4 * size[rest] <= 5 * size[a]]
            linked = rest_near[_alike(words[rest_near], words[a], size[a] + size[rest_near], w) >= SIMILAR]
            pairs += [(rows[a], rows[b]) for b in linked]
            free = rest[~np.isin(rest, linked)] if len(linked) else rest
    return pairs


class SignatureTree:
    """A binary tree over rows sorted by group and size: OR of bitmaps, size range, most shingles left out, common group.

    A bitmap has a bit for every first and every second shingle at a place, so it leaves out the third and later ones.
    What two sets share at a place is at most the smaller of their numbers there, so the bits that both have and the
    shingles left out bound their overlap.
    """

    def __init__(self, words: np.ndarray, n: np.ndarray, group: np.ndarray) -> None:
        spare = n - _popcount(words)
        self.levels = [(words, n, n, spare, group)]
        while len(self.levels[-1][1]) > 1:
            w, low, high, most, g = self.levels[-1]
            at = np.arange(0, len(low), 2)
            one = np.bitwise_or.reduceat(w, at, axis=0)
            first, last = g[at], g[np.minimum(at + 1, len(g) - 1)]
            self.levels.append((one, np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(most, at), np.where(first == last, first, -1)))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows of different groups whose largest possible overlap allows a link."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        most_pairs = max(64, FRONTIER // (8 * self.levels[0][0].shape[1]))
        while stack:
            level, i, j = stack.pop()
            if len(i) > most_pairs:
                half = len(i) // 2
                stack += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
                continue
            words, low, high, spare, group = self.levels[level]
            keep = (4 * low[i] <= 5 * high[j]) & (4 * low[j] <= 5 * high[i]) & ((group[i] != group[j]) | (group[i] == -1))
            i, j = i[keep], j[keep]
            most = np.minimum(spare[i], spare[j]) + _popcount(words[i] & words[j])
            keep = (most >= _need(low[i], low[j])) | ((i == j) & (level > 0))
            i, j = i[keep], j[keep]
            if level == 0:
                off = i != j
                yield i[off], j[off]
                continue
            below = len(self.levels[level - 1][1])
            left = np.concatenate((2 * i, 2 * i, 2 * i + 1, (2 * i + 1)[i != j]))
            right = np.concatenate((2 * j, 2 * j + 1, 2 * j + 1, (2 * j)[i != j]))
            inside = (left < below) & (right < below)
            stack.append((level - 1, left[inside], right[inside]))


def tree_pairs(n: np.ndarray, bits: list[bytes], group: np.ndarray, spanning: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a bucket's rows of different groups that their bitmaps allow to link.

    With ``spanning`` a forest of the pairs that look linked, the most similar of those at hand first: fewer than rows.
    """
    everyone = np.unique(group, return_inverse=True)[1]
    sets = UnionFind(int(everyone.max()) + 1) if spanning else None
    for w, rows, own in _classes(n):
        g = np.unique(group[rows], return_inverse=True)[1]
        if len(rows) < 2 or g.max() == 0:
            continue
        order = np.lexsort((n[rows], g))
        rows, mine = rows[order], (np.arange(len(rows)) < own)[order]
        words = _stack([bits[i] for i in rows], w)
        for i, j in SignatureTree(words, n[rows], g[order]).pairs():
            here = mine[i] | mine[j]  # two rows of the next width meet in their own class
            i, j = i[here], j[here]
            if sets is not None:
                alike = _alike(words[i], words[j], n[rows[i]] + n[rows[j]], w)
                best = np.argsort(-alike, kind="stable")[: int((alike >= SIMILAR).sum())]
                i, j = _forest(sets, i[best], j[best], everyone[rows])
            yield rows[i], rows[j]


def _forest(sets: UnionFind, i: np.ndarray, j: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs, in order, that join two groups not joined before."""
    kept: list[tuple[int, int]] = []
    for at in range(0, len(i), 2_000):
        root = np.array([sets.find(x) for x in range(len(sets.parent))])
        a, b = i[at : at + 2_000], j[at : at + 2_000]
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True) if (apart := root[group[a]] != root[group[b]]).any() else ():
            if sets.union(int(group[x]), int(group[y])):
                kept.append((x, y))
    found = np.array(kept, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


# ---- the join


def _emit(ids: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    values = ids.to_numpy()
    x, y = values[a], values[b]
    pairs = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1)[x != y], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, cuts in _runs(batches):
        n, bits, a, b = rows.column("n").to_numpy(), rows.column("bits").combine_chunks(), [], []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            for at in range(start, stop, LEADER_BLOCK):
                own = np.arange(at, min(at + LEADER_BLOCK, stop))
                own = np.concatenate(([start], own)) if at > start else own  # the bucket's first row leads every block
                if len(own) > 1:
                    for x, y in leader_pairs(n[own], [bits[i].as_py() for i in own]):
                        a.append(own[x])
                        b.append(own[y])
        yield _emit(rows.column("id"), np.array(a, np.int64), np.array(b, np.int64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers for whole numbers."""
    h = x.astype(np.int64).view(np.uint64) * np.uint64(_BASE)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (by key and size) that can have a partner, under the number of the bucket they form.

    A bucket ends where the next size is beyond what can link. Buckets whose nodes are all in one component are left out.
    Buckets of equal nodes get the same number; should other buckets get it by chance, they are visited together, which
    is no harm.
    """
    for rows, cuts in _runs(batches):
        group, ids, n = (rows.column(c).to_numpy() for c in ("group", "id", "n"))
        cuts = np.union1d(cuts, np.flatnonzero(4 * n[1:] > 5 * n[:-1]) + 1)
        number = np.add.reduceat(_mix(ids), cuts[:-1])
        mixed = np.minimum.reduceat(group, cuts[:-1]) != np.maximum.reduceat(group, cuts[:-1])
        first = np.zeros(len(number), bool)
        first[np.unique(number, return_index=True)[1]] = True
        keep = np.flatnonzero(np.repeat(mixed & first, np.diff(cuts)))
        numbers = np.repeat(number.view(np.int64), np.diff(cuts))[keep]
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids[keep])], ["key", "id"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (by key) whose key has another row."""
    for rows, cuts in _runs(batches):
        sizes = np.diff(cuts)
        keep = pa.array(np.repeat(sizes > 1, sizes))
        yield from rows.filter(keep).combine_chunks().to_batches()


def _traverse(spanning: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _runs(batches, 5_000):
            n, bits, group, ids = rows.column("n").to_numpy(), rows.column("bits").combine_chunks(), rows.column("group").to_numpy(), rows.column("id")
            mixed = np.minimum.reduceat(group, cuts[:-1]) != np.maximum.reduceat(group, cuts[:-1])
            for start, stop in zip(cuts[:-1][mixed], cuts[1:][mixed], strict=True):
                for i, j in tree_pairs(n[start:stop], bits.slice(start, stop - start).to_pylist(), group[start:stop], spanning):
                    if len(i):
                        yield _emit(ids, i + start, j + start)

    return run


def verified(docs: DataFrame, key: str, text: str, pairs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose texts link, compared set by set. A much-wanted ``a`` is checked in several tasks."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SPLIT).alias("parts"))
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    wanted = stored(dealt.select("a", "part", F.col("b").alias("id")).unionAll(dealt.select("a", "part", F.col("a").alias("id")).distinct()), "wanted")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("_text")).join(small(wanted), "id").select("a", "part", "id", "_text")
    kind = docs.schema[key].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, sets = None, []
        for part, texts in grouped(batches, "_text"):
            a, b = [], []
            for x, s, y, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), texts, strict=True):
                if leader != (x, s):
                    leader, sets = (x, s), []
                if x == y:
                    sets.append(shingle_set(t))
                elif sets and (own := shingle_set(t)) is not None and any(similar(one, own) for one in sets):
                    a.append(x)
                    b.append(y)
            kind_of = part.column(0).type
            yield pa.RecordBatch.from_arrays([pa.array(a, kind_of), pa.array(b, kind_of)], ["a", "b"])

    by_leader = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("id") != F.col("a"))
    return by_leader.mapInArrow(check, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` (the smallest linked id) for every row.

    A null, empty or wordless text has an empty set and is linked with nothing. Ids are whole numbers; rows of one id
    are one document with several texts, linked where any of them links; a row without an id stands alone with a null
    component. Equal sets are always linked. Other columns are not looked at; an empty table gives an empty one.
    """
    with scratch() as keep:
        members, roots = _linked(docs, key, text)
        members, roots = keep(members), keep(roots)
    return members.join(small(roots.withColumnRenamed("id", "node")), "node", "left").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("component_id"))


def _linked(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``id, n, node`` of every row, and ``id, root`` of the nodes that are linked with a smaller one; both written."""
    rows = sketches(docs, key, text)
    known = rows.where("n > 0 and id is not null")
    copies = stored(known.groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("rows")).where("rows > 1").select("digest", "node"), "copies")
    # sets without a shingle have no digest and no copy: they stay out of the join, where they would meet under one key
    joined = known.join(small(copies), "digest", "left").withColumn("node", F.coalesce("node", "id"))
    nodes = joined.where("id = node")
    alone = rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("node"))
    members = stored(joined.select("id", "n", "node").unionAll(alone), "members")

    kind = docs.schema[key].dataType.simpleString()
    pair = f"a {kind}, b {kind}"

    def buckets(keyed: DataFrame, name: str) -> DataFrame:
        by_key = keyed.select("key", "id", "n", "group").repartition("key").sortWithinPartitions("key", "n", "id")
        return stored(by_key.mapInArrow(_mixed, f"key long, id {kind}").distinct(), name)

    def with_bitmaps(bucket: DataFrame, roots: DataFrame) -> DataFrame:
        full = bucket.join(_grouped(nodes, roots).select("id", "n", "group", "bits"), "id").select("key", "n", "id", "group", "bits")
        return full.repartition("key").sortWithinPartitions("key", "n", "id")

    with scratch() as keep:
        roots = docs.sparkSession.createDataFrame([], f"id {kind}, root {kind}")
        led = buckets(nodes.select(F.explode("leads").alias("key"), "id", "n", F.col("id").alias("group")), "leads")
        led = stored(with_bitmaps(led, roots).mapInArrow(_lead, pair).distinct(), "led")
        links = keep(stored(verified(docs, key, text, led), "links"))
        roots = keep(stored(components(links), "roots"))

    # Most shingles are in one set alone: they go before anything but the key and the id is moved. The keys are worked
    # through in turns, so that the shuffle files of one turn are gone before the next.
    turn = lambda i: F.pmod(F.col("key"), F.lit(TURNS)) == i
    several = []
    for i in range(TURNS):
        entries = nodes.select(F.explode("prefix").alias("key"), "id").where(turn(i)).repartition("key").sortWithinPartitions("key")
        several.append(stored(entries.mapInArrow(_repeated, f"key long, id {kind}"), "repeated"))
    keyed = reduce(DataFrame.unionAll, several).join(_grouped(nodes, roots).select("id", "n", "group"), "id")
    for spanning in (True, False):
        with scratch() as keep:
            mixed = keep(buckets(keyed, "mixed"))
            turns = [stored(with_bitmaps(mixed.where(turn(i)), roots).mapInArrow(_traverse(spanning), pair).distinct(), "candidates") for i in range(TURNS)]
            more = reduce(DataFrame.unionAll, turns).distinct()
            links = keep(stored(links.unionAll(verified(docs, key, text, stored(more, "pairs"))), "links"))
            roots = keep(stored(components(links), "roots"))
        keyed = mixed.join(_grouped(nodes, roots).select("id", "n", "group"), "id")
    return members, roots


def _numbered(docs: DataFrame, number: str) -> DataFrame:
    """``docs`` with a column of numbers that no two rows share and that every pass over the table finds again.

    Rows that are read straight from files are numbered by file and place in it; any others are written with their numbers first.
    """
    straight = docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    if not straight or {"_metadata", "_path", "_file", "_at"} & set(docs.columns):
        return stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    own = [F.col(f"`{c}`") for c in docs.columns]
    path = F.col("_metadata.file_path").alias("_path")
    files = stored(docs.select(path).distinct().select("_path", F.row_number().over(Window.orderBy("_path")).alias("_file")), "files")  # a row a file
    placed = docs.select(*own, path, F.col("_metadata.row_index").alias("_at"))
    return placed.join(small(files), "_path").select(*own, F.expr("shiftleft(cast(_file as bigint), 40) + _at").alias(number))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked texts, that with the smallest key (null last); columns as they are.

    Rows are told apart by a number of their own and not by their key, so rows of one key with unrelated texts stay, and
    rows without a key are treated like any other. Of repeated rows one stays. Rows without a word are linked with
    nothing and all stay. An empty table gives an empty one.
    """
    number = "_row"
    while number in docs.columns:
        number += "_"
    numbered = _numbered(docs, number)
    with scratch() as keep:
        found = near_duplicates(numbered.select(F.col(number).alias("_row"), F.col(text).alias("text")), "_row")
        keys = numbered.select(F.col(number).alias("_row"), F.col(f"`{key}`").alias("_key"))
        several = stored(found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id"), "groups")
        members = found.join(small(several), "component_id").select("component_id", "_row").join(keys, "_row")
        first = members.groupBy("component_id").agg(F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_row"))["_row"].alias("first"))
        others = keep(stored(members.join(first, "component_id").where("_row <> first").select(F.col("_row").alias(number)), "near-copies"))
    return numbered.join(small(others), number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _grouped(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes with the component each is in so far."""
    return nodes.join(small(roots), "id", "left").withColumn("group", F.coalesce("root", "id"))
