"""Mixing schedule, periodic runs and the Merkle manifest against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.llm import merkle, mixing, periodic_runs, queries
from tallyforge.llm.frames import table
from tallyforge.llm.running import running

# ---- sums along an order


def test_running_sums_in_groups(spark):
    rows = [(None if g == 0 else f"g{g}", (7 * i) % 50, i % 4) for i in range(600) for g in [i % 5 if i % 3 else 1]]
    df = spark.createDataFrame(rows, "g string, o int, w int").repartition(5)
    found = running(df, "g", ["o"], F.col("w")).collect()
    assert len({r.row for r in found}) == 600
    for g in {r[0] for r in rows}:
        own, total = sorted((r for r in found if r.g == g), key=lambda r: (r["at"], r.w)), 0
        assert sorted(r.w for r in own) == sorted(w for x, _, w in rows if x == g)
        for r in own:
            assert r["at"] == total and r.at_total == sum(x[2] for x in rows if x[0] == g)
            total += r.w
        order = [r.o for r in own if r.w]
        assert order == sorted(order)
    alone = [r["at"] for r in running(df, None, ["o"]).collect()]
    assert sorted(alone) == list(range(600))
    assert running(df.limit(0), "g", ["o"]).count() == 0


# ---- mixing


def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, share * sum(sizes.values())
    while len(fixed) < len(sizes):
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if most * sizes[s] < level * weight[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: most * sizes[s] for s in over}
    return fixed


def mixed(spark, rows, block):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, at string, taken string")
    pieces, documents = mixing.mix(docs, "doc_id", "source", block=block)
    return pieces.collect(), documents.collect()


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_mix_meets_targets(spark, block):
    rng = random.Random(block)
    rows = [(i if i % 11 else None, rng.choice(["a", "a", "a", "b", "é", None, "tiny"][: 6 if i > 3 else 7]), " w" * rng.choice([0, 1, 3, 40]), "x", "y") for i in range(150)]
    rows += [(999, "long", "w\t" * 5000, "x", "y"), (1, "a", None, "x", "y"), (2, "b", "twice", "x", "y"), (2, "b", "twice", "x", "y")]
    pieces, documents = mixed(spark, rows, block)
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += len((r[2] or "").split())
    want = plain_targets(sizes)
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in documents) == sorted((str(r[0]), str(r[1]), len((r[2] or "").split())) for r in rows)
    taken = Counter()
    for r in documents:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
    # every slot is one block of one source, without a gap and at most ``block`` words long
    slots, per_row = defaultdict(list), Counter()
    for p in pieces:
        slots[p.time].append(p)
        per_row[p.row] += p.taken
        assert p.taken > 0
    for held in slots.values():
        held.sort(key=lambda p: p["at"])
        assert len({(p.source, p.block) for p in held}) == 1 and held[0]["at"] == 0
        assert all(a["at"] + a.taken == b["at"] for a, b in zip(held, held[1:])) and held[-1]["at"] + held[-1].taken <= block
    assert all(per_row[r.row] == r.taken for r in documents)
    # at any time every source has had its share, up to a few slots
    times, count = sorted(slots), Counter()
    total = sum(want.values())
    for k, t in enumerate(times[: len(times) * 2 // 3], 1):
        count[slots[t][0].source] += 1
        assert all(abs(count[s] - k * want[s] / total) <= 6 + 0.05 * k for s in want if sizes[s] >= 50 * block)


def test_mix_of_nothing(spark):
    for rows in ([], [(1, "a", None, "", "")], [(1, None, "", "", ""), (2, "b", "  ", "", "")]):
        pieces, documents = mixed(spark, rows, 4)
        assert not pieces and [r.taken for r in documents] == [0] * len(rows)


def test_mix_repeats(spark, base):
    a, b = (sorted(map(tuple, queries.op11_low_discrepancy_mix(spark, base).repartition(n).collect())) for n in (1, 3))
    assert a == b


# ---- periodic runs


def plain_runs(words):
    """All runs by comparing every position with every other."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= max(q, 12 - q):
                stretch = words[i : j + q]
                if not any(all(stretch[k] == stretch[k + d] for k in range(len(stretch) - d)) for d in range(1, q)):
                    out.append((i, q, j - i + q))
            i = j + 1
    return sorted(out)


def collapsed(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def tiled_runs(texts):
    """What the operator's parts find, put together without Spark."""
    words, counts = periodic_runs.split_words(texts)
    ids = np.array(words.dictionary_encode().indices if len(words) else [], np.int64)
    bands = {low: (high, step) for low, high, step in periodic_runs.octaves(1 << 40)}
    held = defaultdict(list)
    for d, low, first, some, marks in periodic_runs.tiles_of(ids, counts):
        for q, parts in periodic_runs.fragments(some.tolist(), marks.tolist(), low, *bands[low]).items():
            held[d, q] += [(first + a, first + b) for a, b in parts]
    out = [[] for _ in texts]
    for (d, q), parts in held.items():
        a = b = None
        for x, y in sorted(parts) + [(1 << 60, 0)]:
            if a is not None and x <= b:
                b = max(b, y)
                continue
            if a is not None and b - a >= max(q, 12 - q):
                out[d].append((a, q, b - a + q))
            a, b = x, y
    return [sorted(x) for x in out]


@st.composite
def repetitive(draw):
    text = []
    for _ in range(draw(st.integers(0, 4))):
        block = draw(st.lists(st.sampled_from("abc"), min_size=1, max_size=draw(st.sampled_from([2, 5, 9, 20, 40]))))
        text += (block * draw(st.integers(1, 9)))[: draw(st.integers(1, 150))]
        text += draw(st.lists(st.sampled_from("abcdefgh"), max_size=4))
    return text


@settings(max_examples=150, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=4), st.sampled_from([1, 16, 4096]))
def test_tiles_find_all_runs(docs, span):
    old, periodic_runs.TILE_WORDS = periodic_runs.TILE_WORDS, span
    try:
        assert tiled_runs([" ".join(d) for d in docs]) == [plain_runs(d) for d in docs]
    finally:
        periodic_runs.TILE_WORDS = old


def test_long_runs_and_thue_morse():
    rng = random.Random(4)
    thue = [str(bin(i).count("1") % 2) for i in range(700)]
    block = [str(rng.randrange(9)) for _ in range(331)]
    docs = [thue, block * 3 + ["x"] + block * 2, ["u"] * 900, ["a", "b"] * 300 + ["b", "a"] * 40]
    assert tiled_runs([" ".join(d) for d in docs]) == [plain_runs(d) for d in docs]


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic_runs.z_function(s) == want


def test_run_frames(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", 32)
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 12), (4, "a " * 12), (5, "a " * 11), (None, "x y z " * 9 + "q"), (6, "the quick\x0bbrown fox jumps"), (7, "w" * 5000 + " v" * 700)]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in texts], "doc_id long, text string, _row int, runs string")
    found = periodic_runs.find_runs(docs, ["doc_id"], with_text=True).collect()
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.collapsed_sha256) for r in found)
    want = []
    for i, t in texts:
        words = [w for w in (t or "").replace("\x0b", " ").replace("\t", " ").replace("\n", " ").split(" ") if w]
        runs = plain_runs(words)
        text = collapsed(words, runs)
        want.append((str(i), len(words), runs, text, hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert periodic_runs.find_runs(docs.limit(0), ["doc_id"]).count() == 0


def test_run_query(spark, base):
    docs = {r.doc_id: r.text for r in table(spark, base, "documents").collect()}
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, base).collect()}
    assert set(found) == set(docs)
    n_runs = 0
    for i, text in docs.items():
        words = [w.decode() for w in (text or "").encode().split()]
        if len(words) > 3000:
            continue
        order = queries.planted_period((i,), len(words))
        if order is not None:
            h = zlib.crc32(str(i).encode())
            a, g = h // 10 % len(words), h // 10
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(len(words))]
        runs, r = plain_runs(words), found[i]
        n_runs += len(runs)
        best = max(runs, key=lambda x: (x[2], -x[0], -x[1]), default=None)
        assert (r.start, r.period, r.length) == (best or (None,) * 3) and r.n_runs == len(runs)
        assert r.exponent_milli == (best and 1000 * best[2] // best[1])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, q, n in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert n_runs


# ---- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = i // 16 * 16
        out.append((nodes[run:i], nodes[i + 1 : run + 16]))
        i //= 16
    return out


def plain_manifest(rows):
    """(doc_id, source, text) to what the query returns, as a list."""
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, s, t: h("".join(map(value, (i, s, "en", 7, t))))
    groups = defaultdict(list)
    for i, s, t in rows:
        groups[s].append(((i is not None, i or 0, leaf(i, s, t)), i, t))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[0][2] for x in sorted(groups[s], key=lambda x: x[0])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, doc, t) in enumerate(sorted(groups[s], key=lambda x: x[0])):
            path = siblings(trees[s], i) + siblings(top, k)
            proof = h(*[d for b, a in path for d in b + a])
            digest = trees[s][0][i]
            if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
                digest = leaf(doc, s, None if t is None else t.translate({x: x + 32 for x in range(65, 91)}))
            for b, a in path:
                digest = h(*b, digest, *a)
            out.append((str(doc), trees[s][0][i], trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out)


def manifest(spark, rows):
    docs = spark.createDataFrame([(i, s, t, "en", 7, "x") for i, s, t in rows], "doc_id long, source string, text string, lang string, n_chars long, position string")
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(docs, "doc_id", "source", queries.LEAF, {"text": low}, changed).collect()


@pytest.mark.parametrize("tier", [1, 3])
def test_manifest(spark, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    monkeypatch.setattr(merkle, "CHUNK", 16**tier)
    rows = [(i, "hot" if i % 3 else f"s{i % 20}", f"Text {i}" if i % 7 else "plain") for i in range(700)]
    rows += [(None, "hot", "N"), (None, None, None), (5, "hot", ""), (5, "hot", ""), (5, "hot", None), (9999, "Ä", "É" * 3000), (1, "alone", "One")]
    rows += [(i, f"many{i}", "X") for i in range(40)]
    found = manifest(spark, rows)
    assert sorted((str(r.doc_id), *tuple(r)[1:7]) for r in found) == plain_manifest(rows)
    assert {r.verified for r in found} == {True, False}
    # the places in a source's log are those of an append log over all its leaves
    leaves = [r for r in found if r.subroot == next(x.subroot for x in found if x.doc_id == 1 and x.leaf != x.subroot)]
    n = len(leaves)
    height = merkle.levels_over(n)
    log = merkle.append_log([bytes([i % 256]) * 32 for i in range(n)], height)
    at = merkle.position(0, np.arange(n), n, height)
    assert sorted(r.position for r in leaves) == at.tolist() and [log[p][0] for p in at] == [i % 256 for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 4097])
def test_closed_form_places(n):
    height = merkle.levels_over(n)
    leaves = [bytes([i % 251]) * 32 for i in range(n)]
    log, nodes = merkle.append_log(leaves, height), leaves
    for level in range(height + 1):
        assert [log[p] for p in merkle.position(level, np.arange(len(nodes)), n, height)] == nodes
        nodes = [merkle.node(nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    assert len(log) == merkle.position(height, 0, n, height) + 1


def test_manifest_of_one_and_of_nothing(spark):
    one = manifest(spark, [(3, "a", "T")])[0]
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == h() and one.verified == (one.folded_root == one.root)
    assert manifest(spark, []) == []
