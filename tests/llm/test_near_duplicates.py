"""Signature trees and the component search against brute force."""

import random

import numpy as np
import pytest

from tallyforge.llm import signature_tree as S
from tallyforge.llm.components import components
from tallyforge.llm.frames import table
from tests.llm import helpers as H


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, texts = text(60), []
    for _ in range(25):
        base = text(r.choice([3, 6, 12, 40, 90, 200]))
        texts.append(base)
        for _ in range(r.randrange(5)):
            copy = list(base)
            for _ in range(r.randrange(4)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(copy)
    texts += [text(30) + passage + text(30) for _ in range(30)]  # a passage that many share
    base = text(120)
    for _ in range(60):  # a large group of near copies
        copy = list(base)
        copy[r.randrange(120)] = r.choice(vocabulary)
        texts.append(copy)
    return [(i, r.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    texts = corpus(seed)
    found = S.near_duplicates(H.documents(spark, texts).repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == H.near_duplicates(texts)


def test_given_documents(spark, base):
    docs = table(spark, base, "documents")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = S.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == H.near_duplicates(texts)


def test_many_frequent_shingles_change_nothing(spark, monkeypatch):
    """With every shingle frequent, and with tiny blocks, parts and broadcast bounds, the answers stay."""
    texts = corpus(3)
    for name, value in (("FREQUENT", 1e-9), ("REPORTED", 1), ("LEADER_BLOCK", 8), ("FRONTIER", 64), ("SPLIT", 3), ("BROADCAST_ROWS", 0), ("LEADS", 1)):
        monkeypatch.setattr(S, name, value)
    found = S.near_duplicates(H.documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == H.near_duplicates(texts)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(250_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three four five"), (6, "one two three four five"), (None, "one"), (7, long), (8, long + " y"), (9, "w" * 50_000)]
    docs = H.documents(spark, rows).withColumnRenamed("lang", "key").withColumnRenamed("source", "node")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in S.near_duplicates(docs).collect())
    n = 250_000 - 4
    assert found == [(0, 1, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (6, 1, 6), (7, n, 7), (8, n + 1, 7), (9, 1, 9)]
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_hashes_do_not_depend_on_how_a_text_is_cut(monkeypatch):
    text = " ".join(f"w{i % 977} é" for i in range(3000))
    whole = S.shingle_set(text)
    monkeypatch.setattr(S, "PART_BYTES", 300)
    assert np.array_equal(whole, S.shingle_set(text))
    assert len(whole) == len(H.shingles(text))


def test_tree_finds_every_pair_its_bounds_allow():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**63, rng.integers(5, 300), dtype=np.uint64)
        for _ in range(4):
            keep = rng.random(len(base)) > rng.random() * 0.2
            sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 2**63, rng.integers(0, 10), dtype=np.uint64)))))
    sets = sorted((s for s in sets if len(s)), key=len)
    n, group = np.array([len(s) for s in sets]), np.arange(len(sets)) // 2
    found = {tuple(sorted((int(a), int(b)))) for i, j in S.tree_pairs(n, [S.bitmap(s) for s in sets], group) for a, b in zip(i, j, strict=True)}
    wanted = {(a, b) for a in range(len(sets)) for b in range(a) if group[a] != group[b] and S.similar(sets[a], sets[b])}
    assert {tuple(sorted(p)) for p in wanted} <= found and len(found) < len(sets) ** 2 / 8


@pytest.mark.parametrize("block", [500_000, 3])
def test_components_of_random_links(spark, monkeypatch, block):
    monkeypatch.setattr("tallyforge.llm.components.BLOCK", block)
    r = random.Random(block)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 5), (7, 7)]
    sets = H.Sets([x for p in links for x in p if x is not None])
    for a, b in links:
        if a is not None:
            sets.join(a, b)
    found = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()}
    assert found == {x: sets.find(x) for x in sets.parent if sets.find(x) != x}
