import random
from fractions import Fraction

import numpy as np
import pytest

from orbitframe.llm import minhash_dedup as M
from orbitframe.llm.components import components


def brute(docs, least):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, groups, size, words):
    rng = random.Random(seed)
    docs = []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(words)]
        for _ in range(size):
            now = list(base)
            for _ in range(rng.randrange(6)):
                now[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            docs.append((len(docs), " ".join(now)))
    return docs


@pytest.mark.parametrize("least, chunk", [(Fraction(4, 5), 4096), (Fraction(85, 100), 8)])
def test_against_all_pairs(spark, least, chunk):
    docs = near_copies(1, 6, 30, 90)
    got = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), least, chunk=chunk).collect()
    want = brute(docs, least)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(odd_docs, no_docs):
    rows = M.near_duplicates(odd_docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert got[6].component_id == 1 and not got[6].kept and got[1].kept
    assert got[None].component_id == 1 and not got[None].kept
    assert got[7].n_shingles == 1 and got[7].kept
    for i in (2, 3, 4):
        assert got[i].n_shingles == 0 and got[i].component_id == i and got[i].kept
    assert M.near_duplicates(no_docs).count() == 0


def test_case_and_short_texts(spark):
    docs = [(1, "A b c"), (2, "a B C"), (3, "a b"), (4, "É b c"), (5, "é b c")]
    got = {r.doc_id: r.component_id for r in M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    for s in (0.3, 0.8):
        same = int(2000 * 2 * s / (1 + s))
        b = np.concatenate([a[:same], rng.integers(0, 2**63, 2000 - same).astype(np.uint64)])
        m = M.minhashes([a, b], 512)
        assert abs((m[0] == m[1]).mean() - s) < 0.09


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 230)] + [(230, 229), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in [7, *range(200, 231)]} == {7} and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_a_large_cluster_in_chunks(spark):
    """One group of near copies, and one that falls apart into several, cut into many chunks."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(3000)}" for _ in range(60)]
    docs = near_copies(3, 1, 150, 90)
    for g in range(4):  # alike enough to share tables, too unlike to be linked
        own = list(base)
        for k in range(9):
            own[(g * 13 + k * 6) % 60] = f"g{g}.{k}"
        for i in range(25):
            now = list(own)
            now[rng.randrange(60)] = f"x{rng.randrange(10**6)}" if i else own[0]
            docs.append((len(docs), " ".join(now)))
    got = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), Fraction(85, 100), chunk=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, Fraction(85, 100))


def test_chunks_by_weight(spark, monkeypatch):
    docs = near_copies(4, 3, 20, 90)
    monkeypatch.setattr(M, "CHUNK_SHINGLES", 400)
    got = M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, Fraction(4, 5))


def test_one_id_with_several_texts(spark):
    a, b, c, d = ("one two three four five six", "red green blue black white pink", "sun moon star sky cloud rain", "up down left right in out")
    rows = [(1, a), (1, b), (2, a), (3, b), (9, c), (5, c), (5, d), (7, d), (8, None), (8, d), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in M.near_duplicates(df).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (5, 2, 5), (5, 2, 5), (7, 2, 5), (8, 0, 8), (8, 2, 5), (9, 2, 5), (10, 0, 10)]


def test_any_ids(spark):
    text = "one two three four five six"
    ids = [2**63 - 1, -(2**63), 2**62 + 5, 0]
    got = {r.doc_id: r.component_id for r in M.near_duplicates(spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(ids, -(2**63))


def test_hubs(spark):
    """A hub with far more neighbours than all other nodes, looked up in the broadcast table."""
    edges = [(5, i) for i in range(1000, 3000)] + [(i, i + 1) for i in range(1000, 1100)] + [(4000 + i, 4001 + i) for i in range(0, 100, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(got[i] == 5 for i in [5, *range(1000, 3000)]) and all(got[4001 + i] == 4000 + i for i in range(0, 100, 2))


def test_components_in_few_tables(spark, monkeypatch):
    """What a task can link up takes no shuffle: stars one table, other edges two; larger tables come out right too."""
    from orbitframe.llm import components as K

    made, keep = [], K.materialise
    monkeypatch.setattr(K, "materialise", lambda df, name, *more: made.append(name) or keep(df, name, *more))
    edges = [(5, i) for i in range(1000, 1400)] + [(7, 6), (6, 7), (9, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7), "t").collect()}
    assert got == {i: 5 for i in [5, *range(1000, 1400)]} | {6: 6, 7: 6}
    assert len(made) == 1
    rng = random.Random(8)
    edges = [(rng.randrange(-300, 300) * 2**52, rng.randrange(-300, 300) * 2**52) for _ in range(260)] + [(i, i + 1) for i in range(1, 60)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    for portion, tables in ((1 << 18, [2]), (64, range(3, 99))):
        made.clear()
        monkeypatch.setattr(K, "PORTION", portion)
        rows = components(spark.createDataFrame(edges, "a long, b long").repartition(5), "t").collect()
        assert len(rows) == len(root) and {r.node: r.component for r in rows} == root and len(made) in tables
