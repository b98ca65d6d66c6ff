import re
from collections import Counter

import numpy as np
from llm_data import DATA

from orbitframe.llm import quality_rules as Q


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    repeat = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat)


def test_base_counts(spark, odd_docs, no_docs):
    got = Q.judge(odd_docs).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert len(got) == odd_docs.count()
    for r in got:
        n = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and (r.kept is False or not r.base_failed)
    assert Q.judge(no_docs).count() == 0


def test_the_real_table(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in Q.judge(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])


def test_judgement_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    seen = [(labels[r.doc_id], r.kept) for r in Q.judge(docs).filter("not base_failed").collect() if r.doc_id in labels]
    assert np.mean([k for q, k in seen if q == 1]) > 0.98 and np.mean([k for q, k in seen if q == 0] or [0]) < 0.1


def test_fit_finds_what_made_the_votes():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    right = np.linspace(0.7, 0.95, len(Q.RULES))
    vote = np.where(rng.random((20_000, len(Q.RULES))) < right, good[:, None], ~good[:, None]) * 2
    vote[rng.random(vote.shape) < 0.3] = 1
    codes, back, n = np.unique(vote @ 3 ** np.arange(len(Q.RULES)), return_inverse=True, return_counts=True)
    p = Q.fit(codes, n.astype(float))[back]
    assert ((p > 0.5) == good).mean() > 0.97 and abs(p.mean() - good.mean()) < 0.02


def test_kept_rows_are_whole(odd_docs, no_docs):
    kept = Q.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    want = sorted(str(r.doc_id) for r in Q.judge(odd_docs).filter("kept").collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert Q.keep_good(no_docs).count() == 0


def test_fit_equals_the_textbook():
    """Expectation-maximisation written out with loops over texts, from the same start."""
    import math

    rng = np.random.default_rng(7)
    n, rules = 300, len(Q.RULES)
    good = rng.random(n) < 0.7
    vote = np.where(rng.random((n, rules)) < 0.8, good[:, None], ~good[:, None]) * 2
    vote[rng.random(vote.shape) < 0.2] = 1
    p = [1 / (1 + math.exp(-max(-8, min(8, sum(x == 2 for x in v) - 3.0 * sum(x == 0 for x in v))))) for v in vote.tolist()]
    for _ in range(200):
        log = []
        for weight in ([1 - x for x in p], p):
            table = []
            for j in range(rules):
                seen = [sum(w for w, v in zip(weight, vote.tolist()) if v[j] == k) + Q.SMOOTHING for k in range(3)]
                table.append([math.log(x / sum(seen)) for x in seen])
            log.append(table)
        prior = math.log((sum(p) + Q.SMOOTHING) / (n - sum(p) + Q.SMOOTHING))
        gain = [[min(0.0, log[1][j][0] - log[0][j][0]), 0.0, max(0.0, log[1][j][2] - log[0][j][2])] for j in range(rules)]
        new = [1 / (1 + math.exp(-max(-30, min(30, prior + sum(gain[j][v[j]] for j in range(rules)))))) for v in vote.tolist()]
        done = max(abs(a - b) for a, b in zip(new, p)) < 1e-9
        if done:
            break
        p = new
    codes, back, count = np.unique(vote @ 3 ** np.arange(rules), return_inverse=True, return_counts=True)
    assert np.allclose(Q.fit(codes, count.astype(float))[back], p, atol=1e-6)
