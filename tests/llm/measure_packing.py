"""Prints how many of a seed's best neighbours in the whole corpus its shard holds: python tests/llm/measure_packing.py FOLDER [SEEDS]."""

import sys

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq

from orbitframe.llm import packing as P
from orbitframe.llm.tokens import Encoder


def main(folder: str, seeds: int) -> None:
    texts = [(t or "").encode() for t in pq.read_table(f"{folder}/documents.parquet", columns=["text"])["text"].to_pylist()]
    own, docs = Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    for a in range(0, len(texts), 1000):
        docs += [np.append(x, x.dtype.type(1)) for x in own.encode(texts[a : a + 1000])]
    n, mean = len(docs), float(np.mean([len(d) for d in docs]))
    df = sum(np.bincount(P.distinct(docs[s], 50_000)[1], minlength=50_000) for s in P.portions(docs))
    idf = P.weights_of(n, df)
    parts = int(np.ceil(sum(P.share(len(d)) for d in docs)))
    rng = np.random.default_rng(1)
    some = rng.choice(n, min(n, P.SAMPLE), replace=False)
    x = np.zeros((len(some), P.WIDTH), np.float32)
    for k, d in enumerate(some):
        _, place, value = P.vectors([docs[d]], idf)
        np.add.at(x[k], place, value)
    tree = P.Tree.fit(x, int(min(P.DEPTH, np.ceil(np.log2(parts)))))
    key = np.concatenate([P.keys(tree, docs[s], list(range(s.start, s.stop)), idf) for s in P.portions(docs)])
    order = np.argsort(key)
    reach = np.cumsum([P.share(len(docs[d])) for d in order])
    shard = np.empty(n, dtype=np.int64)
    shard[order] = np.minimum((reach * parts / reach[-1]).astype(np.int64), parts - 1)
    norm = P.K1 * (1 - P.B + P.B * np.array([len(d) for d in docs]) / mean)
    asked = rng.choice(n, seeds, replace=False)
    score = np.zeros((seeds, n), dtype=np.float32)
    terms = [set(np.unique(docs[q]).tolist()) for q in asked]
    holds = np.zeros((len(idf), seeds), dtype=np.float32)
    for k, t in enumerate(terms):
        holds[list(t), k] = idf[list(t)]
    for d in range(n):
        t, tf = np.unique(docs[d], return_counts=True)
        score[:, d] = (tf * (P.K1 + 1) / (tf + norm[d])).astype(np.float32) @ holds[t]
    hit, near_hit, mass, chance = [], [], [], []
    for k, q in enumerate(asked):
        self_score, s = score[k, q], score[k].copy()
        s[q] = -1
        best = np.argsort(-s)[:10]
        mine = np.flatnonzero((shard == shard[q]) & (np.arange(n) != q))
        hit.append(np.mean(shard[best] == shard[q]))
        near = best[s[best] >= 0.8 * self_score]
        near_hit += (shard[near] == shard[q]).tolist()
        if len(mine) and s[best].sum() > 0:
            mass.append(np.sort(s[mine])[::-1][:10].sum() / s[best].sum())
        chance.append(np.mean(shard == shard[q]))
    print(f"{folder}: {n} documents, {parts} shards, {seeds} seeds; ten best in the shard {np.mean(hit):.3f} (by chance {np.mean(chance):.3f});")
    print(f"  neighbours with 0.8 of the seed's own score or more: {len(near_hit)}, in the shard {np.mean(near_hit):.3f}; score of the shard's ten best as a share of the corpus' {np.mean(mass):.3f}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 200)
