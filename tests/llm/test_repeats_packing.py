import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_data import DATA

from orbitframe.llm import packing as P
from orbitframe.llm import substring_dedup as S
from orbitframe.llm.tokens import Encoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def brute(docs, window):
    first, out = {}, {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if first.setdefault(tuple(w[k : k + window]), i) < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("window, block", [(50, 25), (9, 5), (9, 2)])
def test_repeats_against_all_windows(spark, window, block):
    rng = random.Random(window)
    passages = [[f"p{rng.randrange(40)}" for _ in range(rng.randint(window - 2, window * 3))] for _ in range(6)]
    docs = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"r{rng.randrange(10**6)}" for _ in range(rng.randint(1, 70))]
        docs.append((i, " ".join(words)))
    got = S.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window, block).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute(docs, window)
    assert all(sum(b - a for a, b in r.spans) == r.n_removed for r in got)


def test_repeats_in_odd_rows(odd_docs, no_docs, spark):
    rows = S.drop_repeats(odd_docs, 9, 5, with_text=True).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count() and got[6].kept == "" and got[6].n_removed == got[1].n_words and got[1].n_removed == 0
    assert got[None].n_removed == 0 and got[2].n_words == 0 and got[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[5].n_words == 60_000 and got[8].n_words == 4
    assert S.drop_repeats(no_docs).count() == 0
    far = spark.createDataFrame([(2**62 + 5, "a b c d e f g h i j"), (-(2**63), "a b c d e f g h i j"), (2**63 - 1, "a b c d e f g h i j")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in S.drop_repeats(far, 9, 5).collect()} == {-(2**63): 0, 2**62 + 5: 10, 2**63 - 1: 10}
    with pytest.raises(ValueError):
        S.drop_repeats(odd_docs, 9, 6)


def test_token_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    texts = ["I'm don't l'été x<|endoftext|>y foo_bar 12,345 ÉTÉ×÷ Straße İ ¿Qué? 日本語 e\u0301té \u00a0 x\u0085y tab\tz \x1c q Σίσυφος", "", " \n ", "a", "'s 'S LL we'll", "naïve café—ok … ½ ²x3 𝒳 😀"]
    texts += [r["text"] for r in __import__("pyarrow.parquet", fromlist=["x"]).read_table(DATA / "documents.parquet", columns=["text"]).to_pylist()]
    plain = Tokenizer.from_file(TOKENIZER)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    mine = Encoder(TOKENIZER)
    assert [x.tolist() for x in mine.encode([t.encode() for t in texts])] == want
    mine.forget()
    assert [mine.encode([t.encode()])[0].tolist() for t in texts[:30]] == want[:30]


def test_windows_of_one_hash_but_unlike_words():
    """Two windows whose first hashes are equal count as repeated only if the second ones are too."""
    values = np.array([[7, 1], [7, 2], [7, 1], [9, 3], [9, 3], [5, 5]], dtype=np.uint64)
    ids, found = S.repeated(values, np.array([1, 2, 3, 4, 5, 6]))
    assert sorted(zip(ids.tolist(), found.tolist())) == [(3, 7), (5, 9)]
    w = S.Words([b"a b c d e f", b"a b c d e f x"])
    one, two = w.windows(5)[1], w.windows(5, w.hashed(S.tables(False, False, True)[0]))[1]
    assert len(set(one.tolist()) | set(two.tolist())) == len(set(one.tolist())) + len(set(two.tolist())) and one[0] == one[2] and two[0] == two[2]


def check_pieces(rows, texts, size):
    """Each id of each text once, in windows without gaps."""
    ids = {i: x.astype("<u4") for i, x in zip(texts, (np.append(x, 1) for x in Encoder(TOKENIZER).encode([(t or "").encode() for t in texts.values()])))}
    at = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert all(at[i] == len(ids[i]) for i in ids)
    windows = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == windows.get(r.sequence_id, 0)
        windows[r.sequence_id] = r.offset + r.length
    assert max(windows.values()) <= size and all(n == size or n & (n - 1) == 0 for n in windows.values())


@pytest.fixture
def small_shards(monkeypatch):
    """Shards of few documents, so that small tables have many; workers get the numbers with the functions."""
    import orbitframe.llm.packing as module

    def set_to(tokens, docs):
        monkeypatch.setattr(module, "SHARD_TOKENS", tokens)
        monkeypatch.setattr(module, "SHARD_DOCS", docs)

    return set_to


@pytest.mark.parametrize("size, shard_tokens", [(2048, None), (64, 5000)])
def test_packing_is_a_round_trip(spark, small_shards, size, shard_tokens):
    if shard_tokens:
        small_shards(shard_tokens, 50)
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = P.pack_documents(docs, TOKENIZER, size=size).collect()
    check_pieces(rows, texts, size)
    assert (len({r.sequence_id >> 24 for r in rows}) > 10) == bool(shard_tokens)
    assert sorted(P.pack_documents(docs.repartition(5), TOKENIZER, size=size).collect()) == sorted(rows)  # whatever the partitions


def test_packing_odd_rows(odd_docs, no_docs):
    rows = P.pack_documents(odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), TOKENIZER, size=128).collect()
    check_pieces(rows, {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}, 128)
    every = P.pack_documents(odd_docs, TOKENIZER, size=128, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in every) and len({r.doc_id for r in every}) == 9
    assert P.pack_documents(no_docs, TOKENIZER).count() == 0


def test_windows_gather_what_is_alike():
    rng = random.Random(4)
    topics = [[1000 * k + rng.randrange(60) for _ in range(40)] for k in range(8) for _ in range(8)]
    rng.shuffle(topics)
    docs = [np.array(t + [1], dtype=np.uint16) for t in topics]
    windows = P.pack(docs, 41 * 4)
    alike = [len({int(docs[d][0]) // 1000 for d, _, _ in w}) for w in windows]
    assert np.mean(alike) < 2.0


def plain_pack(docs, size, idf, mean):
    """BM25 by its formula over all pairs, and the greedy fill, one document after another."""
    left, out, now, room, seed = list(range(len(docs))), [], [], size, None

    def score(q, d):
        total = 0.0
        for t in set(q.tolist()):
            tf = int((d == t).sum())
            if tf and idf[t] > 0:
                total += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        return total

    while left:
        d = left[0] if room == size else max(left, key=lambda x: (round(score(docs[seed], docs[x]), 9), -x))
        left.remove(d)
        start = 0
        while start < len(docs[d]):
            if room == size:
                seed = d
            n = min(room, len(docs[d]) - start)
            now.append((d, start, n))
            room, start = room - n, start + n
            if not room:
                out.append(now)
                now, room = [], size
    return out, now


def test_packing_against_the_formula():
    rng = np.random.default_rng(3)
    for n, most in ((40, 30), (300, 60)):
        docs = [rng.integers(0, 200, rng.integers(1, most)).astype(np.uint16) for _ in range(n)]
        docs += docs[:10]  # copies
        df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=200)
        idf, mean = P.weights_of(len(docs), df), float(np.mean([len(d) for d in docs]))
        full, rest = plain_pack(docs, 64, idf, mean)
        got = P.pack(docs, 64, idf, mean)
        assert got[: len(full)] == full and got[len(full) :] == P.in_powers(rest)


def test_the_index_takes_counts_of_the_whole_corpus():
    docs = [np.array(x, dtype=np.uint16) for x in ([1, 2, 3], [1, 2, 4], [5, 6, 3])]
    idf = np.array([0, 5.0, 0, 1.0, 1.0, 1.0, 1.0])
    assert P.Bm25(docs, idf, 3.0).scores(0).argsort().tolist() == [2, 1, 0]
    assert P.Bm25(docs, idf[::-1].copy(), 30.0).scores(0)[2] > 0


def topics(rng, n_topics, each):
    """Documents of different topics, some of each that share no text with the others, and near copies."""
    out = []
    for _ in range(n_topics):
        own = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(40)]
        out.append([" ".join(rng.choice(own) for _ in range(rng.randint(25, 40))) for _ in range(each)])
    return out


def test_alike_documents_share_shards(spark, small_shards):
    """Of eight topics and shards for about as many, a document's window holds mostly its own topic; near copies meet."""
    rng = random.Random(8)
    by_topic = topics(rng, 8, 60)
    texts = [(t, x) for t, group in enumerate(by_topic) for x in group]
    copies = [(t, x.replace(x.split()[3], "zzz", 1)) for t, x in texts[::4]]
    rows = texts + copies
    order = list(range(len(rows)))
    rng.shuffle(order)
    small_shards(7000, 100)
    df = spark.createDataFrame([(i, rows[k][1]) for i, k in enumerate(order)], "doc_id long, text string")
    got = P.pack_documents(df, TOKENIZER, size=512).collect()
    check_pieces(got, {i: rows[k][1] for i, k in enumerate(order)}, 512)
    windows, shards = {}, {}
    for r in got:
        windows.setdefault(r.sequence_id, set()).add(order[r.doc_id])
        shards[order[r.doc_id]] = r.sequence_id >> 24
    assert len(set(shards.values())) >= 6
    alike = [np.mean([rows[k][0] == rows[j][0] for k in w for j in w]) for w in windows.values() if len(w) > 2]
    assert np.mean(alike) > 0.8
    together = [shards[k * 4] == shards[len(texts) + k] for k in range(len(copies))]
    assert np.mean(together) > 0.9


def test_a_group_of_copies_is_cut_like_all_else(spark, small_shards):
    small_shards(2000, 40)
    text = "one two three four five six seven eight nine ten " * 3
    rows = [(i, text) for i in range(400)] + [(1000 + i, f"other {i} " + " ".join(f"w{i * j}" for j in range(30))) for i in range(400)] + [(None, text)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.pack_documents(df, TOKENIZER, size=256).collect()
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    held = {}
    for r in got:
        held[r.sequence_id >> 24] = held.get(r.sequence_id >> 24, 0) + (r.start == 0)
    assert max(held.values()) <= 60


def test_the_driver_holds_no_whole_vectors():
    """The sample stays without its zeros while the tree is fitted: whole vectors of 16 bits would take 32 MB, and their root 64 more."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from orbitframe.llm import packing

    rng, rows = np.random.default_rng(4), []
    for k in range(packing.SAMPLE):  # four topics, each with places of its own
        place = np.unique(rng.integers(k % 4 * 1000, k % 4 * 1000 + 1000, 100)).astype(np.uint16)
        rows.append((place.tobytes(), (rng.random(len(place)) / 10 + 0.01).astype(np.float16).tobytes()))
    table = pa.table({"place": pa.array([r[0] for r in rows], pa.binary()), "value": pa.array([r[1] for r in rows], pa.binary())})
    tracemalloc.start()
    some = packing.sampled(table)
    tree = packing.Tree.fit(some, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * packing.SAMPLE * packing.WIDTH, peak
    # the same from whole vectors
    x, held = np.array([some.row(i) for i in range(len(some))]), [np.arange(len(some))]
    assert [r.astype(np.float16).tobytes() for r in x] == sorted(r.astype(np.float16).tobytes() for r in x)
    for node in range(3):
        own = x[held[node]]
        far = int(np.argmin(own @ own.mean(0)))
        one, two = own[far], own[int(np.argmin(own @ own[far]))]
        for _ in range(4):
            right = own @ (two - one) > 0
            one, two = own[~right].mean(0), own[right].mean(0)
        side = own @ (two - one)
        assert np.allclose(tree.way[node], two - one, atol=1e-6) and np.isclose(tree.cut[node], np.median(side), atol=1e-6)
        held += [held[node][side < np.median(side)], held[node][side >= np.median(side)]]


def test_the_driver_holds_little_of_the_sample():
    """The sample travels without its zeros; the tree is that of the whole vectors, in little more memory than two copies of them."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from orbitframe.llm import packing

    rng = np.random.default_rng(3)
    x = np.zeros((packing.SAMPLE, packing.WIDTH), dtype=np.float32)
    for row in x:
        row[rng.integers(0, packing.WIDTH, 100)] = rng.random(100) / 10
    dense = [v.astype(np.float16).tobytes() for v in x]
    made = packing.sparse(x)
    table = pa.table({"place": pa.array([m[0] for m in made], pa.binary()), "value": pa.array([m[1] for m in made], pa.binary())})
    assert table.nbytes < sum(map(len, dense)) / 8
    want = packing.Tree.fit(np.array([np.frombuffer(v, np.float16) for v in sorted(dense)], dtype=np.float32), 3)
    del x, dense, made
    tracemalloc.start()
    got = packing.Tree.fit(packing.sampled(table), 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got.way == want.way).all() and (got.cut == want.cut).all()
    assert peak < 2.4 * 4 * packing.SAMPLE * packing.WIDTH, peak

