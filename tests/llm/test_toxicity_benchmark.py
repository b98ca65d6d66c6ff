import re

import numpy as np
from llm_data import DATA
from pyspark.sql import functions as F

from orbitframe.llm import decontaminate as D
from orbitframe.llm import toxicity as T

MODEL = T.Model(((T.fold("idiot"), 5.0), (T.fold("trash"), 4.0)), ("trash can",), (-4.0, 2.0, 1.0, 0.0))


def score(text):
    return T.value(MODEL.curve, T.features(T.fold(text), T.automaton(MODEL)))


def test_disguises_and_exceptions():
    plain = score("you idiot")
    for text in ("you 1d10t", "you іdіоt", "you IDIOT!", "you ｉｄｉｏｔ", "you id\u200biot", "you idiots"):
        assert score(text) == plain > 0.9, text
    assert score("the trash can is full") == score("") == score("videotrashy") < 0.1 < score("the trash is full")
    assert score("idiot " + "fine words here " * 200) < plain


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = T.learn(docs, labels.filter(~held))
    rows = T.score(docs, model).join(labels, "doc_id").filter(held).collect()
    hit = np.mean([r.predicted for r in rows if r.toxic == 1])
    assert hit > 0.85 and np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.01
    assert T.learn(docs, labels.filter(~held)) == model


def naive(text, model):
    """The score by looking for every entry at every place of the folded text."""
    import math

    t, hits, spared = T.fold(text or ""), [], []
    for b in range(len(t)):
        if b and t[b - 1].isalnum():
            continue
        for e in {T.fold(x) for x in model.exceptions}:
            if t.startswith(e, b) and not t[b + len(e) : b + len(e) + 1].isalnum():
                spared.append((b, b + len(e)))
        for e, w in model.entries:
            if t.startswith(e, b) and (len(e) >= 4 or not t[b + len(e) : b + len(e) + 1].isalnum()):
                hits.append((b, b + len(e), w))
    hits = [h for h in hits if not any(a <= h[0] and h[1] <= z for a, z in spared)]
    total = sum(h[2] for h in hits)
    x = (math.log1p(total), math.log1p(100 * total / max(1, len(t.split()))), math.log1p(len({t[a:z] for a, z, _ in hits})))
    z = model.curve[0] + sum(a * b for a, b in zip(model.curve[1:], x)) if t and model.entries else model.curve[0]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_against_a_plain_search(spark, odd_docs):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    model = T.Model((*MODEL.entries, (T.fold("the"), 1.5), (T.fold("oner"), 0.7), ("er", 0.2)), (*MODEL.exceptions, "the erer", "of the"), MODEL.curve)
    for df in (docs, odd_docs.filter("length(text) < 1000 or text is null")):
        texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = sorted((str(r.doc_id), round(r.score, 9), r.predicted) for r in T.score(df, model).collect())
        assert got == sorted((str(i), round(v, 9), int(v >= 0.7)) for i, v in ((i, naive(t, model)) for i, t in texts))


def test_entries():
    counts = [("idio", 50, 0), ("idiot", 50, 0), ("idiots", 20, 0), ("an", 40, 1), ("trash", 45, 1), ("tras", 45, 30)]
    got = dict(T.choose(counts, 60, 100))
    assert set(got) == {"idiot", "an", "trash"} and got["idiot"] > got["trash"] > 0
    many = [(f"word{i:05d}", 20, 0) for i in range(5000)]
    assert len(T.choose(many, 60, 100)) == 5000
    model = T.Model((("an", 3.0),), (), (-2.0, 2.0, 0.0, 0.0))
    has = lambda t: T.features(T.fold(t), T.automaton(model))[0] > 0
    assert has("an ox") and has("x an") and not has("and") and not has("ban")


def test_labels_of_any_ids(spark):
    rows = [(2**62 + 5, "a b"), (2**63 - 1, "c"), (-(2**63), "d e f"), (7, "one two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, (i, _) in enumerate(rows)], "doc_id long, toxic int")
    assert T.score(docs, T.learn(docs, labels)).count() == 4


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    rows = T.score(odd_docs, MODEL).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = T.learn(odd_docs, none)
    assert empty.entries == () and T.score(odd_docs, empty).filter("predicted = 1").count() == 0
    mixed = spark.createDataFrame([(1, 1), (6, 0), (6, 0), (None, 1), (7, None), (2, 1)], "doc_id long, toxic int")
    assert T.score(odd_docs, T.learn(odd_docs, mixed)).count() == odd_docs.count()
    assert T.score(no_docs, MODEL).count() == 0


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(w):
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_every_leak_is_found_and_no_other(spark):
    docs, items = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    index = {r.item_id: shingles(words(r.text)) for r in items.collect()}
    texts = {r.doc_id: shingles(words(r.text)) for r in docs.collect()}
    for r in D.contaminated(docs, items).collect():
        want = sorted(i for i, s in index.items() if s and len(s & texts[r.doc_id]) >= 0.8 * len(s))
        assert r["items"] == want and r.contaminated == bool(want)


def test_pruned_retrieval_is_full_retrieval():
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{int(x)}" for x in rng.zipf(1.3, n) % 400]
    items = [(i, " ".join(word(int(rng.integers(6, 60))))) for i in range(40)]
    index = D.build(items)
    texts = []
    for k in range(60):
        t = word(int(rng.integers(0, 400)))
        if k % 2:
            own = items[k % 40][1].split()
            at = int(rng.integers(0, len(t) + 1))
            t[at:at] = own[: max(3, int(len(own) * rng.uniform(0.4, 1)))]
        texts.append(" ".join(t).encode())
    w = D.hashes(texts)
    want = set()
    for t in range(len(texts)):
        own = w.hash[w.first[t] : w.first[t + 1]]
        for a in range(0, max(1, len(own)), index.length):
            here = np.unique(own[a : a + 2 * index.length])
            for s in range(len(index.owner)):
                terms = index.vocabulary[index.seg_terms[s]]
                if index.seg_impact[s][np.isin(terms, here)].sum() >= 0.6 - 1e-9:
                    want.add((t, int(index.owner[s])))
    assert set(D.retrieve(index, w, 0.6)) == want and want


def test_benchmark_with_odd_rows(spark, odd_docs, no_docs):
    from llm_data import PROSE

    items = spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (None, "x y z"), (4, "one"), (4, "one")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    rows = D.contaminated(odd_docs, items, extra=("text", "shard")).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count() and got[1]["items"] == [1] and got[None]["items"] == [1] and 4 in got[7]["items"]
    assert not got[2].contaminated and not got[5].contaminated and got[5].shard == "y" and got[1].text == PROSE
    assert D.contaminated(odd_docs, items.limit(0)).filter("contaminated").count() == 0 and D.contaminated(no_docs, items).count() == 0


def test_shards_change_nothing(spark, monkeypatch):
    """The same rows whether the items are one shard or many."""
    docs, items = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, None, None, None, None), (5, "", "x", "y", 0)], docs.schema))
    rows = lambda: sorted((str(r.doc_id), r.contaminated, r.n_retrieved, r["items"], round(r.overlap, 9), str(r.source)) for r in D.contaminated(docs, items, extra=("source",)).collect())
    one = rows()
    monkeypatch.setattr(D, "SHARD_BYTES", 2000)
    assert rows() == one and any(r[1] for r in one)
    assert D.contaminated(docs.limit(0), items).count() == 0


def test_questions_and_answers():
    assert D.halves("one two three four five? six seven eight nine ten") == ("one two three four five?", " six seven eight nine ten")
    q, a = D.halves("a b c d e f g h i")
    assert q + a == "a b c d e f g h i" and len(words(a)) == 3
    assert D.halves("one") == ("one", "one")
