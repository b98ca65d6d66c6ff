import re
from fractions import Fraction

import corpus_pipeline as C
from llm_data import DATA
from test_near_dedup import brute

from orbitframe.llm import packing, quality_rules
from orbitframe.llm.queries import ORACLE_SQL, QUERIES


def test_stages_in_order(spark):
    """Each stage against what its operator must do to its input; the pieces hold just what is left."""
    docs = first = spark.read.parquet(str(DATA / "documents.parquet"))
    seen = {}
    for name, stage in C.STAGES:
        before, docs = docs, C.materialise(stage(spark, docs, str(DATA)), "test")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == first.columns
        left = {r.doc_id: r for r in docs.collect()}
        was = {r.doc_id: r for r in before.collect()}
        assert set(left) <= set(was)
        if name == "quality rules":
            assert set(left) == {r.doc_id for r in quality_rules.judge(before).filter("kept").collect()}
        if name == "line dedup":
            lines = [x for r in left.values() for x in (y.strip(" ") for y in r.text.split("\n")) if x.strip()]
            assert len(lines) == len(set(lines)) and all(r.n_chars == len(r.text) for r in left.values())
        if name == "near-dedup":
            want = brute([(r.doc_id, r.text) for r in was.values()], Fraction(4, 5))
            assert set(left) == {i for i, (n, c) in want.items() if i == c or n == 0} and all(left[i] == was[i] for i in left)
        if name == "decontamination":
            items = [re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(str(DATA / "benchmark.parquet")).collect()]
            flat = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in left.values()]
            assert not any(" ".join(i) in t for i in items for t in flat)
            gone = [" ".join(re.findall(r"[^\W_]+", was[i].text.lower())) for i in set(was) - set(left)]
            part = lambda i, t: len({tuple(i[k : k + 5]) for k in range(len(i) - 4)} & {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)})
            assert all(any(part(i, t) >= 0.8 * max(1, len(i) - 4) for i in items) for t in gone)
    packed = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    want = {r.doc_id: r.doc_tokens for r in packing.pack_documents(seen["decontamination"], __import__("public_tokenizers").path("word_bpe_49k.json")).collect()}
    assert packed == want
    assert C.run(spark, str(DATA)).count() == docs.count()


ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu. " * 1), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu. "), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu. "),
    (3, "another text of twelve words that stands under the very same id."), (3, "sun moon star sky cloud rain snow wind storm hail fog mist dew frost."), (None, "sun moon star sky cloud rain snow wind storm hail fog mist dew frost."),
    (None, None), (4, None), (5, ""), (6, " \t\n"), (2**62 + 5, "up down left right in out over under above below near far here there."), (-(2**63), "up down left right in out over under above below near far here there."),
]


def odd_table(spark):
    """Rows with nulls, repeated ones, two texts under one id, and columns whose names stages use themselves."""
    rows = [(i, t, "en" if k % 3 else None, "s" if k % 4 else None, len(t or "") if k % 5 else None, k, "x", 1.5) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, kept string, component double")


def test_near_dedup_keeps_one_row_of_each_group(spark):
    left = [(r.doc_id, r.text) for r in C.near_duplicates(spark, odd_table(spark), str(DATA)).collect()]
    want = [(1, ODD[0][1]), ODD[3], ODD[4], (None, None), (4, None), (5, ""), (6, " \t\n"), (-(2**63), ODD[-1][1])]
    assert sorted(map(str, left)) == sorted(map(str, want))


def test_every_stage_copes_with_odd_rows(spark):
    docs = odd_table(spark)
    for name, stage in C.STAGES:
        got = stage(spark, docs, str(DATA))
        if name != "packing":
            assert got.columns == list(C.COLUMNS), name
        rows = got.collect()
        assert rows or name == "quality rules", name
        if name == "packing":
            assert sum(r.start == 0 for r in rows) == len(ODD)
        assert stage(spark, docs.limit(0), str(DATA)).count() == 0, name


def test_line_dedup_of_odd_rows(spark):
    got = sorted(str((r.doc_id, r.text, r.n_chars)) for r in C.lines(spark, odd_table(spark), str(DATA)).collect())
    own = lambda i, t: str((i, t, len(t)))
    want = [own(1, ODD[0][1])] * 2 + [own(3, ODD[3][1]), own(3, ODD[4][1]), own(None, ODD[5][1]), own(None, ""), own(4, ""), own(5, ""), own(6, " \t\n"), own(-(2**63), ODD[-1][1])]
    assert got == sorted(want)  # of texts that are one line the later copies go; rows without an id stay


def test_line_dedup_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Copies of a line with letters put in are looked at without a row for each two of them."""
    import random

    rng, made = random.Random(3), {}
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line = "f" + text(118) + "f"
    copies = [line[:i] + text(4) + line[i:] for i in (rng.randrange(len(line)) for _ in range(500))]
    docs = spark.createDataFrame([(k, x, "en", "s", len(x)) for k, x in enumerate(copies)], "doc_id long, text string, lang string, source string, n_chars long")
    keep = C.line_dedup.materialise
    monkeypatch.setattr(C.line_dedup, "materialise", lambda df, name, *more: made.setdefault(name, keep(df, name, *more)))
    left = sorted(r.doc_id for r in C.lines(spark, docs, str(DATA)).collect())
    assert made["pairs"].count() < 10 * len(copies)
    con = __import__("duckdb").connect()
    con.register("d", docs.select("doc_id", "text").toPandas())
    near = "SELECT a.doc_id FROM d a JOIN d b ON b.doc_id < a.doc_id AND levenshtein(a.text, b.text) <= 2"
    assert left == [i for (i,) in con.sql(f"SELECT doc_id FROM d WHERE doc_id NOT IN ({near}) ORDER BY doc_id").fetchall()]
    assert 0 < len(left) < len(copies)


def test_a_long_text_passes_every_stage(spark):
    long = "\n".join(" ".join(f"w{(i * 7919 + k) % 50021}" for k in range(20)) + "." for i in range(30_000))  # 4 MB
    docs = spark.createDataFrame([(1, long, "en", "s", len(long)), (2, "short text", "en", "s", 10)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES:
        assert stage(spark, docs, str(DATA)).filter("doc_id = 1").count() >= (name != "quality rules"), name


def test_no_documents(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(str(DATA / f"{t}.parquet")).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_queries_equal_their_sql(spark, duck, same):
    for name, sql in ORACLE_SQL.items():
        assert same(QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(sql).df()), name


def test_a_query_for_each_operator():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 11))
