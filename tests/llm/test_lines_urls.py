import hashlib
import random

import pytest
from pyspark.sql import functions as F

from orbitframe.llm import line_dedup as L
from orbitframe.llm import url_filter as U


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def edited(rng, s, k):
    s = list(s)
    for _ in range(k):
        i = rng.randrange(len(s))
        what = rng.randrange(3)
        s[i : i + (what > 0)] = [rng.choice("abé ")] if what < 2 else []
    return "".join(s)


def test_verification(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(3, 30)))
        pairs.append((a, edited(rng, a, rng.randint(0, 4)) if rng.random() < 0.8 else "".join(rng.choice("abcé") for _ in range(len(a)))))
    pairs = [p for p in pairs if p[1]]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", L.within(F.col("a"), F.col("b")).alias("w")).collect():
        assert r.w == (distance(r.a, r.b) <= L.EDITS), r


def test_against_all_pairs(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(18, 45))) for _ in range(30)]
    docs = []
    for d in range(120):
        lines = [edited(rng, rng.choice(base), rng.randint(0, 4)) if rng.random() < 0.6 else "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 6))]
        docs.append((d, "\n".join(lines)))
    got = {r.doc_id: r for r in L.drop_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    seen: list[str] = []
    for d, text in docs:
        kept = []
        for line in text.split("\n"):
            own = line.strip(" ")
            if own:
                near = lambda s: len(own) >= L.LEAST and len(s) >= L.LEAST and abs(len(s) - len(own)) <= L.EDITS and distance(own, s) <= L.EDITS  # noqa: B023, E731
                gone = any(own == s or near(s) for s in seen)
                seen.append(own)
                if gone:
                    continue
            kept.append(line)
        assert got[d].kept == "\n".join(kept) and got[d].n_removed == len(text.split("\n")) - len(kept)


def test_crowded_keys_change_nothing(spark, monkeypatch):
    """Many lines that share a segment, dealt to several tasks, against the plain way."""
    rng = random.Random(4)
    head = "the very same beginning of all lines "
    docs = [(i, head + edited(rng, "and an end of their own that differs ", 3) + "".join(rng.choice("abcdef") for _ in range(rng.randint(0, 3)))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    plain = sorted(tuple(r) for r in L.drop_lines(df).collect())
    monkeypatch.setattr(L, "SAMPLED", 2)
    monkeypatch.setattr(L, "CROWD", 16)
    assert sorted(tuple(r) for r in L.drop_lines(df).collect()) == plain
    assert any(r[2] for r in plain)


def test_groups_of_near_copies_make_no_square_of_pairs(spark):
    """Copies of a line with letters put in, most of them more than the distance apart, and copies that are all within it, against the SQL."""
    import duckdb

    from orbitframe.llm.queries import OP3_SQL

    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    far, near = "f" + text(118) + "f", "n" + text(78) + "n"
    lines = []
    for _ in range(600):
        i = rng.randrange(len(far))
        lines += [far[:i] + text(4) + far[i:], edited(rng, near, 1).replace("é", "k")]  # the SQL's distance counts bytes
    rng.shuffle(lines)
    docs = [(7 * k, "\n".join(lines[3 * k : 3 * k + 3])) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    made = {}
    keep = L.materialise
    try:
        L.materialise = lambda df, name, *more: made.setdefault(name, keep(df, name, *more))
        got = sorted((r.doc_id, r.n_removed, r.kept) for r in L.drop_lines(df).collect())
    finally:
        L.materialise = keep
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.sql(f"SELECT doc_id, n_removed, kept_sha256 FROM ({OP3_SQL}) ORDER BY doc_id").fetchall()
    assert [(d, n, hashlib.sha256(kept.encode()).hexdigest()) for d, n, kept in got] == want
    n = made["lines"].count()
    assert n > 700 and 500 < sum(r[1] for r in got) and made["pairs"].count() < 40 * n


def test_crowded_keys_against_pairs(spark, monkeypatch):
    """Lines of several lengths and alphabets, both directions: verified within the join, dealt out, or as pairs."""
    rng = random.Random(12)
    base = ["a\u00e9\U0001f600 common line with few signs", "e" * 40, "etnoiar" * 40]
    lines = [edited(rng, rng.choice(base), rng.randint(0, 5)) for _ in range(400)]
    df = spark.createDataFrame([(k // 2, "\n".join(lines[k : k + 2])) for k in range(0, 400, 2)], "doc_id long, text string")
    found = []
    for many, crowd in ((10**9, 4096), (16, 4096), (16, 16)):
        monkeypatch.setattr(L, "SAMPLED", 2)
        monkeypatch.setattr(L, "MANY", many)
        monkeypatch.setattr(L, "CROWD", crowd)
        found.append(sorted(tuple(r) for r in L.drop_lines(df).collect()))
    assert found[0] == found[1] == found[2] and 50 < sum(r[2] for r in found[0]) < 400


def test_verification_ends_early(spark):
    """Lines that soon are too far apart cost few steps, and ones of which one begins the other are told."""
    import time

    rng = random.Random(13)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    told = [("abc", "abc"), ("abc", "abcd"), ("abc", "abcde"), ("abc", "abcdef"), ("abcd", "abc"), ("abcdef", "abc"), ("a", "b"), ("a", "bcd"), ("abcabc", "bcabca"), ("\u00e9\U0001f600x", "\u00e9x")]
    got = spark.createDataFrame(told, "a string, b string").select("a", "b", L.within(F.col("a"), F.col("b")).alias("w")).collect()
    assert [r.w for r in got] == [distance(a, b) <= L.EDITS for a, b in told]
    near, far = [], []
    for _ in range(400):
        a = text(1500)
        near.append(("x" + a, "y" + a))
        far.append((a, text(1500)))
    seconds = {}
    for name, pairs, want in (("near", near, 400), ("far", far, 0)) * 2:
        df = spark.createDataFrame(pairs, "a string, b string").coalesce(1).cache()
        df.count()
        began = time.time()
        assert df.filter(L.within(F.col("a"), F.col("b"))).count() == want
        seconds[name] = time.time() - began
        df.unpersist()
    assert seconds["far"] < 0.6 * seconds["near"], seconds


def test_work_for_each_line(spark, monkeypatch):
    """A text is hashed once and not for each of its lines; lines of crowded keys are read once for all joins."""
    monkeypatch.setattr(L, "SAMPLED", 2)
    lines = [f"\t{i} a line that many others are like " + "abcdefgh"[i % 8] * (i % 3) for i in range(400)] + ["\t\r", "\x0b \x0c", "\t \tx", "\tx"] * 2
    docs = spark.createDataFrame([(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(102)], "doc_id long, text string")
    made = {}
    keep = L.materialise
    monkeypatch.setattr(L, "materialise", lambda df, name, *more: made.setdefault(name, (keep(df, name, *more), df))[0])
    gone = L.removed_lines(docs)
    plan = gone._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Generate posexplode") < plan.index("xxhash64(text")
    assert made["near"][0].count() > 100 and not [f for f in made["near"][1].inputFiles() if "/lines-" in f]
    assert {r.doc_id: r.gone for r in gone.collect() if r.doc_id >= 100} == {101: [2, 3]}  # blank lines stay


def test_signatures(spark):
    """Counts and lengths beyond a byte, too: pairs within the distance pass, whatever the line's length."""
    rng = random.Random(6)
    pairs = []
    for n in (20, 254, 255, 256, 257, 300, 1000):
        for _ in range(40):
            a = "".join(rng.choice("etnoiarsé") for _ in range(n)) if rng.random() < 0.7 else "e" * n
            b = edited(rng, a, rng.randint(0, 2))
            pairs.append((*sorted((a, b), key=len),))
    df = spark.createDataFrame([(k, x) for k, p in enumerate(pairs) for x in p], "k long, line string").withColumn("n", F.length("line"))
    sig = {r.line: r.sig for r in L.with_signatures(df).collect()}
    for line, got in sig.items():
        want = [line.count(c) % 256 for c in L.LETTERS] + [len(line) % 256]
        assert [(got >> 8 * k) & 255 for k in range(8)] == want
    both = spark.createDataFrame([(sig[a], sig[b], len(b) - len(a)) for a, b in pairs], "a long, b long, more long")
    met = both.select("more", L.longer(F.col("a"), F.col("b")).alias("longer"), L.apart(F.col("a"), F.col("b")).alias("apart")).collect()
    assert all(r.longer == r.more and r.apart <= 2 * L.EDITS - r.more for r in met)


def test_lines_without_a_pair_are_not_compared(spark):
    """The joins that verify pairs read only lines that are in a pair."""
    docs = spark.createDataFrame([(i, f"line number {i} of its own kind {i * 7919} " + "xyz"[i % 3] * i) for i in range(50)] + [(99, "line number 3 of its own kind 23757 xxX")], "doc_id long, text string")
    made = {}
    keep = L.materialise
    try:
        L.materialise = lambda df, name, *more: made.setdefault(name, keep(df, name, *more))
        assert {r.doc_id for r in L.drop_lines(docs).collect() if r.n_removed} == {99}
    finally:
        L.materialise = keep
    assert 2 <= made["compared"].count() < made["lines"].count() == 51


def test_short_and_blank_lines(spark):
    docs = [(1, "a\n\n \t\nb\na"), (2, "b \n\nc\n\t"), (2**62 + 5, "c\nd"), (2**63 - 1, "d\n" + "long " * 20), (-5, "long " * 20 + "x")]
    got = {r.doc_id: r.kept for r in L.drop_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: "a\n\n \t\nb", 2: "\nc\n\t", 2**62 + 5: "d", 2**63 - 1: "", -5: "long " * 20 + "x"}
    far = {r.doc_id: r.n_removed for r in L.drop_lines(spark.createDataFrame(docs, "doc_id long, text string"), least=200).collect()}
    assert far[2**63 - 1] == 1  # the long lines are no longer compared


def test_odd_rows(odd_docs, no_docs):
    rows = L.drop_lines(odd_docs, extra=("shard", "key")).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert got[1].n_removed == 0 and got[6].n_removed == 1 and got[6].kept == ""
    assert got[2].kept == "" and got[2].n_lines == 1 and got[4].kept == " \t\n " and got[4].n_lines == 2
    assert got[None].n_removed == 0 and got[5].shard == "y" and got[5].key == 5
    assert L.drop_lines(no_docs).count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    urls = ["http://EXAMPLE.com/en/1", "https://www.example.com/en/", "https://a.www.example.com/en/x?y#z", "http://example.com", "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "spam", None, "", "x://spam-farm.org/", "x://cheap-pills.org", "http://a.b/En/://", "http://example.com/e", "http://example.com/en/1"]
    rules = [U.place_rule(a, p) for a, p in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))]
    rules += [U.word_rule("block", "spam-farm"), U.word_rule("block", "cheap-pills")]
    df = spark.createDataFrame([(i, u, "t") for i, u in enumerate(urls)], "page_id long, url string, token string")
    return rules, {r.page_id: r for r in U.judge(df, rules).collect()}


def test_url_rules(judged, spark):
    _, got = judged
    say = {i: (r.rule, r.verdict) for i, r in got.items()}
    assert say == {
        0: ("example.com/en/", "block"), 1: ("www.example.com/en/", "allow"), 2: ("www.example.com/en/", "allow"), 3: (None, "allow"), 4: ("net/es/", "block"),
        5: ("net/fr/", "block"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: ("spam-farm", "block"),
        11: ("cheap-pills", "block"), 12: (None, "allow"), 13: ("com/", "allow"), 14: ("example.com/en/", "block"),
    }
    assert (got[0].host, got[0].path) == ("example.com", "/en/1") and (got[2].host, got[2].path) == ("a.www.example.com", "/en/x")
    assert (got[8].host, got[8].path) == ("", "") and (got[3].host, got[3].path) == ("example.com", "")


def test_rules_are_filed_by_their_rarest_token(judged, spark):
    rules, _ = judged
    urls = spark.createDataFrame([("example.com/en/",), ("example.com/fr/",), ("b.com/",)], "subject string")
    at = {r.rule: r.token for r in U.rule_index(urls, rules).collect()}
    assert at["example.com/en/"] == "en" and at["com/"] == "com" and at["www.example.com/en/"] == "www"
    with pytest.raises(ValueError):
        U.judge(urls.limit(0).withColumns({"page_id": F.lit(1), "url": F.lit("")}), [])
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


def test_patterns():
    import re

    fits = lambda rule, subject: bool(re.search(U.pattern_rule("block", rule).pattern.replace(r"\z", r"\Z"), subject))
    assert fits("casino-*", "m.casino-win.example.com/x") and fits("casino-*", "casino-win") and not fits("casino-*", "mycasino-win.com/") and not fits("casino-*", "x.com/casino-win")
    assert fits("*-bets.*", "free-bets.example.com/") and not fits("*-bets.*", "free-bets/")
    assert fits("Example.com/a*/b", "www.example.com/axx/y/b/c") and not fits("example.com/a*/b", "example.com/A/b") and fits("example.com", "example.com") and fits("example.com", "example.com/x") and not fits("example.com", "example.com.org/")
    assert fits("*/*.exe$", "a.b/c/d.exe") and not fits("*/*.exe$", "a.b/c/d.exe2") and not fits("*/*.exe$", "a.exe")
    assert U.pattern_rule("block", "*/wp-login.php").tokens == ("wp", "login") and U.pattern_rule("block", "*/*.exe$").tokens == ("exe",)
    assert U.pattern_rule("block", "ca*no.com/x*/yy/z").tokens == ("com", "yy") and U.pattern_rule("block", "*/--").tokens == ()


def test_thousands_of_rules(spark, monkeypatch):
    """All rules with wildcards on all URLs, one after another, against the index; with a broadcast index and without."""
    import re

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 3)))
    shapes = [lambda: f"{word()}.{word()}/", lambda: f"{word()}-*", lambda: f"*-{word()}.*/{word()}", lambda: f"*/{word()}*/{word()}$", lambda: f"{word()}.{word()}/{word()}/{word()}"]
    texts = sorted({rng.choice(shapes)() for _ in range(3000)})
    table = spark.createDataFrame([(rng.choice(["allow", "block"]), t, "pattern") for t in texts] + [("block", "*/--", "pattern"), ("allow", "aa", "word"), ("allow", "b.c/", "place")], "action string, pattern string, kind string")
    rules = U.rules_of(table)
    assert len(rules) > 1000 and any(not r.tokens for r in rules)
    urls = [f"http://{'.'.join(rng.choice([word(), word() + '-' + word()]) for _ in range(rng.randint(1, 3)))}/{'/'.join(word() for _ in range(rng.randint(0, 3)))}" for _ in range(150)] + ["http://x.y/--z"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    compiled = [(r, re.compile(r.pattern.replace(r"\z", r"\Z"))) for r in rules]
    want = {}
    for i, u in enumerate(urls):
        fit = [r for r, p in compiled if p.search(u[7:])]
        want[i] = min(fit, key=lambda r: (-r.tier, -len(r.name), r.name)) if fit else None
    for most in (U.BROADCAST_BYTES, 0):
        monkeypatch.setattr(U, "BROADCAST_BYTES", most)
        got = {r.page_id: (r.rule, r.verdict) for r in U.judge(df, rules).collect()}
        assert got == {i: (r.name, r.action) if r else (None, "allow") for i, r in want.items()}
    assert sum(r is not None for r in want.values()) > 30


def test_only_rules_without_tokens(spark):
    df = spark.createDataFrame([(1, "http://x.y/--z"), (2, "http://x.y/z"), (3, None), (None, "http://x.y/--")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in U.judge(df, [U.pattern_rule("block", "*/--")]).collect()} == {1: "block", 2: "allow", 3: "allow", None: "block"}
