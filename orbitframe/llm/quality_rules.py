"""Quality rules by weak supervision.

Eleven rules look at a text and vote good (1), bad (-1) or abstain (0).  Expectation-maximisation
over the counts of vote patterns estimates how each rule votes on good and on bad texts and how
common good texts are; a text's quality is the posterior probability of good given its votes.  A
text is kept if the fixed base rules pass and that probability is 0.5 or more.

There are 3**11 vote patterns at most, whatever the input's size: that table is what the driver
collects and what is broadcast.  Votes come from every whole text, in one scan.

Defined results: a null or empty text, and one of white space, has no words and fails the base
rules; repeated rows are judged one by one, and each counts; an empty table gives an empty one;
rows with a null id are judged like others; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise
from ._text import Words, batches

SYMBOLS = b"#*$%&|<>"
RULES = ("symbols", "capitals", "repeats", "lines", "word_size", "sentences", "length", "shouting", "variety", "letters", "marked")
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: A rule's probabilities stay off 0 and 1 by as much as this many texts would move them.
SMOOTHING = 1.0


def per_text(marks: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of marks between successive edges."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts for each text; those of COLUMNS are exact by their definitions."""
    w = Words(texts)
    spread, buf = w.text_start.copy(), w.buf
    spread[-1] = len(buf)
    inside = np.ones(256, dtype=bool)
    inside[[9, 10, 11, 12, 13, 32]] = False
    symbol, upper, letter = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
    symbol[list(SYMBOLS)], upper[65:91], letter[65:91], letter[97:123] = True, True, True, True
    known = letter.copy()
    known[48:58], known[0xC0:] = True, True  # digits, and the first byte of each character beyond ASCII
    n = np.diff(w.first)
    at, h = w.windows(5)
    _, inverse, count = np.unique(h ^ (w.text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    twice = at[count[inverse] > 1]
    cover = np.zeros(len(w.hash) + 6, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 5, -1)
    last = buf[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    _, distinct = np.unique(w.hash ^ (w.text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return {
        "n_words": n,
        "word_chars": per_text(inside[buf] & ((buf & 0xC0) != 0x80), spread),
        "n_symbols": per_text(symbol[buf], spread),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
        "n_repeat_words": per_text(np.cumsum(cover)[: len(w.hash)] > 0, w.first),
        "n_lines": np.array([len(x) for x in lines], dtype=np.int64),
        "n_upper": per_text(upper[buf], spread),
        "n_letters": per_text(letter[buf], spread),
        "n_ends": per_text(np.isin(last, list(b".!?")), w.first),
        "n_shouts": per_text((last == ord("!")) | (last == ord("?")), w.first),
        "n_alnum": per_text(known[buf], spread),
        "n_marked": per_text(symbol[last], w.first),
        "n_distinct": np.bincount(w.text[distinct], minlength=len(texts)),
    }


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """A row of votes for each text, in the order of RULES."""
    n = np.maximum(m["n_words"], 1)

    def vote(good, bad):
        return np.where(bad, -1, np.where(good, 1, 0))

    symbols, caps = m["n_symbols"] / n, m["n_upper"] / np.maximum(m["n_letters"], 1)
    repeats, lines = m["n_repeat_words"] / n, m["n_dup_lines"] / np.maximum(m["n_lines"], 1)
    size, ends, shouts = m["word_chars"] / n, m["n_ends"] / n, m["n_shouts"] / n
    variety = m["n_distinct"] / np.sqrt(n)
    return np.stack([
        vote(symbols < 0.02, symbols > 0.15),
        vote(caps < 0.15, caps > 0.4),
        vote(repeats < 0.05, repeats > 0.2),
        vote((lines == 0) & (m["n_lines"] > 1), lines > 0.3),
        vote((size > 3) & (size < 9), (size > 11) | (size < 2)),
        vote((ends > 0.03) & (ends < 0.3), (ends < 0.01) | (ends > 0.6)),
        vote(m["n_words"] >= 40, m["n_words"] < 10),
        vote(shouts < 0.02, shouts > 0.2),
        vote(variety > 4, variety < 2),
        vote(m["n_alnum"] > 0.94 * m["word_chars"], m["n_alnum"] < 0.9 * m["word_chars"]),
        vote(m["n_marked"] < 0.02 * n, m["n_marked"] > 0.15 * n),
    ], axis=1)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, and the votes as one number in base 3."""

    def run(it):
        import pyarrow as pa

        for rows in batches(it, ["text", "doc_id"]):
            m = measure([r[0] for r in rows])
            cols = [pa.array([r[1] for r in rows], pa.int64())]
            cols += [pa.array(m[c.split()[0]].astype(np.int64)) for c in COLUMNS.split(", ")] + [pa.array(code_of(m).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", *(c.split()[0] for c in COLUMNS.split(", ")), "code"])

    return docs.select("text", F.col("doc_id").cast("long")).mapInArrow(run, f"doc_id long, {COLUMNS}, code int")


def fit(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The probability of good for each vote pattern, by expectation-maximisation over their counts."""
    v = codes[:, None] // 3 ** np.arange(len(RULES)) % 3  # 0 bad, 1 abstain, 2 good
    start = (v == 2).sum(1) - 3.0 * (v == 0).sum(1)
    p = 1 / (1 + np.exp(-np.clip(start, -8, 8)))
    kinds = np.stack([v == k for k in range(3)], axis=2).astype(float)  # pattern, rule, vote
    for _ in range(rounds):
        likelihood = []
        share = np.array([(counts * (1 - p)).sum(), (counts * p).sum()]) + SMOOTHING
        for weight in (counts * (1 - p), counts * p):
            seen = np.einsum("i,ijk->jk", weight, kinds) + SMOOTHING
            likelihood.append(np.log(seen / seen.sum(1, keepdims=True)))
        # a rule that would count against its own vote says nothing instead
        gain = likelihood[1] - likelihood[0]
        gain[:, 2], gain[:, 0], gain[:, 1] = np.maximum(gain[:, 2], 0), np.minimum(gain[:, 0], 0), 0
        score = np.log(share[1] / share[0]) + np.einsum("jk,ijk->i", gain, kinds)
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p


def code_of(m: dict[str, np.ndarray]) -> np.ndarray:
    """The votes of each text as one number in base 3."""
    return (votes(m) + 1) @ (3 ** np.arange(len(RULES)))


def posteriors(rows: DataFrame) -> dict[int, float]:
    """The probability of good for each vote pattern in rows (code)."""
    found = rows.groupBy("code").count().orderBy("code").collect()  # 3**11 rows at most
    codes, counts = np.array([r[0] for r in found], dtype=np.int64), np.array([r[1] for r in found], dtype=float)
    return dict(zip(codes.tolist(), fit(codes, counts).tolist())) if len(codes) else {}


def keep_good(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that judge() would keep, all columns as they are; two scans and no shuffle of texts."""
    table = posteriors(scan(docs))
    place = docs.columns.index("text")

    def run(it):
        import pyarrow as pa

        for b in it:
            mask: list[bool] = []
            for rows in batches([b], [b.schema.names[place]]):
                m = measure([r[0] for r in rows])
                failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
                good = np.array([table.get(c, 0.0) >= least for c in code_of(m).tolist()], dtype=bool)
                mask += (~failed & good).tolist()
            yield b.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, quality (the posterior) and kept, one row for each row of docs."""
    rows = materialise(scan(docs), "quality")
    table = docs.sparkSession.createDataFrame(list(posteriors(rows).items()), "code int, quality double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.join(F.broadcast(table), "code").withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)).drop("code")
