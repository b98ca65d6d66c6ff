"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding undoes disguises: compatibility forms, case, look-alike Greek and Cyrillic letters,
invisible characters, and digits or signs put for letters; ``l`` and ``1`` fold to ``i``.  Lexicon
entries are beginnings of words, or whole short words, with a weight, the log of how much more often labelled toxic texts
hold them than others.  A hit inside an exception phrase does not count.  A text's weights, as a
sum and by its length, give a probability through a logistic curve.

Entries, weights and curve are learned from labelled rows only: at most `sample_rows` of them, the
first by a hash of their id, without near copies.  All texts are scored whole, in one scan.

Defined results: a null or empty text has no hits and gets the curve's value there; repeated rows
are scored one by one; without labelled rows of both kinds the lexicon is empty and every score is
the share of toxic rows, or 0; labels that contradict each other all count; ids may be any 64-bit
numbers; a text is one task's, at about 5 bytes of memory a byte; an empty table gives an empty one;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import U, Words, batches, mix

#: Letters that look like Latin ones, then what is written for letters.
LOOKALIKES = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "τ": "t", "ι": "i", "κ": "k", "ε": "e", "υ": "u", "χ": "x", "ı": "i"}
WRITTEN = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i"}
UNSEEN = "­​‌‍⁠﻿"
FOLD = str.maketrans(LOOKALIKES | WRITTEN | dict.fromkeys(UNSEEN))
#: Phrases in which an entry is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy", "sore loser rule", "stupid simple", "class clown")
#: Lengths of the word beginnings that can become entries; a longer word is known by its first ten
#: letters, a shorter one only as a whole.
SIZES = range(4, 11)


@dataclass(frozen=True)
class Model:
    """Entries with their weights, exception phrases, and the curve: constant, sum's, share's and kinds' factors."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


def fold(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(FOLD)


def beginnings(text: str) -> set[str]:
    """What of a folded text could be entries."""
    words = set(re.findall(r"[^\W_]+", text))
    return {w[:k] for w in words for k in SIZES if len(w) >= k} | {w for w in words if 1 < len(w) < SIZES[0]}


def automaton(model: Model):
    import ahocorasick

    found = ahocorasick.Automaton()
    for e, weight in model.entries:
        found.add_word(e, (len(e), weight))
    for e in {fold(x) for x in model.exceptions}:
        found.add_word(e, (len(e), None))
    if len(found):
        found.make_automaton()
    return found


def features(text: str, found) -> tuple[float, float, float]:
    """log(1 + sum of weights), log(1 + sum for each hundred words), log(1 + kinds of entries) of a folded text."""
    if not len(found) or not text:
        return 0.0, 0.0, 0.0
    hits, spared = [], []
    for end, (size, weight) in found.iter(text):
        begin = end - size + 1
        if begin and text[begin - 1].isalnum():
            continue
        if weight is not None and size >= SIZES[0]:
            hits.append((begin, end, weight))
        elif end + 1 == len(text) or not text[end + 1].isalnum():  # phrases and short words are whole
            (spared if weight is None else hits).append((begin, end, weight))
    if spared:
        spared.sort(key=lambda x: x[0])
        begins, ends = [x[0] for x in spared], list(accumulate((x[1] for x in spared), max))
        inside = lambda h: (k := bisect_right(begins, h[0])) and ends[k - 1] >= h[1]
        hits = [h for h in hits if not inside(h)]
    total = sum(h[2] for h in hits)
    kinds = len({text[h[0] : h[1] + 1] for h in hits})
    return math.log1p(total), math.log1p(100 * total / max(1, len(text.split()))), math.log1p(kinds)


def value(curve: tuple[float, ...], x: tuple[float, ...]) -> float:
    z = curve[0] + sum(a * b for a, b in zip(curve[1:], x))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression by Newton's method; no feature may count for the other side."""
    used = [True] * x.shape[1]
    while True:
        a = np.column_stack([np.ones(len(x)), x[:, used]])
        b = np.zeros(a.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            h = (a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(len(b))
            step = np.linalg.solve(h, a.T @ (y - p) - 0.05 * b)
            b += step
            if np.abs(step).max() < 1e-8:
                break
        out = np.zeros(x.shape[1] + 1)
        out[[True, *used]] = b
        if (out[1:] >= 0).all():
            return tuple(float(v) for v in out)
        used = [u and v >= 0 for u, v in zip(used, out[1:])]


def choose(counts: list[tuple[str, int, int]], n_toxic: int, n_other: int) -> list[tuple[str, float]]:
    """Entries among (beginning, toxic texts, other texts): the strongest ones, none of which begins another."""
    rows = []
    for e, t, c in counts:
        weight = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_other + 1))
        rows.append((round(t / n_toxic - c / n_other, 9), len(e), e, weight))
    out: dict[str, float] = {}
    begun: set[str] = set()
    for _, size, e, weight in sorted(rows, reverse=True):
        if size < SIZES[0] or not (e in begun or any(e[:k] in out for k in range(SIZES[0], size + 1))):
            out[e] = weight
            begun |= {e[:k] for k in range(SIZES[0], size + 1)}
    return list(out.items())


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, least_texts: int = 8, least_weight: float = 1.6, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """A model from labels (doc_id, toxic) of rows of docs; at most sample_rows of them.

    Entries are all that least_texts toxic texts of the sample hold, or more, and that are so much
    likelier there than in others (least_weight, in log odds); fewer texts than that tell nothing sure.
    """
    spark = docs.sparkSession
    chosen = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")

    def marks(it):
        import pyarrow as pa

        for part in batches(it, ["text", "doc_id", "toxic"]):
            w = Words([r[0] for r in part], lower=True)
            at, h = w.windows(5)
            cut = np.searchsorted(w.text[at], np.arange(len(part) + 1))
            ids, cols = np.array([r[1] for r in part], dtype=np.int64).view(U), []
            for k in range(1, 4):
                x = mix(h ^ U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
                own = [int((x[a:b].min() if b > a else i).view(np.int64)) for a, b, i in zip(cut[:-1], cut[1:], mix(ids ^ U(k)))]
                cols.append(pa.array(own, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int32()), *cols], ["doc_id", "toxic", "m1", "m2", "m3"])

    # near copies of a text would make all its words look telling: one text for each minhash
    one = rows.select("text", "doc_id", "toxic").mapInArrow(marks, "doc_id long, toxic int, m1 long, m2 long, m3 long")
    for m in ("m1", "m2", "m3"):
        one = one.groupBy(m).agg(F.min(F.struct("doc_id", "toxic", *[x for x in ("m1", "m2", "m3") if x != m])).alias("s")).select(m, "s.*")
    picked = [(r[0], r[1]) for r in one.select("doc_id", "toxic").collect()]  # sample_rows at most
    n_toxic = sum(t == 1 for _, t in picked)
    n_other = len(picked) - n_toxic
    share = n_toxic / max(1, len(picked))
    base = math.log(max(share, 1e-9)) - math.log(max(1 - share, 1e-9))
    if not n_toxic or not n_other:
        return Model((), exceptions, (max(-30.0, min(30.0, base)), 0.0, 0.0, 0.0))
    picked_rows = F.broadcast(spark.createDataFrame(picked, "doc_id long, toxic int"))
    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("text is not null").join(picked_rows, "doc_id").select("text", "toxic")

    def count(it):
        import pyarrow as pa

        seen: dict[str, list[int]] = {}
        for part in batches(it, ["text", "toxic"]):
            for text, t in part:
                for e in beginnings(fold(text.decode())):
                    seen.setdefault(e, [0, 0])[0 if t == 1 else 1] += 1
            if len(seen) > 500_000:
                yield flush(seen, pa)
        yield flush(seen, pa)

    def flush(seen, pa):
        cols = [pa.array(list(seen), pa.string()), *(pa.array([v[k] for v in seen.values()], pa.int64()) for k in (0, 1))]
        seen.clear()
        return pa.RecordBatch.from_arrays(cols, ["entry", "t", "c"])

    odds = math.exp(least_weight) * (n_toxic + 1) / (n_other + 1)
    counts = rows.mapInArrow(count, "entry string, t long, c long").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    strong = counts.filter((F.col("t") >= least_texts) & (F.col("t") + 0.5 >= odds * (F.col("c") + 0.5)))
    # as many as the words of sample_rows texts at most
    chosen_entries = choose([tuple(r) for r in strong.collect()], n_toxic, n_other)
    model = Model(tuple(chosen_entries), exceptions, (base, 0.0, 0.0, 0.0))

    def look(it):
        import pyarrow as pa

        found = automaton(model)
        for part in batches(it, ["text", "toxic"]):
            x = [features(fold(r[0].decode()), found) for r in part]
            cols = [pa.array([r[1] for r in part], pa.int32()), *(pa.array([v[k] for v in x], pa.float64()) for k in range(3))]
            yield pa.RecordBatch.from_arrays(cols, ["toxic", "f1", "f2", "f3"])

    # sorted: sums in another order would change the last digits
    seen = sorted(tuple(r) for r in rows.mapInArrow(look, "toxic int, f1 double, f2 double, f3 double").collect())
    x, y = np.array([r[1:] for r in seen]), np.array([float(r[0] == 1) for r in seen])
    return Model(model.entries, exceptions, fit_curve(x, y))


def score(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 if the score is `least` or more) for each row of docs."""

    def run(it):
        import pyarrow as pa

        found = automaton(model)
        for part in batches(it, ["text", "doc_id"]):
            p = [value(model.curve, features(fold(r[0].decode()), found)) for r in part]
            cols = [pa.array([r[1] for r in part], pa.int64()), pa.array(p, pa.float64()), pa.array([int(v >= least) for v in p], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "score", "predicted"])

    return docs.select("text", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, score double, predicted int")
