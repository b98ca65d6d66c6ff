"""Benchmark decontamination: a BM25 inverted index of the test items with block-max pruning.

Items are split into segments of `SEGMENT` words at most.  A term's impact on a segment is its
BM25 weight as a share of the segment's score against itself, so that 1 is all of it.  Every
passage of every text is a query: passages are twice a segment's length and overlap by half, so
that each stretch as long as a segment lies in one.  Segments are kept in blocks of `BLOCK`, and
each term knows its largest impact in each block.  A passage looks at a block only if these bounds,
with the total of the block's low-impact terms in place of those terms, can reach the threshold
(the pruning rule of block-max WAND, applied to whole batches of passages with arrays); then the
block's segments are scored in full.  All segments at the threshold or above are retrieved.

A retrieved item is verified on five-word shingles: the share of the shingles of its question and
of its answer (what follows the last question mark, line feed or sentence end that leaves both
parts five words, else the last third) that the text holds.  The item is in the text if both shares,
or that of the whole item, are `overlap` or more.

The items go to executors in shards of about `SHARD_BYTES`, one scan of the texts for each, one
after another; how common a term is and how long segments are is counted over all items first, so
the number of shards changes no score.

Words are runs of letters and digits, lower-cased.  Defined results: a null or empty text holds
nothing; an item of fewer than five words is one shingle, and one without words, or a null one, is
never found; repeated rows are judged one by one; an empty table of texts gives an empty one, and
without items nothing is contaminated; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialise
from ._text import U, Words, batches

SEGMENT = 128
BLOCK = 8
K1, B = 1.2, 0.75
SHARD_BYTES = 16 << 20
#: A segment's terms of least impact, up to this share of its score, are only bounded at first.
BOUNDED = 0.25


def plain(text: bytes) -> bytes:
    """Lower case beyond ASCII; ASCII letters are folded when they are hashed."""
    return text if text.isascii() else text.decode(errors="replace").lower().encode()


def hashes(texts: list[bytes]) -> Words:
    return Words([plain(t) for t in texts], lower=True, letters=True)


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct hashes of five words in a row; of all words if they are fewer."""
    if len(words) == 0:
        return np.zeros(0, dtype=U)
    k = min(5, len(words))
    fake = Words.__new__(Words)
    fake.hash, fake.text = words, np.zeros(len(words), dtype=np.int64)
    return np.unique(fake.windows(k)[1])


def halves(text: str) -> tuple[str, str]:
    """Question and answer."""
    places = [m.end() for m in re.finditer(r"\?|\n|[.!](?=\s)", text)]
    enough = lambda x: len(re.findall(r"[^\W_]+", x)) >= 5
    for mark in (r"?", "\n", ""):
        for p in reversed([x for x in places if not mark or text[x - 1] == mark]):
            if enough(text[:p]) and enough(text[p:]):
                return text[:p], text[p:]
    words = list(re.finditer(r"\S+", text))
    if len(words) < 3:
        return text, text
    p = words[len(words) * 2 // 3].start()
    return text[:p], text[p:]


@dataclass
class Index:
    items: list[int]  # by place
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # shingles of question, answer and whole, by place
    whole: list[int]  # how many words of a shingle, by place
    owner: np.ndarray  # place of each segment
    length: int  # words of the longest segment of all
    vocabulary: np.ndarray  # term hashes, sorted
    seg_terms: list[np.ndarray]  # terms of each segment
    seg_impact: list[np.ndarray]
    post_at: np.ndarray  # for each term, where its blocks begin in post_block
    post_block: np.ndarray
    post_max: np.ndarray
    rest: np.ndarray  # by block: the largest total of low-impact terms


@dataclass
class Counts:
    """Over all items: how many segments there are, their mean and greatest length, and terms with the segments that hold each."""

    segments: int
    mean: float
    longest: int
    terms: np.ndarray  # hashes, ascending
    df: np.ndarray


def segments_of(words: np.ndarray) -> list[np.ndarray]:
    """An item's words in stretches of SEGMENT at most."""
    return np.array_split(words, math.ceil(len(words) / SEGMENT)) if len(words) else []


def counts_of(rows: list[tuple[int, str]]) -> Counts:
    parts = [s for _, text in rows for s in segments_of(hashes([text.encode()]).hash)]
    terms, df = np.unique(np.concatenate([np.unique(s) for s in parts] or [np.zeros(0, U)]), return_counts=True)
    return Counts(len(parts), sum(map(len, parts)) / max(1, len(parts)), max(map(len, parts), default=0), terms, df)


def build(rows: list[tuple[int, str]], counts: Counts | None = None) -> Index | None:
    """The index of (item_id, text); None if no item has a word.  counts: those of all items, if these aren't all."""
    counts = counts or counts_of(rows)
    items, parts, whole, owner, segments = [], [], [], [], []
    for i, text in sorted(rows):
        q, a = halves(text)
        both = hashes([text.encode(), q.encode(), a.encode()])
        w = [both.hash[x:y] for x, y in zip(both.first[:-1], both.first[1:])]
        if not len(w[0]):
            continue
        items.append(i)
        whole.append(min(5, len(w[0])))
        parts.append((shingles(w[1]), shingles(w[2]), shingles(w[0])))
        for s in segments_of(w[0]):
            owner.append(len(items) - 1)
            segments.append(s)
    if not items:
        return None
    vocabulary, flat = np.unique(np.concatenate(segments), return_inverse=True)
    cut = np.cumsum([len(s) for s in segments])[:-1]
    counted = [np.unique(x, return_counts=True) for x in np.split(flat, cut)]
    df = counts.df[np.searchsorted(counts.terms, vocabulary)]
    idf = np.log(1 + (counts.segments - df + 0.5) / (df + 0.5))
    terms, impacts, rest = [], [], np.zeros(math.ceil(len(segments) / BLOCK))
    best: list[dict[int, float]] = [{} for _ in vocabulary]
    for k, ((t, tf), s) in enumerate(zip(counted, segments)):
        x = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(s) / counts.mean))
        x /= x.sum()
        order = np.argsort(x, kind="stable")
        low = order[np.cumsum(x[order]) <= BOUNDED]
        rest[k // BLOCK] = max(rest[k // BLOCK], x[low].sum())
        terms.append(t)
        impacts.append(x)
        for j in np.setdiff1d(np.arange(len(t)), low):
            d = best[t[j]]
            d[k // BLOCK] = max(d.get(k // BLOCK, 0.0), float(x[j]))
    sizes = np.array([len(d) for d in best])
    return Index(
        items, parts, whole, np.array(owner), counts.longest, vocabulary, terms, impacts,
        np.concatenate([[0], np.cumsum(sizes)]), np.array([b for d in best for b in sorted(d)], dtype=np.int64),
        np.array([d[b] for d in best for b in sorted(d)]), rest,
    )


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each range, one after another."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - (total - size), size)


def retrieve(index: Index, w: Words, threshold: float) -> list[tuple[int, int]]:
    """Pairs (text, item's place) of which a passage scores threshold or more against a segment."""
    quick = index_bits(index)
    near = np.flatnonzero(quick[w.hash >> U(44)])
    at = np.minimum(np.searchsorted(index.vocabulary, w.hash[near]), len(index.vocabulary) - 1)
    sure = index.vocabulary[at] == w.hash[near]
    near, term = near[sure], at[sure]
    if not len(near):
        return []
    step, n_terms = index.length, len(index.vocabulary)
    n = np.diff(w.first)
    base = np.concatenate([[0], np.cumsum(n // step + 2)])  # each text's passages, and one unused
    text = w.text[near]
    half = base[text] + 1 + (near - w.first[text]) // step
    key = np.unique(half * n_terms + term)
    key = np.unique(np.concatenate([key, key - n_terms]))  # a half belongs to its own passage and the one before
    passage, term = key // n_terms, key % n_terms
    size = index.post_at[term + 1] - index.post_at[term]
    place = ragged(index.post_at[term], size)
    n_blocks = len(index.rest)
    pair, back = np.unique(np.repeat(passage, size) * n_blocks + index.post_block[place], return_inverse=True)
    bound = np.bincount(back, weights=index.post_max[place], minlength=len(pair))
    pair = pair[bound + index.rest[pair % n_blocks] >= threshold - 1e-9]
    out = set()
    for p in pair.tolist():
        x, block = divmod(p, n_blocks)
        lo, hi = np.searchsorted(key, [x * n_terms, (x + 1) * n_terms])
        here = key[lo:hi] - x * n_terms
        for s in range(block * BLOCK, min((block + 1) * BLOCK, len(index.owner))):
            if index.seg_impact[s][np.isin(index.seg_terms[s], here, assume_unique=True)].sum() >= threshold - 1e-9:
                out.add((int(np.searchsorted(base, x, side="right")) - 1, int(index.owner[s])))
    return sorted(out)


def index_bits(index: Index) -> np.ndarray:
    bits = np.zeros(1 << 20, dtype=bool)
    bits[index.vocabulary >> U(44)] = True
    return bits


def shares(index: Index, place: int, words: np.ndarray, made: dict) -> tuple[float, float, float]:
    """The shares of question, answer and whole item that the text's shingles hold."""
    out = []
    for part in index.parts[place]:
        hit = np.zeros(len(part), dtype=bool)
        for k in range(1, 6):  # a short part's single shingle has fewer words
            if k not in made and (k == 5 or len(part) == 1):
                fake = Words.__new__(Words)
                fake.hash, fake.text = words, np.zeros(len(words), dtype=np.int64)
                made[k] = np.unique(fake.windows(k)[1])
            if k in made:
                hit |= np.isin(part, made[k])
        out.append(float(hit.mean()) if len(part) else 1.0)
    return tuple(out)


def find(index: Index | None, texts: list[bytes], threshold: float, overlap: float) -> list[tuple[int, list[int], float]]:
    """For each text: items retrieved, item ids verified, and the largest share of a whole item."""
    kept: list[list] = [[0, [], 0.0] for _ in texts]
    if index is None:
        return [tuple(x) for x in kept]
    w = hashes(texts)
    made: dict[int, dict] = {}
    for t, place in retrieve(index, w, threshold):
        q, a, both = shares(index, place, w.hash[w.first[t] : w.first[t + 1]], made.setdefault(t, {}))
        kept[t][0] += 1
        kept[t][2] = max(kept[t][2], both)
        if both >= overlap or (q >= overlap and a >= overlap):
            kept[t][1].append(index.items[place])
    return [tuple(x) for x in kept]


def counted(items: DataFrame, shard: Column) -> tuple[DataFrame, int, float, int]:
    """shard, term and df (segments of all items that hold the term); how many segments there are, their mean and greatest length."""

    def run(it):
        import pyarrow as pa

        for rows in batches(it, ["text", "shard"]):
            for text, own in rows:
                for s in segments_of(hashes([text]).hash):
                    terms = np.unique(s).view(np.int64)
                    k = len(terms)
                    cols = [pa.array(np.full(k, own), pa.int32()), pa.array(terms), pa.array(np.arange(k) == 0), pa.array(np.full(k, len(s)), pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, ["shard", "term", "first", "words"])

    terms = materialise(items.select("text", shard.alias("shard")).mapInArrow(run, "shard int, term long, first boolean, words long"), "terms")
    total = terms.filter("first").agg(F.count("*"), F.sum("words"), F.max("words")).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    return terms.select("shard", "term").distinct().join(df, "term"), total[0], (total[1] or 0) / max(1, total[0]), total[2] or 0


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.8, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, contaminated, n_retrieved, items (found, ascending) and overlap for each row of docs; and its columns `extra`."""
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / SHARD_BYTES))
    spark, shard = docs.sparkSession, F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")
    terms, n_segments, mean, longest = counted(items, shard)

    def index_of(k: int):
        """The broadcast index of a shard, whose size SHARD_BYTES bounds."""
        rows = [tuple(r) for r in items.filter(shard == k).collect()]
        own = terms.filter(F.col("shard") == k).select("term", "df").toArrow()
        at = own.column(0).to_numpy().view(U)
        order = np.argsort(at)
        return spark.sparkContext.broadcast(build(rows, Counts(n_segments, mean, longest, at[order], own.column(1).to_numpy()[order])))

    def judged(rows: DataFrame, columns: list[str], sent, hits_only: bool) -> DataFrame:
        """The columns and __n, __items, __best for each of rows, or only for those that have something."""
        fields = {f.name: f for f in rows.schema.fields}
        keep = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in columns)
        place = rows.columns.index("text")

        def run(it):
            import pyarrow as pa

            for b in it:
                found, index = [], sent.value
                for part in batches([b], [b.schema.names[place]]):
                    found += find(index, [r[0] for r in part], threshold, overlap)
                cols = [pa.array([v[k] for v in found], kind) for k, kind in enumerate((pa.int64(), pa.list_(pa.int64()), pa.float64()))]
                out = pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in columns] + cols, [*columns, "__n", "__items", "__best"])
                yield out.filter(pa.array([v[0] > 0 for v in found], pa.bool_())) if hits_only else out

        return rows.mapInArrow(run, f"{keep}, __n long, __items array<long>, __best double")

    columns = [c for c in dict.fromkeys(("doc_id", *extra))]
    if n == 1:
        out = judged(docs.select(*dict.fromkeys(("text", *columns))), columns, index_of(0), False)
    else:
        # equal texts have equal results: what is found goes by a hash of the text
        marks = {"__h1": F.xxhash64("text"), "__h2": F.xxhash64(F.lit(1), "text")}
        texts, hits = docs.filter("text is not null").select("text").withColumns(marks), None
        for k in range(n):
            sent = index_of(k)
            own = materialise(judged(texts, list(marks), sent, True).distinct(), "leaks")
            sent.destroy()
            hits = own if hits is None else hits.unionByName(own)
        hits = hits.groupBy(*marks).agg(F.sum("__n").alias("__n"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("__items")))).alias("__items"), F.max("__best").alias("__best"))
        out = docs.select(*dict.fromkeys(("text", *columns))).withColumns(marks).join(hits.hint("merge"), list(marks), "left")
        out = out.withColumns({"__n": F.coalesce("__n", F.lit(0)), "__items": F.coalesce("__items", F.array().cast("array<long>")), "__best": F.coalesce("__best", F.lit(0.0))})
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.size("__items") > 0).alias("contaminated"), F.col("__n").cast("long").alias("n_retrieved"),
        F.sort_array(F.array_distinct("__items")).alias("items"), F.col("__best").alias("overlap"), *[c for c in extra if c != "doc_id"],
    )
