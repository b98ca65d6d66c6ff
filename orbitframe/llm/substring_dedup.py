"""Exact substring dedup with fixed-block anchors.

Every text is cut into non-overlapping blocks of `block` words; with 2 * block - 1 <= `window`
every window of `window` words holds a whole block.  All rolling windows of `block` words probe the
index of those blocks: an anchor is a block that some text has in place and that starts in at
least two texts.  A repeat of `window` words or more thus has an anchor in each of its texts.  Each
anchor is stretched by a word at a time to either side, as far as a window still holds it, and the
stretched windows are compared by two independent 64-bit hashes of their words; a run of equal ones
that follow each other is a maximal repeat, whatever number of texts share it, and no pairs of texts
are made.  A word goes if it lies in a window that also starts in a text of a smaller doc_id.

Index, probes and replies travel as packed binary rows, dealt out by hash to shards that grow in
number with the text, so the memory of a task does not; a block that is in very many texts makes
many entries of one shard's arrays.

Defined results: a null text is empty; a text of fewer than `window` words loses nothing; rows that
share a doc_id are parts of one document and remove nothing from each other; a row without an id
loses nothing and removes nothing; an empty table gives an empty one; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise, release
from ._text import U, Words, batches, mix, tables

#: Words of text that a shard is sized for.
SHARD_WORDS = 3_000_000


def pack(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit values; width 16: whole pairs of them."""
    if width == 16:
        return np.ascontiguousarray(values).tobytes()
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(data, U).reshape(-1, 2)
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view(U)


def to_shards(ids: np.ndarray, text: np.ndarray, values: np.ndarray, shard: np.ndarray, width: int) -> Iterator[tuple]:
    """(shard, ids, counts, values) for each shard; text gives each value's place in ids, ascending."""
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cut):
        if len(part):
            own, counts = np.unique(text[part], return_counts=True)
            yield int(shard[part[0]]), np.diff(ids[own], prepend=0).tobytes(), counts.astype(np.uint32).tobytes(), pack(values[part], width)


def dealt(ids: np.ndarray, values: np.ndarray, parts: int) -> list[tuple]:
    """Rows for to_shards() that deal values out by a hash of the id they belong to."""
    order = np.argsort(ids, kind="stable")
    own, text = np.unique(ids[order], return_inverse=True)
    place = (mix(own.view(U)) % U(parts)).astype(np.int64)
    return list(to_shards(own, text, values[order], place[text], 8))


def by_shard(df: DataFrame, parts: int, answer: Callable, width: int, schema: str, turns: int = 1) -> DataFrame:
    """answer(values, ids) for all that one shard got, as Arrow batches.

    In several turns a shard's values are taken a part at a time, equal ones together: only their
    packed form is in memory as a whole.
    """

    def run(it):
        def done(rows):
            for turn in range(turns):
                ids, values = [], []
                for own, counts, data in rows:
                    v = unpack(data, width)
                    i = np.repeat(np.cumsum(np.frombuffer(own, np.int64)), np.frombuffer(counts, np.uint32))
                    if turns > 1:
                        mine = ((v if v.ndim == 1 else v[:, 0]) >> U(1)) % U(turns) == U(turn)
                        v, i = v[mine], i[mine]
                    values.append(v)
                    ids.append(i)
                values, ids = np.concatenate(values), np.concatenate(ids)
                if len(values):
                    yield answer(values, ids)

        now, rows = None, []
        for b in it:
            for s, *row in zip(*(b.column(k).to_pylist() for k in range(4))):
                if s != now and rows:
                    yield from done(rows)
                    rows = []
                now = s
                rows.append(row)
        if rows:
            yield from done(rows)

    return df.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def found_by_text(df: DataFrame, parts: int, pick: Callable, width: int) -> DataFrame:
    """doc_id and found, a row for each document of which pick(values, ids) takes values, distinct and ascending.

    The values taken go back packed, a row for each shard and place, and are put together by document there.
    """

    def give(values, ids):
        import pyarrow as pa

        out = list(given_back(ids, values))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["doc_id", "found"])

    taken = by_shard(df, parts, lambda values, ids: table_of(dealt(*pick(values, ids), parts)), width, SHARDED, turns=3)
    return by_shard(taken, parts, give, 8, FOUND)


def groups_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal values together, and where each group begins in it."""
    order = np.argsort(values, kind="stable")
    return order, np.flatnonzero(np.concatenate([[True], np.diff(values[order]) != 0]))


def given_back(ids: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    cut = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
    for a, b in zip(cut[:-1], cut[1:]):
        if b > a:
            yield int(ids[a]), np.unique(values[a:b]).tobytes()


def anchors(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values (lowest bit: the window is a block in place) of those that are blocks and in two texts."""
    block, values = (values & U(1)).astype(bool), values >> U(1)
    order, begin = groups_of(values)
    some = np.add.reduceat(block[order].astype(np.int64), begin) > 0
    some &= np.minimum.reduceat(ids[order], begin) < np.maximum.reduceat(ids[order], begin)
    keep = order[np.repeat(some, np.diff(np.concatenate([begin, [len(order)]])))]
    return ids[keep], values[keep]


def repeated(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and first halves of the pairs that a smaller id has too; both halves must be equal."""
    order, begin = groups_of(values[:, 0])
    size = np.diff(np.concatenate([begin, [len(order)]]))
    if (values[order, 1] != np.repeat(values[order[begin], 1], size)).any():  # unlike windows with one first half
        order = np.lexsort((values[:, 1], values[:, 0]))
        begin = np.flatnonzero(np.concatenate([[True], (np.diff(values[order], axis=0) != 0).any(1)]))
        size = np.diff(np.concatenate([begin, [len(order)]]))
    least = np.repeat(np.minimum.reduceat(ids[order], begin), size)
    keep = order[ids[order] > least]
    return ids[keep], values[keep, 0]


SHARDED = "shard int, ids binary, counts binary, data binary"
FOUND = "doc_id long, found binary"


def table_of(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(4)], ["shard", "ids", "counts", "data"])


def probes(docs: DataFrame, window: int, block: int, shards: int) -> DataFrame:
    """All rolling windows of `block` words; 47 bits of each and whether it is a block in place."""

    def run(it):
        for rows in batches(it, ["text", "doc_id"]):
            w = Words([r[0] for r in rows])
            at, h = w.windows(block)
            text = w.text[at]
            keep = np.diff(w.first)[text] >= window
            at, h, text = at[keep], h[keep], text[keep]
            v = (h >> U(16)) & ~U(1) | ((at - w.first[text]) % block == 0).astype(U)
            ids = np.array([r[1] for r in rows], dtype=np.int64)
            yield table_of(list(to_shards(ids, text, v, ((h & U(0xFFFFFFFF)) % U(shards)).astype(np.int64), 6)))

    return docs.select("text", "doc_id").mapInArrow(run, SHARDED)


def is_in(values: np.ndarray, text: np.ndarray, found: list, n: int) -> np.ndarray:
    """Whether each value is among those found for its text."""
    out = np.zeros(len(values), dtype=bool)
    cut = np.searchsorted(text, np.arange(n + 1))
    for t in range(n):
        if found[t] and cut[t + 1] > cut[t]:
            out[cut[t] : cut[t + 1]] = np.isin(values[cut[t] : cut[t + 1]], np.frombuffer(found[t], U))
    return out


def candidates(docs: DataFrame, window: int, block: int, shards: int) -> DataFrame:
    """An anchor stretched to either side: all windows of `window` words that hold it, as two hashes each.

    docs has text, doc_id and found.
    """

    def run(it):
        for rows in batches(it, ["text", "doc_id", "found"]):
            w = Words([r[0] for r in rows])
            at, h = w.windows(block)
            text = w.text[at]
            hit = at[is_in(h >> U(17), text, [r[2] for r in rows], len(rows))]
            near = np.zeros(len(w.hash) + window + 1, dtype=np.int64)
            np.add.at(near, np.maximum(hit - (window - block), 0), 1)
            np.add.at(near, hit + 1, -1)
            at, h = w.windows(window)
            keep = np.cumsum(near)[at] > 0
            _, other = w.windows(window, w.hashed(tables(False, False, True)[0]))
            at, both = at[keep], np.column_stack([h[keep], other[keep]])
            ids = np.array([r[1] for r in rows], dtype=np.int64)
            yield table_of(list(to_shards(ids, w.text[at], both, ((both[:, 0] >> U(32)) % U(shards)).astype(np.int64), 16)))

    return docs.select("text", "doc_id", "found").mapInArrow(run, SHARDED)


def removed_spans(w: Words, found: list, window: int) -> np.ndarray:
    """Whether each word lies in a window found."""
    at, h = w.windows(window)
    hit = at[is_in(h, w.text[at], found, len(found))]
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return np.cumsum(cover)[: len(w.hash)] > 0


def drop_repeats(docs: DataFrame, window: int = 50, block: int = 25, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (the maximal removed runs, as word offsets), one row for each row.

    with_text adds kept: the kept words, joined by one space.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block: 2 * block - 1 <= window")
    spark = docs.sparkSession
    docs = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, math.ceil(total / 6 / SHARD_WORDS))
    named = docs.filter("doc_id is not null")
    found = materialise(found_by_text(probes(named, window, block, shards), shards, anchors, 6), "anchors")
    # merge joins at every size: what would fit a broadcast depends on the corpus
    near = candidates(named.join(found.hint("merge"), "doc_id"), window, block, shards)
    again = materialise(found_by_text(near, shards, repeated, 16), "repeats")
    release(found)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", *["kept"] * with_text]

    def run(it):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
        for rows in batches(it, ["text", "doc_id", "found"]):
            w = Words([r[0] for r in rows]) if any(r[2] for r in rows) else None
            gone = removed_spans(w, [r[2] for r in rows], window) if w else None
            out = []
            for t, (text, i, hits) in enumerate(rows):
                words, spans, n = text.split(), [], 0
                kept = words
                if hits:
                    mask = gone[w.first[t] : w.first[t + 1]]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                    spans = edge.reshape(-1, 2).tolist()
                    kept = [x for x, m in zip(words, mask.tolist()) if not m]
                joined = b" ".join(kept)
                out.append((i, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), spans, joined))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k] if k < 5 else pa.binary()).cast(pa.string() if k == 5 else kinds[k]) for k in range(len(names))], names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<array<long>>" + ", kept string" * with_text
    return docs.join(again.hint("merge"), "doc_id", "left").select("text", "doc_id", "found").mapInArrow(run, schema)
