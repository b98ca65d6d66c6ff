"""Lexical retrieval packing.

A window begins with a seed, an unused document (or what is left of the one cut last); the unused
documents, ranked by BM25 with the seed's terms as the query, fill the window greedily in that order.
The one that doesn't fit is cut, and its rest begins the next window, so windows are full.  A shard's
last window is cut into windows whose sizes are powers of two, which need no padding.

The inverted index lies in shards of alike documents, and a seed asks its own shard.  What a shard
holds is settled by the documents' terms: a tree of two-means cuts over vectors of weighted terms,
fitted on SAMPLE documents at most, sorts documents into leaves; within a leaf they are ordered by a
minhash of their runs of tokens, so that near copies lie together, and then by a hash.  That order
is cut into shards of about SHARD_TOKENS tokens or SHARD_DOCS documents, at places found in a sample
that grows with the input.  Copies of one text, however many, are cut into shards like all else.
Terms' document frequencies and the mean length are those of the whole corpus.  The work grows in
proportion to the corpus; what a seed's shard lacks of its best neighbours in the whole corpus is
measured in README.

A document is its token ids and then the end id.  Defined results: a null or empty text is the end
id alone; repeated rows are packed one by one; rows with a null id are packed like others; equal
scores go by the order in the shard; a document longer than a shard is a shard of its own, one
task's; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise
from ._text import U, batches, low, mix
from .tokens import encoder

K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SHARD_TOKENS, SHARD_DOCS = 2_000_000, 8192
#: Documents that the tree is fitted on, its greatest depth, and the length of vectors.
SAMPLE, DEPTH, WIDTH = 4096, 10, 4096
#: Parts that shards are dealt to at most, and sampled documents for each.
PARTS, CUT_SAMPLE = 20_000, 64
#: Tokens of the runs that the minhash is taken of.
RUN = 4


class Bm25:
    """An inverted index over documents given as arrays of token ids.

    Terms that an eighth of the documents hold have a row of all documents' weights instead of
    postings: adding rows takes less than scattering as many postings.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray | None = None, mean: float | None = None):
        """idf (by token id) and mean (length) are those of these documents unless given."""
        n = self.n = len(docs)
        sizes = np.array([len(d) for d in docs])
        kind = np.uint32 if (int(max(map(np.max, docs))) + 1) * n < 1 << 32 else np.uint64
        key, tf = np.unique(np.concatenate(docs).astype(kind) * kind(n) + np.repeat(np.arange(n, dtype=kind), sizes), return_counts=True)
        term, self.doc = key // kind(n), (key % kind(n)).astype(np.int32)
        names, begin, df = np.unique(term, return_index=True, return_counts=True)
        self.begin = np.concatenate([begin, [len(key)]])
        own = weights_of(n, df) if idf is None else idf[names]
        norm = K1 * (1 - B + B * sizes / max(1.0, sizes.mean() if mean is None else mean))
        self.weight = np.repeat(own, df) * tf * (K1 + 1) / (tf + norm[self.doc])
        self.useful = own > 0
        wide = np.flatnonzero(self.useful & (df * 8 >= n))
        self.row = np.full(len(df), -1)
        self.row[wide] = np.arange(len(wide))
        self.rows = np.zeros((len(wide), n), dtype=np.float32)
        for r, t in enumerate(wide):
            at = slice(self.begin[t], self.begin[t + 1])
            self.rows[r, self.doc[at]] = self.weight[at]
        order = np.argsort(self.doc, kind="stable")
        self.own_terms = np.repeat(np.arange(len(df)), df)[order]
        self.own_begin = np.searchsorted(self.doc[order], np.arange(n + 1))

    def scores(self, d: int) -> np.ndarray:
        """All documents' scores with the terms of document d as the query."""
        own = self.own_terms[self.own_begin[d] : self.own_begin[d + 1]]
        own = own[self.useful[own]]
        row = self.row[own]
        asked = np.zeros(len(self.rows), dtype=np.float32)
        asked[row[row >= 0]] = 1
        out = (asked @ self.rows).astype(np.float64)
        rare = own[row < 0]
        size = self.begin[rare + 1] - self.begin[rare]
        total = np.cumsum(size)
        if len(rare):
            place = np.arange(total[-1]) + np.repeat(self.begin[rare] - (total - size), size)
            out += np.bincount(self.doc[place], weights=self.weight[place], minlength=self.n)
        return out


def weights_of(n: int, df: np.ndarray) -> np.ndarray:
    """Terms' weights from the number of documents that hold them; those of half the documents say nothing."""
    return np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))


def ranking(score: np.ndarray, used: np.ndarray) -> Iterator[int]:
    """Unused documents, best first, equal ones by their place; the first few are sorted out on their own."""
    left = np.flatnonzero(~used)
    own = score[left]
    if len(left) > 256:
        least = np.partition(own, len(own) - 64)[len(own) - 64]
        head = left[own >= least]
        yield from head[np.argsort(-score[head], kind="stable")].tolist()
        left = left[own < least]
        own = score[left]
    yield from left[np.argsort(-own, kind="stable")].tolist()


def pack(docs: list[np.ndarray], size: int, idf: np.ndarray | None = None, mean: float | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); all are full but the last ones, which are powers of two."""
    if not docs:
        return []
    index = Bm25(docs, idf, mean)
    used = np.zeros(len(docs), dtype=bool)
    windows, now, room = [], [], size
    next_seed, ranked = 0, None

    def unused():
        nonlocal next_seed
        while next_seed < len(docs) and used[next_seed]:
            next_seed += 1
        return next_seed if next_seed < len(docs) else None

    while True:
        if room == size:
            d, ranked = unused(), None
        else:
            if ranked is None:  # the window has a seed and no ranking yet
                ranked = ranking(index.scores(now[0][0]), used)
            d = next((x for x in ranked if not used[x]), None)
        if d is None:
            break
        used[d], start = True, 0
        while start < len(docs[d]):  # what doesn't fit begins further windows
            n = min(room, len(docs[d]) - start)
            now.append((d, start, n))
            room -= n
            start += n
            if room == 0:
                windows.append(now)
                now, room, ranked = [], size, None
    if now:
        windows += in_powers(now)
    return windows


def in_powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces of a window, cut into windows whose sizes are falling powers of two."""
    out, pieces = [], list(window)
    left = sum(p[2] for p in pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        own = []
        while room:
            d, start, n = pieces.pop(0)
            take = min(room, n)
            own.append((d, start, take))
            room -= take
            if take < n:
                pieces.insert(0, (d, start + take, n - take))
        out.append(own)
    return out


# --- the order of documents -----------------------------------------------------------------------


def ids_of(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if width == 2 else np.uint32)


def vectors(docs: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of the documents' terms: document, place and value of what isn't 0."""
    doc, term = distinct(docs, len(idf))
    value = idf[term]
    doc, term, value = (x[value > 0] for x in (doc, term, value))  # terms of half the documents say nothing
    norm = np.sqrt(np.bincount(doc, weights=value**2, minlength=len(docs)))
    return doc, (term.astype(U) * U(0x9E3779B97F4A7C15) >> U(64 - WIDTH.bit_length() + 1)).astype(np.int64), value / np.maximum(norm, 1e-9)[doc]


def distinct(docs: list[np.ndarray], terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct terms, of ids below `terms`: document and term of each, in order."""
    kind = np.uint32 if terms * len(docs) < 1 << 32 else np.uint64
    sizes = np.array([len(d) for d in docs])
    key = np.sort(np.concatenate(docs).astype(kind) + np.repeat(np.arange(len(docs), dtype=kind) * kind(terms), sizes))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return (key // kind(terms)).astype(np.int64), (key % kind(terms)).astype(np.int64)


def portions(docs: list[np.ndarray], most: int = 1 << 19) -> Iterator[slice]:
    """Stretches of documents of about so many tokens, and one document at least."""
    first, held = 0, 0
    for k, d in enumerate(docs):
        if held and held + len(d) > most:
            yield slice(first, k)
            first, held = k, 0
        held += len(d)
    if first < len(docs):
        yield slice(first, len(docs))


class Rows:
    """Rows of WIDTH columns without their zeros; steps over them take about BLOCK entries at a time."""

    BLOCK = 1 << 18

    def __init__(self, size: np.ndarray, place: np.ndarray, value: np.ndarray):
        """size: of each row, how many entries it has; place and value: the entries of all rows, one row after another."""
        self.size, self.place, self.value = size, place, value
        self.begin = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)

    @classmethod
    def of(cls, x: np.ndarray) -> Rows:
        """The rows of an array."""
        row, place = np.nonzero(x)
        return cls(np.bincount(row, minlength=len(x)), place.astype(np.uint16), x[row, place])

    def __len__(self) -> int:
        return len(self.size)

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Stretches of rows, and of their entries the row (from the stretch's first), place and value."""
        first = 0
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(self.begin, self.begin[first] + self.BLOCK, side="right")) - 1)
            at = slice(self.begin[first], self.begin[last])
            yield slice(first, last), np.repeat(np.arange(last - first), self.size[first:last]), self.place[at], self.value[at].astype(np.float32)
            first = last

    def dot(self, v: np.ndarray) -> np.ndarray:
        """Each row's product with a vector."""
        out = np.zeros(len(self), dtype=np.float32)
        for rows, row, place, value in self.blocks():
            out[rows] = np.bincount(row, weights=value * v[place], minlength=rows.stop - rows.start)
        return out

    def mean(self, chosen: np.ndarray) -> np.ndarray:
        """The mean of the chosen rows (true in a mask)."""
        out = np.zeros(WIDTH)
        for rows, row, place, value in self.blocks():
            out += np.bincount(place, weights=value * chosen[rows][row], minlength=WIDTH)
        return (out / np.count_nonzero(chosen)).astype(np.float32)

    def row(self, i: int) -> np.ndarray:
        out, at = np.zeros(WIDTH, dtype=np.float32), slice(self.begin[i], self.begin[i + 1])
        out[self.place[at]] = self.value[at]
        return out

    def only(self, chosen: np.ndarray) -> Rows:
        kept = np.repeat(chosen, self.size)
        return Rows(self.size[chosen], self.place[kept], self.value[kept])


@dataclass
class Tree:
    """Cuts of a full binary tree, from the top: a document goes right where way @ vector is cut or more."""

    depth: int
    way: np.ndarray
    cut: np.ndarray

    @classmethod
    def fit(cls, x: Rows | np.ndarray, depth: int) -> Tree:
        """Each node cuts its documents (rows of x) in half along the line between two means of them."""
        way, cut = np.zeros((max(1, (1 << depth) - 1), WIDTH), dtype=np.float32), np.zeros(max(1, (1 << depth) - 1), dtype=np.float32)
        held = deque([x if isinstance(x, Rows) else Rows.of(x)])
        for node in range((1 << depth) - 1):
            own = held.popleft()
            if len(own) > 1:
                far = int(np.argmin(own.dot(own.mean(np.ones(len(own), dtype=bool)))))  # the one least like the others, and the one least like it
                one, two = own.row(far), own.row(int(np.argmin(own.dot(own.row(far)))))
                for _ in range(4):
                    right = own.dot(two - one) > 0
                    if right.all() or not right.any():
                        break
                    one, two = own.mean(~right), own.mean(right)
                way[node] = two - one
            side = own.dot(way[node])
            cut[node] = np.median(side) if len(own) else 0
            held += [own.only(side < cut[node]), own.only(side >= cut[node])]
        return cls(depth, way, cut)

    def leaves(self, doc: np.ndarray, place: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """The number of the leaf of each of n documents given by their vectors."""
        node = np.zeros(n, dtype=np.int64)
        for _ in range(self.depth):
            side = np.bincount(doc, weights=self.way[node[doc], place] * value, minlength=n).astype(np.float32)
            node = 2 * node + 1 + (side >= self.cut[node])
        return node - ((1 << self.depth) - 1)


def sparse(x: np.ndarray) -> list[tuple[bytes, bytes]]:
    """The places of what isn't 0 in each row, and its values in 16 bits."""
    half = x.astype(np.float16)
    return [(p.astype(np.uint16).tobytes(), v[p].tobytes()) for v in half for p in [np.flatnonzero(v)]]


def sampled(rows) -> Rows:
    """The vectors of a table of what sparse() gives, in an order of their own; without zeros, for the driver's sake."""
    made = []
    for place, value in zip(rows.column(0), rows.column(1)):
        place, value = np.frombuffer(place.as_py(), np.uint16), np.frombuffer(value.as_py(), np.float16)
        # the order is that of the whole vectors' bytes: of two, the one whose next entry comes first is greater
        key = np.column_stack([(WIDTH - place).astype(">u2").view(np.uint8).reshape(-1, 2), value.view(np.uint8).reshape(-1, 2)])
        made.append((key.tobytes(), place, value))
    made.sort(key=lambda m: m[0])
    none = np.zeros(0, dtype=np.uint16)
    size = np.array([len(m[1]) for m in made], dtype=np.int64)
    return Rows(size, np.concatenate([none, *(m[1] for m in made)]), np.concatenate([none.astype(np.float16), *(m[2] for m in made)]))


def sketches(docs: list[np.ndarray]) -> np.ndarray:
    """20 bits of a minhash of each document's runs of RUN tokens."""
    flat = np.concatenate(docs).astype(U)
    h = mix(flat + U(1))
    run = h.copy()
    for k in range(1, RUN):  # runs over the end of a document are of it and the next one: those don't count
        run[: max(0, len(run) - k)] = mix(run[: max(0, len(run) - k)] * U(3) + h[k:])
    sizes = np.array([len(d) for d in docs])
    end = np.cumsum(sizes)
    left = np.repeat(end, sizes) - np.arange(len(flat))
    run[(left < RUN) & (np.repeat(sizes, sizes) >= RUN)] = ~U(0)
    return mix(np.minimum.reduceat(run, end - sizes)) >> U(44)


def keys(tree: Tree, docs: list[np.ndarray], ids: list, idf: np.ndarray) -> np.ndarray:
    """The documents' places in the order: leaf, sketch, and a hash of id and tokens."""
    leaf = tree.leaves(*vectors(docs, idf), len(docs))
    salt = np.array([zlib.crc32(d.tobytes(), zlib.crc32(str(i).encode())) for d, i in zip(docs, ids)], dtype=U)
    # rows that are wholly equal are told apart by their number here, so that they can be cut apart too
    salt = mix(salt * U(0x9E3779B97F4A7C15) + np.arange(len(docs), dtype=U) * repeated(docs, ids)) >> U(32)
    return ((leaf.astype(U) << U(52)) | (sketches(docs) << U(32)) | salt).astype(np.int64)


def repeated(docs: list[np.ndarray], ids: list) -> np.ndarray:
    """1 for each row that equals another one here, else 0."""
    seen: dict = {}
    for k, (d, i) in enumerate(zip(docs, ids)):
        seen.setdefault((i, d.tobytes() if len(d) < 64 else zlib.crc32(d.tobytes()), len(d)), []).append(k)
    out = np.zeros(len(docs), dtype=U)
    for rows in seen.values():
        if len(rows) > 1:
            out[rows] = 1
    return out


def share(n: int) -> float:
    """The part of a shard that a document of n tokens is."""
    return max(n / SHARD_TOKENS, 1 / SHARD_DOCS)


# --- the job --------------------------------------------------------------------------------------


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048, with_ids: bool = False) -> DataFrame:
    """A row for each piece, with the columns of PIECES; with_ids adds ids, its token ids.

    tokenizer: the path of a tokenizers file, the same on all machines.
    """
    spark = docs.sparkSession

    def tokens(it):
        import pyarrow as pa

        own = encoder(tokenizer)
        for part in batches(it, ["text", "doc_id"], 3 << 20):
            data = [np.append(x, x.dtype.type(end_id)) for x in own.encode([r[0] for r in part])]
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in part], pa.int64()), pa.array([x.tobytes() for x in data], pa.binary()), pa.array([x.itemsize for x in data], pa.int32()), pa.array([len(x) for x in data], pa.int64())], ["doc_id", "data", "width", "n"])

    made = docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(tokens, "doc_id long, data binary, width int, n long")
    made = materialise(made, "tokens", "snappy")  # ids don't shrink much

    def term_counts(it):
        import pyarrow as pa

        df = np.zeros(0, dtype=np.int64)
        for b in it:
            data = [ids_of(d, w) for d, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            for some in portions(data):
                n = int(max(map(np.max, data[some]))) + 1
                own = np.bincount(distinct(data[some], n)[1], minlength=len(df))
                own[: len(df)] += df
                df = own
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], ["term", "df"])

    # a row for each entry of the vocabulary
    seen = made.select("data", "width").mapInArrow(term_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    whole = made.agg(F.count("*"), F.sum("n"), F.sum(F.greatest(F.col("n") / SHARD_TOKENS, F.lit(1 / SHARD_DOCS)))).first()
    total, mean = whole[0], (whole[1] or 0) / max(1, whole[0])
    idf = np.zeros(int(max([0, *seen.column(0).to_pylist()])) + 1)
    idf[seen.column(0).to_numpy()] = weights_of(total, seen.column(1).to_numpy())
    parts = int(min(PARTS, np.ceil(whole[2] or 1)))

    # rows chosen by a hash, in proportion to the parts
    picked = made.filter(F.xxhash64("doc_id", "data") <= F.lit(low(max(SAMPLE, CUT_SAMPLE * parts) / max(1, total))))
    picked = materialise(picked, "picked") if parts > 1 else picked

    def flat(it):
        import pyarrow as pa

        for b in it:
            rows = [ids_of(d, w) for d, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            for some in portions(rows):
                doc, place, value = vectors(rows[some], idf)
                x = np.zeros((len(rows[some]), WIDTH), dtype=np.float32)
                np.add.at(x, (doc, place), value)
                made = sparse(x)
                yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], pa.binary()) for k in (0, 1)], ["place", "value"])

    depth = int(min(DEPTH, np.ceil(np.log2(parts)), max(0, np.log2(max(1, min(total, SAMPLE)) / 4))))
    tree = Tree(0, np.zeros((1, WIDTH), np.float32), np.zeros(1, np.float32))
    cuts = np.zeros(0, dtype=np.int64)
    if parts > 1:
        tree = Tree.fit(sampled(picked.select("data", "width").limit(SAMPLE).mapInArrow(flat, "place binary, value binary").toArrow()), depth)

    sent = spark.sparkContext.broadcast((tree, idf))

    def ordered(it):
        """Rows with their key and, from the cuts, their part."""
        import pyarrow as pa

        for b in it:
            data = [ids_of(d, w) for d, w in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            if not data:
                continue
            ids, (tree, idf) = b.column(0).to_pylist(), sent.value
            key = np.concatenate([keys(tree, data[some], ids[some], idf) for some in portions(data)])
            part = np.searchsorted(cuts, key, side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key, pa.int64()), pa.array(part, pa.int32())], ["doc_id", "data", "width", "n", "key", "part"])

    keyed = "doc_id long, data binary, width int, n long, key long, part int"
    if parts > 1:
        some = picked.mapInArrow(ordered, keyed).select("key", F.greatest(F.col("n") / SHARD_TOKENS, F.lit(1 / SHARD_DOCS)).alias("share"))
        some = some.groupBy("key").agg(F.sum("share").alias("share")).toArrow()  # about CUT_SAMPLE * PARTS rows at most
        key, weight = some.column(0).to_numpy(), some.column(1).to_numpy()
        order = np.argsort(key, kind="stable")
        reach = np.cumsum(weight[order])
        cuts = np.unique(key[order][np.searchsorted(reach, reach[-1] * np.arange(1, parts) / parts)]) if len(reach) else cuts

    schema = PIECES + ", ids array<long>" * with_ids
    names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids

    def packed(it):
        import pyarrow as pa

        def done(rows, part, shard):
            data, cols = [ids_of(r[1], r[2]) for r in rows], [[] for _ in range(8)]
            for k, window in enumerate(pack(data, size, sent.value[1], mean)):
                offset = 0
                for d, start, length in window:
                    ids = data[d][start : start + length].astype("<u4")
                    row = (rows[d][0], start, length, zlib.crc32(ids.tobytes()), len(data[d]), (part << 40) + (shard << 24) + k, offset, ids if with_ids else None)
                    for c, v in zip(cols, row):
                        c.append(v)
                    offset += length
            made = [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.list_(pa.int64()))] * with_ids
            return pa.RecordBatch.from_arrays(made, names)

        now, shard, rows, full = None, 0, [], 0.0
        for b in it:
            for doc_id, data, width, n, part in zip(*(b.column(k).to_pylist() for k in range(5))):
                own = share(n)
                if rows and (part != now or full + own > 1.25):
                    yield done(rows, now, shard)
                    shard, rows, full = shard + 1 if part == now else 0, [], 0.0
                now, full = part, full + own
                rows.append((doc_id, data, width))
        if rows:
            yield done(rows, now, shard)

    dealt = made.mapInArrow(ordered, keyed).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key")
    return dealt.select("doc_id", "data", "width", "n", "part").mapInArrow(packed, schema)
