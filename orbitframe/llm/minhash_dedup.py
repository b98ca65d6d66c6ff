"""MinHash near-dedup with tensored banding.

A text's set holds the 64-bit hashes of its distinct five-word shingles (A-Z lower-cased).  Two
small collections of band hashes, A and B, are computed, each of `bands` bands of `rows` minhashes;
a table key pairs one band of A with one of B.  So 2 * bands * rows minhashes serve bands**2
tables of 2 * rows minhashes each, as a square root of what they would take one by one.  A pair of
similarity s shares a table with probability (1 - (1 - s**rows)**bands)**2: 0.99998 at 0.85 and
0.9997 at 0.8 with the defaults.

Texts with equal sets become one class first.  Classes that share a table are clustered by linking
each to the smallest class of the table (a star, never all pairs); within a cluster, pairs whose
minhashes agree enough are confirmed on their full sets, and only links that join two components
are given out, so a cluster of n classes yields n - 1 rows at most.  A cluster of over `chunk`
classes, or of more than CHUNK_SHINGLES shingles, is cut into chunks.  First each chunk is linked
up by itself, together with the class that names the cluster; then only classes outside the
cluster's largest component so far are held against all others, chunk by chunk.  A large group of
near copies so moves few more rows than it has; one that falls apart moves up to n * n / chunk.
The memory of a task is bounded, and nothing is dropped.

Defined results: a null or empty text, and one of white space, has no shingles and is linked with
nothing; a text of fewer than five words has one shingle, all of it; repeated rows and exact copies
are linked; rows that share an id are one document, which is linked with whatever any of its texts
is linked with; a row without an id is linked like others but can't be a component's name, unless
all of its copies have none, in which case its component is null and it is kept; ids may be any
64-bit numbers; a text of n words takes about 60 n bytes of memory and is one task's; an empty table
gives an empty one; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise, release
from ._text import U, Words, batches, mix
from .components import components, with_value

SHINGLE = 5
#: Shingles of all classes of a chunk: 16 MB.
CHUNK_SHINGLES = 2_000_000


def seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text, its shingles' hashes, sorted and distinct."""
    w = Words(texts, lower=True)
    at, h = w.windows(SHINGLE)
    bounds = np.searchsorted(w.text[at], np.arange(len(texts) + 1)) if len(at) else np.zeros(len(texts) + 1, dtype=np.int64)
    out = []
    for t in range(len(texts)):
        a, b = w.first[t], w.first[t + 1]
        if bounds[t + 1] > bounds[t]:
            out.append(np.unique(h[bounds[t] : bounds[t + 1]]))
        elif b > a:
            short = w.hash[a:b]
            total = U(b - a)
            for x in short:
                total = mix(np.array([total ^ x], dtype=U) * U(0x9E3779B97F4A7C15))[0]
            out.append(np.array([total], dtype=U))
        else:
            out.append(np.zeros(0, dtype=U))
    return out


def minhashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n minhashes for each set, none of them empty; 32 bits of each."""
    flat = np.concatenate(sets)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), n), dtype=np.uint32)
    for i, a in enumerate(seeds(n)):
        x = flat ^ (a >> U(7))
        x *= a
        x ^= x >> U(32)
        out[:, i] = (np.minimum.reduceat(x * (a ^ U(0x5851F42D4C957F2C) | U(1)), begin) >> U(32)).astype(np.uint32)
    return out


def band_hashes(m: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """2 * bands hashes for each row of minhashes."""
    x = m.reshape(len(m), 2 * bands, rows).astype(U)
    h = np.broadcast_to(seeds(2 * bands), x.shape[:2]).copy()
    for r in range(rows):
        h = mix(h ^ (x[:, :, r] * U(0x9E3779B97F4A7C15)))
    return h


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, s1, s2 (128 bits that name the set; null if it is empty) and bands."""

    def run(it):
        import pyarrow as pa

        for batch in batches(it, ["text", "doc_id"]):
            sets = shingle_sets([r[0] for r in batch])
            full = [i for i, s in enumerate(sets) if len(s)]
            name, band = np.zeros((len(sets), 2), dtype=U), [None] * len(sets)
            if full:
                some = [sets[i] for i in full]
                begin = np.concatenate([[0], np.cumsum([len(s) for s in some])[:-1]])
                flat = np.concatenate(some)
                name[full, 0], name[full, 1] = np.add.reduceat(flat, begin), np.add.reduceat(mix(flat ^ U(0x1234567)), begin)
                for i, b in zip(full, band_hashes(minhashes(some, 2 * bands * rows), bands, rows).astype(np.int64)):
                    band[i] = b
            none = np.array([len(s) == 0 for s in sets], dtype=bool)
            cols = [pa.array([r[1] for r in batch], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
            cols += [pa.array(name[:, k].view(np.int64), mask=none) for k in (0, 1)] + [pa.array(band, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "s1", "s2", "bands"])

    schema = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
    return docs.select("text", F.col("doc_id").cast("long")).mapInArrow(run, schema)


def table_edges(classes: DataFrame, bands: int) -> DataFrame:
    """Star edges (a, b): each class (id, bands) and the smallest class that it shares a table with.

    Bands that only one class has can't be part of a shared table; they go first.
    """
    one = classes.select("id", F.posexplode("bands").alias("band", "h"))
    shared = one.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    left = one.join(shared, "h", "left_semi")
    sides = left.groupBy("id").agg(
        F.collect_list(F.when(F.col("band") < bands, F.col("h"))).alias("a"), F.collect_list(F.when(F.col("band") >= bands, F.col("h"))).alias("b")
    )
    keys = sides.select("id", F.explode("a").alias("x"), "b").select("id", "x", F.explode("b").alias("y")).select("id", F.xxhash64("x", "y").alias("key"))
    least = keys.groupBy("key").agg(F.min("id").alias("m"), F.count("*").alias("n")).filter("n > 1")
    total = classes.count() * bands * bands
    return with_value(keys, "key", least, total).filter("id <> m").select(F.col("id").alias("a"), F.col("m").alias("b")).distinct()


def spanning_links(members: list[tuple], least: Fraction, agree: int, across: bool) -> Iterator[tuple[int, int]]:
    """Links (a, b) that join components among members (id, side, component so far, minhashes, set).

    across: only pairs of unlike sides are looked at.  Pairs that are joined already are not.
    """
    n = len(members)
    _, root = np.unique(np.array([m[2] for m in members], dtype=np.int64), return_inverse=True)
    marks = np.stack([m[3] for m in members])
    sizes = np.array([len(m[4]) for m in members])
    side = np.array([m[1] for m in members])
    for i in range(n):
        others = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        if across:
            others = others[side[others] != side[i]]
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[small * least.denominator >= large * least.numerator]
        if not len(others):
            continue
        for j in others[(marks[others] == marks[i]).sum(1) >= agree]:
            if root[i] == root[j]:
                continue
            same = len(np.intersect1d(members[i][4], members[j][4], assume_unique=True))
            if least.denominator * same >= least.numerator * (sizes[i] + sizes[j] - same):
                yield members[i][0], members[j][0]
                root[root == root[j]] = root[i]


def linked(units: DataFrame, least: Fraction, n_marks: int, across: bool) -> DataFrame:
    """Links (a, b) within each unit (cluster, c1, c2) of rows id, side, part, marks and hashes."""
    # minhashes of a linked pair agree in fewer places than this once in millions of pairs
    s = float(least)
    agree = int(n_marks * s - 5 * (n_marks * s * (1 - s)) ** 0.5)

    def run(it):
        import pyarrow as pa

        def done(members):
            out = list(spanning_links(members, least, agree, across)) if len(members) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

        key, members = None, []
        for b in it:
            for c, c1, c2, *row in zip(*(b.column(k).to_pylist() for k in range(8))):
                if (c, c1, c2) != key:
                    yield done(members)
                    key, members = (c, c1, c2), []
                members.append((*row[:3], np.frombuffer(row[3], np.uint32), np.frombuffer(row[4], U)))
        yield done(members)

    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.select("cluster", "c1", "c2", "id", "side", "part", "marks", "hashes")
    return units.repartition(n, "cluster", "c1", "c2").sortWithinPartitions("cluster", "c1", "c2", "id").mapInArrow(run, "a long, b long")


def confirmed_links(docs: DataFrame, clusters: DataFrame, least: Fraction, n_marks: int, chunk: int) -> DataFrame:
    """Confirmed links (a, b) within clusters (id, cluster, n_shingles).

    docs has id and text, a row for each text of a class's document; the links of all of them count.
    """
    size = clusters.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    pieces = F.greatest(F.ceil(F.col("size") / chunk), F.ceil(F.col("weight") / CHUNK_SHINGLES)).cast("int")
    size = size.filter("size > 1").select("cluster", pieces.alias("chunks"))
    placed = clusters.join(size, "cluster").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    # a merge join at every size: whether the members would fit a broadcast depends on the corpus
    rows = docs.join(placed.select("id", "cluster", "chunks", "chunk").hint("merge"), "id")

    def sets(it):
        import pyarrow as pa

        for batch in batches(it, ["text", "id", "cluster", "chunks", "chunk"]):
            found = shingle_sets([r[0] for r in batch])
            full = [i for i, s in enumerate(found) if len(s)]  # a document's further text may be empty
            if not full:
                continue
            marks = minhashes([found[i] for i in full], n_marks)
            cols = [pa.array([batch[i][k] for i in full], kind) for k, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.int32()), (4, pa.int32()))]
            cols += [pa.array([m.tobytes() for m in marks], pa.binary()), pa.array([found[i].tobytes() for i in full], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "cluster", "chunks", "chunk", "marks", "hashes"])

    full = rows.select("text", "id", "cluster", "chunks", "chunk").mapInArrow(sets, "id long, cluster long, chunks int, chunk int, marks binary, hashes binary")
    full = materialise(full, "sets")
    # the class that names the cluster is with every chunk, so that a chunk's copies meet the others' at it
    every = F.when(F.col("id") == F.col("cluster"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))
    alone = full.withColumns({"c1": F.explode(every), "c2": F.lit(-1), "side": F.lit(0), "part": F.col("id")})
    first = materialise(linked(alone, least, n_marks, False), "links")
    cut = full.filter("chunks > 1")
    if not cut.limit(1).count():
        release(full)
        return first
    parts = materialise(components(first, "parts"), "parts")
    members = cut.join(parts.select(F.col("node").alias("id"), "component").hint("merge"), "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
    largest = members.groupBy("cluster", "part").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max(F.struct("n", "part"))["part"].alias("main"))
    members = members.join(largest, "cluster")
    outside = F.col("part") != F.col("main")
    n_out = members.filter(outside).groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum(F.octet_length("hashes")) / (8 * CHUNK_SHINGLES))).cast("int").alias("rounds"))
    members = members.join(n_out, "cluster")  # clusters that are one component by now are done
    one = members.withColumns({"c1": F.col("chunk"), "c2": F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)), "side": F.lit(0)})
    spread = F.sequence(F.lit(0), F.col("chunks") - 1)
    two = members.filter(outside).withColumns({"c1": F.explode(spread), "c2": F.pmod(F.xxhash64(F.lit(1), "id"), "rounds").cast("int"), "side": F.lit(1)})
    names = ["cluster", "c1", "c2", "id", "side", "part", "marks", "hashes"]
    second = materialise(linked(one.select(*names).unionByName(two.select(*names)), least, n_marks, True), "links")
    release(full)
    release(parts)
    return first.unionByName(second)


def same_document(sig: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of texts that share a doc_id."""
    several = sig.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    own = sig.filter("s1 is not null").join(several, "doc_id").join(classes.select("s1", "s2", "id"), ["s1", "s2"]).select("doc_id", "id")
    least = own.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("most")).filter("b <> most").select("doc_id", "b")
    return own.join(least, "doc_id").filter("id <> b").select(F.col("id").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, least: Fraction = Fraction(4, 5), bands: int = 12, rows: int = 3, chunk: int = 512) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs; kept is doc_id = component_id.

    Texts are linked if their sets' intersection is at least `least` of their union.
    """
    sig = materialise(signatures(docs, bands, rows), "minhash")
    classes = sig.filter("s1 is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles"))
    classes = materialise(classes.filter("id is not null"), "classes")
    edges = materialise(table_edges(classes, bands), "edges")
    clusters = components(edges, "cluster").select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    sizes = classes.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    clusters = materialise(clusters.join(sizes, "id"), "clusters")
    named = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id is not null")
    links = confirmed_links(named, clusters, least, 2 * bands * rows, chunk)
    joined = materialise(components(links.unionByName(same_document(sig, classes)), "linked"), "components")
    for x in (edges, clusters, links):
        release(x)
    found = classes.select("s1", "s2", "id").join(joined, F.col("id") == F.col("node"), "left").select("s1", "s2", F.coalesce("component", "id").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "s1", "s2").join(found, ["s1", "s2"], "left")
    component = F.when(F.col("s1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
