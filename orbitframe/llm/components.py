"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialise, release

#: A key with more than this share of all rows is looked up in a broadcast table, which so has few rows.
HOT_SHARE = 512
LEAST_HOT = 64
#: Edges that a task links up at once.
PORTION = 1 << 18


def with_value(rows: DataFrame, key: str, values: DataFrame, total: int) -> DataFrame:
    """rows joined to values (key, m, n) by their key; n: how many of the rows have it, total: how many there are.

    Rows of the keys that have very many of them stay where they are: there are at most HOT_SHARE such
    keys, whatever the input, and their values are broadcast.
    """
    often = F.col("n") > max(LEAST_HOT, total // HOT_SHARE)
    hot = values.filter(often).select(F.col(key).alias("__key"), F.col("m").alias("__m"))
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__key"), "left")
    kept = marked.filter("__key is not null").withColumnRenamed("__m", "m").drop("__key")
    others = marked.filter("__key is null").drop("__key", "__m").join(values.filter(~often).select(key, "m"), key)
    return kept.unionByName(others.select(*kept.columns))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node of the edges (a, b) to the smallest node that they join it to; none to itself."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    top = np.arange(len(nodes))
    while True:
        least, now = np.minimum(top[x], top[y]), top.copy()
        np.minimum.at(now, top[x], least)
        np.minimum.at(now, top[y], least)
        while (now[now] != now).any():
            now = now[now]
        if (now == top).all():
            below = np.flatnonzero(top != np.arange(len(nodes)))
            return nodes[below], nodes[top[below]]
        top = now


def contracted(edges: DataFrame) -> DataFrame:
    """Edges that join what edges (a, b) join: of each task's part, PORTION at a time, a forest of links to its smallest nodes."""

    def run(it):
        import pyarrow as pa

        def done(parts):
            a, b = forest(*(np.concatenate([p[k] for p in parts]) for k in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        parts, held = [], 0
        for batch in it:
            parts.append([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
            held += batch.num_rows
            if held >= PORTION:
                yield done(parts)
                parts, held = [], 0
        if held:
            yield done(parts)

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def state(edges: DataFrame) -> tuple[int, int]:
    """How many edges (a, b) there are, and how many nodes keep them from being stars.

    Those are nodes with two smaller neighbours, and such with a smaller and a larger one.
    """
    ends = edges.select("a", F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("a"), F.lit(None).cast("long").alias("to")))
    nodes = ends.groupBy("a").agg(F.count("to").alias("below"), F.count("*").alias("n"), F.min("to").alias("least"), F.max("to").alias("most"))
    wrong = (F.col("least") != F.col("most")) | ((F.col("below") > 0) & (F.col("below") < F.col("n")))
    found = nodes.agg(F.sum("below"), F.count_if(wrong)).first()
    return found[0] or 0, found[1]


def components(edges: DataFrame, name: str) -> DataFrame:
    """node and component (the smallest node reachable) for each node of edges (a, b).

    Tasks link up PORTION edges each; where that takes several of them, large-star and small-star
    steps come before it, again and again until all edges are stars.  Such a step is two aggregations
    over the edges, which are at most as many as the nodes after the first steps.  Each round's table
    goes to the shared folder, so a lost executor costs one round at most.  Hubs are aggregated with
    partial results and never gathered in one task.  A round's shuffles cost the driver memory for
    each of their tasks, however few the edges; so there are no more rounds than it takes.
    """
    now = materialise(contracted(edges), name)
    n, wrong = state(now)
    while wrong:
        step, tasks = now, -(-n // PORTION)
        if tasks > 1:
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
            # large star: a node's larger neighbours go to its smallest neighbour
            large = with_value(both.filter("b > a"), "a", least, 2 * n).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            large = materialise(large, name)
            # small star: a node and its smaller neighbours go to the smallest of them
            small = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
            joined = with_value(large, "a", small, n).select(F.col("b").alias("a"), F.col("m").alias("b"))
            step = materialise(joined.unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), name)
            release(now)
            release(large)
        now = materialise(contracted(step.coalesce(tasks)), name)
        release(step)
        n, wrong = state(now) if tasks > 1 else (n, 0)
    # an edge may be there twice, from two tasks
    parts = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return parts.unionByName(parts.select(F.col("component").alias("node"), "component").distinct())
