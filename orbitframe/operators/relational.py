"""Keyed tables: first and last rows, upserts, lookups, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[Column], most: int = 1) -> DataFrame:
    """The first rows of each key in an order; that should be total, or ties are broken at random."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most).drop("__n")


def _extreme(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    """One row of each key by an aggregation, so that a key of many rows shrinks before the shuffle.

    Rows compare by `order` and then by the other columns, nulls lowest, as far as these have an order.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rest = [c for c in df.columns if c not in (*keys, *order)]
    loose = [c for c in rest if "map<" in kinds[c] or "variant" in kinds[c]]
    by = F.struct(*[F.col(c) for c in [*order, *rest] if c not in loose and c not in keys])
    if loose:
        best = (F.min_by if pick is F.min else F.max_by)(F.struct(*[c for c in df.columns if c not in keys]), by)
    else:
        best = pick(by)
    out = df.groupBy(*keys).agg(best.alias("__best"))
    return out.select(*[c if c in keys else F.col("__best")[c].alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first by order, nulls first."""
    return _extreme(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last by order, nulls first."""
    return _extreme(df, keys, order, F.max)


def union_by_name(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows; columns in the order first seen, null where a table lacks one."""
    out = first
    for df in more:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def upsert(state: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """State with new rows in place of those of the same key; among several of one table the last by `order` counts.

    Unlike a plain replacement this also holds for an empty state.
    """
    both = union_by_name(state.withColumn("__from", F.lit(0)), new.withColumn("__from", F.lit(1)))
    return last_per_key(both, keys, ["__from", *order]).drop("__from")


def lookup_last(left: DataFrame, right: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A left join to the last row of each key on the right."""
    return left.join(last_per_key(right, keys, order), keys, "left")


def predominant(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each key's most common value in upper case, the smallest of equally common ones; null if there is none."""
    return df.groupBy(*keys).agg(F.mode(F.upper(F.col(value)), deterministic=True).alias(value))


def value_counts(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(F.upper(F.col(value)).alias(value)).agg(F.count("*").alias("n"))


def missing(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows whose key was not found."""
    return expected.join(found.select(*keys).distinct(), keys, "left_anti")


def fully_present(owners: DataFrame, required: DataFrame, found: DataFrame, owner: str, item: str) -> DataFrame:
    """Owners with whether all required items were found for them (relational division).

    One aggregation over what was found, so owners x required is never built.
    """
    n = required.select(item).distinct().agg(F.count("*").alias("n_required"))
    have = found.join(required.select(item).distinct(), item, "left_semi").groupBy(owner).agg(F.countDistinct(item).alias("n_found"))
    joined = owners.select(owner).join(have, owner, "left").join(F.broadcast(n))  # one row
    return joined.select(owner, F.coalesce("n_found", F.lit(0)).alias("n_found"), (F.coalesce("n_found", F.lit(0)) >= F.col("n_required")).alias("complete"))


def complete_by(found: DataFrame, owner: str, item: str, required: list) -> DataFrame:
    """For each owner in found, how many of the required items it has, and whether all: one aggregation."""
    n = F.count_distinct(F.when(F.col(item).isin(*required), F.col(item)))
    return found.groupBy(owner).agg(n.alias("n_found")).withColumn("complete", F.col("n_found") >= len(set(required)))


def filled(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """left with nulls in columns filled from the last row of the same key on the right."""
    own = last_per_key(right.select(*dict.fromkeys([*keys, *order, *columns])), keys, order)
    own = own.select(*keys, *[F.col(c).alias("__" + c) for c in columns])
    joined = left.join(own, keys, "left")
    return joined.select(*[F.coalesce(c, "__" + c).alias(c) if c in columns else c for c in left.columns])


def find_one(catalogue: DataFrame, name: str, value: str, columns: list[str]) -> DataFrame:
    """One row at most with the columns of the product that has this name."""
    return catalogue.filter(F.col(name) == value).select(*columns).limit(1)


def preferred(left: DataFrame, right: DataFrame, keys: list[str], value: str, rank: Column) -> DataFrame:
    """For each key the value of the lowest rank on the right, ties to the smallest value."""
    best = right.groupBy(*keys).agg(F.min(F.struct(rank.alias("rank"), F.col(value).alias("value")))["value"].alias(value))
    return left.join(best, keys, "left")


def equals_all(values: dict[str, object]) -> Column:
    """A conjunction of column = value; of none, true.  A None value sets no condition."""
    out = F.lit(True)
    for k, v in values.items():
        if v is not None:
            out = out & (F.col(k) == v)
    return out
