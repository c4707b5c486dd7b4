"""Joins and numbering that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ionsift.session import settle

# A key is heavy when it holds more than 1/MAX_HEAVY of all rows (and more than one task's
# share), so there are at most MAX_HEAVY heavy keys whatever the data: this is the size bound
# behind the broadcasts below.
MAX_HEAVY = 100_000


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", null_safe: bool = False):
    """Join on equally named columns, keeping the left ones; NULL keys meet only if asked."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"_r_{k}"]) if null_safe else left[k] == renamed[f"_r_{k}"]
        condition = one if condition is None else condition & one
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def heavy_keys(
    counts: DataFrame, keys: list[str], n: str, rows_per_task: int, at_most: int | None = None
) -> DataFrame | None:
    """Keys holding too many rows for one task, with the number of parts to cut them into.

    ``counts`` has one row per key. A small job looks at the counts: without a heavy key (the
    usual case) the answer is None and joins stay plain. Otherwise the heavy keys, at most
    MAX_HEAVY rows, come back as a local table. ``at_most`` is a known bound on the rows of any
    key, such as the size of the whole table; below one task's share there is nothing to look at.
    """
    if at_most is not None and at_most <= rows_per_task:
        return None
    total, top = counts.agg(F.sum(n), F.max(n)).first()
    share = max((total or 0) / MAX_HEAVY, rows_per_task)
    if not top or top <= share:
        return None
    rows = counts.where(F.col(n) > share).select(*keys, F.ceil(F.col(n) / share).alias("_parts"))
    return counts.sparkSession.createDataFrame(rows.collect(), rows.schema)


def part_key(heavy: DataFrame | None) -> list[str]:
    """The extra join key while heavy keys are cut into parts."""
    return [] if heavy is None else ["_part"]


def spread(
    big: DataFrame, heavy: DataFrame | None, keys: list[str], by: list[Column], null_safe: bool = False
) -> DataFrame:
    """Give every row a part number: 0, or one of the key's parts where the key is heavy."""
    if heavy is None:
        return big
    marked = join_on(big, F.broadcast(heavy), keys, "left", null_safe)
    part = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")), F.lit(0).cast("long"))
    return marked.withColumn("_part", part).drop("_parts")


def repeat(small: DataFrame, heavy: DataFrame | None, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Repeat the rows of heavy keys once per part, so that each part finds its match.

    All parts of all heavy keys together are at most 2 * MAX_HEAVY.
    """
    if heavy is None:
        return small
    marked = join_on(small, F.broadcast(heavy), keys, "left", null_safe)
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_parts"), F.lit(1).cast("long")) - 1)
    return marked.withColumn("_part", F.explode(parts)).drop("_parts")


def balanced_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    heavy: DataFrame | None,
    by: list[str],
    how: str = "left",
    null_safe: bool = False,
    both_large: bool = False,
) -> DataFrame:
    """Join a big table to a smaller one with the heavy keys of the big side cut into parts.

    With ``both_large`` the join is by shuffle and sort, whatever size Spark estimates for a side.
    """
    left = spread(big, heavy, keys, [F.col(f"`{c}`") for c in by], null_safe)
    right = repeat(small, heavy, keys, null_safe)
    if both_large:
        right = right.hint("merge")
    return join_on(left, right, keys + part_key(heavy), how, null_safe).drop("_part")


def with_dataset(df: DataFrame, per_dataset: DataFrame, keys: list[str], n_rows: int) -> DataFrame:
    """Attach a table with one row per dataset, whose row count the caller has looked up.

    Small enough (the usual case) it is broadcast; beyond that the datasets are joined by
    shuffle, the large ones cut into parts.
    """
    if n_rows <= MAX_HEAVY:
        return join_on(df, F.broadcast(per_dataset), keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = heavy_keys(counts, keys, "_n", MAX_HEAVY)
    return balanced_join(df, per_dataset, keys, heavy, df.columns)


def with_group(
    df: DataFrame,
    keys: list[str],
    by: list[str],
    rows_per_task: int,
    at_most: int | None = None,
    **aggregates: Column,
) -> DataFrame:
    """Attach group aggregates to every row; NULL keys form a group.

    Unlike a whole-partition window, the aggregate is combined before the shuffle and a heavy
    group is never held by one task. ``df`` is read more than once: settle it first if it is
    not cheap.
    """
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[expr.alias(name) for name, expr in aggregates.items()]
    )
    heavy = heavy_keys(groups, keys, "_n", rows_per_task, at_most)
    return balanced_join(df, groups.drop("_n"), keys, heavy, by, "left", null_safe=True)


def number_rows(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """1, 2, 3 … per group in sort order, without putting a group in one task.

    One range-partitioned sort gives every row its (partition, position). The sorted rows are
    settled, since the offsets below read them a second time and must see the same split. Rows
    equal in the sort columns are ordered by a hash of the whole row; copies of a row, which are
    interchangeable, by their place in the input, so that they too spread over tasks.
    """
    everything = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = settle(
        df.withColumns({"_hash": everything, "_row": F.monotonically_increasing_id()})
        .orderBy(*[F.col(f"`{g}`").asc_nulls_first() for g in groups], *order, "_hash", "_row")
        .drop("_hash", "_row")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_chunk", F.shiftright("_at", 33))
    )
    keys = groups + ["_chunk"]
    # One row per group and sort partition; without groups, one row per sort partition.
    chunks = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = (
        Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = chunks.select(*keys, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = join_on(placed, starts, keys, "inner", null_safe=bool(groups))
    return numbered.withColumn(name, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long")).drop(
        "_at", "_chunk", "_first", "_before"
    )
