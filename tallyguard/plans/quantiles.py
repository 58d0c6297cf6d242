"""Exact order statistics in two narrow passes.

Pass one counts rows per (group, bucket) for a fixed, order-preserving bucketing of the value; the number
of buckets is small whatever the data. Prefix counts name the buckets that hold the wanted ranks. Pass two
counts the distinct values of those buckets only. No group is ever collected or sorted whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.plans.scratch import write_once
from tallyguard.plans.small_side import bounded

RankOf = Callable[[Column], Column]


def value_bucket(value: Column, resolution: int = 512) -> Column:
    """Monotone bucket number: ``resolution`` buckets per factor e, mirrored for negative values."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * resolution)).cast("long")


def order_statistics(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    picks: dict[str, RankOf],
    resolution: int = 512,
    max_rows: int | None = None,
) -> DataFrame:
    """The value at given 0-based ranks of each group.

    ``picks`` maps a name to a function from the group's row count to a rank. Nulls are left out.
    Returns by..., pick, n (rows of the group), rank, value, below (rows with a smaller value).
    """
    by = list(by)
    base = df.where(F.col(value).isNotNull()).select(
        *by, F.col(value).cast("double").alias("_value"), value_bucket(F.col(value), resolution).alias("_bucket")
    )
    counts = base.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.explode(
        F.array(*[F.struct(F.lit(name).alias("pick"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in picks.items()])
    )
    targets = (
        counts.withColumn("_below", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("n", F.sum("_rows").over(Window.partitionBy(*by)))
        .select(*by, "_bucket", "_below", "_rows", "n", wanted.alias("_want"))
        .select(*by, "_bucket", "_below", "_rows", "n", "_want.pick", "_want.rank")
        .where((F.col("_below") <= F.col("rank")) & (F.col("rank") < F.col("_below") + F.col("_rows")))
        .drop("_rows")
    )

    small = bounded(targets, max_rows)
    if small is not None:
        targets = F.broadcast(small)
        inside = base.join(F.broadcast(small.select(*by, "_bucket").distinct()), [*by, "_bucket"], "left_semi")
    else:
        targets = write_once(targets, "ranks")
        inside = base
    # counted before any shuffle join, so a hot value is one row
    values = inside.groupBy(*by, "_bucket", "_value").agg(F.count(F.lit(1)).alias("_count"))
    ordered = Window.partitionBy(*by, "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("_before", F.coalesce(F.sum("_count").over(ordered), F.lit(0)))
    start = F.col("_below") + F.col("_before")
    return (
        placed.join(targets, [*by, "_bucket"])
        .where((start <= F.col("rank")) & (F.col("rank") < start + F.col("_count")))
        .select(*by, "pick", "n", "rank", F.col("_value").alias("value"), start.alias("below"))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: Sequence[str] = (),
    resolution: int = 512,
    max_rows: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles, one column per entry of ``quantiles``, plus the row count ``n``."""
    by = list(by)
    picks: dict[str, RankOf] = {}
    for name, q in quantiles.items():
        picks[f"{name}:lo"] = lambda n, q=q: F.floor((n - 1) * F.lit(q))
        picks[f"{name}:hi"] = lambda n, q=q: F.ceil((n - 1) * F.lit(q))
    found = order_statistics(df, value, by, picks, resolution, max_rows)

    def at(label: str) -> Column:
        return F.max(F.when(F.col("pick") == label, F.col("value")))

    ends = found.groupBy(*by).agg(
        F.max("n").alias("n"),
        *[at(f"{name}:{end}").alias(f"_{name}_{end}") for name in quantiles for end in ("lo", "hi")],
    )
    columns = []
    for name, q in quantiles.items():
        position = (F.col("n") - 1) * F.lit(q)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        columns.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return ends.select(*by, "n", *columns)


def approx_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch with the same columns as ``exact_quantiles``."""
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        *[F.percentile_approx(value, q, accuracy).cast("double").alias(name) for name, q in quantiles.items()],
    )
