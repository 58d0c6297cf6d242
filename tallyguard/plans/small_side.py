"""Attach per-group values to rows without trusting that the groups are few or even.

A per-group table is broadcast only after its size has been checked. Beyond the bound, the hot groups
(at most ``HOT_GROUPS`` of them can each hold more than 1/``HOT_GROUPS`` of the rows) are broadcast and
every other group meets its rows in a shuffle join in which the rows of hot groups are spread out. Rows whose key
is surely none of the groups', as a broadcast bitmap of key hashes tells, stay out of that shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyguard.plans.scratch import write_once

#: most rows that a per-group table may have to be broadcast whole
BROADCAST_ROWS = 50_000
#: and the most memory it may take
BROADCAST_BYTES = 32 << 20
#: a group is hot when it holds more than one part in this many of all rows
HOT_GROUPS = 20_000
#: bits per group and most bits (16 MB) of the bitmap of key hashes; it is left out where bits would be fewer than two per group
BITS_PER_GROUP, MAX_BITS = 32, 1 << 27
#: 64-bit numbers that one of Spark's bitmaps (32,768 bits) is cut into
BITMAP_WORDS = 512


def bounded(df: DataFrame, max_rows: int | None = None) -> DataFrame | None:
    """``df`` as a local table if it has at most ``max_rows`` rows and ``BROADCAST_BYTES``, else None."""
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), to_arrow_schema(df.schema).types)]
    if not rows:
        return df.sparkSession.createDataFrame([], df.schema)
    if sum(column.nbytes for column in columns) > BROADCAST_BYTES:
        return None
    # by way of Arrow it becomes a local relation, which Spark plans without tasks of its own
    return df.sparkSession.createDataFrame(pa.table(columns, names=df.columns), df.schema)


def settle(df: DataFrame, label: str = "groups", max_rows: int | None = None) -> DataFrame:
    """A small aggregate as a local table, a large one as a written table: computed once either way."""
    written = write_once(df, label)
    small = bounded(written, max_rows)
    return small if small is not None else written


def _maybe_grouped(df: DataFrame, groups: DataFrame, keys: list[str], rows: int) -> DataFrame | None:
    """``df`` with ``_maybe``: false only for rows that match no group. None if a bitmap would tell little."""
    size = 1 << 15
    while size < min(rows * BITS_PER_GROUP, MAX_BITS):
        size <<= 1
    if size < 2 * rows:
        return None
    place = F.pmod(F.xxhash64(F.lit("bit"), *keys), F.lit(size)) + 1
    bitmaps = groups.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )
    # eight bytes a number, the first one highest, so that a row looks up its bit without making texts
    word = lambda i: F.conv(F.hex(F.substr("_bitmap", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = bitmaps.select("_bucket", F.transform(F.sequence(F.lit(0), F.lit(BITMAP_WORDS - 1)), word).alias("_words"))
    bit = F.bitmap_bit_position(F.col("_place")).cast("int")
    placed = df.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    found = F.getbit(F.get("_words", F.shiftright(bit, 6)), bit.bitwiseAND(63).bitwiseXOR(56))
    known = F.coalesce(found == 1, F.lit(False))
    return placed.join(F.broadcast(words), "_bucket", "left").select(*df.columns, known.alias("_maybe"))


def attach_group_values(
    df: DataFrame,
    groups: DataFrame,
    keys: list[str],
    rows_col: str,
    spread_on: str,
    how: str = "left",
    max_rows: int | None = None,
    hot_groups: int | None = None,
    settled: bool = False,
) -> DataFrame:
    """Join one-row-per-group ``groups`` to ``df`` on ``keys``; ``how`` is left or inner.

    ``rows_col`` is the row count of each group and ``spread_on`` a high-cardinality column of ``df``.
    Rows with a null key match nothing. ``settled`` says that ``groups`` is a local or a written table. Beyond the
    bound a left join reads ``df`` twice, so it should be a stored table or cheap to derive from one.
    """
    groups = groups if settled else write_once(groups, "groups")
    small = bounded(groups, max_rows)
    if small is not None:
        return df.join(F.broadcast(small), keys, how)

    hot_limit = hot_groups or HOT_GROUPS
    facts = groups.agg(F.sum(rows_col), F.count(F.lit(1))).first()
    total = facts[0]
    values = [name for name in groups.columns if name not in keys]
    told = _maybe_grouped(df, groups, keys, facts[1])
    candidates = df if told is None else told.where("_maybe").drop("_maybe")
    hot = groups.where(F.col(rows_col) * F.lit(hot_limit) > F.lit(total)).select(
        *keys, *[F.col(name).alias(f"_hot_{name}") for name in values]
    )
    unmatchable = F.lit(False)
    for key in keys:
        unmatchable = unmatchable | F.col(key).isNull()
    spread = F.xxhash64(F.lit("spread"), F.col(spread_on))
    routed = candidates.join(F.broadcast(hot), keys, "left").withColumn(
        "_route",
        F.when(F.col(f"_hot_{rows_col}").isNotNull() | unmatchable, spread).otherwise(F.xxhash64(*keys)),
    )
    cold = groups.withColumn("_route", F.xxhash64(*keys))
    joined = routed.join(cold, [*keys, "_route"], "left").select(
        *df.columns,
        *[F.coalesce(F.col(name), F.col(f"_hot_{name}")).alias(name) for name in values],
    )
    if how == "inner":
        return joined.where(F.col(rows_col).isNotNull())
    if told is None:
        return joined
    nothing = [F.lit(None).cast(groups.schema[name].dataType).alias(name) for name in values]
    return joined.unionByName(told.where(~F.col("_maybe")).select(*df.columns, *nothing))
