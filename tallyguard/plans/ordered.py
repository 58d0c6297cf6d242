"""Ordered windows over groups of any size.

A plain window puts each group in one task. Here large groups are cut into pieces along their order, at bounds taken
from a sample, and one shuffle deals rows by (group, piece). Each piece numbers, sums and looks around locally; what
it must know of its neighbours is one row per piece, added up with map-side combine and broadcast. There are about as
many pieces as shuffle partitions, or one for each ``PIECE_ROWS`` rows if that is more, so these tables are small.

The input is read up to four times (rows, sample, facts of pieces, windows) and shuffled once: it should be a stored
table, or cheap to derive from one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.plans.scratch import write_once

#: about how many rows a piece of a large group may have at most
PIECE_ROWS = 2_000_000
#: sampled rows for each piece
SAMPLES = 16


def _bounds(df: DataFrame, group: list[str], order: list[str], rows: int) -> DataFrame | None:
    """``_bounds`` of each group that is to be cut: the positions at which its later pieces begin; None if none is.

    ``_before`` are the sampled positions before these: a piece's last row is none before its own.
    """
    wanted = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / PIECE_ROWS))
    share = min(1.0, SAMPLES * wanted / max(rows, 1))
    drawn = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = df.where(drawn).select(*group, F.struct(*order).alias("_position"))
    drawn = sample.groupBy(*group).agg(F.sort_array(F.collect_list("_position")).alias("_drawn"))
    found = drawn.select(
        *group,
        F.filter("_drawn", lambda p, i: i % SAMPLES == SAMPLES - 1).alias("_bounds"),
        F.filter("_drawn", lambda p, i: i % SAMPLES == SAMPLES - 2).alias("_before"),
    ).where(F.size("_bounds") > 0)
    found = write_once(found, "bounds")
    return None if found.isEmpty() else found


def _cut(df: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, bool]:
    """``df`` with each row's piece (``_part``), whether its group is cut (``_spans``) and whether it may be its piece's
    first or last row (``_edge``: first rows, and about one in ``SAMPLES`` of all); whether any group is cut."""
    bounds = _bounds(df, group, order, df.count())
    if bounds is None:
        return df.withColumns({"_part": F.lit(0), "_spans": F.lit(False), "_edge": F.lit(False)}), False
    most = bounds.agg(F.max(F.size("_bounds"))).first()[0]
    named = bounds.select("_bounds", "_before", *[F.col(name).alias(f"_cut_{name}") for name in group])
    same = [F.col(name).eqNullSafe(F.col(f"_cut_{name}")) for name in group] or [F.lit(True)]
    joined = df.join(F.broadcast(named), reduce(lambda a, b: a & b, same), "left")
    here, part = F.struct(*order), F.col("_part")
    edge = (here >= F.get("_before", part)) | (here == F.get("_bounds", part - 1))
    joined = joined.withColumn("_part", F.lit(0))
    for power in reversed(range(most.bit_length())):  # how many bounds lie at or before a row, by halves
        step = 1 << power
        joined = joined.withColumn("_part", part + F.when(F.get("_bounds", part + (step - 1)) <= here, step).otherwise(0))
    return joined.select(*df.columns, "_part", F.col("_bounds").isNotNull().alias("_spans"), edge.alias("_edge")), True


def ordered_windows(
    df: DataFrame,
    group: list[str],
    order: list[str],
    number: str | None = None,
    running: dict[str, str] | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
) -> DataFrame:
    """Add row number, running sums (integer columns), previous and next values within each group.

    ``order`` must be a total order. ``running``, ``lag`` and ``lead`` map a new column to its source.
    """
    running, lag, lead = running or {}, lag or {}, lead or {}
    rows, is_cut = _cut(df, group, order)

    # One row per piece: what the pieces after and before it need.
    inner = rows.where("_spans")
    pieces = inner.groupBy("_part", *group).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(source).alias(f"_sum_{name}") for name, source in running.items()]
    )
    position = [F.col(name) for name in order]
    ends = []
    if lag:
        tail = F.struct(*position, *[F.col(source).alias(f"v_{name}") for name, source in lag.items()])
        ends.append(F.max(tail).alias("_tail"))
    if lead:
        head = F.struct(*position, *[F.col(source).alias(f"v_{name}") for name, source in lead.items()])
        ends.append(F.min(head).alias("_head"))
    if ends:
        # only rows that may be the first or the last of a piece are compared by position; every piece has one
        edges = inner.where("_edge").groupBy("_part", *group).agg(*ends)
        if number or running:
            named = {"_part": "_end_part", **{name: f"_end_{name}" for name in group}}
            same = [F.col(name).eqNullSafe(F.col(new)) for name, new in named.items()]
            pieces = pieces.join(edges.withColumnsRenamed(named), reduce(lambda a, b: a & b, same), "left").drop(*named.values())
        else:
            pieces = edges.withColumn("_rows", F.lit(0).cast("long"))

    along = Window.partitionBy(*group).orderBy("_part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried: list[Column] = [F.sum("_rows").over(earlier).alias("_rows_before")]
    carried += [F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in running]
    carried += [F.lag(F.col(f"_tail.v_{name}")).over(along).alias(f"_edge_{name}") for name in lag]
    carried += [F.lead(F.col(f"_head.v_{name}")).over(along).alias(f"_edge_{name}") for name in lead]
    spanning = (
        pieces.select("*", *carried, F.count(F.lit(1)).over(Window.partitionBy(*group)).alias("_pieces"))
        .where(F.col("_pieces") > 1)
        .select(
            F.col("_part").alias("_span_part"),
            *[F.col(name).alias(f"_span_{name}") for name in group],
            "_rows_before",
            *[f"_before_{name}" for name in running],
            *[f"_edge_{name}" for name in [*lag, *lead]],
        )
    )

    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local: list[Column] = [F.row_number().over(inside).alias("_local_number")]
    if lead:
        local.append(F.lead(F.lit(True)).over(inside).alias("_has_next"))
    local += [F.sum(source).over(upto).alias(f"_local_{name}") for name, source in running.items()]
    local += [F.lag(source).over(inside).alias(f"_local_{name}") for name, source in lag.items()]
    local += [F.lead(source).over(inside).alias(f"_local_{name}") for name, source in lead.items()]

    placed = rows.select("*", *local)
    if is_cut:
        same_piece = [F.col("_part") == F.col("_span_part")]
        same_piece += [F.col(name).eqNullSafe(F.col(f"_span_{name}")) for name in group]
        joined = placed.join(F.broadcast(spanning), reduce(lambda a, b: a & b, same_piece), "left")
    else:
        nothing = ["_rows_before", *[f"_before_{name}" for name in running]]
        joined = placed.withColumns({name: F.lit(None).cast("long") for name in nothing})
        kinds = {name: df.schema[source].dataType for name, source in {**lag, **lead}.items()}
        joined = joined.withColumns({f"_edge_{name}": F.lit(None).cast(kind) for name, kind in kinds.items()})

    added = []
    if number:
        added.append(
            (F.col("_local_number") + F.coalesce(F.col("_rows_before"), F.lit(0))).cast("long").alias(number)
        )
    for name in running:
        before = F.coalesce(F.col(f"_before_{name}"), F.lit(0))
        added.append((F.coalesce(F.col(f"_local_{name}"), F.lit(0)) + before).alias(name))
    first = F.col("_local_number") == 1
    for name in lag:
        added.append(F.when(first, F.col(f"_edge_{name}")).otherwise(F.col(f"_local_{name}")).alias(name))
    for name in lead:
        last = F.col("_has_next").isNull()
        added.append(F.when(last, F.col(f"_edge_{name}")).otherwise(F.col(f"_local_{name}")).alias(name))
    return joined.select(*df.columns, *added)
