"""Merkle tree over a table's rows, by sibling-shift self-joins.

Each row is a leaf, the hash of its columns. The leaves of one source, in the order of doc_id, are the lowest nodes of
its tree; ``width`` consecutive nodes (the last run: what is left) become one parent until one node remains, the
subroot. The subroots, in the order of source, are the lowest nodes of the tree that ends in the root.

A node's index gives its run (index / ``width``) and its slot in it. On every level the nodes of slot zero are
equijoined with their siblings, one join for each offset to a slot, and emit the parent. Nodes shrink by ``width`` from
level to level; each level is one written table of runs, and keys are (tree, run), so that no tree, however large,
meets in one task. Indices come from two-level numbering: ranges of (source, doc_id) number their own rows, and the
rows before each range are added. The way down joins each level with the one above it and hands every leaf the siblings
on its path; a path grows with the logarithm of the rows only.

Hashes are lower-case hex SHA-256 of inputs concatenated; tables hold them as 32 bytes. Trees have an own key: empty
for a null source, else ``s`` and the source, which sorts null first and then by UTF-8 bytes.

Defined cases: a null value of any column is hashed as ``-`` (a null source is a source of its own); rows of one doc_id
and source are ordered by their leaves, null doc_ids first; repeated rows are leaves of their own; a source with one
row has its leaf as subroot, a table with one source its subroot as root; an empty table gives no rows; columns that
are not named are not hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.plans.ordered import ordered_windows
from tallyguard.plans.scratch import write_once

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: binary, right: binary>>"


def measured(value: str | Column) -> Column:
    """A value with its length before it, ``-`` for null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: tuple[str, ...], **instead: Column) -> Column:
    """Hash of a row, as hex; ``instead`` replaces values of columns."""
    return F.sha2(F.concat(*[measured(instead.get(c, c)) for c in columns]), 256)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _hash(*digests: Column) -> Column:
    """Hash of digests (bytes; null: none) as bytes."""
    return F.unhex(F.sha2(F.concat(*[F.coalesce(_hex(d), F.lit("")) for d in digests]), 256))


def _numbered(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``idx`` from 0 along ``order`` in each group; rows alike in all of it may spread."""
    tied = write_once(nodes.withColumn("_tie", F.monotonically_increasing_id()), "merkle-tied")
    numbered = ordered_windows(tied, [group], [*order, "_tie"], number="idx").drop("_tie")
    return write_once(numbered.withColumn("idx", F.col("idx") - 1), "merkle-nodes")


def _runs(nodes: DataFrame, width: int) -> DataFrame:
    """One row per run of siblings: ``tree``, ``run``, ``h0`` ... and ``done`` for a tree's only node."""
    placed = nodes.select("tree", F.floor(F.col("idx") / width).alias("run"), (F.col("idx") % width).alias("slot"), "hash")
    runs = placed.filter("slot = 0").select("tree", "run", F.col("hash").alias("h0"))
    for offset in range(1, width):  # the sibling at this offset from slot zero
        sibling = placed.filter(F.col("slot") == offset).select("tree", "run", F.col("hash").alias(f"h{offset}"))
        runs = runs.join(sibling, ["tree", "run"], "left")
    return runs.withColumn("done", (F.col("run") == 0) & F.col("h1").isNull())


def _climb(nodes: DataFrame, width: int) -> list[DataFrame]:
    """The runs of all levels, leaves first, each a written table."""
    levels = []
    while True:
        levels.append(write_once(_runs(nodes, width), "merkle-runs"))
        open_ = levels[-1].filter("NOT done")
        if open_.isEmpty():
            return levels
        parent = _hash(*[F.col(f"h{k}") for k in range(width)])
        nodes = open_.select("tree", F.col("run").alias("idx"), parent.alias("hash"))


def _path(slot: Column, width: int) -> Column:
    """Path of the node in a slot of a run that knows its parent's path (``above``)."""

    def siblings(slots: list[int]) -> Column:
        return F.concat(F.lit(b""), *[F.coalesce(F.col(f"h{k}"), F.lit(b"")) for k in slots])

    steps = [
        F.struct(siblings(list(range(k))).alias("left"), siblings(list(range(k + 1, width))).alias("right")) for k in range(width)
    ]
    step = steps[-1]
    for k in range(width - 2, -1, -1):
        step = F.when(slot == k, steps[k]).otherwise(step)
    return F.when(F.col("done"), F.col("above")).otherwise(F.concat(F.array(step), "above"))


def _descend(levels: list[DataFrame], tops: DataFrame, width: int) -> DataFrame:
    """The runs of leaves, with ``above``: siblings from their parent upwards. ``tops``: tree, path of its root."""
    below = None
    for level in reversed(levels):
        found = level.filter("done").join(tops, "tree")
        if below is not None:
            over = below.withColumnRenamed("run", "_over")
            lower = level.filter("NOT done").select("tree", "run", *[F.col(f"h{k}").alias(f"_h{k}") for k in range(width)], "done")
            joined = lower.drop("done").withColumn("_over", F.floor(F.col("run") / width)).join(over, ["tree", "_over"])
            joined = joined.select(
                "tree",
                "run",
                *[F.col(f"_h{k}").alias(f"h{k}") for k in range(width)],
                F.lit(False).alias("done"),
                _path(F.col("run") % width, width).alias("above"),
            )
            found = joined.unionByName(found)
        below = write_once(found, "merkle-paths")
    return below


def _with_paths(nodes: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """``nodes`` with the ``path`` of each: its siblings (left and right of it) on every level up to the root."""
    placed = nodes.withColumn("run", F.floor(F.col("idx") / width)).withColumn("_slot", F.col("idx") % width)
    joined = placed.join(runs, ["tree", "run"])
    return joined.select(*nodes.columns, _path(F.col("_slot"), width).alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf (hex) and a path give, as hex."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))


def proof_digest(path: Column) -> Column:
    """Hash of a path's siblings in a row."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), ""), 256)


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    width: int = 3,
    source: str = "source",
    claimed: Column | None = None,
) -> DataFrame:
    """Every row's ``doc_id``, ``leaf``, ``subroot``, ``root`` (hex) and ``path``.

    ``claimed`` is a second hash (hex) of each row, carried along: what someone says the leaf is.
    """
    if width < 2:
        raise ValueError("a parent needs at least two slots")
    tree = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))
    leaf = leaf_of(columns)
    leaves = docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf).alias("hash"),
        F.unhex(leaf if claimed is None else claimed).alias("claimed"),
    )
    leaves = _numbered(leaves.withColumn("known", F.col("doc_id").isNotNull()), "tree", ["known", "doc_id", "hash"]).drop("known")
    levels = _climb(leaves.select("tree", "idx", "hash"), width)
    ends = [level.filter("done").select(F.col("tree").alias("source_tree"), F.col("h0").alias("hash")) for level in levels]
    subroots = ends[0]
    for end in ends[1:]:
        subroots = subroots.unionByName(end)
    subroots = _numbered(subroots.withColumn("tree", F.lit("")), "tree", ["source_tree"])
    upper = _climb(subroots.select("tree", "idx", "hash"), width)
    last = upper[-1].filter("done").first()
    root = None if last is None else last["h0"].hex()
    spark = docs.sparkSession
    nothing = spark.range(1).select(F.lit("").alias("tree"), F.array().cast(PATH).alias("above"))
    subroots = write_once(_with_paths(subroots, _descend(upper, nothing, width), width), "merkle-subroots")
    tops = subroots.select(F.col("source_tree").alias("tree"), F.col("path").alias("above"))
    runs = _descend(levels, tops, width)
    named = subroots.select(F.col("source_tree").alias("tree"), F.col("hash").alias("subroot"))
    rows = _with_paths(leaves, runs, width).join(named, "tree")
    return rows.select(
        "doc_id", _hex(F.col("hash")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), F.lit(root).alias("root"), "path",
        _hex(F.col("claimed")).alias("claimed"),
    )
