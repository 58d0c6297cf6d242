"""Isolation forest (Liu, Ting and Zhou, "Isolation Forest", ICDM 2008) on Spark.

Each tree is grown from its own small sample in a grouped map, and rows are scored batch by batch with numpy. Samples,
split features and split points come from MD5 digests of the seed, the tree and the row id or the node, never from
partitions or a generator's state, so that any engine that knows MD5 grows the same trees. Path lengths are whole
numbers of 1e-9 and add up alike in any order.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, FOREST_FEATURES, AuditConfig
from tallyguard.functions.money import flag
from tallyguard.plans.quantiles import exact_quantiles
from tallyguard.plans.scratch import write_once

# the functions of this module travel to the executors as code, which need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: hexadecimal digits of a digest that are used, and how many values they have: exact in a double
_DIGITS = 13
_HASH_RANGE = float(16**_DIGITS)
#: path lengths are counted in parts of one step
PATH_UNITS = 1e9
_EULER = 0.5772156649015329


@dataclass(frozen=True)
class Scaling:
    """Mean and scale per feature; a constant feature has scale 1."""

    mean: dict[str, float]
    scale: dict[str, float]

    def apply(self, name: str) -> Column:
        return (F.col(name) - F.lit(self.mean[name])) / F.lit(self.scale[name])


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays. A leaf points to itself, so every row can take the same number of steps."""

    features: tuple[str, ...]
    scaling: Scaling
    trees: tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], ...]
    depth: int
    sample_rows: int

    def to_frame(self, spark) -> DataFrame:
        """One row per tree, to be saved and scored with later."""
        rows = [
            (
                number,
                self.depth,
                self.sample_rows,
                list(self.features),
                [self.scaling.mean[f] for f in self.features],
                [self.scaling.scale[f] for f in self.features],
                *[part.tolist() for part in tree],
            )
            for number, tree in enumerate(self.trees)
        ]
        return spark.createDataFrame(rows, SAVED_SCHEMA)


SAVED_SCHEMA = (
    "tree int, depth int, sample_rows int, features array<string>, means array<double>, scales array<double>, "
    "feature array<int>, threshold array<double>, left array<int>, path array<double>"
)
_TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, left array<int>, path array<double>"


def load_forest(saved: DataFrame) -> Forest:
    """A forest from the table that ``Forest.to_frame`` saved; one bounded row per tree."""
    rows = saved.orderBy("tree").collect()
    names = tuple(rows[0]["features"])
    scaling = Scaling(dict(zip(names, rows[0]["means"])), dict(zip(names, rows[0]["scales"])))
    return Forest(names, scaling, tuple(_arrays(row) for row in rows), rows[0]["depth"], rows[0]["sample_rows"])


def _arrays(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.asarray(row["feature"], dtype=np.int64),
        np.asarray(row["threshold"], dtype=np.float64),
        np.asarray(row["left"], dtype=np.int64),
        np.asarray(row["path"], dtype=np.float64),
    )


def average_path(rows: float) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of that many rows."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + _EULER) - 2.0 * (rows - 1.0) / rows


def feature_scaling(df: DataFrame, features: Sequence[str] = FOREST_FEATURES, digits: int = 17) -> Scaling:
    """Mean and population deviation of every feature in one aggregate.

    The order in which partial sums meet shows in the last digits only; fewer ``digits`` hide it.
    """
    moments = df.agg(
        *[F.avg(name).alias(f"m_{name}") for name in features],
        *[F.stddev_pop(name).alias(f"s_{name}") for name in features],
    ).first()

    def kept(value: float | None) -> float:
        return float(f"{value or 0.0:.{digits}g}")

    mean = {name: kept(moments[f"m_{name}"]) for name in features}
    scale = {name: kept(moments[f"s_{name}"]) or 1.0 for name in features}
    return Scaling(mean, scale)


def standardize(df: DataFrame, features: Sequence[str] = FOREST_FEATURES) -> DataFrame:
    """Features with mean 0 and deviation 1, as ``<name>_std``."""
    scaling = feature_scaling(df, features)
    return df.withColumns({f"{name}_std": scaling.apply(name) for name in features})


def _unit_hash(*columns: Column) -> Column:
    """Uniform in [0, 1) from the digest of the columns, joined by colons."""
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") / F.lit(_HASH_RANGE)


def _digest(*parts) -> int:
    """The same digits of the same digest, outside of Spark."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:_DIGITS], 16)


def _tree_samples(df: DataFrame, id_col: str, rows: int, config: AuditConfig) -> DataFrame:
    """(tree, row) pairs: ``forest_sample`` rows per tree without replacement, or all rows if there are fewer.

    Every tree draws from all rows. Each row has one uniform place on a circle, and tree ``t`` of ``T`` looks at the
    arc that starts at ``t / T`` and holds four times the rows it needs on average, so which trees look at a row
    follows by arithmetic. Of its candidates a tree takes those with the lowest hash of its own.
    """
    seed, sample, trees = config.forest_seed, config.forest_sample, config.forest_trees
    share = min(1.0, 4.0 * sample / rows)
    place = _unit_hash(F.lit(seed), F.col(id_col)) * trees
    # trees whose arc [t, t + share * T) holds the place, on the circle: at most T of them
    last = F.floor(place).cast("long")
    first = F.greatest(F.ceil(place - share * trees).cast("long"), last - (trees - 1))
    looking = F.when(first <= last, F.sequence(first, last))  # the condition keeps it safe beside the filter, too
    candidates = df.where(first <= last).withColumn("tree", F.explode(looking)).withColumn(
        "tree", F.pmod(F.col("tree"), F.lit(trees)).cast("int")
    )
    candidates = candidates.withColumn("_draw", _unit_hash(F.lit(seed), F.col("tree"), F.col(id_col)))
    lowest = Window.partitionBy("tree").orderBy("_draw", id_col)
    return (
        candidates.withColumn("_place", F.row_number().over(lowest))
        .where(F.col("_place") <= sample)
        .drop("_place", "_draw")
    )


def _grow(points: np.ndarray, seed: int, tree: int, depth_limit: int):
    """One tree, breadth first; the two children of a node are neighbours in the arrays.

    What is drawn at a node depends on its number: 1 for the root, 2n and 2n + 1 for the children of n.
    """
    feature, threshold, left, path = [0], [np.inf], [0], [0.0]
    queue = [(0, 1, points, 0)]
    while queue:
        node, number, inside, depth = queue.pop(0)
        low, high = inside.min(axis=0), inside.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= depth_limit or len(inside) <= 1 or len(open_features) == 0:
            left[node] = node
            path[node] = float(round((depth + average_path(len(inside))) * PATH_UNITS))
            continue
        chosen = int(open_features[_digest(seed, tree, number, "feature") % len(open_features)])
        share = _digest(seed, tree, number, "cut") / _HASH_RANGE
        cut = float(low[chosen] + share * (high[chosen] - low[chosen]))
        goes_right = inside[:, chosen] > cut
        feature[node], threshold[node], left[node] = chosen, cut, len(feature)
        for side, part in enumerate((inside[~goes_right], inside[goes_right])):
            queue.append((len(feature), 2 * number + side, part, depth + 1))
            feature.append(0)
            threshold.append(np.inf)
            left.append(0)
            path.append(0.0)
    return feature, threshold, left, path


def fit_forest(df: DataFrame, id_col: str = "transaction_id", config: AuditConfig = DEFAULT) -> Forest:
    """Grow the trees in parallel and bring back their nodes (fewer than ``2 * forest_sample`` per tree)."""
    features = tuple(config.features)
    moments = df.agg(F.count(F.lit(1)).alias("n")).first()
    sample_rows = min(config.forest_sample, moments["n"])
    if sample_rows == 0:
        raise ValueError("cannot fit a forest on an empty ledger")
    depth_limit = math.ceil(math.log2(max(sample_rows, 2)))
    scaling = feature_scaling(df, features, digits=10)
    scaled = df.select(id_col, *[scaling.apply(name).alias(name) for name in features])
    samples = _tree_samples(scaled, id_col, moments["n"], config)
    seed = config.forest_seed

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(id_col)
        tree = int(key[0])
        if len(rows) != sample_rows:  # out of reach for samples of this size; scores would be off
            raise ValueError(f"tree {tree} drew {len(rows)} of {sample_rows} rows")
        parts = _grow(rows[list(features)].to_numpy(dtype=np.float64), seed, tree, depth_limit)
        names = ("feature", "threshold", "left", "path")
        return pd.DataFrame({"tree": [tree], **{name: [part] for name, part in zip(names, parts)}})

    grown = samples.groupBy("tree").applyInPandas(grow, _TREE_SCHEMA).orderBy("tree").collect()
    return Forest(features, scaling, tuple(_arrays(row) for row in grown), depth_limit, sample_rows)


def path_score(forest: Forest) -> Column:
    """Anomaly score in (0, 1) of a row: 2 to the power of minus mean path over expected path."""
    trees, depth = forest.trees, forest.depth
    expected = average_path(forest.sample_rows) or 1.0

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        rows = len(columns[0])
        values = np.concatenate([column.to_numpy(dtype=np.float64) for column in columns])
        position = np.arange(rows)
        total = np.zeros(rows)
        for feature, threshold, left, path in trees:
            offset = feature * rows
            node = np.zeros(rows, dtype=np.int64)
            for _ in range(depth):
                goes_right = values.take(offset.take(node) + position) > threshold.take(node)
                node = left.take(node) + goes_right
            total += path.take(node)
        return pd.Series(np.exp2(-(total / PATH_UNITS / len(trees)) / expected))

    return score(*[forest.scaling.apply(name) for name in forest.features])


def raw_scores(df: DataFrame, forest: Forest, name: str = "ml_raw_score") -> DataFrame:
    return df.withColumn(name, path_score(forest))


@dataclass(frozen=True)
class Calibration:
    """The cut above which a row is flagged, and the range that maps to 0..100."""

    cut: float
    low: float
    high: float


def calibrate(scored: DataFrame, config: AuditConfig = DEFAULT, name: str = "ml_raw_score") -> Calibration:
    """Exact upper quantile and range of the scores; ``scored`` should be a written table."""
    cut = exact_quantiles(scored, name, {"cut": 1.0 - config.contamination}, resolution=65536).first()["cut"]
    ends = scored.agg(F.min(name).alias("low"), F.max(name).alias("high")).first()
    return Calibration(cut, ends["low"], ends["high"])


def with_verdict(scored: DataFrame, calibration: Calibration, name: str = "ml_raw_score") -> DataFrame:
    """Flag strictly above the cut, and the score from 0 to 100 with one decimal; equal scores all give 0."""
    span = calibration.high - calibration.low
    if span > 0:
        scaled = F.bround((F.col(name) - calibration.low) / span * 100.0, 1)
    else:
        scaled = F.when(F.col(name).isNotNull(), F.lit(0.0))
    return scored.withColumns(
        {"ml_iso_forest_flag": flag(F.col(name) > calibration.cut), "ml_anomaly_score": scaled}
    )


def score_forest(df: DataFrame, forest: Forest, config: AuditConfig = DEFAULT) -> DataFrame:
    """``df`` with ``ml_iso_forest_flag`` and ``ml_anomaly_score``.

    The Python scores are computed once and written; threshold and range then read one column.
    """
    scored = write_once(raw_scores(df, forest), "scored")
    return with_verdict(scored, calibrate(scored, config)).drop("ml_raw_score")
