from __future__ import annotations

import pickle
import subprocess
import sys

import numpy as np
import pytest
from conftest import SMALL
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyguard.config import DEFAULT
from tallyguard.operators import forest
from tallyguard.operators.features import add_features


@pytest.fixture(scope="module")
def featured(spark):
    return add_features(contract._workspace(spark, SMALL).flagged)


@pytest.fixture(scope="module")
def grown(featured):
    return forest.fit_forest(featured)


def test_shape(grown):
    assert len(grown.trees) == DEFAULT.forest_trees and grown.depth == 8 and grown.sample_rows == 256
    assert max(len(tree[0]) for tree in grown.trees) < 2 * 256


def test_verdicts(featured, grown):
    rows = forest.score_forest(featured, grown)
    n = featured.count()
    row = rows.agg(
        F.sum("ml_iso_forest_flag").alias("hits"),
        F.min("ml_anomaly_score").alias("low"),
        F.max("ml_anomaly_score").alias("high"),
    ).first()
    assert (row["low"], row["high"]) == (0.0, 100.0)
    assert 0.035 * n < row["hits"] <= np.ceil(DEFAULT.contamination * n)


def test_extremes_rank_high(featured, grown):
    scored = forest.raw_scores(featured, grown)
    median = scored.agg(F.median("ml_raw_score")).first()[0]
    top = scored.orderBy(F.desc("amount")).limit(20).agg(F.min("ml_raw_score")).first()[0]
    assert top > median


def test_partitions_do_not_matter(featured, grown):
    again = forest.fit_forest(featured.repartition(5))
    for one, two in zip(grown.trees, again.trees):
        assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_saved_forest_scores_alike(spark, featured, grown, tmp_path):
    grown.to_frame(spark).write.parquet(str(tmp_path / "forest"))
    loaded = forest.load_forest(spark.read.parquet(str(tmp_path / "forest")))
    pair = featured.select(forest.path_score(grown).alias("a"), forest.path_score(loaded).alias("b"))
    assert pair.where("a <> b").count() == 0


@pytest.mark.parametrize("rows", [300, 2_000, 60_000])
def test_trees_draw_from_all_rows(spark, rows):
    frame = spark.range(rows).select(F.concat(F.lit("T"), "id").alias("transaction_id"), "id")
    drawn = forest._tree_samples(frame, "transaction_id", rows, DEFAULT)
    sizes = {r["tree"]: r["count"] for r in drawn.groupBy("tree").count().collect()}
    need = min(rows, DEFAULT.forest_sample)
    assert sizes == dict.fromkeys(range(DEFAULT.forest_trees), need)
    assert drawn.distinct().count() == drawn.count()
    used = drawn.select("id").distinct()
    if rows > 40_000:  # far more than a pool: the trees hardly share rows, and come from the whole range
        assert used.count() > 0.7 * need * DEFAULT.forest_trees
        tenths = used.groupBy((F.col("id") * 10 / rows).cast("int").alias("k")).count().collect()
        assert len(tenths) == 10 and max(t["count"] for t in tenths) < 1.2 * min(t["count"] for t in tenths)


def test_large_ledgers(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"),
        *[(F.xxhash64("id", F.lit(k)) % 1000).cast("double").alias(name) for k, name in enumerate(DEFAULT.features)],
    )
    grown = forest.fit_forest(rows)
    assert len(grown.trees) == DEFAULT.forest_trees
    assert forest.raw_scores(rows, grown).where("ml_raw_score between 0 and 1").count() == 20_000


def test_equal_rows_score_zero(spark):
    rows = spark.range(50).select(
        F.col("id").cast("string").alias("transaction_id"), *[F.lit(1.0).alias(name) for name in DEFAULT.features]
    )
    found = forest.score_forest(rows, forest.fit_forest(rows)).agg(
        F.max("ml_anomaly_score"), F.sum("ml_iso_forest_flag")
    ).first()
    assert tuple(found) == (0.0, 0)


def test_average_path():
    assert forest.average_path(1) == 0.0 and forest.average_path(2) == 1.0
    assert forest.average_path(256) == pytest.approx(10.24, abs=0.01)


def test_constant_feature_keeps_scale_one(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = forest.standardize(df, ["a", "b"]).orderBy("a").collect()
    assert [(r["a_std"], r["b_std"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_tree_code_needs_no_package_on_executors(tmp_path):
    """What Spark ships to a worker must load where only numpy and pandas are installed."""
    points = np.array([[0.0, 1.0], [1.0, 1.0], [9.0, 1.0]])
    work = cloudpickle.dumps((forest._grow, (points, 42, 0, 2)))
    (tmp_path / "work.pkl").write_bytes(work)
    script = (
        "import pickle, sys; f, a = pickle.load(open('work.pkl', 'rb')); assert len(f(*a)) == 4; "
        "assert 'tallyguard' not in sys.modules"
    )
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, check=True)
    assert pickle.loads(work)[0](*pickle.loads(work)[1])[2][0] == 1
