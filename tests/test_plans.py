"""The skew-safe plan helpers against brute force, with their large-data paths forced on small data."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyguard.plans import small_side
from tallyguard.plans.ordered import ordered_windows
from tallyguard.plans.quantiles import approx_quantiles, exact_quantiles, order_statistics
from tallyguard.plans.scratch import shared_root
from tallyguard.plans.small_side import attach_group_values, bounded, settle
from tallyguard.session import TASK_BYTES, bound_tasks


@pytest.fixture(scope="module")
def skewed() -> pd.DataFrame:
    """A third of the rows in one group, the rest in many small ones, and rows without a group."""
    rng = np.random.default_rng(7)
    n = 3000
    group = np.where(np.arange(n) % 3 == 0, "hot", [f"g{k}" for k in rng.integers(0, 400, n)])
    group = np.where(np.arange(n) % 50 == 1, None, group)
    return pd.DataFrame(
        {
            "id": [f"r{k:05d}" for k in range(n)],
            "grp": group,
            "day": rng.integers(0, 5, n),
            "cents": rng.integers(1, 10_000, n),
            "amount": np.round(rng.lognormal(7, 2, n), 2),
        }
    )


def test_bounded(spark):
    assert bounded(spark.range(5), 5).count() == 5
    assert bounded(spark.range(6), 5) is None
    assert settle(spark.range(6), max_rows=5).count() == 6


def test_tasks_are_bounded_unless_the_session_names_sizes(spark):
    split, piece = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    fresh = spark.newSession()
    fresh.conf.unset(piece)
    fresh.conf.set(split, "5m")
    bound_tasks(fresh)
    assert fresh.conf.get(split) == "5m" and fresh.conf.get(piece) == str(TASK_BYTES[piece])


def test_scratch_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rows_of_no_group_stay_out_of_the_shuffle(spark, skewed):
    """Only rows whose key may be a group's are dealt by key; before, every row was."""
    df = spark.createDataFrame(skewed).withColumn("half", F.when(F.col("day") != 2, F.col("day") / 2))
    keys = ["grp", "half"]
    groups = df.where("grp in ('g1', 'g2', 'g7')").groupBy(*keys).agg(F.count("*").alias("n")).na.drop()
    told = {r["id"]: r for r in small_side._maybe_grouped(df, groups, keys, groups.count()).collect()}
    wanted = {(r["grp"], r["half"]): r["n"] for r in groups.collect()}
    inside = {k for k, r in told.items() if (r["grp"], r["half"]) in wanted}
    maybe = {k for k, r in told.items() if r["_maybe"]}
    assert len(told) == len(skewed) and inside and inside <= maybe and len(maybe) < len(inside) + 0.1 * len(skewed)
    for how in ("left", "inner"):
        found = attach_group_values(df, groups, keys, "n", "id", how, max_rows=1, settled=True).collect()
        assert len(found) == (len(skewed) if how == "left" else len(inside))
        assert all(r["n"] == wanted.get((r["grp"], r["half"])) for r in found)
    assert small_side._maybe_grouped(df, groups, keys, small_side.MAX_BITS) is None


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("max_rows", [None, 10])
def test_attach_group_values(spark, skewed, how, max_rows):
    df = spark.createDataFrame(skewed)
    groups = df.where("grp is not null").groupBy("grp").agg(F.count("*").alias("n"), F.max("amount").alias("top"))
    found = attach_group_values(df, groups, ["grp"], "n", "id", how, max_rows=max_rows, hot_groups=20)
    want = skewed.dropna(subset=["grp"]).groupby("grp")["amount"].agg(["size", "max"])
    rows = {r["id"]: r for r in found.collect()}
    kept = skewed if how == "left" else skewed.dropna(subset=["grp"])
    assert set(rows) == set(kept["id"])
    for record in kept.itertuples():
        row = rows[record.id]
        if record.grp is None:
            assert row["n"] is None and row["top"] is None
        else:
            assert (row["n"], row["top"]) == tuple(want.loc[record.grp])


def test_hot_groups_leave_the_shuffle_key(spark, skewed):
    """Beyond the broadcast bound, rows of the hot group do not share a join key."""
    df = spark.createDataFrame(skewed)
    groups = df.where("grp is not null").groupBy("grp").agg(F.count("*").alias("n"))
    joined = attach_group_values(df, groups, ["grp"], "n", "id", "left", max_rows=10, hot_groups=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_route" in plan
    assert small_side.HOT_GROUPS <= 50_000


def _expected(frame: pd.DataFrame) -> pd.DataFrame:
    ordered = frame.sort_values(["day", "id"])
    groups = ordered.groupby("grp", dropna=False)
    return ordered.assign(
        number=groups.cumcount() + 1,
        total=groups["cents"].cumsum(),
        before=groups["cents"].shift(1),
        after=groups["cents"].shift(-1),
    ).set_index("id")


@pytest.mark.parametrize("hot", [False, True])
def test_ordered_windows(spark, skewed, many_parts, hot):
    frame = skewed.assign(grp="all") if hot else skewed
    found = ordered_windows(
        spark.createDataFrame(frame),
        ["grp"],
        ["day", "id"],
        number="number",
        running={"total": "cents"},
        lag={"before": "cents"},
        lead={"after": "cents"},
    )
    got = found.toPandas().set_index("id")
    want = _expected(frame).loc[got.index]
    assert (got["number"] == want["number"]).all() and (got["total"] == want["total"]).all()
    for name in ("before", "after"):
        pd.testing.assert_series_equal(got[name].astype(float), want[name].astype(float), check_names=False)


def test_ordered_windows_without_groups(spark, many_parts):
    found = ordered_windows(spark.range(100).withColumn("v", -F.col("id")), [], ["v"], number="k")
    assert {r["id"]: r["k"] for r in found.collect()} == {n: 100 - n for n in range(100)}


def test_lag_keeps_real_nulls(spark, many_parts):
    rows = [(n, None if n % 2 else n) for n in range(40)]
    df = spark.createDataFrame(rows, "id int, v int").withColumn("g", F.lit("x"))
    found = ordered_windows(df, ["g"], ["id"], lag={"p": "v"}, lead={"f": "v"}).orderBy("id").collect()
    values = [v for _, v in rows]
    assert [r["p"] for r in found] == [None, *values[:-1]]
    assert [r["f"] for r in found] == [*values[1:], None]


@pytest.mark.parametrize("max_rows", [None, 3])
def test_exact_quantiles(spark, skewed, max_rows):
    wanted = {"q25": 0.25, "median": 0.5, "q955": 0.955}
    df = spark.createDataFrame(skewed).where("grp is not null")
    got = exact_quantiles(df, "amount", wanted, ["grp"], max_rows=max_rows).toPandas().set_index("grp")
    for group, part in skewed.dropna(subset=["grp"]).groupby("grp"):
        assert got.loc[group, "n"] == len(part)
        for name, q in wanted.items():
            assert got.loc[group, name] == pytest.approx(part["amount"].quantile(q), rel=1e-12)


def test_quantiles_of_ties_signs_and_nothing(spark):
    df = spark.createDataFrame([(v,) for v in (-3.0, -1.5, 0.0, 0.0, 2.0, 2.0, 2.0, None)], "v double")
    row = exact_quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 1.0}).first()
    assert tuple(row) == (7, -3.0, -0.75, 0.0, 2.0)
    assert exact_quantiles(df.where("v > 5"), "v", {"a": 0.5}).first()["a"] is None
    four = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 8.0)], "v double")
    assert tuple(exact_quantiles(four, "v", {"a": 0.25, "b": 0.5, "c": 0.75}).first()) == (4, 1.75, 3.0, 5.0)
    assert approx_quantiles(four, "v", {"b": 0.5}).first()["n"] == 4


def test_order_statistics_counts_below(spark):
    df = spark.createDataFrame([("a", v) for v in (5.0, 1.0, 5.0, 5.0, 9.0)], "g string, v double")
    row = order_statistics(df, "v", ["g"], {"third": lambda n: F.lit(2)}).first()
    assert (row["value"], row["below"], row["n"]) == (5.0, 1, 5)
