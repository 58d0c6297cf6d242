"""How far the detectors agree with each other and with planted labels."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.config import LOWEST_TIER
from tallyguard.functions.money import count_where, flag


def detector_flags(ml: bool = True, truth: bool = True) -> dict[str, Column]:
    """The detection layers as 0/1 expressions over the enriched ledger."""
    flags = {
        "rules": flag(F.col("risk_tier") != LOWEST_TIER),
        "iqr": F.col("stat_iqr_flag"),
        "mad": F.col("stat_zscore_flag"),
    }
    if ml:
        flags["forest"] = F.col("ml_iso_forest_flag")
    if truth:
        flags["truth"] = F.col("ground_truth_anomaly")
    return flags


def detector_correlation(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Pearson matrix of 0/1 columns in long form, rounded to 4 digits.

    All moments come from one aggregate over integer counts. A constant column has no correlation: null.
    """
    names = list(flags)
    rows = df.select(*[flags[name].cast("long").alias(name) for name in names])
    pairs = list(combinations(names, 2))
    sums = [F.sum(name).alias(f"s_{name}") for name in names]
    sums += [F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs]
    moments = rows.agg(F.count(F.lit(1)).alias("n"), *sums)

    def spread(name: str) -> Column:
        total = F.col(f"s_{name}").cast("double")
        return F.sqrt(F.col("n") * total - total * total)

    def pearson(a: str, b: str) -> Column:
        if a == b:
            return F.try_divide(spread(a), spread(a))
        both = f"p_{a}_{b}" if (a, b) in pairs else f"p_{b}_{a}"
        covered = F.col("n").cast("double") * F.col(both) - F.col(f"s_{a}").cast("double") * F.col(f"s_{b}")
        return F.try_divide(covered, spread(a) * spread(b))

    cells = [
        F.struct(F.lit(a).alias("detector"), F.lit(b).alias("other"), F.round(pearson(a, b), 4).alias("correlation"))
        for a in names
        for b in names
    ]
    return moments.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def detector_overlap(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows and spend for every combination of verdicts that occurs."""
    named = df.select(*[flags[name].alias(name) for name in flags], "amount")
    return named.groupBy(*flags).agg(
        F.count(F.lit(1)).alias("overlap_rows"),
        F.round(F.sum(F.rint(F.col("amount") * 100).cast("long")) / 100.0, 2).alias("overlap_spend"),
    )


def backtest(df: DataFrame, flags: dict[str, Column], label: str = "ground_truth_type", benign: str = "BENIGN_NORMAL") -> DataFrame:
    """Per label and detector: rows, hits and recall; benign rows count as false alarms instead."""
    named = df.select(F.col(label).alias("typology"), *[flags[name].alias(name) for name in flags])
    grouped = named.groupBy("typology").agg(
        F.count(F.lit(1)).alias("label_rows"), *[F.sum(name).alias(name) for name in flags]
    )
    each = F.explode(
        F.array(*[F.struct(F.lit(name).alias("detector"), F.col(name).alias("flagged_rows")) for name in flags])
    )
    return grouped.select("typology", "label_rows", each.alias("d")).select(
        "typology",
        "d.detector",
        "label_rows",
        "d.flagged_rows",
        F.round(
            F.when(F.col("typology") != benign, F.try_divide(F.col("d.flagged_rows"), F.col("label_rows"))), 4
        ).alias("recall"),
    )


def detector_quality(df: DataFrame, flags: dict[str, Column], truth: str = "ground_truth_anomaly") -> DataFrame:
    """True and false positives, misses, precision and recall of each detector over all labels."""
    named = df.select(F.col(truth).alias("_truth"), *[flags[name].alias(name) for name in flags])
    sums = []
    for name in flags:
        hit, real = F.col(name) == 1, F.col("_truth") == 1
        sums += [
            count_where(hit & real).alias(f"tp_{name}"),
            count_where(hit & ~real).alias(f"fp_{name}"),
            count_where(~hit & real).alias(f"fn_{name}"),
        ]
    cells = [
        F.struct(
            F.lit(name).alias("detector"),
            F.col(f"tp_{name}").alias("true_positives"),
            F.col(f"fp_{name}").alias("false_positives"),
            F.col(f"fn_{name}").alias("misses"),
        )
        for name in flags
    ]
    counts = named.agg(*sums).select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    hits = F.col("true_positives")
    return counts.withColumns(
        {
            "precision": F.round(F.try_divide(hits, hits + F.col("false_positives")), 4),
            "recall": F.round(F.try_divide(hits, hits + F.col("misses")), 4),
        }
    )
