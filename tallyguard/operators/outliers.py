"""Per-department outliers: interquartile fence and modified z-score.

Quantiles are exact order statistics over the whole group. The per-department constants are joined back, so
the rows themselves are never shuffled or grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions.money import flag
from tallyguard.plans.quantiles import approx_quantiles, exact_quantiles
from tallyguard.plans.small_side import attach_group_values, settle

_METHODS = {"exact": exact_quantiles, "approx": approx_quantiles}


def group_quantiles(df: DataFrame, quantiles: dict[str, float], by: str = "department", method: str = "exact") -> DataFrame:
    """Quantiles of ``amount`` per group; ``approx`` is a one-pass sketch."""
    return _METHODS[method](df, "amount", quantiles, [by])


def _fences(quartiles: DataFrame, config: AuditConfig) -> DataFrame:
    reach = (F.col("q75") - F.col("q25")) * config.iqr_multiple
    return quartiles.withColumn("iqr_upper_bound", F.col("q75") + reach)


def _spreads(df: DataFrame, medians: DataFrame, by: str, method: str) -> DataFrame:
    """Median absolute deviation per group; a zero one is replaced by the sample deviation of the amounts."""
    rows = attach_group_values(
        df.select(by, "amount", "transaction_id"), medians, [by], "n", "transaction_id", "inner", settled=True
    ).withColumn("deviation", F.abs(F.col("amount") - F.col("median")))
    deviations = settle(_METHODS[method](rows, "deviation", {"mad": 0.5}, [by]).drop("n"))
    if deviations.where(F.col("mad") == 0).isEmpty():
        return deviations
    fallback = df.groupBy(by).agg(F.stddev_samp("amount").alias("deviation"))
    # both sides have one row per group
    spread = F.when(F.col("mad") == 0, F.col("deviation")).otherwise(F.col("mad"))
    return deviations.join(fallback, by).select(by, spread.alias("mad"))


def _iqr_columns() -> dict:
    return {"stat_iqr_flag": flag(F.col("amount") > F.col("iqr_upper_bound"))}


def _zscore_columns(config: AuditConfig) -> dict:
    """Signed: only amounts far above the median count. A missing spread leaves the score null."""
    score = F.lit(config.mad_scale) * (F.col("amount") - F.col("median")) / (F.col("mad") + config.mad_epsilon)
    return {"stat_zscore": score, "stat_zscore_flag": flag(score > config.mad_cut)}


def iqr_outliers(df: DataFrame, config: AuditConfig = DEFAULT, by: str = "department", method: str = "exact") -> DataFrame:
    fences = _fences(group_quantiles(df, {"q25": 0.25, "q75": 0.75}, by, method), config)
    rows = attach_group_values(df, fences, [by], "n", "transaction_id")
    return rows.withColumns(_iqr_columns()).select(*df.columns, "stat_iqr_flag", "iqr_upper_bound")


def mad_outliers(df: DataFrame, config: AuditConfig = DEFAULT, by: str = "department", method: str = "exact") -> DataFrame:
    medians = settle(group_quantiles(df, {"median": 0.5}, by, method))
    constants = medians.join(_spreads(df, medians, by, method), by)
    rows = attach_group_values(df, constants, [by], "n", "transaction_id")
    return rows.withColumns(_zscore_columns(config)).select(*df.columns, "stat_zscore", "stat_zscore_flag")


def group_constants(df: DataFrame, config: AuditConfig = DEFAULT, by: str = "department", method: str = "exact") -> DataFrame:
    """Fence, median and spread of each group, from one set of quantiles; settled."""
    quartiles = group_quantiles(df, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by, method)
    fences = settle(_fences(quartiles, config))
    return settle(fences.join(_spreads(df, fences.select(by, "n", "median"), by, method), by))


def with_statistics(df: DataFrame, constants: DataFrame, config: AuditConfig = DEFAULT, by: str = "department") -> DataFrame:
    """Both tests on rows of the groups that ``group_constants`` was asked about."""
    rows = attach_group_values(df, constants, [by], "n", "transaction_id", settled=True)
    return rows.withColumns({**_iqr_columns(), **_zscore_columns(config)}).select(
        *df.columns, "stat_iqr_flag", "iqr_upper_bound", "stat_zscore", "stat_zscore_flag"
    )


def add_statistics(df: DataFrame, config: AuditConfig = DEFAULT, by: str = "department", method: str = "exact") -> DataFrame:
    """Both tests from one set of quantiles."""
    return with_statistics(df, group_constants(df, config, by, method), config, by)


def outlier_counts(df: DataFrame, flags: tuple[str, ...] = ("stat_iqr_flag", "stat_zscore_flag")) -> DataFrame:
    """Rows flagged by each method, and their percentage of all rows."""
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(name).alias(name) for name in flags])
    each = F.explode(
        F.array(*[F.struct(F.lit(name).alias("method"), F.col(name).alias("flagged_rows")) for name in flags])
    )
    return totals.select("_rows", each.alias("m")).select(
        "m.method",
        "m.flagged_rows",
        F.round(F.try_divide(F.col("m.flagged_rows") * 100.0, F.col("_rows")), 2).alias("flagged_pct"),
    )
