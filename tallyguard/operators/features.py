"""Row features that the statistics and the model use. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.functions.money import below_any_limit, flag, leading_digit, nearest_limit_distance


def add_features(df: DataFrame, config: AuditConfig = DEFAULT) -> DataFrame:
    amount = F.col("amount")
    clean_round = (amount >= config.clean_round_floor) & (amount % config.clean_round_step == 0)
    return df.withColumns(
        {
            "log_amount": F.log1p(amount),
            "threshold_dist": nearest_limit_distance(amount, config.limits),
            "is_structuring_candidate": flag(below_any_limit(amount, config.bands)),
            "first_digit": leading_digit(amount),
            "is_clean_round_sum": flag(clean_round),
        }
    )
