"""Thresholds, weights and texts of the audit rules.

Every operator takes an ``AuditConfig``; the defaults are the published rule values.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Band:
    """Amounts from ``low`` to ``high`` (both included) sit just below ``limit``."""

    low: float
    high: float
    limit: int


# Approval limits and the bands just below them.
APPROVAL_BANDS = (
    Band(4800.00, 4999.99, 5000),
    Band(9500.00, 9999.99, 10000),
    Band(48000.00, 49999.99, 50000),
)

# Rule flag -> points in the composite score.
RULE_WEIGHTS = {
    "flag_duplicate_invoice": 35,
    "flag_threshold_structuring": 30,
    "flag_missing_governance": 25,
    "flag_spend_spike": 30,
    "flag_round_amount": 20,
    "flag_weekend_posting": 20,
}

# Tier name -> lowest score that reaches it, highest first.
RISK_TIERS = (("Critical", 60), ("High", 35), ("Medium", 20))
LOWEST_TIER = "Low"

# Rule flag -> reason text, in the order in which reasons are tried.
RULE_REASONS = (
    ("flag_duplicate_invoice", "Potential Duplicate Invoice Payment"),
    ("flag_threshold_structuring", "Approval Limit Structuring / Split Purchase"),
    ("flag_spend_spike", "Extreme Statistical Spend Outlier"),
    ("flag_missing_governance", "Unverified Transaction - Missing Governance"),
    ("flag_round_amount", "Suspicious Round-Sum Billing"),
    ("flag_weekend_posting", "High-Value Off-Hours / Weekend Posting"),
)
NO_REASON = "Normal Verified Business Spend"

# Defaults written into the staged ledger.
DEFAULT_CURRENCY = "USD"
BENIGN_LABEL = "BENIGN_NORMAL"

# Inputs of the isolation forest.
FOREST_FEATURES = (
    "log_amount",
    "dept_spend_multiplier",
    "is_weekend",
    "is_clean_round_sum",
    "is_structuring_candidate",
    "day_of_week",
)


@dataclass(frozen=True)
class AuditConfig:
    bands: tuple[Band, ...] = APPROVAL_BANDS
    weights: dict[str, int] = field(default_factory=lambda: dict(RULE_WEIGHTS))
    tiers: tuple[tuple[str, int], ...] = RISK_TIERS
    score_cap: int = 100
    round_floor: float = 5000.0
    round_step: int = 5000
    clean_round_floor: float = 1000.0
    clean_round_step: int = 1000
    weekend_floor: float = 15000.0
    spike_multiple: float = 5.0
    approver_limit: float = 1000.0
    iqr_multiple: float = 2.5
    mad_cut: float = 4.5
    mad_scale: float = 0.6745
    mad_epsilon: float = 1e-6
    ntile: int = 100
    ntile_cut: int = 99
    forest_trees: int = 150
    forest_sample: int = 256
    forest_seed: int = 42
    contamination: float = 0.045
    features: tuple[str, ...] = FOREST_FEATURES
    quadrant_score: float = 40.0
    scatter_amount: float = 60000.0
    rolling_days: int = 7

    @property
    def limits(self) -> list[int]:
        return [band.limit for band in self.bands]


DEFAULT = AuditConfig()
