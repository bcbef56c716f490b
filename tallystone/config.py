"""Settings of the engine: plain values, one frozen dataclass per concern."""

from __future__ import annotations

from dataclasses import dataclass, field

# Severities per rule family.
SEVERITIES = {
    "missing_transaction_id": "CRITICAL",
    "missing_amount": "CRITICAL",
    "missing_currency": "HIGH",
    "missing_account_id": "CRITICAL",
    "missing_entity_id": "CRITICAL",
    "missing_payment_date_unpaid": "LOW",
    "missing_payment_date_inconsistent": "HIGH",
    "missing_optional_metadata": "INFO",
    "duplicate_exact": "HIGH",
    "duplicate_business_key": "HIGH",
    "duplicate_near": "MEDIUM",
    "duplicate_invoice": "HIGH",
    "invalid_currency": "HIGH",
    "invalid_account": "HIGH",
    "invalid_entity": "HIGH",
    "invalid_date": "HIGH",
    "inconsistent_classification": "HIGH",
    "payment_before_invoice": "HIGH",
    "negative_amount_not_allowed": "MEDIUM",
    "amount_mismatch": "MEDIUM",
    "journal_entry_unbalanced": "CRITICAL",
    "subledger_tie_out_failure": "HIGH",
}

# Weight of one issue in the quality score, and what quarantines a record.
SEVERITY_WEIGHTS = {"CRITICAL": "1.0", "HIGH": "0.6", "MEDIUM": "0.3", "LOW": "0.1", "INFO": "0.02"}
UNKNOWN_SEVERITY_WEIGHT = "0.3"
QUARANTINE_SEVERITIES = ("CRITICAL", "HIGH")

# Quality dimensions, their equal weights and the rule prefixes that feed them.
DIMENSION_WEIGHTS = {
    "completeness": 0.2,
    "uniqueness": 0.2,
    "validity": 0.2,
    "consistency": 0.2,
    "reconciliation": 0.2,
}
DIMENSION_PREFIXES = (
    ("completeness", ("missing_",)),
    ("uniqueness", ("duplicate_",)),
    (
        "validity",
        (
            "invalid_currency", "negative_amount_not_allowed", "invalid_date", "payment_before_invoice",
            "amount_mismatch", "statistical_outlier", "invalid_due_date",
        ),
    ),
    (
        "consistency",
        (
            "invalid_account", "invalid_entity", "invalid_customer_id", "invalid_vendor_id",
            "inconsistent_classification",
        ),
    ),
    ("reconciliation", ("journal_entry_unbalanced", "subledger_tie_out_failure")),
)

VALID_CURRENCIES = ("EUR", "USD", "GBP")
Z_95 = 1.96


@dataclass(frozen=True)
class QualitySettings:
    severities: dict[str, str] = field(default_factory=lambda: dict(SEVERITIES))
    tolerance: str = "0.01"
    near_duplicate_tolerance: str = "0.005"
    outlier_z: float = 8.0
    outlier_min_rows: int = 20


@dataclass(frozen=True)
class ForecastSettings:
    horizon: int = 12
    validation_months: int = 6
    season: int = 12


# The defaults of the next class.
@dataclass(frozen=True)
class LiquiditySettings:
    minimum_cash: float = 2_750_000.0
    low_max: float = 0.05
    medium_max: float = 0.20
    high_max: float = 0.50


# Scenario shifts of the simulated inputs.
SCENARIOS = {
    "base": {"revenue_pct": 0.0, "opex_pct": 0.0, "dso_days": 0.0, "dpo_days": 0.0},
    "optimistic": {"revenue_pct": 0.10, "opex_pct": -0.03, "dso_days": -5.0, "dpo_days": 0.0},
    "pessimistic": {"revenue_pct": -0.10, "opex_pct": 0.05, "dso_days": 10.0, "dpo_days": -5.0},
    "stress": {"revenue_pct": -0.35, "opex_pct": 0.10, "dso_days": 25.0, "dpo_days": -10.0},
}


@dataclass(frozen=True)
class SimulationSettings:
    n_simulations: int = 10_000
    seed: int = 42
    debt_annual_rate: float = 0.065
    # "correct": cost of sales is revenue x (1 - gross margin).
    # "margin": cost of sales is revenue x gross margin, for parity with figures computed that way.
    cost_ratio: str = "correct"


# The defaults of the next class.
@dataclass(frozen=True)
class PlanSettings:
    max_borrowing: float = 5_000_000.0
    borrowing_rate_annual: float = 0.07
    max_payment_delay_days: float = 30.0
    max_collections_acceleration_pct: float = 0.15
    max_capex_reduction_pct: float = 0.30
    factoring_discount_rate: float = 0.02
    capex_delay_cost_rate: float = 0.05
    policy_minimum_cash: float = 16_000_000.0
    safety_buffer_z: float = 3.0
