"""Every threshold of the engine in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Fixed values of the metric definitions.
    deploy_days: int = 90
    overage_ratio: float = 1.2
    spike_share: float = 0.7
    spike_min_index: int = 3
    quota_share: float = 0.15
    gap_days: int = 31
    split: float = 0.5
    healthy_vrr: float = 0.5
    partial_vrr: float = 0.25
    even_gap: float = 0.01
    overage_run_months: int = 3
    reporting_lag_days: int = 31

    # Bounds that depend on the book at hand.
    portfolio_bounds: tuple[float, float] = (1e6, 1e9)
    cohort_shares: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "spike_drop": (0.03, 0.07),
            "shelfware": (0.08, 0.12),
            "overage": (0.13, 0.17),
        }
    )
    row_bounds: dict[str, tuple[int, int]] = field(
        default_factory=lambda: {
            "customers": (90, 110),
            "products": (450, 550),
            "entitlements": (450, 550),
            "features": (1800, 2200),
        }
    )
    spike_cohort: str = "spike_drop"
    overage_cohort: str = "overage"
    shelfware_cohort: str = "shelfware"
