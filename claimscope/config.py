"""All thresholds of the engine in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    runout_months: int = 12
    maturity_months: int = 6
    paid_ceiling: float = 500_000_000.0
    min_peers: int = 30
    rare_share: float = 0.01
    surge_ratio: float = 5.0
    z_cutoff: float = 3.5
    z_clip: float = 50.0
    min_signals: int = 2
    max_lines_per_patient: float = 100.0
    max_paid_per_line: float = 50_000.0
    extreme_pct: float = 0.99
    min_service_volume: int = 30
    min_claim_lines: int = 100
    anomaly_bar: float = 0.70
    frag_max_share: float = 0.50
    min_net_paid: float = 10_000_000.0
    ambiguity_share: float = 0.01
    yearly_min_peers: int = 20
    yearly_min_active: int = 6
    billing_years: tuple[int, int] = (2018, 2024)
    seed: int = 42
    val_fraction: float = 0.20


DEFAULT = Config()
