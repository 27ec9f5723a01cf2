"""Parameters of every stage, as plain Python values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default scoring weights. They add up to 1.2; the score is clipped.
DEFAULT_WEIGHTS = {
    "cadence": 0.2,
    "repetition": 0.3,
    "speed": 0.2,
    "hygiene": 0.15,
    "protocol": 0.1,
    "volume": 0.05,
    "ua_full_concentration": 0.1,
    "ua_full_ip_diversity": 0.1,
}

# Band thresholds. ``low`` is kept for completeness; every score
# under ``medium`` is Low.
DEFAULT_THRESHOLDS = {"high": 0.75, "medium": 0.55, "low": 0.25}

# Hours counted as night.
DEFAULT_NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5, 6)


@dataclass(frozen=True)
class Params:
    # ingest
    tz: str = "UTC"
    min_events: int = 5
    # features
    night_hours: tuple[int, ...] = DEFAULT_NIGHT_HOURS
    gap_percentiles: tuple[int, ...] = (50, 95)
    ladder_distinct_dates: bool = False
    # A cohort with more events than this is ordered in slices spread over many
    # tasks instead of one window partition (see operators/sequence.py).
    hot_cohort_rows: int = 1_000_000
    # scoring
    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    alpha_blend_iso: float = 0.5
    thresholds: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    # isolation forest
    n_trees: int = 300
    # Rows per tree (a whole number; 256 is that of the published method) or a share of all
    # cohorts (a fraction); see operators/iforest.py.
    max_samples: int | float = 0.8
    seed: int = 42
    # history
    ewma_alpha_7d: float = 0.3
    ewma_alpha_30d: float = 0.1
    lookback_days: int = 30
    # reports
    top_n: int = 50
    sample_rows: int = 3
