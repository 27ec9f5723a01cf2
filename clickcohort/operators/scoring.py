"""Rule score, blend, risk bands, and checks on the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.operators.tallies import KEY
from clickcohort.params import Params

SCORES = ("rule_score", "iso_score", "botness")
BANDS = ("High", "Medium", "Low")

# Scales of the rule terms.
ENTROPY_SCALE = 4.0
GAP_SCALE_SECONDS = 60.0
RUN_SCALE = 10.0
VOLUME_SCALE = 10.0
HTTP2_SUSPICIOUS = 0.95


def _zero(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def rule_score(columns: Sequence[str], params: Params = Params()) -> Column:
    """Weighted rules, clipped to [0, 1].

    Nulls count as 0 and a rule is left out when one of its columns is absent. The
    weights of the two user-agent rules default to 0.1.
    """
    have = set(columns)
    one = F.lit(1.0)

    def mean(left: Column, right: Column) -> Column:
        return (left + right) / 2.0

    rules: list[tuple[str, tuple[str, ...], object]] = [
        ("cadence", ("night_share", "hourly_entropy"),
         lambda night, entropy: mean(night, 1 - entropy / ENTROPY_SCALE)),
        ("repetition", ("top_signature_share", "repeat_ratio"), mean),
        ("speed", ("gap_p50", "max_run_lt_1s"),
         lambda gap, run: mean(1 - F.least(gap / GAP_SCALE_SECONDS, one),
                               F.least(run / RUN_SCALE, one))),
        ("hygiene", ("cookie_rate", "referrer_rate"),
         lambda cookie, referrer: mean(1 - cookie, 1 - referrer)),
        ("ua_full_concentration", ("ua_full_mode_share",), lambda share: share),
        ("ua_full_ip_diversity", ("ua_full_ip_diversity_ratio",), lambda ratio: ratio),
        ("protocol", ("http11_share", "http2_share"),
         lambda http11, http2: F.greatest(
             http11, (http2 > HTTP2_SUSPICIOUS).cast("double"))),
        ("volume", ("n_events",), lambda n: F.least(F.log1p(n) / VOLUME_SCALE, one)),
    ]
    total = F.lit(0.0)
    for name, needs, term in rules:
        if have.issuperset(needs):
            weight = (params.weights.get(name, 0.1) if name.startswith("ua_full")
                      else params.weights[name])
            total = total + F.lit(float(weight)) * term(*[_zero(c) for c in needs])
    return F.greatest(F.lit(0.0), F.least(total, one))


def botness(params: Params = Params()) -> Column:
    alpha = float(params.alpha_blend_iso)
    return F.lit(alpha) * F.col("rule_score") + F.lit(1 - alpha) * F.col("iso_score")


def risk_band(score: Column, params: Params = Params()) -> Column:
    """High, Medium or Low; null and NaN are Low."""
    known = score.isNotNull() & ~F.isnan(score)
    return (
        F.when(known & (score >= params.thresholds["high"]), "High")
        .when(known & (score >= params.thresholds["medium"]), "Medium")
        .otherwise("Low")
    )


def add_scores(features: DataFrame, iso: DataFrame | Column | None = None,
               params: Params = Params()) -> DataFrame:
    """rule_score, iso_score, botness, risk_band.

    ``iso`` is a column, or a frame (cohort_key, iso_score), or nothing for 0.
    """
    scored = features.withColumn("rule_score", rule_score(features.columns, params))
    if isinstance(iso, DataFrame):
        scored = scored.join(iso, KEY, "left")
    else:
        scored = scored.withColumn("iso_score", F.lit(0.0) if iso is None else iso)
    scored = scored.withColumn("botness", botness(params))
    return scored.withColumn("risk_band", risk_band(F.col("botness"), params))


def band_counts(scored: DataFrame) -> DataFrame:
    """Cohorts per band: all three bands, also those without cohorts."""
    counts = scored.agg(*[F.count_if(F.col("risk_band") == b).alias(b) for b in BANDS])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(b).alias("risk_band"), F.col(b).alias("cohorts")) for b in BANDS
    ])).alias("_r")).select("_r.*")


def score_statistics(scored: DataFrame) -> DataFrame:
    """Per score: mean, sample deviation, min, max, and the number of cohorts."""
    parts = []
    for name in SCORES:
        parts += [F.avg(name).alias(f"{name}_mean"), F.stddev_samp(name).alias(f"{name}_std"),
                  F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
    wide = scored.agg(F.count("*").alias("cohorts"), *parts)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("score"), F.col("cohorts"),
                 *[F.col(f"{name}_{stat}").alias(stat) for stat in ("mean", "std", "min", "max")])
        for name in SCORES
    ])).alias("_r")).select("_r.*")


def scoring_issues(scored: DataFrame) -> DataFrame:
    """One row per problem found: (issue, cohorts)."""
    checks = {}
    for name in SCORES:
        value = F.col(name)
        missing = value.isNull() | F.isnan(value)
        checks[f"missing {name}"] = missing
        checks[f"{name} outside [0, 1]"] = ~missing & ~value.between(0.0, 1.0)
    checks["invalid risk_band"] = ~F.coalesce(F.col("risk_band").isin(*BANDS), F.lit(False))
    names = list(checks)
    wide = scored.agg(*[F.count_if(checks[c]).alias(f"_{i}") for i, c in enumerate(names)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("issue"), F.col(f"_{i}").alias("cohorts"))
        for i, c in enumerate(names)
    ])).alias("_r")).select("_r.*").where(F.col("cohorts") > 0)
