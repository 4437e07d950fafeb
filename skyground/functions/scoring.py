"""The bounded product that ranks a detection-report pair."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as V


def match_score(
    frp: Column,
    confidence: Column,
    num_sources: Column,
    distance_m: Column,
    delta_h: Column,
    radius_m: float = V.JOIN_RADIUS_M,
    decay_h: float = V.TIME_DECAY_H,
) -> Column:
    """Five factors, each in [0, 1]: intensity, confidence, sources, nearness, recency.

    ``distance_m`` and ``delta_h`` come in as FLOAT and are widened back, so the score is that of
    the stored values. Only the exact text 'h' counts as high confidence.
    """
    one = F.lit(1.0)
    intensity = F.least(
        F.coalesce(frp.cast("double"), F.lit(0.0)) / V.FRP_SATURATION_MW, one)
    trust = F.when(confidence == V.HIGH_CONFIDENCE, one).otherwise(V.OTHER_CONFIDENCE_FACTOR)
    support = F.least(
        F.coalesce(num_sources, F.lit(1)).cast("double") / V.SOURCES_SATURATION, one)
    nearness = F.sqrt(one - distance_m.cast("double") / radius_m)
    recency = one - F.abs(delta_h.cast("double")) / decay_h
    return (intensity * trust * support * nearness * recency).cast("float")
