"""Scoring expressions: signed confidence, review weight, normalised score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions.text import missing_text_guard


def signed_confidence(p_positive: Column, text: Column | None = None) -> Column:
    """Predicted class (-1 or 1) times its probability; a tie goes to -1.

    Missing text scores 0 when the text column is given.
    """
    signed = F.when(p_positive > 0.5, p_positive).otherwise(p_positive - F.lit(1.0))
    return signed if text is None else missing_text_guard(text, signed)


def huber_probability(margin: Column) -> Column:
    """Probability of the positive class of a modified-Huber classifier."""
    return (F.least(F.greatest(margin, F.lit(-1.0)), F.lit(1.0)) + 1.0) / 2.0


def review_weight(score: Column, votes: Column, confidence: Column) -> Column:
    """Weight of one review: score + (1 + 0.1 * score * votes) * confidence."""
    signed_votes = (score * votes).cast("double")
    return score.cast("double") + (F.lit(1.0) + F.lit(0.1).cast("double") * signed_votes) * confidence


def normalized_score(score: Column, occurrence: Column, k: float = K.NORMALISATION_K) -> Column:
    """Mean weight, damped for rarely reviewed games, scaled to about -10..10."""
    seen = occurrence.cast("double")
    damping = F.lit(0.8) + F.lit(0.2) * F.try_divide(seen, seen + F.lit(float(k)))
    return F.try_divide(score, seen) * damping / F.lit(2.0) * F.lit(10.0)


def percent(share: Column) -> Column:
    return F.round(share * F.lit(100.0), 2)
