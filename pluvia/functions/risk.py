"""Risk scores and bands as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pluvia.schemas import HIGH_ABOVE, MODERATE_ABOVE, ONSET_HOURS, ONSET_MM

# Blend weights and the logistic base of the local model.
THREE_SIGNAL = {"rule": 0.2, "boosted": 0.4, "seasonal": 0.4}
TWO_SIGNAL = {"rule": 0.33, "model": 0.67}
LOGISTIC_BASE = 2.71828
RULE_CEILING = 0.4


def onset_flag(total: Column, driest: Column) -> Column:
    """Enough rain and no dry reading; false where either is unknown."""
    return F.coalesce((total >= ONSET_MM) & (driest > 0), F.lit(False))


def round_mm(total: Column) -> Column:
    """Two decimals, half up by the decimal value: 15.395 summed as 15.394999... is 15.40."""
    return F.round(total + 1e-9, 2)


def rule_signal(total: Column) -> Column:
    return F.when(total >= ONSET_MM, 1.0).otherwise(0.0)


def band(score: Column) -> Column:
    return (
        F.when(score > HIGH_ABOVE, "HIGH").when(score > MODERATE_ABOVE, "MODERATE").otherwise("LOW")
    )


def three_signal(total: Column, boosted: Column, seasonal: Column) -> Column:
    w = THREE_SIGNAL
    return w["rule"] * rule_signal(total) + w["boosted"] * boosted + w["seasonal"] * seasonal


def two_signal(total: Column, model: Column) -> Column:
    """Rule blended with the model; the rule alone where there is no model score."""
    rule = rule_signal(total)
    return F.coalesce(TWO_SIGNAL["rule"] * rule + TWO_SIGNAL["model"] * model, rule)


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def normalise(raw: Column) -> Column:
    """First element of a text array as a probability; null where it is not a number."""
    number = F.try_element_at(raw, F.lit(1)).try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number), clamp01(number))


def local_model(prediction: Column, total: Column) -> Column:
    """Soft probability of a predicted hourly rain, blended with the rule."""
    margin = (prediction * ONSET_HOURS - ONSET_MM / 2) / ONSET_MM
    soft = 1.0 / (1.0 + F.pow(F.lit(LOGISTIC_BASE), -2.0 * margin))
    return clamp01(TWO_SIGNAL["rule"] * rule_signal(total) + TWO_SIGNAL["model"] * soft)


def rule_only(total: Column) -> Column:
    """The last resort: certain at the threshold, else a capped share of twice of it."""
    partial = F.least(F.lit(RULE_CEILING), total / (ONSET_MM * 2))
    return F.when(total >= ONSET_MM, 1.0).otherwise(partial)


def alert_level(score: Column, fired: Column) -> Column:
    return F.when(fired, "WATCH").otherwise(band(score))


def served_alert_level(level: Column, flag: Column) -> Column:
    """A served HIGH becomes WATCH once the onset flag is set."""
    return F.when((level == "HIGH") & flag, "WATCH").otherwise(level)


def prefer(*candidates: Column) -> Column:
    """The first non-null struct of (score, source, ...)."""
    return F.coalesce(*candidates)


def point_colour(score: Column, hot_above: float = 25.0) -> Column:
    return F.when(score > hot_above, "red").otherwise("blue")
