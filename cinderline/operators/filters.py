"""From raw detections to those that qualify, with counts of every step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from .geo import inside_flag, near_flag

STEPS = ("uk_land", "not_static_type", "confidence", "not_persistent")


def flag_steps(points: DataFrame, sides: DataFrame, exclusions: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """points (x, y, type, confidence) with a flag for each step by itself. A null type is no static type; a null confidence
    fails."""
    out = inside_flag(points, sides, "uk_land", buffer_m=settings.land_buffer_m)
    out = near_flag(out, exclusions, "_near")
    out = out.withColumn("not_static_type", ~F.coalesce(F.col("type").isin(*settings.static_types), F.lit(False)))
    out = out.withColumn("confidence_kept", F.coalesce(F.col("confidence").isin(*settings.confidence_kept), F.lit(False)))
    return out.withColumn("not_persistent", ~F.col("_near")).drop("_near")


def qualifying(flagged: DataFrame) -> DataFrame:
    return flagged.where("uk_land and not_static_type and confidence_kept and not_persistent")


def funnel(flagged: DataFrame) -> DataFrame:
    """One row: how many rows are left after each step, from one pass."""
    so_far, counts = F.lit(True), [F.count("*").alias("bbox")]
    for name, flag in zip(STEPS, ("uk_land", "not_static_type", "confidence_kept", "not_persistent"), strict=True):
        so_far = so_far & F.col(flag)
        counts.append(F.count_if(so_far).alias(name))
    return flagged.agg(*counts)
