"""Smoothed scores and weights. Groups may be of any size; see `skew`."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from winnow.functions.limits import (
    CAP_EPSILON,
    DAY_BLOCKS,
    FLOOR_WEIGHT,
    KEEP_SHARE,
    U16_MAX,
    WEIGHT_EPOCH_BLOCKS,
)
from winnow.operators.skew import join_totals, ranked, with_totals
from winnow.session import materialize

HALF_DIGITS = 9  # of a number up to 65535, whose own error is below 1e-10


def ema_score(
    events: DataFrame, keep: float = KEEP_SHARE, width: int = DAY_BLOCKS, tie: str = "tie"
) -> DataFrame:
    """(uid, score) after s = keep * s + (1 - keep) * score over all events in order, from 0.

    The recurrence is a weighted sum whose pieces combine: events are summed per uid and
    stretch of `width` steps, and a stretch is then damped by the number of events after it.
    """
    cut = events.withColumn("_stretch", F.floor(F.col("step") / F.lit(width)))
    newest = Window.partitionBy("uid", "_stretch").orderBy(F.desc("step"), F.desc(tie))
    damped = F.lit(1 - keep) * F.col("score") * F.pow(F.lit(keep), F.col("_age"))
    stretches = (
        cut.withColumn("_age", F.row_number().over(newest) - 1)
        .groupBy("uid", "_stretch")
        .agg(F.sum(damped).alias("_part"), F.count(F.lit(1)).alias("_n"))
    )
    later = Window.partitionBy("uid").orderBy(F.desc("_stretch")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    after = F.coalesce(F.sum("_n").over(later), F.lit(0))
    return (
        stretches.withColumn("_after", after)
        .groupBy("uid")
        .agg(F.sum(F.col("_part") * F.pow(F.lit(keep), F.col("_after"))).alias("score"))
    )


def latest_score(log: DataFrame, tie: str | None = None) -> DataFrame:
    """(uid, score): the last logged score; rows without uid or score are ignored."""
    position = F.struct("step", tie) if tie else F.col("step")
    return (
        log.where("uid is not null and score is not null")
        .groupBy("uid")
        .agg(F.max_by("score", position).alias("score"))
    )


def dense_scores(members: DataFrame, scores: DataFrame) -> DataFrame:
    """One score per member, 0 for members never scored."""
    return members.join(scores.select("uid", "score"), "uid", "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


def l1_weights(scores: DataFrame, group: list[str], at_most: int | None = None) -> DataFrame:
    """score / sum of absolute scores as `weight`; a group with a NaN is left out whole."""
    summed = with_totals(
        scores, group, at_most, _norm=F.sum(F.abs("score")), _nan=F.bool_or(F.isnan("score"))
    )
    norm = F.when(F.col("_norm") == 0, F.lit(1.0)).otherwise(F.col("_norm"))
    return (
        summed.where("not _nan").withColumn("weight", F.col("score") / norm).drop("_norm", "_nan")
    )


def capped_weights(
    df: DataFrame, limit: float, group: list[str], at_most: int | None = None
) -> DataFrame:
    """Weights scaled to sum 1 with none above `limit`; the excess is spread over the others.

    Uniform when the weights sum to 0 or the limit leaves no room. Weights that sum to 1 have
    fewer than 1 / limit members above the limit, so only that many per group decide the
    cutoff; everything else about a group is a sum.
    """
    top = math.floor(1 / limit) + 2
    totals = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("weight").alias("_sum")
    )
    largest = Window.partitionBy(*group).orderBy(F.desc("weight"), "uid")
    whole = Window.partitionBy(*group)
    heads = (
        df.select(*group, "uid", "weight")
        .withColumn("_k", F.row_number().over(largest))
        .where(F.col("_k") <= top)
        .join(totals, group)
        .where(F.col("_sum") != 0)
        .withColumn("_share", F.col("weight") / F.col("_sum"))
    )
    above = F.coalesce(
        F.sum("_share").over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    clipped_share = F.col("_share") / (
        (F.col("_k") - 1) * F.col("_share") + (1 - above) + F.lit(CAP_EPSILON)
    )
    capped = F.when(F.col("_over"), F.col("_share")).otherwise(F.lit(0.0))
    cutoff = (
        (F.lit(limit) * (1 - F.sum(capped).over(whole)) - F.lit(CAP_EPSILON))
        / (1 - F.lit(limit) * F.sum(F.col("_over").cast("int")).over(whole))
        * F.col("_sum")
    )
    cutoffs = (
        heads.withColumn("_over", clipped_share >= limit)
        .withColumn("_cutoff", cutoff)
        .groupBy(*group)
        .agg(
            F.first("_cutoff").alias("_cutoff"),
            F.max("_share").alias("_max"),
            F.sum(F.greatest(F.col("weight") - F.col("_cutoff"), F.lit(0.0))).alias("_excess"),
        )
    )
    known = totals.withColumn("_count", F.col("_n")).join(cutoffs, group, "left")
    joined = join_totals(df, known, group, at_most=at_most)
    weight = (
        F.when((F.col("_sum") == 0) | (F.col("_count") * limit <= 1), 1 / F.col("_count"))
        .when(F.col("_max") <= limit, F.col("weight") / F.col("_sum"))
        .otherwise(
            F.least("weight", "_cutoff") / (F.col("_sum") - F.col("_excess"))
        )
    )
    return joined.withColumn("weight", weight).select(*df.columns)


def _quantiles(positive: DataFrame, group: list[str], min_allowed: int, q: float) -> DataFrame:
    """(group, _low): linear quantile of the positive weights, q cut so that enough remain."""
    places = ranked(
        positive.select(*group, "uid", "weight", "_positive"),
        group,
        [F.col("weight"), F.col("uid")],
    )
    share = F.least(
        F.lit(q), F.greatest(F.col("_positive") - min_allowed, F.lit(0)) / F.col("_positive")
    )
    at = share * (F.col("_positive") - 1)
    picked = places.withColumn("_at", at).where(
        (F.col("_rank") - 1).between(F.floor("_at"), F.ceil("_at"))
    )
    low, high = F.min("weight"), F.max("weight")
    rest = F.first(F.col("_at") - F.floor("_at"))
    return picked.groupBy(*group).agg(
        (low + (high - low) * rest).alias("_low"), F.count(F.lit(1)).alias("_picked")
    ).drop("_picked")


def process_weights(
    df: DataFrame,
    min_allowed: int,
    limit: float,
    group: list[str],
    exclude_quantile: int = 0,
    at_most: int | None = None,
) -> DataFrame:
    """Final weights of a group of members.

    No positive weight or fewer members than allowed: uniform. Fewer positive weights than
    allowed: a small floor under everyone, then the cap. Otherwise the positive weights from
    the given quantile up, then the cap.
    """
    counted = with_totals(
        df,
        group,
        at_most,
        _members=F.count(F.lit(1)),
        _positive=F.count_if(F.col("weight") > 0),
    )
    if exclude_quantile:
        counted = materialize(counted, "weights")
    uniform = (F.col("_positive") == 0) | (F.col("_members") < min_allowed)
    few = ~uniform & (F.col("_positive") < min_allowed)
    enough = ~uniform & ~few
    if exclude_quantile:
        positive = counted.where(enough & (F.col("weight") > 0))
        low = _quantiles(positive, group, min_allowed, exclude_quantile / U16_MAX)
        sizes = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        counted = join_totals(counted, sizes.join(low, group, "left"), group, at_most=at_most)
        in_range = F.col("weight") >= F.col("_low")
    else:
        in_range = F.lit(True)
    adjusted = (
        F.when(uniform, F.lit(0.0))
        .when(few, F.lit(FLOOR_WEIGHT) + F.greatest(F.col("weight"), F.lit(0.0)))
        .otherwise(F.col("weight"))
    )
    chosen = counted.where(~enough | ((F.col("weight") > 0) & in_range))
    chosen = materialize(chosen.withColumn("weight", adjusted).select(*df.columns), "weights")
    return capped_weights(chosen, limit, group, chosen.count())


def emit_weights(df: DataFrame, group: list[str], at_most: int | None = None) -> DataFrame:
    """(group, uid, w_u16): weights with the largest scaled to 65535, zeros left out.

    A negative weight or uid fails the job. A group without weight gives no rows. Halves go to the
    even number. A ratio of weights can be a half exactly, and its last bits then depend on the order
    in which the group was summed: within `HALF_DIGITS` decimals of a half it counts as one.
    """
    scaled = with_totals(df, group, at_most, _top=F.max("weight"))
    checked = F.when(
        F.col("weight") < 0, F.raise_error(F.lit("negative weight")).cast("double")
    ).when(F.col("uid") < 0, F.raise_error(F.lit("negative uid")).cast("double"))
    value = checked.when(F.col("_top") == 0, F.lit(0.0)).otherwise(
        F.bround(F.round(F.col("weight") / F.col("_top") * U16_MAX, HALF_DIGITS))
    )
    emitted = scaled.withColumn("w_u16", value.cast("int"))
    return emitted.where("w_u16 != 0").select(*group, "uid", "w_u16")


def weight_intervals(
    scores: DataFrame, width: int = WEIGHT_EPOCH_BLOCKS, tie: str = "tie"
) -> DataFrame:
    """(uid, epoch, until, score): the score of a uid from one block divisible by `width` to another.

    A score holds from the first such block not before it until the next score takes over, the
    last one of each uid for the last epoch of all; `until` is excluded. There are at most as
    many rows as scores, however many epochs they span.
    """
    at = F.ceil(F.col("step") / F.lit(width)) * width
    last = (
        scores.withColumn("epoch", at)
        .groupBy("uid", "epoch")
        .agg(F.max_by("score", F.struct("step", tie)).alias("score"))
    )
    end = scores.agg(F.max(at) + width).scalar()
    following = F.lead("epoch").over(Window.partitionBy("uid").orderBy("epoch"))
    return last.select("uid", "epoch", F.coalesce(following, end).alias("until"), "score")


def epoch_norms(intervals: DataFrame) -> DataFrame:
    """(epoch, until, members, norm): members with a score and the sum of |score|, while they hold.

    A sweep over the epochs at which any score changes: each interval adds itself at its start
    and takes itself away at its end, summed per epoch before the running sums, which hence see
    no more rows than there are epochs.
    """
    size = F.abs("score").cast("double")
    zero = F.lit(0.0)
    start = F.struct(F.col("epoch").alias("at"), F.lit(1).alias("n"), size.alias("up"), zero.alias("down"))
    stop = F.struct(F.col("until").alias("at"), F.lit(-1).alias("n"), zero.alias("up"), size.alias("down"))
    changes = (
        intervals.select(F.inline(F.array(start, stop)))
        .groupBy("at")
        .agg(F.sum("n").alias("n"), (F.sum("up") - F.sum("down")).alias("change"))
    )
    order = Window.partitionBy(F.lit(0)).orderBy("at")
    return changes.select(
        F.col("at").alias("epoch"),
        F.lead("at").over(order).alias("until"),
        F.sum("n").over(order).alias("members"),
        F.sum("change").over(order).alias("norm"),
    ).where("until IS NOT NULL")


def weight_epochs(
    scores: DataFrame, width: int = WEIGHT_EPOCH_BLOCKS, tie: str = "tie"
) -> DataFrame:
    """(epoch, uid, score): `weight_intervals`, with a row for each uid and epoch."""
    step = F.lit(width).cast("long")
    every = F.sequence(F.col("epoch"), F.col("until") - step, step)
    return weight_intervals(scores, width, tie).select(F.explode(every).alias("epoch"), "uid", "score")
