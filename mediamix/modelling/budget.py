"""Response curves and budget scenarios per segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamix.grain import join_on

# Spend steps of a curve and how far beyond the current spend it goes.
STEPS = 100
REACH = 2.0


def saturation(spend: Column, alpha: Column, half: Column) -> Column:
    top = F.pow(spend, alpha)
    return F.coalesce(F.try_divide(top, top + F.pow(half, alpha)), F.lit(0.0))


def response_curves(params: DataFrame, steps: int = STEPS, reach: float = REACH) -> DataFrame:
    """(segment, channel, step, spend, response, marginal) along each channel's curve.

    ``params``: (segment, channel, mean_spend, coef, alpha, half, theta).  A constant
    spend s carries over to s / (1 - theta).  The marginal gain is the difference to the
    step before, computed within the row.
    """
    width = F.col("mean_spend") * reach / steps

    def response(step: Column) -> Column:
        carried = width * step / (1 - F.col("theta"))
        return F.col("coef") * saturation(carried, F.col("alpha"), F.col("half"))

    step = F.col("step")
    return params.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps)))).select(
        "segment",
        "channel",
        "step",
        "mean_spend",
        (width * step).alias("spend"),
        response(step).alias("response"),
        F.when(step > 0, response(step) - response(step - 1)).otherwise(0.0).alias("marginal"),
    )


def concave_steps(curves: DataFrame) -> DataFrame:
    """Curve steps with ``gain``: what the step adds on the concave envelope.

    An S-shaped curve lies below its chord up to the step of the best average return;
    buying along the chord makes gains fall from step to step.
    """
    average = F.when(F.col("step") > 0, F.col("response") / F.col("step"))
    tops = curves.groupBy("segment", "channel").agg(
        F.max_by(F.struct("step", "response"), F.struct(F.coalesce(average, F.lit(-1.0)), F.col("step"))).alias("top")
    )
    on_chord = F.col("step") <= F.col("top.step")
    chord = F.coalesce(F.try_divide(F.col("top.response"), F.col("top.step")), F.lit(0.0))
    return (
        join_on(curves, tops, ["segment", "channel"])
        .withColumn("gain", F.when(on_chord, chord).otherwise(F.col("marginal")))
        .drop("top")
    )


def _part(left: Column, size: Column) -> Column:
    """Part of a step that is bought where ``left`` is what remains after all of it."""
    return F.least(F.greatest(1 + F.coalesce(F.try_divide(left, size), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def budget_scenarios(curves: DataFrame) -> DataFrame:
    """(segment, scenario, channel, steps, spend, response, at_limit, bound).

    A channel can get at most what its curve reaches, ``reach`` times its mean spend;
    ``at_limit`` marks channels that get all of it and might gain from more.

    ``max_response`` spends the current budget where it gains most; ``min_spend`` reaches
    the current response with the least spend.  Steps are bought per segment in order of
    gain per unit of spend; a segment has channels times steps of them.

    ``bound`` is what no allocation along the concave envelopes can better, steps divided or
    not: the highest response of the segment's budget, or the least spend for its response.
    Bought in order of gain, with a part of the last step, it is the optimum itself; whole
    steps are off by less than one.
    """
    steps = concave_steps(curves).filter(F.col("step") > 0)
    cost = F.col("spend") / F.col("step")
    rate = F.round(F.coalesce(F.try_divide(F.col("gain"), cost), F.lit(0.0)), 9)
    current = curves.groupBy("segment", "channel").agg(
        F.max("mean_spend").alias("now"),
        F.max_by("response", F.struct(-F.abs(F.col("spend") - F.col("mean_spend")))).alias("response_now"),
    )
    goals = current.groupBy("segment").agg(F.sum("now").alias("budget"), F.sum("response_now").alias("target"))
    order = (
        Window.partitionBy("segment")
        .orderBy(F.col("rate").desc(), "channel", "step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    bought = join_on(
        steps.withColumns({"rate": rate, "cost": cost}).withColumns(
            {"spent": F.sum("cost").over(order), "reached": F.sum("gain").over(order)}
        ),
        goals,
        ["segment"],
    )
    slack = 1e-9
    scenarios = F.array(
        F.struct(
            F.lit("max_response").alias("scenario"),
            (F.col("spent") <= F.col("budget") * (1 + slack)).alias("taken"),
            (_part(F.col("budget") - F.col("spent"), F.col("cost")) * F.col("gain")).alias("best"),
        ),
        F.struct(
            F.lit("min_spend").alias("scenario"),
            (F.col("reached") - F.col("gain") < F.col("target") * (1 - slack)).alias("taken"),
            (_part(F.col("target") - F.col("reached"), F.col("gain")) * F.col("cost")).alias("best"),
        ),
    )
    whole = Window.partitionBy("segment", "scenario")
    return (
        bought.select("segment", "channel", "step", "cost", "gain", F.inline(scenarios))
        .groupBy("segment", "scenario", "channel")
        .agg(
            F.count_if("taken").alias("steps"),
            (F.count_if("taken") == F.count("*")).alias("at_limit"),
            F.sum(F.when(F.col("taken"), F.col("cost")).otherwise(0.0)).alias("spend"),
            F.sum(F.when(F.col("taken"), F.col("gain")).otherwise(0.0)).alias("response"),
            F.sum("best").alias("best"),
        )
        .withColumn("bound", F.sum("best").over(whole))
        .drop("best")
    )
