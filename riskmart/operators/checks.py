"""Threshold checks and alert levels as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskmart import config


def with_checks(metrics: DataFrame, limits: config.Thresholds = config.Thresholds(),
                strict_psi: bool = False, empty_overlap: str | None = None) -> DataFrame:
    """Add the checks of a metrics row and its alert level.

    An undefined metric fails its floor. A null index passes both ceilings and reports NO_PSI unless
    the boolean column ``empty_overlap`` says that it is undefined because predictions and labels
    share no row: that is CRITICAL. An index of exactly 0 also reports NO_PSI; ``strict_psi``
    reports OK instead.
    """
    floors = {f"{m}_check": F.coalesce(F.col(m) >= low, F.lit(False)) for m, low in limits.floors.items()}
    undefined = F.col(empty_overlap) if empty_overlap else F.lit(False)
    psi = F.col("psi")
    below = {name: F.coalesce(psi < limit, ~undefined) for name, limit in
             (("psi_warning", limits.psi_warning), ("psi_critical", limits.psi_critical))}
    checked = metrics.withColumns({**floors, **below})
    passed = F.lit(True)
    for name in floors:
        passed = passed & F.col(name)
    silent = psi.isNull() if strict_psi else psi.isNull() | (psi == 0)
    level = (F.when(silent & ~undefined, "NO_PSI")
             .when(~F.col("psi_critical"), "CRITICAL")
             .when(~F.col("psi_warning"), "WARNING")
             .otherwise("OK"))
    return checked.withColumns({"all_passed": passed, "alert_level": level})


def retrain_trigger(history: DataFrame, limits: config.Thresholds = config.Thresholds(),
                    model: Sequence[str] = ("model_name",), date_col: str = "snapshot_date",
                    every_months: int | None = None) -> DataFrame:
    """Flag periods in which a metric misses its floor for the second time running, or in which the
    index exceeds its critical limit. One row per model and period in, so the window is small.

    ``every_months`` adds the schedule: a period that many months or more after the model's last
    scheduled one, counted from its first, is due as well."""
    order = Window.partitionBy(*model).orderBy(date_col)
    repeated = F.lit(False)
    for metric, low in limits.floors.items():
        fails = F.coalesce(F.col(metric) < low, F.lit(True))
        before = F.lag(fails.cast("int")).over(order)
        repeated = repeated | (fails & F.coalesce(before == 1, F.lit(False)))
    drifted = F.coalesce(F.col("psi") > limits.psi_critical, F.lit(False))
    flags = history.select(*model, date_col, repeated.alias("repeated_failure"), drifted.alias("drifted"))
    if every_months is None:
        return flags.withColumn("retrain", F.col("repeated_failure") | F.col("drifted"))
    first = F.min(date_col).over(Window.partitionBy(*model))
    spell = F.floor(F.months_between(F.trunc(F.col(date_col), "month"), F.trunc(first, "month")) / every_months)
    due = (spell > 0) & (spell > F.coalesce(F.lag("spell").over(order), F.lit(0)))
    return (flags.withColumn("spell", spell).withColumn("scheduled", due).drop("spell")
            .withColumn("retrain", F.col("repeated_failure") | F.col("drifted") | F.col("scheduled")))


def performance_degradation(history: DataFrame, metric: str = config.SELECTION_METRIC,
                            limits: config.Thresholds = config.Thresholds(),
                            model: Sequence[str] = ("model_name",), date_col: str = "snapshot_date",
                            registry: DataFrame | None = None, split: str = "validation") -> DataFrame:
    """Compare a metric with its value in the model's first period that has one, or, given the registry
    table, with the model's value on ``split`` there."""
    order = Window.partitionBy(*model).orderBy(date_col).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.first(metric, ignorenulls=True).over(order)
    floor = F.col("baseline") * (1 - limits.performance_degradation_threshold)
    if registry is not None:
        known = registry.where((F.col("metric") == metric) & (F.col("split") == split)).select(*model, F.col("value").alias("baseline"))
        compared = history.select(*model, date_col, F.col(metric).alias("value")).join(known, [*model], "left")
    else:
        compared = history.select(*model, date_col, F.col(metric).alias("value"), base.alias("baseline"))
    return (compared.select(*model, date_col, "value", "baseline")
            .withColumn("degraded", F.coalesce(F.col("value") < floor, F.lit(False))))
