"""Classification metrics and drift against NumPy."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskmart import config
from riskmart.operators import drift, metrics
from riskmart.operators.checks import with_checks


def frame(spark, labels, scores, group=None):
    rows = [(int(y), None if p is None else float(p), g) for y, p, g in zip(labels, scores, group or ["g"] * len(labels))]
    return spark.createDataFrame(rows, "label int, prediction double, g string")


def pair_auc(y, p):
    pos, neg = p[y == 1][:, None], p[y == 0][None, :]
    return ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)


@pytest.mark.parametrize("decimals", [1, 2, 12])
def test_auc_with_ties_over_groups(spark, decimals):
    rng = np.random.default_rng(decimals)
    y, p = rng.integers(0, 2, 3000), np.round(rng.random(3000), decimals)
    g = rng.integers(0, 3, 3000)
    df = frame(spark, y, p, [f"g{k}" for k in g]).repartition(7)
    got = {r.g: r.auc_roc for r in metrics.auc(df, ["g"]).collect()}
    for k in range(3):
        assert got[f"g{k}"] == pytest.approx(pair_auc(y[g == k], p[g == k]), abs=1e-12)
    flipped = df.withColumn("prediction", 1 - F.col("prediction"))
    if decimals < 12:
        assert metrics.auc(flipped).first().auc_roc == pytest.approx(1 - metrics.auc(df).first().auc_roc, abs=1e-12)


def test_auc_of_a_large_group_uses_many_tasks(spark):
    """One group with a third of its rows on one score: ties collapse, the rest spreads over ranges."""
    n = 40000
    df = spark.range(n, numPartitions=6).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(5)).alias("prediction"), F.lit("g").alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = metrics.score_counts(df, ["g"], "label", "prediction")
        chunks = metrics._by_score_chunk(counts, ["g"]).groupBy("chunk").count().collect()
        assert len(chunks) == 4 and max(r["count"] for r in chunks) < 0.4 * counts.count()
        rows = df.select("label", "prediction").toPandas()
        want = pair_auc_sorted(rows["label"].to_numpy(), rows["prediction"].to_numpy())
        assert metrics.auc(df, ["g"]).first().auc_roc == pytest.approx(want, abs=1e-12)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def pair_auc_sorted(y, p):
    values, inverse = np.unique(p, return_inverse=True)
    pos, neg = np.bincount(inverse, y == 1), np.bincount(inverse, y == 0)
    below = np.cumsum(neg) - neg
    return float((pos * (below + neg / 2)).sum() / (pos.sum() * neg.sum()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 1.0])), min_size=1, max_size=40))
def test_metrics_of_small_tables(spark, rows):
    y, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    df = frame(spark, y, p)
    got = metrics.evaluate(df).first()
    hit = p >= 0.5
    tn, fp, fn, tp = (int(((y == a) & (hit == b)).sum()) for a, b in ((0, False), (0, True), (1, False), (1, True)))
    assert (got.true_negatives, got.false_positives, got.false_negatives, got.true_positives) == (tn, fp, fn, tp)
    assert got.accuracy == pytest.approx((tn + tp) / len(y))
    assert got.precision == pytest.approx(tp / (tp + fp) if tp + fp else 0)
    assert got.recall == pytest.approx(tp / (tp + fn) if tp + fn else 0)
    if 0 < y.sum() < len(y):
        clipped = np.clip(p, config.LOG_LOSS_EPS, 1 - config.LOG_LOSS_EPS)
        want = -np.mean(np.where(y == 1, np.log(clipped), np.log(1 - clipped)))
        assert got.log_loss == pytest.approx(want, rel=1e-9)
        assert got.auc_roc == pytest.approx(pair_auc(y, p))
    else:
        assert got.log_loss is None and got.auc_roc is None
    assert sum(got.bins) == len(y) == got.n_rows


def test_evaluate_equals_separate_metrics(spark):
    rng = np.random.default_rng(3)
    df = frame(spark, rng.integers(0, 2, 500), np.round(rng.random(500), 2), [f"g{k}" for k in rng.integers(0, 2, 500)])
    whole = {r.g: r for r in metrics.evaluate(df, ["g"]).collect()}
    single = (metrics.with_rates(metrics.confusion_matrix(df, ["g"])).join(metrics.log_loss(df, ["g"]), "g")
              .join(metrics.auc(df, ["g"]), "g").join(drift.score_histogram(df, ["g"]), "g"))
    for r in single.collect():
        for c in single.columns:
            assert whole[r.g][c] == (pytest.approx(r[c], rel=1e-9) if isinstance(r[c], float) else r[c]), c


def test_undefined_probability_predicts_zero(spark):
    got = metrics.confusion_matrix(frame(spark, [1, 0], [float("nan"), float("nan")])).first()
    assert tuple(got) == (1, 0, 1, 0)


def test_one_class_matrix(spark):
    df = frame(spark, [1, 1], [0.9, 0.8])
    assert tuple(metrics.confusion_matrix(df).first()) == (0, 0, 0, 2)
    assert tuple(metrics.confusion_matrix(df, zero_if_one_class=True).first()) == (0, 0, 0, 0)
    two = frame(spark, [1, 1], [0.9, 0.1])
    assert tuple(metrics.confusion_matrix(two, zero_if_one_class=True).first()) == (0, 0, 1, 1)


def test_threshold_is_inclusive_for_labels_only(spark):
    got = metrics.predicted_rates(frame(spark, [1, 0], [0.5, 0.4])).first()
    assert (got.predicted_rate, got.predicted_rate_strict) == (0.5, 0.0)


@pytest.mark.parametrize("tn, fp, fn, tp, want", [
    (290, 81, 54, 88, (0.7368421, 0.5207100, 0.6197183, 0.5659163)),
    (268, 74, 56, 93, (0.7352342, 0.5568862, 0.6241611, 0.5886076)),
    (281, 62, 52, 103, (0.7710843, 0.6242424, 0.6645161, 0.64375))])
def test_published_confusion_counts(spark, tn, fp, fn, tp, want):
    matrix = spark.createDataFrame([(tn, fp, fn, tp)], list(metrics.MATRIX))
    got = metrics.with_rates(matrix).first()
    assert (got.accuracy, got.precision, got.recall, got.f1_score) == pytest.approx(want, abs=1e-6)


def np_psi(expected, actual):
    edges = np.linspace(0, 1, 11)
    edges[0], edges[-1] = -0.001, 1.001
    e, a = (np.histogram(x, edges)[0] / len(x) for x in (expected, actual))
    e, a = (np.where(x == 0, 0.0001, x) for x in (e, a))
    return float(np.sum((a - e) * np.log(a / e)))


def test_psi_edges_are_the_even_grid():
    edges = np.linspace(0, 1, 11)
    edges[0], edges[-1] = -0.001, 1.001
    assert list(config.PSI_EDGES) == list(edges)


def test_psi(spark):
    rng = np.random.default_rng(1)
    base, now = rng.beta(2, 5, 700), np.concatenate([rng.beta(4, 3, 400), [0.0, 0.3, 0.30000000000000004, 0.6, 0.7, 1.0, 1.5]])
    one, two = (spark.createDataFrame([(float(x),) for x in v], "prediction double") for v in (base, now))
    assert drift.psi_between(one, two).first().psi == pytest.approx(np_psi(base, now), rel=1e-9)
    assert drift.psi_between(one, one).first().psi == 0.0
    days = one.withColumn("snapshot_date", F.lit("2024-01-01")).unionByName(two.withColumn("snapshot_date", F.lit("2024-02-01")))
    got = {r.snapshot_date: r.psi for r in drift.psi_by_snapshot(days).collect()}
    assert got == pytest.approx({"2024-01-01": 0.0, "2024-02-01": np_psi(base, now)})


def test_density(spark):
    rng = np.random.default_rng(2)
    days = {"a": rng.random(500), "b": np.round(rng.random(300), 2), "c": np.full(4, 0.25)}
    df = spark.createDataFrame([(d, float(x)) for d, v in days.items() for x in v], "snapshot_date string, prediction double")
    got = drift.score_density(df).collect()
    for d, v in days.items():
        density, _ = np.histogram(v, bins=50, density=True)
        mine = np.zeros(50)
        for r in got:
            if r.snapshot_date == d:
                mine[r.bin] = r.density
        assert mine == pytest.approx(density, rel=1e-9)


def checked(spark, psi=0.05, auc=0.8, precision=0.7, empty=None, **options):
    df = spark.createDataFrame([(auc, precision, 0.6, 0.6, psi, bool(empty))],
                               "auc_roc double, precision double, recall double, f1_score double, psi double, empty boolean")
    return with_checks(df, empty_overlap="empty" if empty is not None else None, **options).first()


def test_checks_and_alert_levels(spark):
    assert [checked(spark, psi).alert_level for psi in (0.05, 0.1, 0.2, 0.0, None)] == ["OK", "WARNING", "CRITICAL", "NO_PSI", "NO_PSI"]
    assert checked(spark, 0.0, strict_psi=True).alert_level == "OK"
    missing = checked(spark, None, auc=None)
    assert (missing.auc_roc_check, missing.all_passed, missing.psi_warning, missing.psi_critical) == (False, False, True, True)
    empty = checked(spark, None, empty=True)
    assert (empty.alert_level, empty.psi_critical) == ("CRITICAL", False)
    assert checked(spark, 0.5).all_passed and not checked(spark, precision=0.59).all_passed
    assert not math.isnan(checked(spark).psi)


def test_undefined_scores_are_counted(spark):
    """Four of six rows without a score: predicted 0, in no bin, and no AUC or log loss for their group."""
    nan = float("nan")
    df = frame(spark, [0, 0, 1, 1, 0, 1, 0, 1], [0.1, nan, None, nan, None, 0.9, 0.2, 0.8], ["g"] * 6 + ["h"] * 2)
    got = {r.g: r for r in metrics.evaluate(df, ["g"]).collect()}
    matrix = {r.g: tuple(r[c] for c in metrics.MATRIX) for r in metrics.confusion_matrix(df, ["g"]).collect()}
    assert matrix["g"] == (3, 0, 2, 1) == tuple(got["g"][c] for c in metrics.MATRIX)
    assert got["g"].n_rows == 6 and sum(got["g"].bins) == 2 and got["g"].accuracy == pytest.approx(4 / 6)
    assert got["g"].auc_roc is None and got["g"].log_loss is None
    assert got["h"].auc_roc == 1.0 and got["h"].log_loss > 0
    assert {r.g: r.log_loss for r in metrics.log_loss(df, ["g"]).collect()}["g"] is None
    assert {r.g: r.auc_roc for r in metrics.auc(df, ["g"]).collect()} == {"g": None, "h": 1.0}
    histogram = {r.g: (list(r.bins), r.n_rows) for r in drift.score_histogram(df, ["g"]).collect()}
    assert histogram["g"] == (list(got["g"].bins), 6)


def test_other_truths_do_not_count(spark):
    df = frame(spark, [0, 1, 2, -1], [0.1, 0.9, 0.9, 0.1])
    assert tuple(metrics.confusion_matrix(df).first()) == (1, 0, 0, 1)
    got = metrics.evaluate(df).first()
    assert (got.n_rows, got.accuracy, got.auc_roc) == (2, 1.0, 1.0)
