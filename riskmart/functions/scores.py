"""Column builders over a predicted probability."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskmart import config


def defined(p: Column) -> Column:
    """Whether a probability is neither null nor NaN."""
    return p.isNotNull() & ~F.isnan(p)


def hard_label(p: Column, threshold: float = config.SCORE_THRESHOLD) -> Column:
    """1 from the threshold upwards, else 0; an undefined probability predicts 0."""
    return F.coalesce((p >= threshold) & ~F.isnan(p), F.lit(False)).cast("int")


def above(p: Column, threshold: float = config.SCORE_THRESHOLD) -> Column:
    """1 strictly above the threshold, else 0 (the diagnostic counterpart of hard_label)."""
    return F.coalesce((p > threshold) & ~F.isnan(p), F.lit(False)).cast("int")


def row_log_loss(p: Column, positive: Column) -> Column:
    """Log loss of one row, the probability kept inside (0, 1); null for an undefined probability."""
    eps = config.LOG_LOSS_EPS
    inside = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return F.when(defined(p), -F.when(positive, F.ln(inside)).otherwise(F.ln(1.0 - inside)))


def grid_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of the equal-width bin on [low, high] that holds x, the last bin closed.

    The quotient can land one bin beside the edge it is compared with, so it is corrected against
    the edges themselves, as an even-grid histogram does.
    """
    step = (high - low) / bins
    guess = F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1))
    lower_edge = low + guess * step
    upper_edge = low + (guess + 1) * step
    return (F.when(x < lower_edge, guess - 1)
            .when((x >= upper_edge) & (guess != bins - 1), guess + 1)
            .otherwise(guess).cast("int"))


def in_bins(name: str, edges=config.PSI_EDGES) -> list[str]:
    """SQL text of one condition per half-open bin between neighbouring edges, the last bin closed."""
    last = len(edges) - 2
    return [f"({name} >= {edges[i]!r}D and {name} {'<=' if i == last else '<'} {edges[i + 1]!r}D)"
            for i in range(last + 1)]


def bin_counts(name: str, edges=config.PSI_EDGES) -> Column:
    """Array of the rows per bin."""
    return F.expr(f"array({', '.join(f'count_if({inside})' for inside in in_bins(name, edges))})")


def stability_index(expected: str, expected_rows: str, actual: str, actual_rows: str,
                    empty_share: float = config.PSI_EMPTY_SHARE) -> Column:
    """Stability index of two array columns of bin counts; null where either side has no rows."""
    def share(count, rows):
        return f"if({count} = 0, {empty_share!r}D, {count} / {rows})"

    e, a = share("e", expected_rows), share("a", actual_rows)
    terms = f"zip_with({expected}, {actual}, (e, a) -> ({a} - {e}) * ln({a} / {e}))"
    return F.expr(f"case when {expected_rows} > 0 and {actual_rows} > 0 "
                  f"then aggregate({terms}, 0D, (total, term) -> total + term) end")
