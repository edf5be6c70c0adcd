"""Column builders for dirty text and numbers. All of them stay inside code generation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: a plain decimal number; keeps exponents, type suffixes and words such as NaN out of
# integers.
_PLAIN_NUMBER = "^ *[+-]?[0-9]+([.][0-9]*)? *$"


def typed(name: str, target: str, is_text: bool, strip: bool = False) -> str:
    """SQL text of a cast that turns values it cannot represent into null instead of failing the job.

    Text becomes INT by way of a plain decimal number that is cut towards zero; ``strip`` removes
    underscores first. Wide tables are cast by one call with all columns as text, not by a handful
    of calls per column.
    """
    source = f"replace(string(`{name}`), '_', '')" if strip else f"`{name}`"
    if target == "int" and (is_text or strip):
        return f"case when {source} rlike '{_PLAIN_NUMBER}' then try_cast(try_cast({source} as double) as int) end"
    return f"try_cast({source} as {target})"


def cast_columns(df: DataFrame, types: Mapping[str, str], *, strip: Sequence[str] = (),
                 required: bool = False) -> DataFrame:
    """Apply a column -> type map in one projection; columns outside the map pass unchanged.

    ``strip`` names text columns that lose their underscores first. Columns of the map that the
    frame lacks are skipped unless ``required``.
    """
    absent = [c for c in types if c not in df.columns]
    if required and absent:
        raise ValueError(f"columns missing from the feed: {absent}")
    return df.selectExpr(*[
        f"{typed(name, types[name], kind == 'string', name in strip)} as `{name}`" if name in types else f"`{name}`"
        for name, kind in df.dtypes])


def with_if_present(df: DataFrame, name: str, build: Callable[[Column], Column]) -> DataFrame:
    """Replace a column by an expression over itself; leave frames without the column alone."""
    return df.withColumn(name, build(F.col(name))) if name in df.columns else df


def null_outside(c: Column, low, high) -> Column:
    """Values strictly below ``low`` or strictly above ``high`` become null."""
    return F.when((c < low) | (c > high), None).otherwise(c)


def band(c: Column, limits: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first band whose exclusive upper limit lies above the value."""
    (first_limit, first_label), *rest = limits
    result = F.when(c < first_limit, first_label)
    for limit, label in rest:
        result = result.when(c < limit, label)
    return result.otherwise(otherwise)


def map_groups(c: Column, groups: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """Name of the group that lists the value (exact match)."""
    result = None
    for label, members in groups.items():
        hit = c.isin(*members)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(otherwise)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    value = c.cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def nan_to_null(c: Column) -> Column:
    """NaN becomes null: Spark orders NaN above every number, so it must not reach a comparison."""
    value = c.cast("double")
    return F.when(F.isnan(value), None).otherwise(value)
