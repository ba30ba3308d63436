"""Column expressions: missing values, safe arithmetic, full windows.

Missing is always NULL, never NaN: ``no_nan`` is applied at every scan.  ``rolling`` gives a value only where the whole
window is there and not missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def by_time(*keys: str, order: str = "timestamp") -> WindowSpec:
    return Window.partitionBy(*(keys or ("symbol",))).orderBy(order)


def W() -> WindowSpec:
    return by_time()


def roll(n: int, w: WindowSpec | None = None) -> WindowSpec:
    return (w or W()).rowsBetween(-(n - 1), 0)


def rolling(agg: Column, x: Column, n: int, w: WindowSpec | None = None) -> Column:
    """``agg`` over the last n rows, where ``x`` has n values."""
    return F.when(F.count(x).over(roll(n, w)) == n, agg.over(roll(n, w)))


def fill(x: Column, w: WindowSpec | None = None, backward: bool = True) -> Column:
    """Last value so far; the leading gap takes the first value of the whole partition."""
    w = w or W()
    forward = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if not backward:
        return forward
    return F.coalesce(forward, F.first(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def clip(x: Column, low, high) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low) if not isinstance(low, Column) else low), F.lit(high) if not isinstance(high, Column) else high))


def no_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in all float columns."""
    return df.select(*[F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name) for f in df.schema])


def number(x: Column) -> Column:
    """Text to a finite or missing number."""
    x = x.try_cast("double")
    return F.when(~F.isnan(x), x)


def ln(x: Column) -> Column:
    """Natural logarithm of positive values, else missing."""
    return F.when(x > 0, F.ln(x))


def numeric(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() in ("double", "float", "integer", "long", "short") and f.name not in skip]


def argmax(probabilities: Column) -> Column:
    """0-based place of the first largest element."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def interval(days) -> Column:
    """A day interval; fractions of days are allowed."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(days) * 86400).cast("decimal(18,6)"))
