"""Statistics as Column expressions and small DataFrame helpers. Nulls are missing values; NaN never gets this far."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAD_SCALE = 1.4826

#: Coefficients of the rational approximation of the normal quantile (fixed values; relative error below 1.2e-9).
QNORM_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
QNORM_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
QNORM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
QNORM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
QNORM_LOW = 0.02425


def _poly(x: Column, coefficients: tuple[float, ...]) -> Column:
    return reduce(lambda acc, c: acc * x + c, coefficients[1:], F.lit(coefficients[0]))


def qnorm(p: Column) -> Column:
    """The standard normal quantile; null outside (0, 1)."""
    q = p - 0.5
    r = q * q
    middle = q * _poly(r, QNORM_A) / (_poly(r, QNORM_B) * r + 1.0)
    tail = lambda x: _poly(x, QNORM_C) / (_poly(x, QNORM_D) * x + 1.0)
    return (
        F.when((p > 0) & (p < QNORM_LOW), tail(F.sqrt(-2.0 * F.log(p))))
        .when((p >= QNORM_LOW) & (p <= 1 - QNORM_LOW), middle)
        .when((p > 1 - QNORM_LOW) & (p < 1), -tail(F.sqrt(-2.0 * F.log(1.0 - p))))
    )


def qnorm_sql(p: str) -> str:
    """The same expression as DuckDB SQL."""
    poly = lambda x, cs: reduce(lambda acc, c: f"({acc} * {x} + {c!r}::DOUBLE)", cs[1:], f"{cs[0]!r}::DOUBLE")
    r = f"(({p} - 0.5::DOUBLE) * ({p} - 0.5::DOUBLE))"
    tail = lambda x: f"{poly(x, QNORM_C)} / ({poly(x, QNORM_D)} * {x} + 1.0::DOUBLE)"
    low, high = f"sqrt(-2.0::DOUBLE * ln({p}))", f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {p}))"
    return (
        f"CASE WHEN {p} > 0 AND {p} < {QNORM_LOW!r}::DOUBLE THEN {tail(low)} "
        f"WHEN {p} >= {QNORM_LOW!r}::DOUBLE AND {p} <= 1 - {QNORM_LOW!r}::DOUBLE THEN ({p} - 0.5::DOUBLE) * {poly(r, QNORM_A)} / ({poly(r, QNORM_B)} * {r} + 1.0::DOUBLE) "
        f"WHEN {p} > 1 - {QNORM_LOW!r}::DOUBLE AND {p} < 1 THEN -({tail(high)}) END"
    )


def no_nan(c: Column) -> Column:
    """NaN as null: done once where values come in."""
    return F.nanvl(c, F.lit(None).cast("double"))


def over(*by: str):  # noqa: ANN201
    return Window.partitionBy(*by)


def avg_rank(value: str, *by: str) -> Column:
    """Rank with ties averaged among the rows of `by`; null values have none."""
    first = F.rank().over(over(*by, F.col(value).isNull()).orderBy(value))
    ties = F.count("*").over(over(*by, value))
    return F.when(F.col(value).isNotNull(), first + (ties - 1) / 2.0)


def inverse_normal(value: str, *by: str, eps: float = 0.0, least: int = 3) -> Column:
    """Rank-based inverse normal transform; groups of fewer than `least` values stay as they are."""
    n = F.count(value).over(over(*by))
    p = (avg_rank(value, *by) - 0.5) / n
    if eps:
        p = F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))
    return F.when(n < least, F.col(value)).otherwise(qnorm(p))


def zscore(value: str, *by: str, least: int = 3) -> Column:
    """(x - mean) / sd in the rows of `by`; null in groups of fewer than `least` values, 0 where sd is 0."""
    w = over(*by)
    sd, n = F.stddev_samp(value).over(w), F.count(value).over(w)
    z = F.when(sd > 0, (F.col(value) - F.avg(value).over(w)) / sd).otherwise(F.lit(0.0))
    return F.when((n >= least) & F.col(value).isNotNull(), z)


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Every row with the one row of `scalars`; one row by construction (an aggregate without grouping)."""
    return df.crossJoin(F.broadcast(scalars))


def center_and_mad(df: DataFrame, value: str, *by: str, scaled: bool = True) -> DataFrame:
    """`by`, median, mad of `value`: two aggregations, the second over deviations from the first's medians."""
    scale = MAD_SCALE if scaled else 1.0
    if by:
        centers = df.groupBy(*by).agg(F.median(value).alias("median"))
        deviations = df.join(centers, list(by))
        spread = deviations.groupBy(*by).agg((F.median(F.abs(F.col(value) - F.col("median"))) * scale).alias("mad"))
        return centers.join(spread, list(by))
    centers = df.agg(F.median(value).alias("median"))
    spread = with_scalars(df, centers).agg((F.median(F.abs(F.col(value) - F.col("median"))) * scale).alias("mad"), F.first("median").alias("median"))
    return spread.select("median", "mad")


def benjamini_hochberg(p: str, *by: str) -> Column:
    """Adjusted p-values among the non-null ones of `by`; equal p-values have equal ones, by the last of their places."""
    known = (*by, F.col(p).isNull())
    m = F.count(p).over(over(*by))
    place = F.row_number().over(over(*known).orderBy(p))
    scaled = F.col(p) * m / place
    down = over(*known).orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(F.col(p).isNotNull(), F.least(F.min(scaled).over(down), F.lit(1.0)))


def r_squared_by(df: DataFrame, value: str, category: str, *by: str) -> DataFrame:
    """R2 of a one-way model of `value` on `category`, for each `by`: between over total sum of squares."""
    rows = df.filter(F.col(value).isNotNull() & F.col(category).isNotNull())
    cells = rows.groupBy(*by, category).agg(F.count(value).alias("_n"), F.sum(value).alias("_s"), F.sum(F.col(value) * F.col(value)).alias("_q"))
    n, s, q = F.sum("_n"), F.sum("_s"), F.sum("_q")
    return cells.groupBy(*by).agg(F.try_divide(F.sum(F.col("_s") * F.col("_s") / F.col("_n")) - s * s / n, q - s * s / n).alias("r2"), n.alias("n"))


def welch_t(value: str, flag: Column) -> Column:
    """Welch's t of `value`, rows with flag against those without, as an aggregate."""
    a, b = F.when(flag, F.col(value)), F.when(~flag, F.col(value))
    return F.try_divide(F.avg(a) - F.avg(b), F.sqrt(F.var_samp(a) / F.count(a) + F.var_samp(b) / F.count(b)))
