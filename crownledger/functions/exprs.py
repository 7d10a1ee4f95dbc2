"""Column rules used across the layers. Everything is a built-in Spark expression, no UDFs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownledger.schemas import AGE_BANDS, GENDER_WORDS

MONEY = "decimal(12,2)"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def money(value) -> Column:
    return as_column(value).cast(MONEY)


def day(value: date) -> Column:
    return F.lit(value).cast("date")


# --- aggregates ------------------------------------------------------------------------------


def rows() -> Column:
    """Number of rows, as BIGINT."""
    return F.count(F.lit(1))


def n_if(flag) -> Column:
    """Rows on which the flag is true, as BIGINT (0 on an empty or all-null group)."""
    return F.count_if(as_column(flag))


def sum_if(amount, flag) -> Column:
    """Sum of an amount over flagged rows; unflagged rows count as zero."""
    return F.sum(F.when(as_column(flag), as_column(amount)).otherwise(F.lit(0)))


def rate_pct(flag, digits: int = 2) -> Column:
    """Share of flagged rows in percent, rounded once on the DOUBLE value."""
    return F.round(F.try_divide(F.lit(100.0) * n_if(flag), F.count(F.lit(1))), digits)


def mean_r(value, digits: int) -> Column:
    """Rounded mean: exact sum first, one division in DOUBLE."""
    value = as_column(value)
    return F.round(F.try_divide(F.sum(value).cast("double"), F.count(value)), digits)


def total(value) -> Column:
    """Money total, exact in DECIMAL; :func:`edge` turns it into DOUBLE for outside readers."""
    return F.sum(as_column(value))


def share_pct(num, den, digits: int = 1) -> Column:
    """100 * num / den of two aggregated amounts; NULL when the denominator is zero."""
    return F.round(F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double")), digits)


# --- scalar rules ----------------------------------------------------------------------------


def benefit_year(value, start_month: int = 9) -> Column:
    """Label ``YYYY-YY`` of the twelve months that start on day one of ``start_month``."""
    value = as_column(value)
    first = F.year(value) - F.when(F.month(value) >= start_month, 0).otherwise(1)
    return F.concat(first.cast("string"), F.lit("-"), F.lpad(((first + 1) % 100).cast("string"), 2, "0"))


def month_of(value) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(as_column(value).cast("date"), "month")


def age_group(age) -> Column:
    """The first band whose last age is not below ``age``. An unknown age falls into the last band; see the null-age quality rule."""
    age = as_column(age)
    bands = [F.when(age <= last, F.lit(name)) if last is not None else F.lit(name) for last, name in AGE_BANDS]
    return F.coalesce(*bands)


def gender_word(code) -> Column:
    code = as_column(code)
    return F.coalesce(*[F.when(code == short, F.lit(word)) for short, word in GENDER_WORDS], F.lower(code))


def guarded_pct(part, whole, digits: int = 2) -> Column:
    """Percentage of a limit; 0 where the limit is not positive, and never a division by zero."""
    part, whole = as_column(part).cast("double"), as_column(whole).cast("double")
    return F.when(whole > 0, F.round(F.try_divide(part, whole) * 100.0, digits)).otherwise(F.lit(0.0))


def utilization_band(pct) -> Column:
    pct = as_column(pct)
    return (
        F.when(pct < 25, "0-25%")
        .when(pct < 50, "25-50%")
        .when(pct < 75, "50-75%")
        .when(pct < 100, "75-100%")
        .otherwise("100%+")
    )


def aging_band(days) -> Column:
    days = as_column(days)
    return F.when(days <= 30, "0-30").when(days <= 60, "31-60").when(days <= 90, "61-90").otherwise("90+")


def is_overdue(due, balance, as_of: date) -> Column:
    return (day(as_of) > as_column(due)) & (as_column(balance) > 0)


def stable_key(*parts) -> Column:
    """SHA-256 over the parts joined by ``::``; the same parts always give the same key."""
    return F.sha2(F.concat_ws("::", *[as_column(p).cast("string") for p in parts]), 256)


def snippet(text, size: int = 200) -> Column:
    """White space collapsed to single blanks, cut to ``size`` characters."""
    return F.substring(F.trim(F.regexp_replace(as_column(text), r"\s+", " ")), 1, size)


def base_name(uri) -> Column:
    return F.element_at(F.split(as_column(uri), "/"), -1)


def to_weekday(value) -> Column:
    """Saturday and Sunday move to the next Monday, other days stay."""
    value = as_column(value).cast("date")
    dow = F.dayofweek(value)
    return F.date_add(value, F.when(dow == 7, 2).when(dow == 1, 1).otherwise(0))


def within(a, b, tolerance: str = "0.02") -> Column:
    """|a - b| below a money tolerance, compared in DECIMAL; NULL if either side is NULL."""
    return F.abs(as_column(a) - as_column(b)) < F.lit(tolerance).cast("decimal(6,4)")


# --- edges -----------------------------------------------------------------------------------


def edge(df: DataFrame) -> DataFrame:
    """DECIMAL columns to DOUBLE and small integers to BIGINT, for readers outside the engine."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint").alias(field.name)
        out.append(col)
    return df.select(*out)
