"""Column-level functions (all built-in expressions, whole-stage codegen)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def set_label(target="target") -> Column:
    """``Test`` where the target is missing, else ``Train``."""
    return F.when(_c(target).isNull(), "Test").otherwise("Train")


def flag_dummy(c) -> Column:
    """``Y`` -> 1, any other value -> 0, missing stays missing."""
    c = _c(c)
    return F.when(c == "Y", F.lit(1)).when(c.isNotNull(), F.lit(0)).cast("int")


def inf_to_null(c) -> Column:
    """Positive or negative infinity becomes missing."""
    c = _c(c)
    return F.when(F.abs(c) == float("inf"), F.lit(None).cast("double")).otherwise(c)


def year_month_to_date(c) -> Column:
    """Year-month text to its first day (a full date keeps its day).

    Any run of non-digits separates the parts (``2017-06``, ``2017/06``,
    ``2017.6``); unseparated ``201706`` / ``20170615`` also parse. Text that
    is not a date becomes null instead of failing the job.
    """
    t = F.regexp_replace(F.trim(_c(c).cast("string")), "[^0-9]+", "-")
    return F.coalesce(F.try_to_date(t, "yyyy-M-d"), F.try_to_date(t, "yyyy-M"),
                      F.try_to_date(t, "yyyyMMdd"), F.try_to_date(t, "yyyyMM"))


def days_before(ref: str | _dt.date, d) -> Column:
    """Whole days from ``d`` to the reference date ``ref``."""
    return F.datediff(F.lit(ref).cast("date"), _c(d))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 of a timestamp; TIMESTAMP_NTZ is read as UTC."""
    return F.unix_timestamp(_c(ts))


def with_calendar(df: DataFrame, ref_date: str = "2018-02-01",
                  col: str = "first_active_month") -> DataFrame:
    """Sequential mutate: month text -> date, then year, month, days to ref."""
    df = df.withColumn(col, year_month_to_date(col))
    return df.withColumns({
        "year": F.year(col),
        "month": F.month(col),
        "howlong": days_before(ref_date, col),
    })


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def fill_zero(df: DataFrame) -> DataFrame:
    """Every missing numeric cell (null or NaN) becomes 0; Inf is kept."""
    return df.fillna(0, subset=numeric_columns(df))


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows with any missing cell are removed."""
    return df.dropna(how="any")


def report_round(c, digits: int = 4) -> Column:
    """Round half away from zero to ``digits`` places, robust to last-bit noise.

    The value is first snapped to 8 places (so sums added up in another order
    land on the same double), then rounded with the plain ``round(x * 10^d)
    / 10^d`` arithmetic that other engines use as well.
    """
    scale = float(10 ** digits)
    return F.round(F.round(_c(c), 8) * scale) / scale


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (report form for cross-engine comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(report_round(f.name, digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
