"""Value columns: parsing, units, features and error terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the station file format and the quality gate.
MISSING_SCALED = 999.9
GOOD_QUALITY = ["1", "5", "9"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_cast(value: Column | str, kind: T.DataType | str) -> Column:
    """Cast that stops the job on a value that does not fit, whatever the ANSI setting."""
    cast = _col(value).try_cast(kind)
    bad = F.raise_error(F.concat(F.lit("value does not fit its column: "), _col(value).cast("string")))
    return F.when(_col(value).isNotNull() & cast.isNull(), bad).otherwise(cast)


def split_scaled(field: Column | str) -> tuple[Column, Column]:
    """``"+0123,1"`` to the value 12.3 and the flag ``"1"``; +9999 means missing."""
    parts = F.split(_col(field), ",")
    scaled = F.get(parts, F.lit(0)).try_cast("double") / 10
    return F.nullif(scaled, F.lit(MISSING_SCALED)), F.get(parts, F.lit(1))


def fahrenheit(celsius: Column | str) -> Column:
    return F.round(_col(celsius) * F.lit(9 / 5) + 32, 1)


def normalize_series_id(series_id: Column | str) -> Column:
    return F.translate(_col(series_id), ".", "_")


def station_key(usaf: Column | str, wban: Column | str) -> Column:
    return F.concat(_col(usaf).cast("string"), _col(wban).cast("string"))


def good_quality(flag: Column | str, value: Column | str) -> Column:
    return _col(flag).isin(GOOD_QUALITY) & _col(value).isNotNull()


def positive_or_null(value: Column | str) -> Column:
    return F.when(_col(value) > 0, _col(value))


def trim_range(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies in the closed range; nulls go."""
    return df.filter(F.col(value).between(low, high))


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def add_polynomials(df: DataFrame, temp: str = "temp_F", hour: str = "hour") -> DataFrame:
    h = F.col(hour).cast("double")
    return df.withColumns(
        {
            f"{temp}_squared": F.col(temp) * F.col(temp),
            f"{hour}_squared": h * h,
            f"{hour}_cubed": h * h * h,
        }
    )


def add_month_flags(df: DataFrame, month: str = "month") -> DataFrame:
    return df.withColumns({name: F.col(month) == n for n, name in enumerate(MONTH_NAMES, 1)})


def error_columns(actual: Column | str, predicted: Column | str, prefix: str) -> list[Column]:
    """Signed, absolute, fractional and absolute fractional error; a zero actual gives null fractions."""
    error = _col(actual) - _col(predicted)
    fraction = F.try_divide(error, _col(actual))
    return [
        error.alias(f"{prefix}_error"),
        F.abs(error).alias(f"{prefix}_error_abs"),
        fraction.alias(f"{prefix}_error_pct"),
        F.abs(fraction).alias(f"{prefix}_error_abs_pct"),
    ]
