"""Time parts of the elapsed-time text ``'<day> <word> HH:MM:SS.frac'`` (P1-P4, bands).

All parts come from one regular expression evaluated JVM-side; no UDF. A
value that does not match gives null parts; ``require_time_parts`` counts such
values and raises, before they reach any block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The layout of the elapsed-time text and the hour bands.
TM_PATTERN = r"^\s*(-?\d+)\s+\S+\s+(\d+):(\d+):(\d+)"
# band index -> (name, first hour, last hour)
BANDS = {
    0: ("morning", 0, 5),
    1: ("work_time", 6, 11),
    2: ("afternoon", 12, 17),
    3: ("night", 18, 23),
}


def _part(col: str, group: int) -> Column:
    return F.regexp_extract(F.col(col), TM_PATTERN, group).try_cast("int")


def day_of(col: str = "tm_diff") -> Column:
    return _part(col, 1)


def hour_of(col: str = "tm_diff") -> Column:
    return _part(col, 2)


def minute_of(col: str = "tm_diff") -> Column:
    return _part(col, 3)


def second_of(col: str = "tm_diff") -> Column:
    return _part(col, 4)


def band_of(hour: Column) -> Column:
    """0: hours 0-5, 1: 6-11, 2: 12-17, 3: 18-23."""
    return F.floor(hour / F.lit(6)).cast("int")


def with_time_parts(df: DataFrame, col: str = "tm_diff") -> DataFrame:
    """Add ``days_diff, hour, minute, second, timestamp, week, half_month, band``.

    ``timestamp`` is elapsed seconds ``86400 d + 3600 h + 60 m + s``;
    ``week`` is the day of a 7-day cycle and ``half_month`` of a 15-day cycle.
    """
    d, h, m, s = day_of(col), hour_of(col), minute_of(col), second_of(col)
    return (df
            .withColumns({"days_diff": d, "hour": h, "minute": m, "second": s})
            .withColumns({
                "timestamp": (F.col("days_diff").cast("long") * 86400 + F.col("hour") * 3600
                              + F.col("minute") * 60 + F.col("second")),
                "week": F.pmod(F.col("days_diff"), F.lit(7)),
                "half_month": F.pmod(F.col("days_diff"), F.lit(15)),
                "band": band_of(F.col("hour")),
            }))


def require_time_parts(df: DataFrame, col: str = "tm_diff") -> DataFrame:
    """``df``, if every ``col`` of it has the layout; else an error with their number (one pass)."""
    bad = df.where(day_of(col).isNull() | hour_of(col).isNull() | minute_of(col).isNull() | second_of(col).isNull()).count()
    if bad:
        raise ValueError(f"{bad} values of {col} are not of the form '<day> <word> HH:MM:SS'")
    return df
