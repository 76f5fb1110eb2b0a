"""Column functions for the text and date fields of sale records.

Every function returns a native ``Column`` so the work stays inside
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Y/N columns of the property attributes and the
# indicator columns that mark a reference point as elite.
YN_COLUMNS = [
    "residential",
    "commercial",
    "market_hawker",
    "miscellaneous",
    "multistorey_carpark",
    "precinct_pavilion",
]
ELITE_INDICATORS = ["sap_ind", "autonomous_ind", "gifted_ind", "ip_ind"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def storey_mid(c: str | Column) -> Column:
    """H1: ``'07 TO 09'`` -> 8.0; malformed text -> NULL (never fails the job)."""
    parts = F.split(_col(c), " TO ")
    lo = F.try_element_at(parts, F.lit(1)).try_cast("int")
    hi = F.try_element_at(parts, F.lit(2)).try_cast("int")
    return (lo + hi) / F.lit(2.0)


def lease_months(c: str | Column, strict_plural: bool = True) -> Column:
    """H2: ``'73 years 05 months'`` -> 881, ``'60 years'`` -> 720.

    With ``strict_plural`` (the default, for parity) the month part counts only
    when the text contains ``months``: ``'61 years 1 month'`` -> 732.
    """
    text = F.trim(_col(c))
    parts = F.split(text, r"\s+")
    years = F.try_element_at(parts, F.lit(1)).try_cast("int")
    month_part = F.try_element_at(parts, F.lit(3)).try_cast("int")
    marker = "months" if strict_plural else "month"
    months = F.when(text.contains(marker), month_part).otherwise(F.lit(0))
    return years * 12 + months


def yn_to_bool(c: str | Column) -> Column:
    """H3: 'Y' -> true, 'N' -> false, anything else -> NULL."""
    col = _col(c)
    return F.when(col == "Y", F.lit(True)).when(col == "N", F.lit(False))


def map_yn_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """H3 on a frame: convert the listed Y/N columns that are present."""
    present = [c for c in (cols or YN_COLUMNS) if c in df.columns]
    return df.withColumns({c: yn_to_bool(c) for c in present}) if present else df


def month_start(c: str | Column) -> Column:
    """H5: truncate a date or timestamp to the first day of its month (DATE)."""
    return F.trunc(F.to_date(_col(c)), "month")


def month_key(c: str | Column) -> Column:
    """Month as ``'yyyy-MM'`` text, the form used in every report."""
    return F.date_format(_col(c), "yyyy-MM")


def add_months(c: str | Column, n: int) -> Column:
    """H6: add months, clipping at month end."""
    return F.add_months(_col(c), n)


def parse_month(c: str | Column, formats: tuple[str, ...] = ("yyyy-MM", "yyyy-MM-dd", "yyyy/MM", "MM/yyyy", "yyyyMM")) -> Column:
    """A1: parse a month written in one of several formats; snap to month start."""
    col = _col(c).cast("string")
    parsed = F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])
    return month_start(parsed)


def expand_transaction_date(df: DataFrame, month_col: str = "month") -> DataFrame:
    """H4: month -> transaction_month, year, month_numeric; the month column is dropped."""
    m = F.to_date(F.col(month_col))
    return df.withColumns(
        {
            "transaction_month": m,
            "year": F.year(m),
            "month_numeric": F.month(m),
        }
    ).drop(month_col)


def address_key(block: str | Column, street: str | Column) -> Column:
    """H9: the lookup key ``block + ' ' + street``."""
    return F.concat_ws(" ", _col(block), _col(street))


def any_yes(cols: list[str], present: list[str]) -> Column:
    """True when any indicator column equals 'Yes'; absent columns count as 'No'."""
    flags = [F.coalesce(F.col(c) == "Yes", F.lit(False)) for c in cols if c in present]
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def blend(p1: str | Column, p2: str | Column, w1: float = 0.5, w2: float = 0.5) -> Column:
    """Weighted blend of two predictions."""
    return F.lit(w1) * _col(p1) + F.lit(w2) * _col(p2)


def request_month(c: str | Column, as_of: str) -> Column:
    """Request month ``yyyy-MM`` if given and parsable, else the ``as_of`` date."""
    parsed = F.try_to_timestamp(_col(c), F.lit("yyyy-MM"))
    return F.coalesce(F.to_date(parsed), F.to_date(F.lit(as_of)))


def register_sql_functions(spark) -> None:
    """SQL names for H1/H2 as SQL-bodied functions (no Python in the plan)."""
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION storey_mid(s STRING) RETURNS DOUBLE RETURN
           (try_cast(split_part(s, ' TO ', 1) AS INT) + try_cast(split_part(s, ' TO ', 2) AS INT)) / 2.0"""
    )
    spark.sql(
        r"""CREATE OR REPLACE TEMPORARY FUNCTION lease_months(s STRING) RETURNS INT RETURN
           try_cast(split(trim(s), '\\s+')[0] AS INT) * 12 +
           CASE WHEN trim(s) LIKE '%months%' THEN try_cast(try_element_at(split(trim(s), '\\s+'), 3) AS INT) ELSE 0 END"""
    )
