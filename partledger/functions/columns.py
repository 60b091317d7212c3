"""Small column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(38,4)"
FILE_DATE_PATTERN = r"cad_metadata_(\d{4})[-_](\d{2})[-_](\d{2})"


def any_null(names: Iterable[str]) -> Column:
    """True where at least one of the columns is null (works for a single column too)."""
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def null_safe(left: DataFrame, right: DataFrame, names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def percent(part: Column, whole: Column) -> Column:
    """100·part/whole for counts, two places, halves up; worked in decimals so ties are exact."""
    exact = F.lit(100) * part.cast("decimal(20,0)")
    return F.round(F.try_divide(exact, whole.cast("decimal(20,0)")), 2).cast("double")


def money(amount: Column) -> Column:
    return F.round(amount, 4).cast(MONEY)


def mean(total: Column, n: Column) -> Column:
    """total/n as money. The casts leave room for 12 places before the one rounding that counts."""
    return money(F.try_divide(total.cast("decimal(28,4)"), n.cast("decimal(12,0)")))


def file_date(path: Column) -> Column:
    """Date in a snapshot file name, written with dashes or underscores; null when there is none."""
    parts = [F.regexp_extract(path, FILE_DATE_PATTERN, i) for i in (1, 2, 3)]
    return F.concat_ws("-", *parts).try_cast("date")


def title_case(text: Column) -> Column:
    return F.trim(F.initcap(text))


def code(text: Column) -> Column:
    return F.trim(F.upper(text))


def trimmed_strings(df: DataFrame) -> DataFrame:
    """Trim every string column that is not technical, in one projection."""
    return df.select(
        [
            F.trim(f.name).alias(f.name)
            if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_prefixed(df: DataFrame, prefixes: tuple[str, ...] = ("_",)) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def age_hours(now: Column, then: Column) -> Column:
    return F.round((F.unix_seconds(now) - F.unix_seconds(then)) / F.lit(3600), 1)


def banded(bands: Sequence[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """The value of the first test that holds."""
    return F.coalesce(*[F.when(test, value) for test, value in bands],
                      otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def content_hash(df: DataFrame) -> Column:
    """Hash of a row; maps are left out, as Spark does not hash them."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def surrogate_key(*parts: Column) -> Column:
    """128-bit key of a natural key: computed anywhere, the same on every run, no numbering pass."""
    return F.md5(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts]))
