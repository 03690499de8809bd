"""Cleaning: promotion flags, null handling, coercion and column alignment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.contracts import PROMOTION_START, PROMOTIONS, Contract
from salesflow.functions.dates import parse_date

NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def numeric_columns(df: DataFrame, leave_out: Iterable[str] = ()) -> list[str]:
    skip = set(leave_out)
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in skip]


def flag_promotions(
    df: DataFrame,
    columns: Iterable[str] = PROMOTIONS,
    date: str = "Date",
    start: str = PROMOTION_START,
) -> DataFrame:
    """``has<column>`` is 1 where a value is present on or after ``start``."""
    tracked = F.col(date) >= F.lit(start).cast("date")
    return df.withColumns(
        {
            f"has{c}": F.when(F.col(c).isNotNull() & tracked, 1).otherwise(0)
            for c in columns
        }
    )


def fill_promotions(
    df: DataFrame,
    columns: Iterable[str] = PROMOTIONS,
    date: str = "Date",
    start: str = PROMOTION_START,
    zero_before_start: bool = False,
) -> DataFrame:
    """Missing promotion values become 0; early ones too with ``zero_before_start``."""

    def filled(name: str) -> Column:
        value = F.coalesce(F.col(name), F.lit(0.0))
        if not zero_before_start:
            return value
        return F.when(F.col(date) >= F.lit(start).cast("date"), value).otherwise(F.lit(0.0))

    return df.withColumns({c: filled(c) for c in columns})


def clean_promotions(df: DataFrame, **options) -> DataFrame:
    """Flags first, from the values as they came, then the fill."""
    zero = options.pop("zero_before_start", False)
    return fill_promotions(
        flag_promotions(df, **options), zero_before_start=zero, **options
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Nulls (and NaN) in every numeric column become ``value``; other types stay."""
    return df.fillna(value)


def coerce(
    df: DataFrame,
    contract: Contract,
    defaults: dict[str, object] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Text or loosely typed columns to the contract's types.

    Values that do not fit, NaN and blanks become null; ``defaults`` replaces
    nulls. An optional column the rows lack is null, a required one stays away.
    ``keep`` names columns outside the contract to pass on.
    """
    types = dict(df.dtypes)
    out = []
    for field in contract.fields:
        if field.name in types:
            value = _typed(F.col(field.name), types[field.name], field.type)
        elif field.required:
            continue
        else:
            value = F.lit(None).cast(field.type)
        if defaults and field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.type))
        out.append(value.alias(field.name))
    return df.select(*out, *keep)


def whole_number(col: Column, want: str = "int") -> Column:
    """A number or its text as ``int`` or ``bigint``: ``45.0`` is 45, ``45.5`` and others are null."""
    exact = col.try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast(want))


def _typed(col: Column, have: str, want: str) -> Column:
    if have == "string":
        col = F.trim(col)
        if want == "date":
            return parse_date(col)
        if want == "string":
            return F.nullif(col, F.lit(""))
    if have == want:
        value = col
    elif want in ("int", "bigint"):
        value = whole_number(col, want)
    else:
        value = col.try_cast(want)
    if want in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value


def align_columns(df: DataFrame, wanted: Iterable[str], default: float = 0) -> DataFrame:
    """Add the absent columns of ``wanted`` as ``default``; the others stay as they are."""
    absent = [c for c in wanted if c not in df.columns]
    return df.withColumns({c: F.lit(default) for c in absent}) if absent else df


def keep_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop what is there; an absent name is no error."""
    return df.drop(*names)


def resolve_clash(
    df: DataFrame, name: str = "IsHoliday", suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """One integer column out of ``name`` and its suffixed copies, the left one first."""
    copies = [name + s for s in suffixes if name + s in df.columns]
    source = copies[0] if copies else name
    if source not in df.columns:
        return df
    return df.withColumn(name, F.col(source).cast("int")).drop(*copies)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def drop_null_target(df: DataFrame, target: str = "Weekly_Sales") -> DataFrame:
    return df.dropna(subset=[target])


def features_and_target(
    df: DataFrame, features: Iterable[str], target: str = "Weekly_Sales", keep: Iterable[str] = ()
) -> DataFrame:
    """Rows with a target, reduced to ``keep``, the available features and the target."""
    wanted = dict.fromkeys([*keep, *[c for c in features if c in df.columns], target])
    return drop_null_target(df, target).select(*wanted)
