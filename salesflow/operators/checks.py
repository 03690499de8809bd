"""Contract checks: required fields, types, allowed values, nulls and unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.contracts import Contract, Field
from salesflow.functions.dates import parse_date
from salesflow.operators.cleaning import whole_number

RULES = ("required", "null", "type", "enum")
VIOLATIONS = "violations"


def _blank(name: str, type_: str) -> Column:
    missing = F.col(name).isNull()
    return missing | (F.trim(name) == "") if type_ == "string" else missing


def _fits(name: str, have: str, want: str) -> Column:
    """Whether a value can be read as the wanted type without losing part of it."""
    if have == want:
        return F.lit(True)
    col = F.trim(name) if have == "string" else F.col(name)
    if want in ("int", "bigint"):
        return whole_number(col, want).isNotNull()
    return (parse_date(col) if want == "date" else col.try_cast(want)).isNotNull()


def _broken(field: Field, types: dict[str, str], rules: Sequence[str]) -> list[Column]:
    """One column per rule of the field: the violation's name, or null."""
    name = field.name
    if name not in types:
        missing = field.required and "required" in rules
        return [F.lit(f"required:{name}")] if missing else []
    blank = _blank(name, types[name])
    out = []
    if field.required and "required" in rules:
        out.append(F.when(blank, F.lit(f"required:{name}")))
    if not field.required and not field.nullable and "null" in rules:
        out.append(F.when(blank, F.lit(f"null:{name}")))
    if "type" in rules:
        bad = ~blank & ~_fits(name, types[name], field.type)
        out.append(F.when(bad, F.lit(f"type:{name}")))
    if field.allowed and "enum" in rules:
        out.append(F.when(~blank & ~F.col(name).isin(*field.allowed), F.lit(f"enum:{name}")))
    return out


def add_violations(
    df: DataFrame, contract: Contract, rules: Sequence[str] = RULES
) -> DataFrame:
    """Adds the array of broken rules, as ``rule:column``; empty for a valid row."""
    types = dict(df.dtypes)
    broken = [c for field in contract.fields for c in _broken(field, types, rules)]
    if not broken:
        return df.withColumn(VIOLATIONS, F.array().cast("array<string>"))
    return df.withColumn(VIOLATIONS, F.array_compact(F.array(*broken)))


def violation_counts(
    df: DataFrame, contract: Contract, rules: Sequence[str] = RULES
) -> DataFrame:
    """Rows per broken rule."""
    return (
        add_violations(df, contract, rules)
        .select(F.explode(VIOLATIONS).alias("violation"))
        .groupBy("violation")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def split_valid(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they came, and rejected rows with their violations."""
    checked = add_violations(df, contract)
    ok = F.size(VIOLATIONS) == 0
    return checked.where(ok).drop(VIOLATIONS), checked.where(~ok)
