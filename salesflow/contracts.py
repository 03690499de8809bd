"""Table contracts: columns, types, keys and allowed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table columns and rules.
PROMOTIONS = ("MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5")
PROMOTION_FLAGS = (
    "hasMarkDown1",
    "hasMarkDown2",
    "hasMarkDown3",
    "hasMarkDown4",
    "hasMarkDown5",
)
STORE_TYPES = ("A", "B", "C")
PROMOTION_START = "2011-11-01"
# Columns of money and their decimals.
MONEY = {"Weekly_Sales": 4}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    nullable: bool = False
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    table: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]

    def schema(self) -> T.StructType:
        """The typed schema. Columns stay nullable, so a scan can report what is missing."""
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type), True) for f in self.fields]
        )

    def raw_schema(self) -> T.StructType:
        """The same columns as text, for files whose values still have to be checked."""
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self.fields])

    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _measures(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, "double", nullable=True) for n in names)


def _flags() -> tuple[Field, ...]:
    return tuple(Field(n, "int") for n in PROMOTION_FLAGS)


_STORE = Field("Store", "int", required=True)
_DEPT = Field("Dept", "int", required=True)
_DATE = Field("Date", "date", required=True)
_HOLIDAY = Field("IsHoliday", "boolean", required=True)
_SALES = Field("Weekly_Sales", "double", required=True)

STORES = Contract(
    "stores",
    ("Store",),
    (
        _STORE,
        Field("Type", "string", required=True, allowed=STORE_TYPES),
        Field("Size", "int", required=True),
    ),
)
RAW_FEATURES = Contract(
    "features",
    ("Store", "Date"),
    (
        _STORE,
        _DATE,
        *_measures("Temperature", "Fuel_Price", *PROMOTIONS, "CPI", "Unemployment"),
        _HOLIDAY,
    ),
)
FEATURES = Contract(
    "features",
    ("Store", "Date"),
    (
        _STORE,
        _DATE,
        *_measures("Temperature", "Fuel_Price", *PROMOTIONS),
        *_flags(),
        *_measures("CPI", "Unemployment"),
        _HOLIDAY,
    ),
)
TRAIN = Contract(
    "train_sales", ("Store", "Dept", "Date"), (_STORE, _DEPT, _DATE, _SALES, _HOLIDAY)
)
TEST = Contract("test_sales", ("Store", "Dept", "Date"), (_STORE, _DEPT, _DATE, _HOLIDAY))
MERGED = Contract(
    "merged_data",
    ("Store", "Dept", "Date"),
    (
        _STORE,
        _DEPT,
        _DATE,
        _SALES,
        Field("IsHoliday", "boolean"),
        *_measures("Temperature", "Fuel_Price", *PROMOTIONS),
        *_flags(),
        *_measures("CPI", "Unemployment"),
        Field("Type", "string", allowed=STORE_TYPES),
        Field("Size", "int"),
        Field("Year", "int"),
        Field("Month", "int"),
        Field("Week", "int"),
    ),
)
CONTRACTS = {
    "stores": STORES,
    "features": FEATURES,
    "train_sales": TRAIN,
    "test_sales": TEST,
    "merged_data": MERGED,
}
