"""Declared schemas: nothing is inferred from the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

WIDE_ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def wide_sales(day_columns: Sequence[str]) -> T.StructType:
    """One row per series, one integer column per day."""
    ids = {name: T.StringType() for name in WIDE_ID_COLUMNS}
    return _struct(**ids, **{day: T.IntegerType() for day in day_columns})


def wide_sales_from_header(header: Sequence[str]) -> T.StructType:
    """The schema of a wide file whose header names the day columns, in file order."""
    return _struct(**{
        name: T.StringType() if name in WIDE_ID_COLUMNS else T.IntegerType() for name in header
    })


CALENDAR = _struct(
    d=T.StringType(),
    date=T.DateType(),
    wm_yr_wk=T.IntegerType(),
    weekday=T.StringType(),
    wday=T.IntegerType(),
    month=T.IntegerType(),
    year=T.IntegerType(),
    event_name_1=T.StringType(),
    event_type_1=T.StringType(),
    event_name_2=T.StringType(),
    event_type_2=T.StringType(),
    snap_CA=T.IntegerType(),
    snap_TX=T.IntegerType(),
    snap_WI=T.IntegerType(),
)

PRICES = _struct(
    store_id=T.StringType(),
    item_id=T.StringType(),
    wm_yr_wk=T.IntegerType(),
    sell_price=T.DoubleType(),
)

PANEL = T.StructType(
    _struct(
        id=T.StringType(), store_id=T.StringType(), item_id=T.StringType(),
        dept_id=T.StringType(), cat_id=T.StringType(), state_id=T.StringType(),
        day_num=T.IntegerType(), sales=T.LongType(),
    ).fields
    + [f for f in CALENDAR.fields if f.name != "d"]
    + [T.StructField("sell_price", T.DoubleType())]
)

MODEL_METADATA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("training_info", T.MapType(T.StringType(), T.StringType())),
    T.StructField("type", T.StringType()),
])

DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
