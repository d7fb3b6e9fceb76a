"""Message schemas. Times travel as text and are parsed on decoding."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)


def _fields(**types) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in types.items()])


TICK = _fields(symbol=StringType(), price=DoubleType(), timestamp=StringType())

# Prices as written by the producer, before they are checked to be numbers.
TICK_TEXT = _fields(symbol=StringType(), price=StringType(), timestamp=StringType())

WINDOW_STAT = _fields(
    timestamp=StringType(),
    symbol=StringType(),
    window=StringType(),
    avg_price=DoubleType(),
    std_price=DoubleType(),
)

MOVING = _fields(
    timestamp=StringType(),
    symbol=StringType(),
    windows=ArrayType(
        _fields(window=StringType(), avg_price=DoubleType(), std_price=DoubleType())
    ),
)

ZSCORES = _fields(
    timestamp=StringType(),
    symbol=StringType(),
    zscores=ArrayType(_fields(window=StringType(), zscore_price=DoubleType())),
)

HIGHER = _fields(timestamp=StringType(), higher_window=DoubleType())
LOWER = _fields(timestamp=StringType(), lower_window=DoubleType())
