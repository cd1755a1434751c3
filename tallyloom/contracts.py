"""Column contracts, written without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def contract(**groups: str) -> T.StructType:
    """``contract(string="a b", int="c")``: fields in the order written, grouped by type."""
    return T.StructType(
        [T.StructField(n, TYPES[kind]) for kind, names in groups.items() for n in names.split()]
    )


def ordered(fields: str) -> T.StructType:
    """``"a string, b int"``: fields in the order written."""
    pairs = (item.split() for item in fields.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])
