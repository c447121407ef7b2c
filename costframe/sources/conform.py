"""Columns of a stored table brought to an expected schema by name, without loss.

An export's money may be stored as DOUBLE (FLOAT64), NUMERIC or a narrow DECIMAL. A file is read with
its own types; only fields whose type differs are cast, so filters on the others still reach the scan.

Instants (TIMESTAMP) are read as their UTC wall clock (TIMESTAMP_NTZ) by the read schema, at any depth:
no session zone enters, and a filter on a UTC range is pushed to the scan. Where a table was read
without that schema, `conform` converts through microseconds since the epoch, which no zone enters
either (a cast would follow the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.schema import WIDE_MONEY


def zone_free(kind: T.DataType) -> T.DataType:
    """`kind` with TIMESTAMP as TIMESTAMP_NTZ, at any depth."""
    if isinstance(kind, T.TimestampType):
        return T.TimestampNTZType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, zone_free(f.dataType), f.nullable) for f in kind.fields])
    return T.ArrayType(zone_free(kind.elementType), kind.containsNull) if isinstance(kind, T.ArrayType) else kind


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table with its own types, instants as UTC wall clock."""
    own = spark.read.parquet(path)
    want = zone_free(own.schema)
    return own if want == own.schema else spark.read.schema(want).parquet(path)


def utc_clock(instant: Column) -> Column:
    """UTC wall clock of a TIMESTAMP, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _value(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.DecimalType):
        return col if have == WIDE_MONEY else col.cast(WIDE_MONEY)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        there = {f.name: f.dataType for f in have.fields}
        if have.fieldNames() == want.fieldNames() and not _decimals(want) and all(there[f.name] == f.dataType for f in want.fields):
            return col
        fields = [(_value(col[f.name], there[f.name], f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        if have.elementType == want.elementType and not _decimals(want):
            return col
        return F.transform(col, lambda x: _value(x, have.elementType, want.elementType))
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        return utc_clock(col)
    return col if have == want else col.cast(want)


def _decimals(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_decimals(f.dataType) for f in kind.fields)
    return _decimals(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.DecimalType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the columns of `schema`, by name; money as DECIMAL(28,12), absent columns NULL."""
    there = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (_value(F.col(f.name), there[f.name], f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
