"""Small fixed tables built inside the plan.

`createDataFrame` on local rows gives an RDD-backed relation whose size the optimizer cannot see
(it assumes the maximum), so a size-checked broadcast would never fire. A `VALUES` relation is a
local relation with a real size estimate, and it is built with one parser call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit(v, dtype: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_lit(v, f.dataType) for v, f in zip(row, schema.fields)) + ")"
                       for row in rows)
    cols = ", ".join(f"`{f.name}`" for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({cols})")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
