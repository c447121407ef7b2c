import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from costframe.sinks.files import display_rows, rows_to_json, write_csv, write_sku_map
from costframe.schema import SKU_MAP


def test_rows_to_json_keeps_nulls_and_decimal_text(spark):
    df = spark.createDataFrame([("a", Decimal("1.50"), dt.date(2024, 1, 2), None)] * 3 + [("b", None, None, 1)],
                               "k string, m decimal(18,6), d date, n int")
    out = [json.loads(r.json) for r in rows_to_json(df, [F.col("k")], n=2).collect()]
    assert out == [{"k": "a", "m": "1.500000", "d": "2024-01-02", "n": None}] * 2
    assert display_rows(df, [F.col("k").desc()], n=1).collect()[0].k == "b"


def test_csv_and_sku_map_writers(spark, tmp_path):
    df = spark.createDataFrame([("n2-standard-2", 1.5, 1.0, 0.5)], "machine_type string, a double, b double, c double")
    write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "csv")).collect()
    assert back[0].machine_type == "n2-standard-2"
    m = spark.createDataFrame([("cpu", "n2-predefined", "r", "S"), ("gpu", "nvidia-l4", "r", "G")], SKU_MAP)
    write_sku_map(m, str(tmp_path / "map"))
    assert sorted(p.name for p in (tmp_path / "map").iterdir() if p.name.startswith("kind=")) == ["kind=cpu", "kind=gpu"]
