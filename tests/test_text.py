from pyspark.sql import functions as F

from taxoweave.functions import text as tx


def test_cache_keys_of_null_parts_differ(spark):
    rows = spark.createDataFrame([("X", None), (None, "X"), (None, None), (" X ", "Y")], "d string, v string")
    got = [r[0] for r in rows.select(tx.cache_key(F.col("d"), F.col("v"))).collect()]
    assert got == ["v2__||__X__||__nan", "v2__||__nan__||__X", "v2__||__nan__||__nan", "v2__||__X__||__Y"]
