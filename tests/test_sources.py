import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from taxoweave.sources import readers, sinks


def test_sink_keeps_the_order_over_all_files(spark, tmp_path):
    df = spark.range(1000).repartition(7).withColumn("text", F.lit("a, b"))
    path = sinks.write_csv(df, str(tmp_path / "csv"), order_by=["id"])
    lines = [line for part in sorted((tmp_path / "csv").glob("part-*")) for line in part.read_text().splitlines()[1:]]
    assert [int(line.split(",")[0]) for line in lines] == list(range(1000))
    assert spark.read.csv(path, header=True).count() == 1000
    path = sinks.write_parquet(df, str(tmp_path / "parquet"), order_by=["id"])
    assert sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == list(range(1000))


def test_missing_path_is_a_clear_error(spark, tmp_path):
    with pytest.raises(AnalysisException) as error:
        readers.read_transactions(spark, str(tmp_path / "nowhere.csv"))
    assert error.value.getCondition() == "PATH_NOT_FOUND"


def test_rows_are_numbered_over_blocks_and_files(spark, tmp_path):
    """Several files, each read in several blocks."""
    from pyspark.sql import types as T

    from taxoweave.operators.joins import file_ordinals

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        number = 0
        for name in ("a", "b", "c"):
            lines = [f"{number + k},text {number + k}" for k in range(400)]
            number += 400
            (tmp_path / f"{name}.csv").write_text("\n".join(["id,text", *lines]) + "\n")
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
        df = spark.read.schema(schema).option("header", True).csv(str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        found = file_ordinals(df, "n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.n, r.id) for r in found) == [(k + 1, k) for k in range(1200)]
    assert file_ordinals(df.where("id < 0")).isEmpty()
