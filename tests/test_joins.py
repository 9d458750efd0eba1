from pyspark.sql import functions as F

from taxoweave.operators.joins import dimension_join, forward_fill, global_position, hot_key_join


def test_hot_keys_are_split_and_nothing_is_lost(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    counts = left.groupBy("k").count()
    for how in ("left", "inner"):
        plain = left.join(right, "k", how)
        salted = hot_key_join(left, right, ["k"], counts=counts, rows="count", spread=["id"], how=how, rows_per_salt=100)
        columns = sorted(plain.columns)
        assert plain.select(columns).exceptAll(salted.select(columns)).isEmpty()
        assert salted.count() == plain.count()


def test_unbounded_dimension_is_shuffled_not_broadcast(spark):
    big, small = spark.range(100).withColumn("k", F.col("id") % 7), spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert dimension_join(big, small, ["k"], bounded=False).count() == 100


def test_positions_are_exact_for_uneven_ids(spark):
    ids = list(range(100)) + [10**12 + i * 7 for i in range(50)] + [-5, 10**15]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(5)
    found = {r.id: r.position for r in global_position(df, "id", buckets=8).collect()}
    assert found == {value: place for place, value in enumerate(sorted(ids))}
    assert global_position(df.limit(0), "id").isEmpty()


def test_forward_fill_crosses_blocks(spark):
    rows = [(1, None, "p"), (2, "a", None), (3, None, None), (11, None, None), (25, "b", "q"), (31, None, None)]
    df = spark.createDataFrame(rows, "n bigint, x string, y string").repartition(3)
    filled = [tuple(r) for r in forward_fill(df, ["x", "y"], "n", block=10).orderBy("n").collect()]
    assert filled == [(1, None, "p"), (2, "a", "p"), (3, "a", "p"), (11, "a", "p"), (25, "b", "q"), (31, "b", "q")]
