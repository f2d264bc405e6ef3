from pyspark.sql import functions as F

from marketsignals.operators.ids import assign_ids


def test_ids_contiguous_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    out = assign_ids(df, ["k"], base=100, num_partitions=5)
    rows = sorted((r.k, r.id) for r in out.collect())
    assert [i for _, i in rows] == list(range(101, 5101))


def test_ids_base_from_column(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    out = assign_ids(df, ["k"], base=F.lit(10))
    assert sorted((r.k, r.id) for r in out.collect()) == [(1, 11), (2, 12), (3, 13)]
