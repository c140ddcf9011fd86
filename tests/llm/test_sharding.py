from pyspark.sql import functions as F

from shelfline.llm import sharding
from shelfline.llm.oracle import sharding_sql


def test_splits_like_sql(spark, documents, against_sql):
    rows = [(i, "ab" * (i % 37)) for i in range(300)] + [(7, None), (None, "x"), (None, None), (900, "z" * 999)]
    df, table = documents(rows)
    assert against_sql(sharding.assign(df, 500), sharding_sql(500), documents=table) is None


def test_equal_rows_go_to_pages(spark, documents, against_sql):
    rows = [(1, "x" * 30)] * 40 + [(2, "é" * 50)] * 3 + [(i, "abc") for i in range(10, 40)]
    df, table = documents(rows)
    got = sharding.assign(df, 100)
    assert against_sql(got, sharding_sql(100), documents=table) is None
    sizes = got.groupBy("bucket", "page").agg(F.sum("n_bytes").alias("n"), F.max("shard_bytes").alias("s"))
    assert all(r.n == r.s <= 100 for r in sizes.collect())


def test_empty_table_and_clashing_columns(spark, documents, tmp_path):
    df, _ = documents([])
    assert sharding.assign(df, 100).count() == 0
    df, _ = documents([(i, "text %d" % i) for i in range(50)])
    odd = df.withColumn("cell", F.lit(1)).withColumn("key", F.lit(2)).withColumn("depth", F.lit("d"))
    assert sharding.assign(odd, 40).count() == 50
    sharding.write(odd, str(tmp_path / "shards"), 40)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.text for r in back.collect()) == sorted("text %d" % i for i in range(50))
    per = back.groupBy("_shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(per) > 5 and all(r.n <= 40 for r in per)
