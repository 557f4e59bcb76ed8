"""The bucketed feature table: versions, buckets across sessions, plans without a shuffle."""

import pytest
from pyspark.sql import functions as F

from trailguard.sources.feature_table import _name, _published, read_bucketed, write_bucketed


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sample(spark, n, factor=1):
    """A third of all rows are one account's; one key is null."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, F.lit(None)).otherwise(
            F.concat(F.lit("a"), F.col("id"))).alias("account_id"),
        F.concat(F.lit("2022-09-"), F.col("id").cast("string")).alias("feature_date"),
        (F.col("id") * factor).alias("x"))


def test_rows_come_back_and_an_overwrite_replaces_them(spark, tmp_path):
    root = str(tmp_path / "t")
    for factor in (1, 2, 3, 4):
        write_bucketed(sample(spark, 60, factor), root, ["account_id"], ["account_id", "feature_date"], 5)
        assert rows(read_bucketed(spark, root)) == rows(sample(spark, 60, factor))
    assert len(list((tmp_path / "t").glob("v-*"))) == 2              # older versions are deleted
    write_bucketed(sample(spark, 0), root, ["account_id"], buckets=3)
    assert read_bucketed(spark, root).count() == 0


def test_an_unpublished_write_is_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(Exception):
        read_bucketed(spark, root)
    write_bucketed(sample(spark, 30), root, ["account_id"], buckets=3)
    sample(spark, 7).write.parquet(root + "/v-dead")                 # a writer that died before publishing
    assert rows(read_bucketed(spark, root)) == rows(sample(spark, 30))


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    root = str(tmp_path / "t")
    write_bucketed(sample(spark, 30), root, ["account_id"], buckets=3)
    held = read_bucketed(spark, root)
    write_bucketed(sample(spark, 40), root, ["account_id"], buckets=4)
    assert held.count() == 30 and read_bucketed(spark, root).count() == 40


def test_no_shuffle_on_the_key_even_for_a_new_session(spark, tmp_path):
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    write_bucketed(sample(spark, 90), left, ["account_id"], buckets=4)
    write_bucketed(sample(spark, 50, 2).withColumnRenamed("x", "y"), right, ["account_id"], buckets=4)
    for root in (left, right):                                       # another session's catalog is empty
        spark.sql(f"DROP TABLE {_name(_published(spark, root)[0].path)}")
    a, b = read_bucketed(spark, left), read_bucketed(spark, right)
    per = a.groupBy("account_id").agg(F.sum("x").alias("x"))
    both = per.join(b.groupBy("account_id").agg(F.sum("y").alias("y")).hint("merge"), "account_id")
    assert "Exchange" not in plan(both)
    want = {r.account_id: (r.x, r.y) for r in
            sample(spark, 90).groupBy("account_id").agg(F.sum("x").alias("x")).join(
                sample(spark, 50, 2).groupBy("account_id").agg(F.sum("x").alias("y")), "account_id").collect()}
    assert {r.account_id: (r.x, r.y) for r in both.collect()} == want and "hot" in want


def test_profile_reads_buckets_without_a_shuffle(spark):
    from trailguard.plans.q_model import account_profile
    assert "Exchange" not in plan(account_profile(spark, "/root/testdata/sf0.001"))
