"""What sorts whole records sorts no more of them in a task than its share."""

import pytest
from pyspark.sql import functions as F

from tapeforge.operators import keyed
from tapeforge.plans import registry
from tapeforge.sources import store

DIR = "/root/testdata/sf0.001"


@pytest.fixture
def kept_apart(spark):
    """Small partitions are not drawn together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def shares(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_lines_of_one_part_of_a_file_are_dealt_out(spark, monkeypatch, kept_apart):
    """Of 1,000 lines that one task reads, of one key, no task parses and sorts half."""
    given = []
    monkeypatch.setattr(store, "last_wins", lambda df, *more: given.append(df) or keyed.last_wins(df, *more))
    one = store.payloads(registry._canonical_customers(spark, DIR)).select("payload").first()["payload"]
    lines = spark.range(1000).coalesce(1).select(F.lit(one).alias("value"), F.col("id").alias("ord"))
    assert store.parse_ndjson(lines).count() == 1
    assert sum(shares(given[0])) == 1000 and max(shares(given[0])) < 500


def test_records_of_one_part_of_a_file_are_dealt_out(spark, kept_apart):
    """A customer file is one task's to read, its records are several tasks'."""
    n = spark.read.parquet(f"{DIR}/customer.parquet").count()
    made = shares(registry._canonical_customers(spark, DIR))
    assert sum(made) == n and max(made) < n / 2
