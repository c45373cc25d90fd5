"""What a seed job writes and does once."""

from pyspark.sql import functions as F

from tapeforge.plans import jobs
from tapeforge.schemas import FIELDS


def test_listings_in_dollars_are_not_written(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "stored", lambda df: seen.append(df) or df)
    monkeypatch.setattr(jobs.merge, "merge_listings", lambda df: df)
    raw = spark.range(1).select(F.lit("sec").alias("feed"), F.lit(3).alias("feed_rank"), F.lit(1).cast("long").alias("row_ord"), *[F.lit(None).cast("array<string>" if f == "mics" else "string").alias(f) for f in FIELDS])
    jobs.seed(raw, spark.createDataFrame([("EUR", "0.5")], "currency string, rate string"), spark.createDataFrame([], "id_type string, id_value string, figi string, name string, ticker string, ord int"))
    assert len(seen) == 1
