"""The jobs: seed, export, rebuild."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import canonical, enrich, fx, identify, merge, quality
from ..sources import feeds, store
from ..sources.lineage import stored
from ..schemas import FEEDS, FIELDS

PLACE = ["feed", "feed_rank", "row_ord"]


class Watch:
    """Figures of the stages of a job, counted while the job's own tables are written: no job of its own."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def stage(self, name: str, df: DataFrame, **counts: Column) -> DataFrame:
        """df, whose rows, and those for which each condition holds, are counted once it is written."""
        self._seen[name] = Observation()
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])

    def figures(self) -> dict[str, dict[str, int]]:
        """By stage; waits for a stage that is still being written, so ask once the result has been written."""
        return {name: seen.get for name, seen in self._seen.items()}


@dataclass
class Seeded:
    """What a seed job made."""

    canonical: DataFrame
    rejected: DataFrame
    failed: DataFrame
    merged: DataFrame
    identified: DataFrame
    filled: DataFrame
    watch: Watch

    def figures(self) -> dict[str, dict[str, int]]:
        """By stage, from one pass; ask once ``canonical`` has been written.

        ``parse``: rows, valid ones, and skipped ones by feed; ``convert``: rows, and converted ones; ``identify``: rows with an identifier, and
        those without; ``merge``: securities, and those with a missing field; ``enrich``: securities, and enriched ones; ``canonical``: records.
        """
        out = {stage: dict(own) for stage, own in self.watch.figures().items()}
        out["convert"] = {"n_rows": out["parse"]["n_valid"], "n_converted": out["parse"].pop("n_converted")}
        out["identify"]["n_unidentified"] = out["convert"]["n_rows"] - out["identify"]["n_rows"]
        return out


def parse(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid listings, quarantine) of raw listings."""
    checked = quality.validate(raw, PLACE)
    return quality.valid(checked), quality.rejected(checked, PLACE)


def listings(raw: DataFrame, rates: DataFrame, responses: DataFrame, on_missing_rate: str = "error") -> DataFrame:
    """Parsed, converted and identified listings."""
    return identify.identify(fx.to_usd(parse(raw)[0], rates, on_missing_rate=on_missing_rate), responses).select(*PLACE, *FIELDS)


def seed(raw: DataFrame, rates: DataFrame, responses: DataFrame, quotes: DataFrame | None = None, summaries: DataFrame | None = None, known: DataFrame | None = None, **more) -> Seeded:
    """Raw listings to canonical records: conversion goes before the merge, so that medians are in dollars.

    Validated listings and, where there is enrichment, merged rows are written before they are read more than once; the merge writes what it
    reads. Listings in dollars are not written: they are a column's change of the validated ones.
    ``more``: what else :func:`enrich.enrich` takes.
    """
    watch = Watch()
    bad = F.size("errors") > 0
    skipped = {f"skipped_{f}": bad & (F.col("feed") == f) for f in FEEDS}
    converted = ~bad & ~fx.skips_conversion(["last_price", "market_cap"])
    checked = stored(watch.stage("parse", quality.validate(raw, PLACE), n_valid=~bad, n_converted=converted, **skipped, skipped_others=bad & ~F.coalesce(F.col("feed").isin(*FEEDS), F.lit(False))))
    valid, rejected = quality.valid(checked), quality.rejected(checked, PLACE)
    dollars = fx.to_usd(valid, rates)
    found = identify.identify(dollars, responses).select(*PLACE, *FIELDS)
    merged = merge.merge_listings(watch.stage("identify", found))
    gaps = enrich.missing_fields()
    merged = watch.stage("merge", merged, n_incomplete=gaps)
    full = merged
    if quotes is not None:
        merged = stored(merged)
        full = watch.stage("enrich", enrich.enrich(merged, quotes, summaries, rates, known, found="_enriched", **more), n_enriched=F.col("_enriched"), n_incomplete=gaps).drop("_enriched")
    made = watch.stage("canonical", canonical.canonicalise(full))
    return Seeded(made, rejected, identify.unidentified(dollars, responses), merged, found, full, watch)


def stage_figures(made: Seeded, key: str = "share_class_figi") -> DataFrame:
    """A row a stage of a seed job: rows, distinct keys, duplicates and rows with a missing field.

    Rejected and unidentified rows have no key: their other figures are null. Each figure is one aggregate, so ask for them once the job has run.
    """
    kept = {"identified": made.identified, "merged": made.merged, "filled": made.filled}
    gaps = None
    for stage, df in kept.items():
        own = df.agg(F.count_if(enrich.missing_fields()).alias("n_incomplete")).select(F.lit(stage).alias("stage"), "n_incomplete")
        gaps = own if gaps is None else gaps.unionByName(own)
    out = quality.run_metrics(kept, key).join(gaps, "stage")
    for stage, df in {"rejected": made.rejected, "unidentified": made.failed}.items():
        out = out.unionByName(df.agg(F.count("*").alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows"), allowMissingColumns=True)
    return out


def seed_to(spark: SparkSession, paths: dict[str, str], rates: DataFrame, responses: DataFrame, table: str, quarantine: str, strict: bool = False, after_broken: str = "stop", **more) -> dict[str, dict]:
    """From landed pages to the published table; rejected rows are written beside it. Returns the figures of all stages and feeds.

    A broken page costs its feed what comes after it, or with ``after_broken='skip'`` that page only; with ``strict`` it ends the job.
    """
    reports: dict[str, feeds.FeedReport] = {}
    made = seed(feeds.union_feeds(spark, paths, strict, after_broken, reports), rates, responses, **more)
    made.rejected.write.mode("overwrite").parquet(quarantine)
    store.upsert_canonical(made.canonical, table)
    return made.figures() | {"feeds": {feed: asdict(r) for feed, r in reports.items()}}


def export(spark: SparkSession, table: str, files: str) -> None:
    store.export_ndjson(store.load_canonical(spark, table), files)


def rebuild(spark: SparkSession, files: str, table: str) -> None:
    store.rebuild_from_ndjson(spark, files, table)
