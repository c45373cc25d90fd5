"""Filling missing fields from quotes: candidates, choice, summary, fill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import LEAST, MISSING_NAME, candidate_score, common, outlined, ratio_bound, shared, weighted_bound
from ..schemas import FIELDS
from ..sources.lineage import stored
from . import fx, quality


#: How long known enrichment is fresh.
TTL_MINUTES = 1440


def missing_fields(fields: list[str] = FIELDS) -> Column:
    """Whether any of the fields is null."""
    return reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])


def attempts(df: DataFrame, key: str = "share_class_figi") -> DataFrame:
    """key, rung, query, name, symbol: ISIN, CUSIP, then name and symbol where they differ; null ones are left out.

    Rungs are 1, 2 and, for the terms of the last, 3 and 4.
    """
    terms = F.array(F.struct(F.lit(1).alias("rung"), F.col("isin").alias("query")), F.struct(F.lit(2).alias("rung"), F.col("cusip").alias("query")), F.struct(F.lit(3).alias("rung"), F.col("name").alias("query")), F.struct(F.lit(4).alias("rung"), F.nullif("symbol", "name").alias("query")))
    return df.select(key, "name", "symbol", F.explode(terms).alias("x")).select(key, "x.rung", "x.query", "name", "symbol").filter("query is not null")


def viable(quotes: DataFrame) -> DataFrame:
    """Quotes with a symbol and a name of either kind."""
    full = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return quotes.filter(full("symbol") & (full("longname") | full("shortname")))


def _decided(found: DataFrame) -> DataFrame:
    """Of the viable quotes of a query: ``only``, the symbol where there is one quote; ``long`` and ``short``, the first symbol where all such
    names are one; ``has_long`` and ``has_short``, whether there is such a name. Blank names are none.
    """
    place = F.struct("rank", "symbol", "longname", "shortname")
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""

    def one_name(c: str) -> Column:
        name = F.when(has(c), F.col(c))
        return F.when(F.min(name) == F.max(name), F.min_by(F.when(has(c), F.col("symbol")), F.when(has(c), place)))

    named = [x for kind, c in (("long", "longname"), ("short", "shortname")) for x in (one_name(c).alias(kind), F.bool_or(has(c)).alias(f"has_{kind}"))]
    return found.groupBy("query").agg(F.when(F.count("*") == 1, F.min("symbol")).alias("only"), *named)


#: What a bound of a score is raised by, for the rounding of either.
_SLACK = 1e-6


def _best_scored(able: DataFrame, attempt: list[str]) -> DataFrame:
    """attempt and quote: the candidate of the best exact score, if that fits; of equals the first.

    The candidate of the greatest bound of an attempt is scored first; then only those are whose bound reaches that score.
    """
    score = candidate_score("quote", "symbol", "theirs", "name").alias("score")
    lead = able.groupBy(*attempt).agg(F.min_by(F.struct("quote", "symbol", "theirs", "name", "place"), F.struct((-F.col("bound")).alias("b"), "place")).alias("x"))
    lead = stored(lead.select(*attempt, "x.*").withColumn("score", score).select(*attempt, "quote", "place", "score"))
    first = lead.select(*attempt, F.col("score").alias("least"), F.col("place").alias("led"))
    rest = able.join(first, attempt).filter((F.col("bound") >= F.col("least")) & ~F.col("place").eqNullSafe(F.col("led")))
    scored = lead.unionByName(rest.withColumn("score", score).select(*attempt, "quote", "place", "score"))
    best = scored.groupBy(*attempt).agg(F.min_by(F.struct("quote", "score"), F.struct((-F.col("score")).alias("s"), "place")).alias("x"))
    return best.filter(F.col("x.score") >= LEAST).select(*attempt, F.col("x.quote").alias("quote"))


def chosen_quotes(tried: DataFrame, quotes: DataFrame, key: str = "share_class_figi") -> DataFrame:
    """key, rung, quote: the best candidate of each attempt that has one. ``quotes``: query, rank, symbol, longname, shortname.

    As :func:`best_candidate`, with a row for each attempt and candidate: the best score is an aggregate, and no row holds
    a query's quotes. Where the quotes alone decide nothing is scored; else bounds of the scores, of DataFrame functions, say which
    candidates may win at all, and short names are looked at only for attempts that no long name fits.
    """
    found = viable(quotes).select("query", "rank", F.col("symbol").alias("quote"), "longname", "shortname")
    known = tried.join(_decided(found.withColumnRenamed("quote", "symbol")), "query")
    first = F.coalesce("only", "long", F.when(~F.col("has_long"), F.col("short")))
    alone = known.filter(first.isNotNull()).select(key, "rung", first.alias("quote"))
    attempt = [key, "rung"]
    open_ = known.filter(first.isNull()).select(key, "rung", "query", "name", "symbol", "has_long", "has_short", F.col("short").alias("one_short"))
    drawn = outlined(open_, _name=F.coalesce("name", F.lit("")), _symbol=F.coalesce("symbol", F.lit("")))
    # a row for each kind of name: one bound's generated code is short enough to be compiled, that of two isn't
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}name").alias("theirs")) for k in ("long", "short")])).alias("x")
    named = found.select("*", kinds).select(*found.columns, "x.*")
    # each quote makes as many pairs as it is searched for: dealt out evenly, and not drawn together again for being small, they are no few tasks' work
    tasks = int(tried.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = drawn.join(outlined(named.repartition(tasks, "query", "rank"), _quote=F.col("quote"), _theirs=F.coalesce("theirs", F.lit(MISSING_NAME))), "query")
    pairs = pairs.filter(F.when(F.col("kind") == "long", F.col("has_long")).otherwise(F.col("has_short")))
    pairs = pairs.withColumns({"_like": common(F.col("_quote"), F.col("_symbol")), "_m": common(F.col("_theirs"), F.col("_name")), "_w": shared(F.col("_theirs"), F.col("_name"))})
    bound = ratio_bound(F.col("_quote"), F.col("_symbol"), F.col("_like")) + weighted_bound(F.col("_theirs"), F.col("_name"), F.col("_m"), F.col("_w")) + _SLACK
    pairs = pairs.select(*attempt, "kind", "name", "symbol", "quote", "theirs", "one_short", F.struct("rank", "quote", "longname", "shortname").alias("place"), bound.alias("bound"))
    # the task's number changes nothing, but keeps Spark from moving the filter into the join with all that the bound is made of
    pairs = stored(pairs.filter(F.col("bound") + F.lit(0) * F.spark_partition_id() >= LEAST))
    by_long = stored(_best_scored(pairs.filter("kind = 'long'"), attempt))
    left = open_.select(*attempt, "one_short").join(by_long.select(*attempt), attempt, "left_anti")
    by_one = left.filter("one_short is not null").select(*attempt, F.col("one_short").alias("quote"))
    by_short = _best_scored(stored(pairs.filter("kind = 'short' and one_short is null").join(by_long.select(*attempt), attempt, "left_anti")), attempt)
    return alone.unionByName(by_long).unionByName(by_one).unionByName(by_short)


def cascade(chosen: DataFrame, summaries: DataFrame, key: str = "share_class_figi") -> DataFrame:
    """key, rung and the summary's columns of the first rung that yields data.

    ISIN and CUSIP fail over when their quote has no summary. Of name and symbol the first with a quote decides.
    """
    decided = Window.partitionBy(key, F.least("rung", F.lit(3))).orderBy("rung")
    terms = chosen.withColumn("_n", F.row_number().over(decided)).filter("_n = 1").drop("_n")
    fields = [c for c in summaries.columns if c != "symbol"]
    found = terms.join(summaries.withColumnRenamed("symbol", "quote"), "quote")
    best = F.min_by(F.struct("rung", "quote", *fields), "rung")
    return found.groupBy(key).agg(best.alias("x")).select(key, "x.*")


#: A quote's value for each field; of several the first that isn't empty. The other six fields a quote doesn't have.
QUOTE_FIELDS = {
    "name": "longName shortName",
    "currency": "currency",
    "last_price": "currentPrice",
    "market_cap": "marketCap",
    "fifty_two_week_min": "fiftyTwoWeekLow",
    "fifty_two_week_max": "fiftyTwoWeekHigh",
    "dividend_yield": "dividendYield",
    "market_volume": "volume",
    "held_insiders": "heldPercentInsiders",
    "held_institutions": "heldPercentInstitutions",
    "short_interest": "shortPercentOfFloat",
    "share_float": "floatShares",
    "shares_outstanding": "sharesOutstanding",
    "revenue_per_share": "revenuePerShare",
    "profit_margin": "profitMargins",
    "gross_margin": "grossMargins",
    "operating_margin": "operatingMargins",
    "free_cash_flow": "freeCashflow",
    "operating_cash_flow": "operatingCashflow",
    "return_on_equity": "returnOnEquity",
    "return_on_assets": "returnOnAssets",
    "total_debt": "totalDebt",
    "revenue": "totalRevenue",
    "ebitda": "ebitda",
    "trailing_pe": "trailingPE",
    "price_to_book": "priceToBook",
    "trailing_eps": "trailingEps",
    "analyst_rating": "recommendationKey",
    "industry": "industry",
    "sector": "sector",
}


def quote_fields(summary: DataFrame, flat: str = "m") -> DataFrame:
    """symbol, which the quote was asked by, and its fields from the map of its values; ``summary_symbol`` is its own symbol.

    What :func:`enrich` takes as summaries, of what ``read_quote_summary`` reads.
    """
    get = lambda k: F.try_element_at(F.col(flat), F.lit(k))

    def first(keys: str) -> Column:
        own = keys.split()
        return get(own[0]) if len(own) == 1 else F.coalesce(*[F.nullif(get(k), F.lit("")) for k in own[:-1]], get(own[-1]))

    more = [c for c in ("refused",) if c in summary.columns]
    return summary.select("symbol", *more, first("underlyingSymbol symbol").alias("summary_symbol"), *[first(keys).alias(f) for f, keys in QUOTE_FIELDS.items()])


def fill(df: DataFrame, enriched: DataFrame, key: str = "share_class_figi", fields: list[str] | None = None, found: str | None = None) -> DataFrame:
    """Every field of df that is null from the enriched row of its key; ``found``: a column that says whether there is such a row, or was before."""
    fields = [f for f in (fields or FIELDS) if f != key and f in enriched.columns and f in df.columns]
    other = enriched.select(key, F.lit(True).alias("_found"), *[F.col(f).alias(f"_{f}") for f in fields])
    out = df.join(other, key, "left")
    more = [] if found is None else [(F.col("_found").isNotNull() | (F.col(found) if found in df.columns else F.lit(False))).alias(found)]
    return out.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in fields else F.col(c) for c in df.columns if c != found], *more)


def reusable(df: DataFrame, known: DataFrame, on: str, now: Column | None = None, ttl_minutes: int = TTL_MINUTES) -> DataFrame:
    """Of each of df's keys the newest known enrichment that isn't older than ``ttl_minutes`` at ``now``; 0 for no limit.

    ``known`` has ``fetched_at`` in seconds; ``now``, a column of df in seconds or a literal, may differ from row to row of a key: the latest
    counts. The age is a range condition of the join, so old snapshots end there. Without ``fetched_at`` everything known is fresh.
    """
    if ttl_minutes < 0:
        raise ValueError("ttl_minutes is negative")
    if "fetched_at" not in known.columns:
        return known
    if now is None:
        raise ValueError("known enrichment has an age: say what time it is")
    asked = df.groupBy(F.col(on).alias("_on")).agg(F.max(now).alias("_now"))
    age = F.col("_now") - F.col("fetched_at")
    near = (F.col(on) == F.col("_on")) & (age >= 0)
    if ttl_minutes:
        near = near & (age <= 60 * ttl_minutes)
    fresh = known.join(asked, near)
    rest = [c for c in known.columns if c != "fetched_at"]
    # of snapshots of one second any would do; the greatest is the same one each time
    newest = fresh.groupBy("_on").agg(F.max(F.struct("fetched_at", *rest)).alias("_row"))
    return newest.select(*[F.col(f"_row.{c}").alias(c) for c in rest])


def answered(summaries: DataFrame, flat: DataFrame | None) -> DataFrame:
    """The summaries that were answered, and of symbols whose every answer was refused the flat records.

    ``summaries`` may have a column ``refused``; only its symbols are looked for in ``flat``.
    """
    if "refused" not in summaries.columns:
        return summaries
    got = summaries.filter(~F.col("refused")).drop("refused")
    if flat is None:
        return got
    wanted = summaries.filter("refused").select("symbol").distinct().join(got.select("symbol"), "symbol", "left_anti")
    return got.unionByName(flat.drop("refused").join(wanted, "symbol", "left_semi"), allowMissingColumns=True)


def enrich(
    df: DataFrame, quotes: DataFrame, summaries: DataFrame, rates: DataFrame, known: DataFrame | None = None, key: str = "share_class_figi", reuse_key: str | None = None,
    flat: DataFrame | None = None, now: Column | None = None, ttl_minutes: int = TTL_MINUTES, found: str | None = None,
) -> DataFrame:
    """df with missing fields filled. ``summaries``: symbol and raw fields, as of :func:`quote_fields`; ``known``: earlier enrichment by key.

    Complete rows are not looked up. Known enrichment that is fresh (:func:`reusable`) goes before any search, older is searched anew.
    ``flat`` has the records for symbols whose summary was refused. An invalid summary or one whose currency has no rate gives nothing.
    ``found``: a column that says which rows were enriched.
    """
    gaps, complete = df.filter(missing_fields()), df.filter(~missing_fields())
    reuse_key = reuse_key or key
    if known is not None:
        known = stored(reusable(gaps, known, reuse_key, now, ttl_minutes))
    search = gaps if known is None else gaps.join(known.select(reuse_key), reuse_key, "left_anti")
    summaries = answered(summaries, flat)
    own = summaries if "summary_symbol" in summaries.columns else summaries.withColumn("summary_symbol", F.col("symbol"))
    chosen = cascade(chosen_quotes(attempts(search, key), quotes, key), own, key).withColumnRenamed("summary_symbol", "symbol")
    raw = chosen.select(F.col(key).alias("_key"), *[F.col(f) if f in chosen.columns and f != key else F.lit(None).cast("array<string>" if f == "mics" else "string").alias(f) for f in FIELDS])
    usable = quality.valid(stored(quality.validate(raw, ["_key"])))
    usable = fx.to_usd(usable, rates, on_missing_rate="quarantine").filter(~F.col("rate_missing")).drop("rate_missing")
    fresh = usable.drop(key).withColumnRenamed("_key", key)
    out = fill(gaps, fresh, key, found=found)
    if known is not None:
        out = fill(out, known, reuse_key, found=found)
    return out.unionByName(complete if found is None else complete.withColumn(found, F.lit(False)))
