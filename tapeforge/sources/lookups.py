"""Landed answers of lookup services: exchange rates, identifiers, quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.identify import query_key
from ..schemas import RATE


def read_fx_rates(spark: SparkSession, path: str) -> DataFrame:
    """currency, rate: foreign units a dollar. An answer that isn't a success is an error with its reason."""
    raw = spark.read.schema("result string, `error-type` string, conversion_rates map<string,string>").option("multiLine", True).json(path)
    failed = F.raise_error(F.concat(F.lit("exchange rates: "), F.coalesce("error-type", F.lit("no reason given"))))
    rates = F.when(F.coalesce(F.col("result"), F.lit("")) != "success", failed.cast("map<string,string>")).otherwise(F.col("conversion_rates"))
    return raw.select(F.explode(rates).alias("currency", "text")).select("currency", F.col("text").try_cast(RATE).alias("rate"))


def read_figi_responses(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """Answers with the query they belong to. ``queries``: query_no, id_type, id_value; columns as identify() needs them."""
    schema = "query_number string, queryId string, request_index string, shareClassFIGI string, ticker string, name string, securityName string"
    raw = spark.read.schema(schema).json(path)
    rows = raw.select(
        query_key({c: F.col(c) for c in ("query_number", "queryId", "request_index")}).alias("query_no"),
        F.col("shareClassFIGI").alias("figi"), "name", F.col("securityName").alias("security_name"), "ticker",
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("ord"),
    )
    return rows.join(queries, "query_no").drop("query_no")


def read_quote_search(spark: SparkSession, path: str) -> DataFrame:
    """query, rank, symbol, longname, shortname of equities, from lines of {query, quotes}."""
    raw = spark.read.schema("query string, quotes array<struct<symbol:string,longname:string,shortname:string,quoteType:string>>").json(path)
    rows = raw.select("query", F.posexplode("quotes").alias("rank", "q")).filter("q.quoteType = 'EQUITY'")
    return rows.select("query", "rank", "q.symbol", "q.longname", "q.shortname")


def flatten_modules(modules: list[Column]) -> Column:
    """One map of several in their order: of a key in more than one the last module's value holds, null or not."""

    def later(a: Column, b: Column) -> Column:
        return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)

    none = F.create_map().cast("map<string,string>")
    out = none
    for m in modules:
        out = later(out, F.coalesce(m, none))
    return out


#: The statuses of a refused answer, for which the flat record is asked.
REFUSED = (401, 500, 502)


def read_quote_summary(spark: SparkSession, path: str, modules: list[str], keep_refused: bool = False) -> DataFrame:
    """symbol and the flattened map m of a quote's modules, from lines of {symbol, status, quoteSummary: {result: [{module: {...}}]}}.

    An answer without results gives nothing. With ``keep_refused`` a line with a refusing status, or with neither status nor answer, is a
    row with an empty map whose column ``refused`` is true.
    """
    schema = "symbol string, status int, quoteSummary struct<result:array<map<string,map<string,string>>>>"
    raw = spark.read.schema(schema).json(path)
    first = F.get(F.col("quoteSummary.result"), F.lit(0))
    refused = F.coalesce(F.col("status").isin(*REFUSED), F.col("quoteSummary").isNull())
    rows = raw.select("symbol", (refused & first.isNull()).alias("refused"), first.alias("first"), flatten_modules([F.try_element_at(first, F.lit(m)) for m in modules]).alias("m"))
    if keep_refused:
        return rows.filter("refused or first is not null").drop("first")
    return rows.filter("first is not null").drop("first", "refused")


def read_flat_quotes(spark: SparkSession, path: str) -> DataFrame:
    """symbol and the map m of the first flat record, from lines of {symbol, quoteResponse: {result: [{...}]}}; answers without one give nothing."""
    raw = spark.read.schema("symbol string, quoteResponse struct<result:array<map<string,string>>>").json(path)
    return raw.select("symbol", F.get(F.col("quoteResponse.result"), F.lit(0)).alias("m")).filter("m is not null")
