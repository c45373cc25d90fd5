"""Landed feed pages to listings in one layout.

Pages are JSON files with explicit schemas; numbers are read as their text. A listing's order is its place: the place of its page,
by the number in the file's name (1.json, page-10.json) and then by the name, and its position in the page.

A page that can't be read, isn't JSON of the expected form, or has gone since it was listed costs that page only, and what a feed
gave before it holds (:func:`union_feeds`); the readers of single feeds fail at it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..operators.keyed import first_wins
from ..schemas import FEEDS, FIELDS
from .lineage import stored

log = logging.getLogger(__name__)

#: Exchanges of one feed by code.
SEC_MICS = {"Nasdaq": "XNAS", "NYSE": "XNYS", "CBOE": "XCBO", "OTC": "XOTC"}

#: Of each feed a page's form; a column that takes the text of a page that isn't of it stands beside the outermost fields.
_BROKEN = "_broken"
EURONEXT = "struct<aaData:array<array<string>>,_broken:string>"
XETRA = (
    "struct<data:array<struct<name:struct<originalValue:string>,wkn:string,isin:string,slug:string,mic:string,overview:struct<lastPrice:string>,"
    "performance:struct<weeks52Low:string,weeks52High:string,performance1Year:string>,"
    "keyData:struct<marketCapitalisation:string,dividendYield:string,priceBookRatio:string,earningsPerShareBasic:string>>>,_broken:string>"
)
LSE = (
    "array<struct<content:array<struct<name:string,value:struct<content:array<struct<issuername:string,tidm:string,isin:string,mics:array<string>,currency:string,lastprice:string,"
    "marketcapitalization:string,fiftyTwoWeeksMin:string,fiftyTwoWeeksMax:string>>>>>>>"
)
SEC = "struct<data:array<array<string>>,_broken:string>"


def _lse_items(page: Column) -> Column:
    """Of the first block named priceexplorersearch of a page's first element."""
    return F.get(F.filter(F.get(page, F.lit(0))["content"], lambda c: c["name"] == "priceexplorersearch"), F.lit(0))["value"]["content"]


_FORMS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "euronext": (EURONEXT, lambda p: p["aaData"]),
    "xetra": (XETRA, lambda p: p["data"]),
    "lse": (LSE, _lse_items),
    "sec": (SEC, lambda p: p["data"]),
}


def _plain(page: Column) -> Column:
    """A file's name with one slash after its scheme, however it came to be written."""
    return F.regexp_replace(page, "^([A-Za-z0-9]+):/+", "$1:/")


def _named(spark: SparkSession, path: str) -> DataFrame:
    """page, page_no: the files there by their number, those without one last, and by name. The driver has listed them; empty ones count."""
    files = spark.createDataFrame([(f,) for f in spark.read.format("binaryFile").load(path).inputFiles()], "page string").select(_plain(F.col("page")).alias("page"))
    name = F.element_at(F.split("page", "/"), -1)
    number = F.regexp_extract(name, r"(\d{1,18})\D*$", 1).try_cast("long")
    return files.withColumn("page_no", F.row_number().over(Window.orderBy(number.asc_nulls_last(), name, "page")) - 1)


def _items(spark: SparkSession, path: str, feed: str, strict: bool = True) -> DataFrame:
    """page, broken, pos and item: a row for each item, and one without for a page that has none or is broken."""
    form, items = _FORMS[feed]
    read = spark.read.option("wholetext", True).option("ignoreCorruptFiles", not strict).option("ignoreMissingFiles", not strict).text(path)
    pages = read.select(_plain(F.col("_metadata.file_path")).alias("page"), "value").select("page", F.from_json("value", form, {"columnNameOfCorruptRecord": _BROKEN}).alias("p"))
    broken = F.col("p").isNull() | (F.col("p")[_BROKEN].isNotNull() if form.startswith("struct") else F.lit(False))
    if strict:
        broken = F.when(broken, F.raise_error(F.concat(F.lit(f"{feed}: not a page: "), F.col("page"))).cast("boolean")).otherwise(F.lit(False))
    return pages.select("page", broken.alias("broken"), items(F.col("p")).alias("items")).select("page", "broken", F.posexplode_outer(F.when(~F.col("broken"), F.col("items"))).alias("pos", "item"))


def _ordered(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """The items with their row_ord."""
    own = rows.filter("pos is not null").join(pages, "page")
    return own.withColumn("row_ord", F.col("page_no").cast("long") * F.lit(1 << 32) + F.col("pos")).drop("page", "page_no", "broken", "pos")


def _listing(rows: DataFrame, feed: str, fields: dict[str, Column], keys: dict[str, Column]) -> DataFrame:
    """The common layout: feed, feed_rank, row_ord, the raw keys, and all fields as text (mics as an array)."""
    null = lambda f: F.lit(None).cast("array<string>" if f == "mics" else "string")
    return rows.select(
        F.lit(feed).alias("feed"), F.lit(FEEDS.index(feed)).alias("feed_rank"), "row_ord", *[c.cast("string").alias(k) for k, c in keys.items()], *[fields.get(f, null(f)).alias(f) for f in FIELDS]
    )


def normalise_euronext(rows: DataFrame) -> DataFrame:
    """Of a column item with a row's cells of HTML; short rows are padded, rows without name or symbol are left out."""
    cell = lambda i: F.coalesce(F.try_element_at("item", F.lit(i + 1)), F.lit(""))
    currency, price = N.html_price(cell(5))
    raw = rows.select("row_ord", N.html_text(cell(1)).alias("name"), cell(2).alias("isin"), N.html_text(cell(3)).alias("symbol"), N.html_mics(cell(4)).alias("mics"), currency.alias("currency"), price.alias("price"))
    raw = raw.filter("name <> '' and symbol <> ''")
    fields = {"name": F.col("name"), "symbol": F.col("symbol"), "isin": F.col("isin"), "mics": F.col("mics"), "currency": F.col("currency"), "last_price": F.col("price")}
    return _listing(raw, "euronext", fields, {"feed_key": F.col("isin")})


def normalise_xetra(rows: DataFrame) -> DataFrame:
    """Of a column item with a nested record; one without a name is kept and fails validation later."""
    d = F.col("item")
    fields = {
        "name": d["name"]["originalValue"], "symbol": d["wkn"], "isin": d["isin"], "currency": F.lit("EUR"),
        "mics": F.when(d["mic"].isNotNull(), F.array(d["mic"])).otherwise(F.array(F.lit("XETR"))),
        "last_price": d["overview"]["lastPrice"], "market_cap": d["keyData"]["marketCapitalisation"], "dividend_yield": d["keyData"]["dividendYield"],
        "price_to_book": d["keyData"]["priceBookRatio"], "trailing_eps": d["keyData"]["earningsPerShareBasic"],
        "fifty_two_week_min": d["performance"]["weeks52Low"], "fifty_two_week_max": d["performance"]["weeks52High"], "performance_1_year": d["performance"]["performance1Year"],
    }
    return _listing(rows, "xetra", fields, {"feed_key": d["isin"]})


def normalise_lse(rows: DataFrame) -> DataFrame:
    """Of a column item; pence become pounds first, a missing list of codes is the exchange's own."""
    d = F.col("item")
    price, currency = N.gbx_to_gbp(d["lastprice"], d["currency"])
    fields = {
        "name": d["issuername"], "symbol": d["tidm"], "isin": d["isin"], "currency": currency, "last_price": price, "market_cap": d["marketcapitalization"],
        "mics": F.when(F.coalesce(F.size(d["mics"]), F.lit(0)) > 0, d["mics"]).otherwise(F.array(F.lit("XLON"))),
        "fifty_two_week_min": d["fiftyTwoWeeksMin"], "fifty_two_week_max": d["fiftyTwoWeeksMax"],
    }
    return _listing(rows, "lse", fields, {"feed_key": d["isin"]})


def normalise_sec(rows: DataFrame, keep_cik: bool = False) -> DataFrame:
    """Of a column item with cik, name, symbol, exchange; rows with fewer or with a blank or zero among them are left out.

    A document is one line: its rows are dealt out anew.
    """
    at = lambda i: F.try_element_at("item", F.lit(i + 1))
    full = F.size("item") >= 4
    for i in range(4):
        full = full & ~N.is_blank(at(i)) & (at(i) != "0")
    codes = F.create_map(*[F.lit(x) for kv in SEC_MICS.items() for x in kv])
    code = F.try_element_at(codes, at(3))
    fields = {"name": at(1), "symbol": at(2), "mics": F.when(code.isNotNull(), F.array(code)).otherwise(F.array().cast("array<string>"))}
    if keep_cik:
        fields["cik"] = F.lpad(at(0), 10, "0")
    return _listing(rows.repartition("row_ord").filter(full), "sec", fields, {"feed_key": at(0)})


def read_euronext(spark: SparkSession, path: str) -> DataFrame:
    return normalise_euronext(_ordered(_items(spark, path, "euronext"), _named(spark, path)))


def read_xetra(spark: SparkSession, path: str) -> DataFrame:
    return normalise_xetra(_ordered(_items(spark, path, "xetra"), _named(spark, path)))


def read_lse(spark: SparkSession, path: str) -> DataFrame:
    return normalise_lse(_ordered(_items(spark, path, "lse"), _named(spark, path)))


def read_sec(spark: SparkSession, path: str, keep_cik: bool = False) -> DataFrame:
    return normalise_sec(_ordered(_items(spark, path, "sec"), _named(spark, path)), keep_cik)


@dataclass
class FeedReport:
    """What became of a feed: its pages, the broken ones, the pages left out for them (themselves included), and its failure where it had no page at all."""

    pages: int = 0
    broken: int = 0
    left_out: int = 0
    failure: str | None = None


def _isolated(spark: SparkSession, path: str, feed: str, after_broken: str) -> tuple[DataFrame, FeedReport]:
    """The items of a feed's good pages, read once and written, and what became of it."""
    named = stored(_named(spark, path))
    items = stored(_items(spark, path, feed, strict=False))
    read = items.groupBy("page").agg(F.bool_or("broken").alias("broken"))
    state = named.join(read, "page", "left").select("page", "page_no", F.coalesce("broken", F.lit(True)).alias("broken"))
    pages, broken, first = state.agg(F.count("*"), F.count_if("broken"), F.min(F.when(F.col("broken"), F.col("page_no")))).first()
    stop = pages if first is None or after_broken == "skip" else first
    report = FeedReport(pages, broken, broken if after_broken == "skip" else pages - stop)
    if broken:
        names = [r["page"] for r in state.filter("broken").orderBy("page_no").limit(SHOWN).collect()]
        log.warning("feed %s: %d of %d pages can't be read, %d are left out: %s", feed, broken, pages, report.left_out, ", ".join(names))
    return _ordered(items.filter(~F.col("broken")), named.filter(F.col("page_no") < stop)), report


#: Broken pages that the log names.
SHOWN = 20
_NORMALISED = {"euronext": normalise_euronext, "xetra": normalise_xetra, "lse": normalise_lse, "sec": normalise_sec}
_READERS = {"euronext": read_euronext, "xetra": read_xetra, "lse": read_lse, "sec": read_sec}


def union_feeds(spark: SparkSession, paths: dict[str, str], strict: bool = True, after_broken: str = "stop", reports: dict[str, FeedReport] | None = None) -> DataFrame:
    """All feeds, the first row of each feed's key only. With ``strict`` any broken page is an error, but for an
    empty file, which has no items.

    Without it a broken page is logged and counted in ``reports``: with ``after_broken='stop'`` a feed gives the pages before its first
    broken one, as a feed that is fetched page by page would; with 'skip' it gives all good ones. A feed without pages is left out.
    """
    if after_broken not in ("stop", "skip"):
        raise ValueError(f"after_broken is {after_broken!r}")
    reports = {} if reports is None else reports
    out = None
    for feed in FEEDS:
        if feed not in paths:
            continue
        if strict:
            rows = _READERS[feed](spark, paths[feed])
        else:
            try:
                items, reports[feed] = _isolated(spark, paths[feed], feed, after_broken)
            except Exception as error:
                log.exception("feed %s can't be read and is left out", feed)
                reports[feed] = FeedReport(failure=str(error).splitlines()[0])
                continue
            rows = _NORMALISED[feed](items)
        rows = first_wins(rows, "feed_key", "row_ord").drop("feed_key")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no feed could be read")
    return out
