"""Queries of the securities master over the driver's tables, each with the SQL that says the same.

The tables hold no securities, so listings are made of orders, customers, suppliers, parts and line items. Rates are a
fixed small table; everything else is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions.similarity import fuzzy_representative
from ..operators import canonical, enrich, fx, identify, keyed, merge, quality
from ..schemas import AMOUNT, FIELDS, FINANCIALS, IDENTITY, field_type
from ..sources import buckets, lookups, store
from ..sources.lineage import scratch, stored
from . import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Units a dollar.
RATES = {"USD": "1", "EUR": "0.92130000", "GBP": "0.78450000", "JPY": "151.37000000", "CHF": "0.88120000"}
_CURRENCIES = list(RATES)
_SQL_CURRENCY = "list_value(" + ", ".join(f"'{c}'" for c in _CURRENCIES) + ")[n_nationkey % 5 + 1]"
_SQL_RATES = "(values " + ", ".join(f"('{c}', {round(float(r) * 10**8)}::hugeint)" for c, r in RATES.items()) + ") fx(currency, rate8)"
#: Half-even cents of a price in cents over a rate in hundred-millionths.
_SQL_CENTS = """(select q + case when 2 * r > rate8 or (2 * r = rate8 and q % 2 = 1) then 1 else 0 end
  from (select (cents * 100000000) // rate8 as q, (cents * 100000000) % rate8 as r))"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _rates(spark: SparkSession, without: tuple[str, ...] = ()) -> DataFrame:
    return spark.createDataFrame([(c, r) for c, r in RATES.items() if c not in without], "currency string, rate string")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast(AMOUNT)


def _figi(seed: Column) -> Column:
    return F.upper(F.substring(F.md5(seed.cast("string").cast("binary")), 1, 12))


def _listed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the currency of the customer's nation."""
    currency = F.get(F.array(*[F.lit(c) for c in _CURRENCIES]), F.col("n_nationkey") % 5)
    nation = _read(spark, sf_dir, "nation").select("n_nationkey")  # a row a nation
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = _read(spark, sf_dir, "orders")
    out = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", _money("o_totalprice").alias("last_price"), currency.alias("currency"))


def merged_orders(usd: DataFrame) -> DataFrame:
    """The listings of each o_custkey merged; each rule counts by (key, value) first, so that no row holds a key's listings."""
    key, order = "o_custkey", "o_orderkey"
    symbols = keyed.mode_first_seen(usd, key, "o_orderpriority", order, "symbol")
    firsts = usd.filter("o_orderstatus is not null").groupBy(key, "o_orderstatus").agg(F.min(order).alias("first"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("first", "o_orderstatus"))), lambda x: x["o_orderstatus"])  # distinct ones, as in the result
    statuses = firsts.groupBy(key).agg(F.array_join(listed, ",").alias("statuses"))
    prices = keyed.median_exact(usd, key, "last_price")
    out = usd.groupBy(key).agg(F.count("*").alias("n_listings"))
    for part in (symbols, statuses, prices):
        out = out.join(part, key, "left")
    return out.select(F.col(key).alias("security"), "symbol", "statuses", F.col("last_price").cast("decimal(18,4)").alias("last_price"), "n_listings")


_SQL_LISTED = f"""listed as (
  select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, (o_totalprice::decimal(18,2) * 100)::bigint::hugeint as cents, {_SQL_CURRENCY} as currency
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
), usd as (select listed.*, {_SQL_CENTS} as usd from listed join {_SQL_RATES} using (currency))"""


@query(
    f"""with {_SQL_LISTED}, counts as (select o_custkey, o_orderpriority, count(*) as n, min(o_orderkey) as first from usd group by all),
modes as (select o_custkey, arg_max(o_orderpriority, (n, -first)) as symbol from counts group by all),
firsts as (select o_custkey, o_orderstatus, min(o_orderkey) as first from usd group by all),
lists as (select o_custkey, string_agg(o_orderstatus, ',' order by first) as statuses from firsts group by all)
select o_custkey as security, symbol, statuses, median(usd::decimal(28,4) / 100)::decimal(18,4) as last_price, count(*) as n_listings
from (select o_custkey, (usd::decimal(28,0)) as usd from usd) join modes using (o_custkey) join lists using (o_custkey) group by o_custkey, symbol, statuses""".replace(
        "median(usd::decimal(28,4) / 100)::decimal(18,4)", "(median(usd::decimal(28,2))::decimal(28,2) * 0.01)::decimal(18,4)"
    )
)
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: convert, then merge all listings of a key."""
    usd = fx.to_usd(_listed_orders(spark, sf_dir), _rates(spark), ["last_price"])
    return merged_orders(stored(usd.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus", "last_price"))).orderBy("security")  # it is read four times


@query("select user_id, arg_max(event_type, (n, -first)) as event_type from (select user_id, event_type, count(*) as n, min(event_id) as first from events where event_type is not null group by all) group by user_id")
def mode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.mode_first_seen(_read(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@query("select l_suppkey, median((l_extendedprice::decimal(18,2))::decimal(20,4))::decimal(18,4) as price from lineitem group by l_suppkey")
def median_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem").select("l_suppkey", _money("l_extendedprice").alias("price"))
    return keyed.median_exact(rows, "l_suppkey", "price").select("l_suppkey", F.col("price").cast("decimal(18,4)").alias("price"))


@query("select user_id, string_agg(event_type, ',' order by first) as types from (select user_id, event_type, min(event_id) as first from events where trim(event_type) <> '' group by all) group by user_id")
def ordered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select("user_id", "event_id", F.array("event_type").alias("types"))
    return keyed.ordered_union(rows, "user_id", "types", "event_id").select("user_id", F.array_join("types", ",").alias("types"))


@query("select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by event_id) = 1")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.first_wins(_read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query("select source, doc_id, lang, n_chars from documents qualify row_number() over (partition by source order by doc_id desc) = 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.last_wins(_read(spark, sf_dir, "documents").select("source", "doc_id", "lang", "n_chars"), "source", "doc_id")


@query(f"with {_SQL_LISTED} select o_orderkey, 'USD' as currency, (case when currency = 'USD' then cents else usd end::decimal(18,2) * 0.01)::decimal(18,2) as last_price from usd")
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fx.to_usd(_listed_orders(spark, sf_dir), _rates(spark), ["last_price"])
    return out.select("o_orderkey", "currency", F.col("last_price").cast("decimal(18,2)").alias("last_price"))


@query(f"with {_SQL_LISTED} select o_orderkey, currency, (cents::decimal(18,2) * 0.01)::decimal(18,2) as last_price from listed where currency in ('JPY', 'CHF')")
def missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fx.to_usd(_listed_orders(spark, sf_dir), _rates(spark, ("JPY", "CHF")), ["last_price"], on_missing_rate="quarantine")
    return out.filter("rate_missing").select("o_orderkey", "currency", F.col("last_price").cast("decimal(18,2)").alias("last_price"))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers for each part, the second invalid for small parts; parts of size 50 have none."""
    part = _read(spark, sf_dir, "part").filter("p_size < 50").withColumn("ord", F.explode(F.array(F.lit(0), F.lit(1))))
    kind = F.when(F.col("p_partkey") % 3 == 0, "ID_ISIN").when(F.col("p_partkey") % 3 == 1, "ID_CUSIP").otherwise("TICKER")
    own = _figi(F.concat(F.col("p_partkey").cast("string"), F.lit("-"), F.col("ord").cast("string")))
    figi = F.when((F.col("ord") == 1) & (F.col("p_size") < 10), F.lower(F.concat(F.lit("x"), own))).otherwise(own)
    return part.select(kind.alias("id_type"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id_value"), figi.alias("figi"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("").alias("name"), F.col("p_type").alias("ticker"), "ord")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    code, k = F.concat(F.lit("P"), F.col("l_partkey").cast("string")), F.col("l_partkey") % 3
    rows = _read(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    return rows.select(F.when(k == 0, code).alias("isin"), F.when(k == 1, code).alias("cusip"), code.alias("symbol"), F.lit("LISTED").alias("name"), "l_quantity")


_SQL_RESPONSES = """r as (select p_partkey, case when p_size % 2 = 0 then p_name end as fig_name, p_type,
  upper(substr(md5(p_partkey || '-' || case when p_size < 10 then '0' else '1' end), 1, 12)) as figi from part where p_size < 50)"""


@query(f"with {_SQL_RESPONSES} select figi as share_class_figi, coalesce(fig_name, p_type) as name, p_type as symbol, count(*) as n_listings, sum(l_quantity) as quantity from lineitem join r on l_partkey = p_partkey group by all")
def identify_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify.identify(_lines(spark, sf_dir), _responses(spark, sf_dir))
    return out.groupBy("share_class_figi", "name", "symbol").agg(F.count("*").alias("n_listings"), F.sum("l_quantity").alias("quantity"))


@query("select l_partkey, count(*) as n_listings from lineitem where l_partkey not in (select p_partkey from part where p_size < 50) group by all")
def identify_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify.unidentified(_lines(spark, sf_dir), _responses(spark, sf_dir))
    return out.groupBy(F.substring("symbol", 2, 20).cast("long").alias("l_partkey")).agg(F.count("*").alias("n_listings"))


@query("""select c_custkey as key, case when c_acctbal >= 0 then c_acctbal else s_acctbal end as last_price, coalesce(case when c_custkey % 2 = 0 then c_mktsegment end, s_name) as sector
from customer left join supplier on c_custkey = s_suppkey""")
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("last_price"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("sector"))
    more = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("last_price"), F.col("s_name").alias("sector"))
    gaps = enrich.missing_fields(["last_price", "sector"])
    return enrich.fill(rows.filter(gaps), more, "key").unionByName(rows.filter(~gaps))


@query(r"""with n as (select doc_id, trim(regexp_replace(text, '[^\p{L}\p{N}_]+', ' ', 'g')) as t from documents)
select doc_id, md5(replace(upper(t), 'ẞ', 'SS')) as digest, length(replace(upper(t), 'ẞ', 'SS')) as n_chars from n""")
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _read(spark, sf_dir, "documents").select("doc_id", N.norm_text(F.col("text")).alias("t"))
    return out.select("doc_id", F.md5(F.col("t").cast("binary")).alias("digest"), F.char_length("t").cast("long").alias("n_chars"))


@query("select o_orderkey, o_totalprice::decimal(18,2) as price, null::varchar as error from orders")
def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written in four ways and read again."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    us = F.format_number(price, 2)
    way = F.col("o_orderkey") % 4
    text = F.when(way == 0, us).when(way == 1, F.translate(us, ",.", ".,")).when(way == 2, F.translate(price.cast("string"), ".", ",")).otherwise(F.concat(F.lit(" ++"), price.cast("string")))
    out = _read(spark, sf_dir, "orders").select("o_orderkey", N.unsigned_decimal("price", text).alias("v"))
    return out.select("o_orderkey", F.col("v.value").cast("decimal(18,2)").alias("price"), F.col("v.error").alias("error"))


_CHECKED = ["name", "symbol", "isin", "mics", "last_price", "currency", "analyst_rating"]


def _raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    return _read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 11 != 0, F.col("c_name")).alias("name"),
        F.concat(F.lit("s-"), text).alias("symbol"),
        F.concat(F.lit("us"), F.lpad(text, F.when(k % 7 == 0, 8).otherwise(9), F.lit("0")), F.lit("5")).alias("isin"),
        F.array(F.lit("xnys"), F.when(k % 13 == 0, "bad").otherwise("xlon")).alias("mics"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("last_price"),
        F.lit("usd").alias("currency"),
        F.when(k % 2 == 0, "buy").otherwise("strong buy").alias("analyst_rating"),
    )


@query("""select c_custkey, upper(replace(c_name, '#', ' ')) as name, 'S ' || c_custkey as symbol, 'US' || lpad(c_custkey::varchar, 9, '0') || '5' as isin, 'XNYS,XLON' as mics, c_acctbal::decimal(18,2) as last_price,
case when c_custkey % 2 = 0 then 'BUY' end as analyst_rating from customer where c_custkey % 11 <> 0 and c_custkey % 7 <> 0 and c_custkey % 13 <> 0 and c_acctbal >= 0""")
def validate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.valid(quality.validate(_raw_customers(spark, sf_dir), ["c_custkey"], _CHECKED))
    return out.select("c_custkey", "name", "symbol", "isin", F.array_join("mics", ",").alias("mics"), F.col("last_price").cast("decimal(18,2)").alias("last_price"), "analyst_rating")


@query("""select c_custkey, concat_ws('; ', case when c_custkey % 11 = 0 then 'name: missing' end, case when c_custkey % 7 = 0 then 'isin: wrong form' end,
case when c_custkey % 13 = 0 then 'mics: wrong form' end, case when c_acctbal < 0 then 'last_price: not a number of at least 0' end) as errors
from customer where c_custkey % 11 = 0 or c_custkey % 7 = 0 or c_custkey % 13 = 0 or c_acctbal < 0""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.rejected(quality.validate(_raw_customers(spark, sf_dir), ["c_custkey"], _CHECKED), ["c_custkey"])
    return out.select("c_custkey", F.array_join("errors", "; ").alias("errors"))


@query(r"""select page_id, trim(regexp_extract(html, '<title>([^<]*)<', 1)) as title, trim(regexp_extract(html, '<li><a href="[^"]*">([^<]*)<', 1)) as link,
list_aggregate(list_filter(list_transform(string_split(trim(regexp_extract(html, '<title>([^<]*)<', 1)), ','), lambda x: trim(x)), lambda x: x <> ''), 'string_agg', '|') as parts from pages""")
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = lambda p: N.html_text(F.regexp_extract("html", p, 0))
    title = F.regexp_extract("html", r"<title>[^<]*</title>", 0)
    return _read(spark, sf_dir, "pages").select("page_id", cell(r"<title>[^<]*</title>").alias("title"), cell(r'<a href="[^"]*">[^<]*</a>').alias("link"), F.nullif(F.array_join(N.html_mics(title), "|"), F.lit("")).alias("parts"))


@query("""select s_suppkey, case when s_suppkey % 2 = 0 then 'GBP' else 'GBX ' end as currency,
case when s_suppkey % 2 = 0 then case when s_acctbal >= 0 then (s_acctbal::decimal(18,2)::decimal(18,4) * 0.01)::decimal(18,4) end else s_acctbal::decimal(18,4) end as price from supplier""")
def pence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "supplier").withColumn("ccy", F.when(F.col("s_suppkey") % 2 == 0, "GBX").otherwise("GBX "))
    price, currency = N.gbx_to_gbp(F.col("s_acctbal").cast("decimal(18,2)").cast("string"), F.col("ccy"))
    return rows.select("s_suppkey", currency.alias("currency"), price.try_cast("decimal(18,4)").alias("price"))


@query("""select event_id, event_type as type, case when event_id % 3 = 0 then null when event_id % 3 = 1 then 'late' else json_extract_string(props, '$.k') end as k from events""")
def flatten_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.from_json("props", "map<string,string>")
    k = F.when(F.col("event_id") % 3 == 1, "late")
    second = F.when(F.col("event_id") % 3 != 2, F.create_map(F.lit("k"), k, F.lit("type"), F.col("event_type"))).otherwise(F.create_map(F.lit("type"), F.col("event_type")))
    m = lookups.flatten_modules([first, second])
    return _read(spark, sf_dir, "events").select("event_id", F.try_element_at(m, F.lit("type")).alias("type"), F.try_element_at(m, F.lit("k")).alias("k"))


def _feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def feed(table: str, key: str, row: str, name: str) -> DataFrame:
        return _read(spark, sf_dir, table).select(F.lit(table).alias("feed"), F.col(key).cast("string").alias("isin"), F.col(row).cast("long").alias("row_ord"), F.col(name).cast("string").alias("name"), F.lit("USD").alias("currency"))

    return {"orders": feed("orders", "o_custkey", "o_orderkey", "o_orderpriority"), "customer": feed("customer", "c_nationkey", "c_custkey", "c_name"), "supplier": feed("supplier", "s_suppkey", "s_suppkey", "s_name"), "part": feed("part", "p_brand", "p_partkey", "p_name")}


_SQL_FEEDS = """f as (select 'orders' as feed, o_custkey::varchar as isin, o_orderkey as row_ord, o_orderpriority as name from orders union all select 'customer', c_nationkey::varchar, c_custkey, c_name from customer
union all select 'supplier', s_suppkey::varchar, s_suppkey, s_name from supplier union all select 'part', p_brand, p_partkey, p_name from part)"""


@query(f"with {_SQL_FEEDS} select * from f qualify row_number() over (partition by feed, isin order by row_ord) = 1")
def feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for df in _feeds(spark, sf_dir).values():
        first = keyed.first_wins(df, "isin", "row_ord").drop("currency")
        out = first if out is None else out.unionByName(first, allowMissingColumns=True)
    return out


@query(f"with {_SQL_FEEDS} select feed, count(*) as n_rows, 0::bigint as missing_isin, 0::bigint as missing_name, 0::bigint as missing_currency, count(distinct isin) as n_keys, count(*) = count(distinct isin) as passed from f group by feed")
def feed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for df in _feeds(spark, sf_dir).values():
        rows = df if rows is None else rows.unionByName(df)
    return quality.feed_quality(rows)


@query(f"with {_SQL_FEEDS} select feed as stage, count(*) as n_rows, count(distinct isin) as n_keys, count(*) - count(distinct isin) as n_duplicates from f group by feed")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_metrics(_feeds(spark, sf_dir), "isin")


def _flat(rows: DataFrame, given: dict[str, Column]) -> DataFrame:
    """All 37 fields, those given and null for the rest."""
    return rows.select(*[given.get(f, F.lit(None)).cast(field_type(f)).alias(f) for f in FIELDS])


def _canonical_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").repartition("c_custkey")  # a small file is one task's, but records are many times as wide
    given = {"share_class_figi": _figi(F.col("c_custkey")), "name": F.upper("c_name"), "symbol": F.concat(F.lit("C"), F.col("c_custkey").cast("string")), "mics": F.array(F.lit("XNYS"), F.lit("XLON")), "last_price": _money("c_acctbal"), "sector": F.col("c_mktsegment")}
    return canonical.canonicalise(_flat(rows, given))


def _flattened(df: DataFrame) -> DataFrame:
    return df.select("identity.share_class_figi", "identity.name", "identity.symbol", "identity.isin", F.array_join("financials.mics", ",").alias("mics"), F.col("financials.last_price").cast("decimal(18,2)").alias("last_price"), "financials.sector")


_SQL_CUSTOMERS = "select upper(substr(md5(c_custkey::varchar), 1, 12)) as share_class_figi, upper(c_name) as name, 'C' || c_custkey as symbol, null::varchar as isin, 'XNYS,XLON' as mics, c_acctbal::decimal(18,2) as last_price, c_mktsegment as sector from customer"


@query(_SQL_CUSTOMERS)
def canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(_canonical_customers(spark, sf_dir))


@query(_SQL_CUSTOMERS)
def export_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To JSON lines and back."""
    lines = store.payloads(_canonical_customers(spark, sf_dir)).select(F.col("payload").alias("value"), F.col("share_class_figi").alias("ord"))
    return _flattened(store.parse_ndjson(lines))


@query("""with last as (select o_custkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
select c_custkey as key, coalesce(o_totalprice, c_acctbal) as value from customer left join last on c_custkey = o_custkey""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))
    new = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("ord"))
    return store.merged(old, new, "key", "ord")


@query(f"""with last as (select upper(substr(md5(o_custkey::varchar), 1, 12)) as share_class_figi, o_totalprice::decimal(18,2) as price from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
select c.* replace (coalesce(price, last_price) as last_price, case when price is null then name else name || ' AGAIN' end as name) from ({_SQL_CUSTOMERS}) c left join last using (share_class_figi)""")
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of buckets is published, changed by a batch with repeated keys, of which the last holds, and read."""
    at = scratch(spark)
    store.publish(_canonical_customers(spark, sf_dir), at, 16)
    orders = _read(spark, sf_dir, "orders").join(_read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    given = {"share_class_figi": _figi(F.col("c_custkey")), "name": F.concat(F.upper("c_name"), F.lit(" AGAIN")), "symbol": F.concat(F.lit("C"), F.col("c_custkey").cast("string")), "mics": F.array(F.lit("XNYS"), F.lit("XLON")), "last_price": _money("o_totalprice"), "sector": F.col("c_mktsegment")}
    own = orders.select("o_orderkey", *[given.get(f, F.lit(None)).cast(field_type(f)).alias(f) for f in FIELDS])
    records = own.select("o_orderkey", F.struct(*IDENTITY).alias("identity"), F.struct(*FINANCIALS).alias("financials"))
    store.upsert_canonical(records, at, "o_orderkey")
    return _flattened(store.load_canonical(spark, at))


@query(f"select * from ({_SQL_CUSTOMERS}) where share_class_figi in (select upper(substr(md5(o_custkey::varchar), 1, 12)) from orders where o_orderstatus = 'P')")
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(_figi(F.col("o_custkey")).alias("figi"))
    return _flattened(store.lookup_many(_canonical_customers(spark, sf_dir), keys))


@query("""with n as (select user_id, event_type, event_id, floor(epoch(ts))::bigint as fetched_at from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)
select user_id, event_type, event_id, fetched_at from n where (select max(floor(epoch(ts)))::bigint from events) - fetched_at <= 60 * 1440""")
def fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots newest by key and at most a day older than the newest of all."""
    seconds = F.datediff("ts", F.lit("1970-01-01")).cast("long") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    rows = _read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", seconds.alias("fetched_at"))
    now = rows.agg(F.max("fetched_at").alias("now"))
    newest = keyed.last_wins(rows, ["user_id", "event_type"], ["ts", "event_id"]).crossJoin(F.broadcast(now))  # a single row is joined
    return store.fresh(newest, F.col("now")).select("user_id", "event_type", "event_id", "fetched_at")


@query()
def fuzzy_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that stands for each brand's parts."""
    rows = _read(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("first"), F.count("*").alias("n"))
    lists = rows.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("first", F.col("p_name").alias("value"), "n"))).alias("t"))
    return lists.select("p_brand", fuzzy_representative("t").alias("name"))


def _searched(part: Column) -> Column:
    """What a part is searched for by: eight parts share an answer list, at every scale."""
    return F.concat(F.lit("Q"), F.floor(part / 8).cast("string"))


def _quotes(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(_searched(k).alias("query"), k.alias("rank"), F.concat(F.lit("P"), k.cast("string")).alias("symbol"), F.when(F.col("p_size") % 3 != 0, F.col("p_name")).alias("longname"), F.col("p_type").alias("shortname"))


def part_quotes(part: DataFrame) -> DataFrame:
    """p_partkey and symbol: the quote of every part that has one."""
    tried = part.select("p_partkey", F.lit(1).alias("rung"), _searched(F.col("p_partkey")).alias("query"), F.col("p_name").alias("name"), F.lit("P1").alias("symbol"))
    return enrich.chosen_quotes(tried, _quotes(part), "p_partkey").select("p_partkey", F.col("quote").alias("symbol"))


@query()
def choose_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every part the best quote of those that its search finds; null where none fits."""
    part = _read(spark, sf_dir, "part")
    return part.select("p_partkey", "p_brand", "p_size").join(part_quotes(part), "p_partkey", "left")


def part_cascade(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    rows = part.select(_figi(k).alias("share_class_figi"), F.when(k % 2 == 0, _searched(k)).alias("isin"), F.when(k % 5 != 0, _searched(k)).alias("cusip"), F.col("p_name").alias("name"), F.concat(F.lit("P"), k.cast("string")).alias("symbol"))
    summaries = part.filter("p_size > 10").select(F.concat(F.lit("P"), k.cast("string")).alias("symbol"), F.col("p_retailprice").alias("last_price"))
    return enrich.cascade(enrich.chosen_quotes(enrich.attempts(rows), _quotes(part)), summaries)


@query("select p_partkey, 'P' || p_partkey as symbol from part where (p_size % 3 <> 0 and p_name <> '') or p_type <> ''")
def viable_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quotes with a symbol and a name of either kind."""
    found = enrich.viable(_quotes(_read(spark, sf_dir, "part")))
    return found.select(F.col("rank").alias("p_partkey"), "symbol")


@query()
def quote_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part searched for in two rungs; the first with a summary gives the data. Parts of size 10 and less have no summary."""
    return part_cascade(_read(spark, sf_dir, "part"))


_SECONDS = "floor(epoch(ts))::bigint"


@query(f"""with newest as (select max({_SECONDS}) as now from events), asked as (select c_custkey % 200 as k, max(now - c_custkey % 5 * 86400) as now from customer, newest group by 1)
select user_id, event_id, event_type from events join asked on user_id = k and now - {_SECONDS} between 0 and 60 * 2880
qualify row_number() over (partition by user_id order by {_SECONDS} desc, event_id desc) = 1""")
def reuse_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each user that is asked for the newest snapshot that is at most two days old when it is asked for."""
    seconds = F.datediff("ts", F.lit("1970-01-01")).cast("long") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    known = _read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", seconds.alias("fetched_at"))
    newest = known.agg(F.max("fetched_at").alias("newest"))
    asked = _read(spark, sf_dir, "customer").select((F.col("c_custkey") % 200).alias("user_id"), F.col("c_custkey")).crossJoin(F.broadcast(newest))  # a single row is joined
    return enrich.reusable(asked, known, "user_id", F.col("newest") - F.col("c_custkey") % 5 * 86400, 2880).select("user_id", "event_id", "event_type")


@query("""with s as (select 'P' || p_partkey % 300 as symbol, p_type as sector, p_size % 4 = 0 as refused from part)
select symbol, sector from s where not refused
union all select 'P' || s_suppkey, s_name from supplier where 'P' || s_suppkey in (select symbol from s where refused) and 'P' || s_suppkey not in (select symbol from s where not refused)""")
def flat_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered summaries, and flat records of the symbols of which every answer was refused."""
    symbol = lambda k: F.concat(F.lit("P"), k.cast("string")).alias("symbol")
    summaries = _read(spark, sf_dir, "part").select(symbol(F.col("p_partkey") % 300), F.col("p_type").alias("sector"), (F.col("p_size") % 4 == 0).alias("refused"))
    return enrich.answered(summaries, _read(spark, sf_dir, "supplier").select(symbol(F.col("s_suppkey")), F.col("s_name").alias("sector")))


def _order_listings(spark: SparkSession, sf_dir: str, keys: int | None = None) -> DataFrame:
    """Orders as listings of their customer, or of one of a few keys."""
    rows = _listed_orders(spark, sf_dir)
    key = F.col("o_custkey") % keys if keys else F.col("o_custkey")
    given = {"share_class_figi": _figi(key), "name": F.concat(F.lit("Holder "), key.cast("string")), "symbol": F.col("o_orderpriority"), "mics": F.array(F.col("o_orderstatus")), "currency": F.lit("USD"), "last_price": F.col("last_price"), "market_cap": F.col("last_price") * 2}
    return rows.select(F.lit("orders").alias("feed"), F.lit(0).alias("feed_rank"), F.col("o_orderkey").alias("row_ord"), *[given.get(f, F.lit(None)).cast(field_type(f)).alias(f) for f in FIELDS])


_SQL_MERGED = """with orders as (select * replace (KEY as o_custkey) from orders),
counts as (select o_custkey, o_orderpriority, count(*) as n, min(o_orderkey) as first from orders group by all),
modes as (select o_custkey, arg_max(o_orderpriority, (n, -first)) as symbol from counts group by all),
firsts as (select o_custkey, o_orderstatus, min(o_orderkey) as first from orders group by all),
lists as (select o_custkey, string_agg(o_orderstatus, ',' order by first) as mics from firsts group by all),
med as (select o_custkey, median((o_totalprice::decimal(18,2))::decimal(20,4)) as price from orders group by all)
select upper(substr(md5(o_custkey::varchar), 1, 12)) as share_class_figi, 'HOLDER ' || o_custkey as name, replace(symbol, '-', ' ') as symbol, mics, 'USD' as currency, price::decimal(18,4) as last_price, (2 * price)::decimal(18,4) as market_cap
from modes join lists using (o_custkey) join med using (o_custkey)"""


def _merged_columns(out: DataFrame) -> DataFrame:
    return out.select("share_class_figi", "name", "symbol", F.array_join("mics", ",").alias("mics"), "currency", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("last_price", "market_cap")])


@query(_SQL_MERGED.replace("KEY", "o_custkey"))
def merge_all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_columns(merge.merge_listings(_order_listings(spark, sf_dir)))


@query(_SQL_MERGED.replace("KEY", "o_custkey % 7"))
def merge_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with seven keys, each of which holds a seventh of all listings."""
    return _merged_columns(merge.merge_listings(_order_listings(spark, sf_dir, 7)))


_LISTING = "(l_orderkey * 8 + l_linenumber) * 1000000000 + l_partkey"


@query(
    f"""with listed as (
  select l_partkey, {_LISTING} as ord, rpad(l_returnflag || l_linestatus, 4, 'X') as mic, list_value({", ".join(f"'{c}'" for c in _CURRENCIES)})[l_linenumber % 5 + 1] as currency, (l_extendedprice::decimal(18,2) * 100)::bigint::hugeint as cents from lineitem
), usd as (select l_partkey // 4 as k, 'P' || l_partkey as symbol, mic, ord, (case when currency = 'USD' then cents else {_SQL_CENTS} end)::decimal(28,2) as usd from listed join {_SQL_RATES} using (currency) where l_partkey in (select p_partkey from part)
), symbols as (select k, arg_max(symbol, (n, -first)) as symbol from (select k, symbol, count(*) as n, min(ord) as first from usd group by all) group by k
), codes as (select k, string_agg(mic, ',' order by first) as mics from (select k, mic, min(ord) as first from usd group by all) group by k
), prices as (select k, (median(usd)::decimal(28,2) * 0.01)::decimal(18,2) as last_price from usd group by k)
select upper(substr(md5(k::varchar), 1, 12)) as share_class_figi, 'GROUP ' || k as name, symbol, null::varchar as isin, mics, last_price, null::varchar as sector from symbols join codes using (k) join prices using (k)"""
)
def seed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation, conversion, identification, merge and canonical form of line items as listings; four parts are one security."""
    part = F.col("l_partkey")
    text = F.concat(F.lit("P"), part.cast("string"))
    given = {"name": F.concat(F.lit("Part "), part.cast("string")), "symbol": text, "mics": F.array(F.rpad(F.concat("l_returnflag", "l_linestatus"), 4, "X")), "currency": F.get(F.array(*[F.lit(c) for c in _CURRENCIES]), F.col("l_linenumber") % 5), "last_price": F.col("l_extendedprice").cast("decimal(18,2)")}
    raw = _read(spark, sf_dir, "lineitem").select(F.lit("sec").alias("feed"), F.lit(3).alias("feed_rank"), F.expr(_LISTING).cast("long").alias("row_ord"), *[given.get(f, F.lit(None)).cast("array<string>" if f == "mics" else "string").alias(f) for f in FIELDS])
    own, group = F.col("p_partkey"), F.floor(F.col("p_partkey") / 4)
    answers = _read(spark, sf_dir, "part").select(F.lit("TICKER").alias("id_type"), F.concat(F.lit("P"), own.cast("string")).alias("id_value"), _figi(group).alias("figi"), F.concat(F.lit("Group "), group.cast("string")).alias("name"), F.lit(None).cast("string").alias("ticker"), F.lit(0).alias("ord"))
    return _flattened(jobs.seed(raw, _rates(spark), answers).canonical)


@query("select event_type, user_id, event_id from events qualify row_number() over (partition by event_type, user_id order by event_id) = 1")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files, each key's first row kept across batches."""
    from ..streaming import incremental

    at = scratch(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = source.select(F.col("event_type").alias("feed"), F.col("user_id").alias("feed_key"), F.col("event_id").alias("row_ord"))
    started = rows.writeStream.foreachBatch(incremental.running_first(f"{at}/rows", n_buckets=16)).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    started.awaitTermination()
    return buckets.read(spark, f"{at}/rows").select(F.col("feed").alias("event_type"), F.col("feed_key").alias("user_id"), F.col("row_ord").alias("event_id"))
