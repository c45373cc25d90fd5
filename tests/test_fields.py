"""Field functions against the fixtures' values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapeforge.functions import normalise as N
from tapeforge.functions.similarity import best_candidate, ratio, representative, token_set_ratio, weighted_ratio


def one(spark, make, *values, types=None):
    cols = [F.lit(v).cast("string") if v is None or isinstance(v, str) else F.lit(v) for v in values]
    return spark.range(1).select(make(*cols).alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [("foo", "FOO"), ("  Foo-Bar!  Ltd.  ", "FOO BAR LTD"), ("   ", None), (None, None), ("--", ""), ("é_1", "É_1")])
def test_norm_text(spark, text, expected):
    assert one(spark, N.norm_text, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("+123.45", "123.45"), ("1.234,56", "1234.56"), ("-123.45", "-123.45"), ("1,234.56", "1234.56"), ("1234,56", "1234.56"), ("1,234,567.89", "1234567.89"), ("1.234.567,89", "1234567.89"), ("1,234,567", "1.234,567"), (" ", None)],
)
def test_numeric_text(spark, text, expected):
    assert one(spark, N.parse_numeric_text, text) == expected


@pytest.mark.parametrize("text, value", [("-10", None), ("not_a_number", None), ("1e3", 1000), ("1_000", 1000), ("NaN", None), ("1,234,567", None), (None, None), ("7", 7)])
def test_unsigned(spark, text, value):
    v = one(spark, lambda c: N.unsigned_decimal("f", c), text)
    assert v["value"] == (None if value is None else Decimal(value))
    assert (v["error"] is None) == (value is not None or text is None)


def test_signed_keeps_minus(spark):
    assert one(spark, lambda c: N.signed_decimal("f", c), "-10.5")["value"] == Decimal("-10.5")


@pytest.mark.parametrize("field, text, ok", [("isin", "us0378331005", True), ("isin", "US037833100", False), ("cusip", "037833100", True), ("cik", "000032019X", False), ("cik", "0000320193", True), ("share_class_figi", "BBG001S5N8V8", True), ("currency", "eur", True), ("currency", "EURO", False), ("mic", None, True)])
def test_identifiers(spark, field, text, ok):
    v = one(spark, lambda c: N.identifier(field, c), text)
    assert (v["error"] is None) == ok and v["value"] == (text.upper() if ok and text else None)


@pytest.mark.parametrize("text, expected", [("buy", "BUY"), ("outperform", None), ("strong_buy", None), (None, None)])
def test_rating(spark, text, expected):
    assert one(spark, N.analyst_rating, text) == expected


def test_mic_list(spark):
    rows = spark.createDataFrame([(["xnys", " "],), ([],), (None,), (["bad"],)], "m array<string>").select(N.mic_list(F.col("m")).alias("v")).collect()
    assert [r["v"]["value"] for r in rows] == [["XNYS", None], None, None, None]
    assert [r["v"]["error"] is None for r in rows] == [True, True, True, False]


@pytest.mark.parametrize("price, currency, expected", [("123,45", "GBX", ("1.2345", "GBP")), (None, "GBX", (None, "GBP")), ("5", "GBP", ("5", "GBP")), ("x", "GBX", (None, "GBP")), ("5", None, ("5", None))])
def test_pence(spark, price, currency, expected):
    p, c = N.gbx_to_gbp(F.lit(price).cast("string"), F.lit(currency).cast("string"))
    row = spark.range(1).select(p.alias("p"), c.alias("c")).first()
    assert (None if row["p"] is None else float(row["p"]), row["c"]) == (None if expected[0] is None else float(expected[0]), expected[1])


def test_html(spark):
    assert one(spark, N.html_text, '<a href="#">Example Co.</a>') == "Example Co."
    assert one(spark, N.html_text, "plain") == "plain"
    assert one(spark, N.html_mics, "<div>XAMS, XBRU,</div>") == ["XAMS", "XBRU"]
    c, p = N.html_price(F.lit("<div>USD <span>1234.56</span></div>"))
    assert tuple(spark.range(1).select(c, p).first()) == ("USD", "1234.56")


def test_similarity():
    assert ratio("abc", "abc") == 100 and ratio("ab", "cd") == 0 and ratio("", "") == 100
    assert token_set_ratio("FOO INC", "FOO INC.") > 0 and token_set_ratio("FOO INC", "FOO INC LTD") == 100 and token_set_ratio("", "") == 0
    assert weighted_ratio("Best Plc", "best plc") == 100


@pytest.mark.parametrize(
    "names, expected",
    [
        (["FOO INC", "FOO INC.", "FOO INCORPORATED", "BAR CORP", "BAR CORPORATION"], "FOO INC"),
        (["X CORP", "Y CORP"], "X CORP"),
        (["BAR CORP", "FOO INC", "FOO INC."], "FOO INC"),
        (["A", "A", "A", "B C", "B C D", "B C E", "B C F"], "A"),
        ([], None),
    ],
)
def test_representative(names, expected):
    counts = {}
    for n in names:
        counts[n] = counts.get(n, 0) + 1
    assert representative(list(counts.items())) == expected


def test_best_candidate():
    quotes = [{"symbol": "WRNG", "longname": "Wrong Ltd", "shortname": None}, {"symbol": "BEST", "longname": "Best Plc", "shortname": None}]
    assert best_candidate(quotes, "BEST PLC", "BEST") == "BEST"
    assert best_candidate(quotes[:1], "anything", "X") == "WRNG"
    assert best_candidate([], "a", "b") is None
    same = [dict(q, longname="Same") for q in quotes]
    assert best_candidate(same, "other", "other") == "WRNG"
    assert best_candidate(quotes, "ZZZZ", "QQQQ") is None


def quote(symbol, longname=None, shortname=None):
    return {"symbol": symbol, "longname": longname, "shortname": shortname}


@pytest.mark.parametrize(
    "quotes, name, symbol, chosen",
    [
        ([quote("brk.b", "Berkshire Hathaway Inc"), quote("XX", "Other Works")], "BERKSHIRE HATHAWAY INC", "BRK-B", "brk.b"),  # symbols without case and marks
        ([quote("A", "", "x"), quote("B", "Foo Holdings", "y")], "QUUX", "Z", "B"),  # a blank name is none: one name is left
        ([quote("A", None, "Foo Holdings"), quote("B", None, "Foo Holdings")], "QUUX", "Z", "A"),  # no long name at all: short ones decide
        ([quote("A", "", "Foo"), quote("B", "", "Bar")], "BAR", "B", "B"),
        ([quote("A", "Foo", None), quote("B", "Bar", None)], "QUUX", "Z", None),
    ],
)
def test_choice_of_quotes(quotes, name, symbol, chosen):
    assert best_candidate(quotes, name, symbol) == chosen


@pytest.mark.parametrize(
    "cell, expected",
    [
        ("<div>USD <span>1234.56</span></div>", ("USD", "1234.56")),
        ("<td>EUR\n<span class='x'>1.234,5</span>", ("EUR", "1.234,5")),
        ("<a>ABC</a><b>GBP<span>7</span><i>JPY<span>8</span>", ("GBP", "7")),
        ("USD <span>1</span>", ("", "")),
        ("<div>USDX <span>1</span>", ("", "")),
        ("<div> USD <span>1</span>", ("", "")),
        ("<div>usd <span>1</span>", ("", "")),
        ("<div>USD <span></span>", ("", "")),
        ("<div>USD <span>-</span>", ("", "")),
        ("<div>USD <span>1", ("", "")),
        ("<div>USD <b>1</b>", ("", "")),
        ("", ("", "")),
    ],
)
def test_price_of_a_cell(spark, cell, expected):
    from tapeforge.functions import normalise

    row = spark.createDataFrame([(cell,)], "c string").select(*normalise.html_price(F.col("c"))).first()
    assert tuple(row) == expected
