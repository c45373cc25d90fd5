"""Surrogates of very long entities, and inputs whose extra columns have the operator's own names."""

import time

from tapeforge.llm import pii


def test_time_grows_with_the_entity(spark):
    """100,000 hexadecimal digits took hours when each looked at all before it."""
    texts = ["key " + "0a1b2c3d" * n + " end" for n in (4, 12_500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pii.replace(df.limit(1), "k").collect()
    began = time.time()
    out = {r["doc_id"]: r["text"] for r in pii.replace(df, "k").collect()}
    assert time.time() - began < 60
    for i, text in enumerate(texts):
        assert len(out[i]) == len(text) and out[i] != text and out[i][:4] == "key " and out[i][-4:] == " end"
        assert set(out[i][4:-4]) <= set("0123456789abcdef")


def test_columns_with_names_of_its_own_stay(spark):
    names = ["_pieces", "_bare", "_cut", "_text", "_salts", "_row", "_none"]
    df = spark.createDataFrame([(1, "mail a@b.org", *range(7)), (2, None, *range(7))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = {r["doc_id"]: r for r in pii.replace(df, "k").collect()}
    assert all([r[n] for n in names] == list(range(7)) for r in out.values())
    assert out[1]["n_entities"] == 1 and out[1]["text"] != "mail a@b.org" and (out[2]["text"], out[2]["n_entities"]) == (None, 0)
