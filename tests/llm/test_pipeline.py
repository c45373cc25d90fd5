"""The pipeline over a small folder, each stage against what is planted in it."""

import corpus_pipeline
from tapeforge.llm import queries

from tests.llm.test_operators import HEAD, prose


def test_pipeline(spark, tmp_path):
    good = [prose(i, 80) + f" Write to user{i}@mail.example.com." for i in range(40)]
    junk = [" | ".join(prose(i, 40).split()) for i in range(6)]
    texts = good + junk + [good[0], good[1] + " Again.", "short", None]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, HEAD).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in HEAD.split(", ")], name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(kept[0]) == {*range(40), 46, 47}
    assert set(kept[1]) == set(range(40))
    assert set(kept[2]) == set(range(40)) and all(f"user{i}@" not in t for i, t in kept[2].items())
    assert set(kept[3].items()) <= set(kept[2].items()) and 5 < len(kept[3]) < 40
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == set(kept[3])
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(tuple(r) for r in pieces)


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
