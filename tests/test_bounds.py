"""Bounds of similarity scores hold for any two texts, and leave few pairs to score."""

import random

from pyspark.sql import functions as F

from tapeforge.functions import similarity as S


def test_bounds_are_never_below_the_scores(spark):
    rng = random.Random(8)
    vocabulary = ["", "a", "ab", "ba", "inc", "Inc.", "corp", "CORP", "foo", "of", "oof", "x1", "1x", "_", "-", "é", "İstanbul", "ß", "foo foo", "  ", "<no-name>", "international", "nationwide"]
    texts = [rng.choice(["", " ", "  "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(6))) for _ in range(400)]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(6000)] + [(t, t) for t in texts]
    df = S.outlined(spark.createDataFrame(pairs, "a string, b string"), x=F.col("a"), y=F.col("b"))
    x, y = F.col("x"), F.col("y")
    m, words = S.common(x, y), S.shared(x, y)
    rows = df.select("a", "b", S.ratio_bound(x, y, m).alias("r"), S.weighted_bound(x, y, m, words).alias("w")).collect()
    tight = 0
    for a, b, r, w in rows:
        assert r + 1e-6 >= S.ratio(S.simplified(a), S.simplified(b)), (a, b)
        assert w + 1e-6 >= S.weighted_ratio(a, b), (a, b, w, S.weighted_ratio(a, b))
        tight += w < 85
    assert tight > len(rows) / 4
