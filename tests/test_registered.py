"""Registered queries that SQL can't express, against brute force on whole small tables."""

from tapeforge.plans import registry

DIR = "/root/testdata/sf0.001"


def plain_token_set(a: str, b: str) -> float:
    """By a table of common subsequences of plain lists, not by bits."""

    def ratio(x, y):
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, c in enumerate(x):
            for j, d in enumerate(y):
                best[i + 1][j + 1] = best[i][j] + 1 if c == d else max(best[i][j + 1], best[i + 1][j])
        return 200 * best[-1][-1] / (len(x) + len(y))

    x, y = set(a.split()), set(b.split())
    both, one, two = (" ".join(sorted(s)) for s in (x & y, x, y))
    if both and (x <= y or y <= x):
        return 100.0
    with_one, with_two = (" ".join(t for t in (both, " ".join(sorted(s))) if t) for s in (x - y, y - x))
    return max([ratio(with_one, with_two)] + ([ratio(both, with_one), ratio(both, with_two)] if both else []))


def test_fuzzy_names_of_all_brands(spark):
    """Each brand's names one by one, equal ones too: the first cluster whose leader is alike, the heaviest, the earliest."""
    groups = {}
    for r in spark.read.parquet(f"{DIR}/part.parquet").orderBy("p_partkey").collect():
        groups.setdefault(r["p_brand"], []).append(r["p_name"])
    want = {}
    for brand, names in groups.items():
        clusters = []
        for name in names:
            home = next((c for c in clusters if plain_token_set(c[0], name) >= 90), None)
            if home is None:
                clusters.append([name])
            else:
                home.append(name)
        weight = lambda c: sum(c.count(n) for n in c)
        best = max(map(weight, clusters))
        want[brand] = next(c[0] for c in clusters if weight(c) == best)
    assert {r["p_brand"]: r["name"] for r in registry.fuzzy_name(spark, DIR).collect()} == want
