"""The ten operators against brute force, round trips and held-out accuracy, on small tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapeforge.llm import chat, common, fingerprints, html_text, lang_id, licenses, mixing, near_dup, packing, pii, quality

WORDS = "the of and river stone light market garden winter paper engine silver mountain letter orange silent copper window travel season".split()
HEAD = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "er"]) for _ in range(n)).capitalize() + "."


def table(spark, texts, **more):
    rows = [(i, t, more.get("lang", {}).get(i, "en"), f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, HEAD)


HARD = [prose(1, 200), prose(1, 200), None, "", " \n\t ", "x", "é", prose(2, 3000), "a " * 3000, "\x00  ß \U0001f600 " + prose(3, 30)]


def hard(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with names that operators use."""
    rows = table(spark, HARD)
    rows = rows.unionByName(rows.filter("doc_id < 4")).unionByName(spark.createDataFrame([(None, prose(1, 200), None, None, None)], HEAD))
    return rows.withColumns({c: F.lit(1) for c in ("row", "pattern", "id", "key", "part", "rank", "bin", "words", "label", "n_words", "quality")})


RUNS = {
    "fingerprints": lambda d: fingerprints.fingerprint_edits(d, fingerprints.rarity(fingerprints.entropy_counts(d))),
    "near_dup": near_dup.near_duplicates,
    "packing": lambda d: packing.pack(d, path()),
    "quality": quality.judge,
    "good": quality.good,
    "lang_id": lambda d: lang_id.predict(d, lang_id.training(d)),
    "licenses": licenses.licenses,
    "mixing": mixing.mix,
    "pii": lambda d: pii.replace(d, "k"),
}


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", RUNS)
def test_hard_rows_and_empty_tables(spark, name):
    d = hard(spark)
    rows = RUNS[name](d).collect()
    if name not in ("mixing", "packing", "good"):
        assert len(rows) == d.count()
    assert RUNS[name](d.limit(0)).collect() == []


def test_words_against_python():
    texts = ["A b\x0bc  d", "", "é x y", " lead", "trail ", "one"]
    offsets, data = common.text_bytes(pa.array(texts))
    h, begin, end, first = common.words(offsets, data, lower=True)
    found = [[data[b:e].tobytes().decode() for b, e in zip(begin[x:y], end[x:y])] for x, y in zip(first, first[1:])]
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    again, *_ = common.words(*common.text_bytes(pa.array(["a B C D é x"])), lower=True)
    assert set(again.tolist()) <= set(h.tolist()) and h[0] == again[0]


# 1 fingerprints


def test_entropy_bins_against_counting():
    data = np.frombuffer((prose(5, 60) + "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa").encode(), np.uint8)
    for w in (8, 32):
        bins = fingerprints._bins(data, w)
        for i in range(0, len(data) - w + 1, 7):
            counts = Counter(data[i : i + w].tolist()).values()
            entropy = -sum(c / w * math.log2(c / w) for c in counts) / math.log2(w)
            assert abs(bins[i] - 1000 * entropy) <= 1.5


def test_fingerprints(spark):
    texts = [prose(i, 300) for i in range(30)] + [prose(3, 300), None, "", prose(4, 300) + " tail", "short text here", "short text here"]
    d = table(spark, texts).repartition(5)
    rows = sorted(RUNS["fingerprints"](d).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    for r, nxt in zip(rows, rows[1:] + rows[:1]):
        own, other = texts[r["doc_id"]] or "", texts[nxt["doc_id"]] or ""
        k = len(own) // 4
        assert r["edited_sha256"] == hashlib.sha256((own[: len(own) - k] + other[:k]).encode()).hexdigest() and r["n_chars"] == len(own)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert rows[3]["fingerprint"] == rows[30]["fingerprint"] and rows[34]["fingerprint"] == rows[35]["fingerprint"] and rows[32]["fingerprint"] == ""
    assert all(r["near_edited"] > 0.5 > r["near_next"] for r in rows[:29])
    alone = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(d, fingerprints.rarity(fingerprints.entropy_counts(d))).collect()}
    assert all(alone[r["doc_id"]] == r["fingerprint"] for r in rows)


def test_ranges_of_ids(spark, monkeypatch):
    """Any number of ranges, with ids far apart, repeated and null, gives the same rows."""
    ids = [None, None, -(10**15), *range(0, 40), 7, 7, 10**12, 10**18]
    d = spark.createDataFrame([(i, prose(k, 40), "en", "s", 0) for k, i in enumerate(ids)], HEAD)
    ranks = fingerprints.rarity(fingerprints.entropy_counts(d))
    want = sorted(map(str, fingerprints.fingerprint_edits(d, ranks).collect()))
    texts = sorted(((i is not None, i or 0), prose(k, 40)) for k, i in enumerate(ids))
    edited = {hashlib.sha256((a[: len(a) - len(a) // 4] + b[: len(a) // 4]).encode()).hexdigest() for (_, a), (_, b) in zip(texts, texts[1:] + texts[:1])}
    assert len(want) == len(ids) and all(any(e in w for w in want) for e in edited)
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 1)
    monkeypatch.setattr(fingerprints, "QUANTILES", 3)
    assert sorted(map(str, fingerprints.fingerprint_edits(d, ranks).collect())) == want


# 2 html


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt; &amp; more", "plain <text> & more"),
        ("<body><nav><a href=#>Menu</a></nav><article><h1>T</h1><p>One\n two<br>three<p>Four &nbsp; five</article><footer>F</footer>", "T\nOne two three\nFour five"),
        ("<div class='ad'>Buy this now, it is a very long advert text</div><main><p>Short.</p><form>f</form><script>var t='</p>';</script><style>p{}</style></main>", "Short."),
        ("<main><p>Real text that goes on for a while.</p><div id='comments'><p>Reader says a lot of things here, more than the article.</p></div></main>", "Real text that goes on for a while."),
        ("<main><ul><li>a<li>b</ul><p>x <b>y</b>z <!-- c --> w</p></main>", "a\nb\nx yz w"),
        ("<p>unclosed <b>bold", "unclosed bold"),
        # names made of heading texts, or with other words in them, say nothing
        ('<article><h2 id="related-work">Related work</h2><p>Body text.</p><p class="ad-hoc">An ad hoc rule.</p><div id="social-policy">On policy.</div></article>', "Related work\nBody text.\nAn ad hoc rule.\nOn policy."),
        ("<article>teaser</article><article>A long article, longer than the teaser before it.</article>", "teaser\nA long article, longer than the teaser before it."),
        ("<article><p>Press <button>Save</button> to go on.</p><button>Share this</button><p>Then wait.</p></article>", "Press Save to go on.\nThen wait."),
        ("<article><p>One.</p><div class='ad-container'>Buy.</div><div class='related-posts'><p>More.</p></div><aside>Side.</aside><p>Two.</p></article>", "One.\nTwo."),
        ("<div class='site-header'>Name of the site</div><article><header><h1>Title</h1></header><p>Text.</p></article>", "Title\nText."),
    ],
)
def test_main_text(html, text):
    assert html_text.extract(html) == text


LONG = [prose(i, 60) for i in range(20)]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in LONG)


@pytest.mark.parametrize(
    "html, head, tail",
    [
        (f"<div id=post><h1>Title</h1><div class=lead><p>lead</p></div><div class=body>{PARAGRAPHS}</div></div>", ["Title", "lead"], []),
        (f"<body><section>{PARAGRAPHS}</section><section><p>The end.</p></section></body>", [], ["The end."]),
        (f"<main><h1>Title</h1><p>Before.</p><article>{PARAGRAPHS}</article></main>", ["Title", "Before."], []),
        (f"<body><nav>Menu</nav><div><a href=#>Other page</a></div><div>{PARAGRAPHS}</div><footer>F</footer></body>", [], []),
    ],
)
def test_main_text_around_the_region(html, head, tail):
    assert html_text.extract(html).split("\n") == [*head, *LONG, *tail]


MENU = "".join(f"<p>{w}</p>" for w in WORDS[:12])


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<body><div>{MENU}</div><div class=wide>{PARAGRAPHS}</div><div>{MENU}</div></body>", LONG),
        (f"<body><div class=page><div>{MENU}</div><div><h1>Title</h1>{PARAGRAPHS}<ul><li>a<li>b<li>c<li>d<li>e<li>f</ul>{PARAGRAPHS}</div><div>{MENU}</div></div></body>", ["Title", *LONG, *"abcdef", *LONG]),
        (f"<table><tr><td>{MENU}</td><td>{PARAGRAPHS}</td></tr></table>", LONG),
        (f"<div class='widget content'>{PARAGRAPHS}</div>", LONG),
        (f"<div><nav>Menu</nav>{MENU}{MENU}<section>{PARAGRAPHS}</section><section>{PARAGRAPHS}</section></div>", LONG * 2),
    ],
)
def test_ratios_select_content(html, text, monkeypatch):
    """Nothing on these pages says what the article is; with the selection turned round another text comes out."""
    found = html_text.extract(html).split("\n")
    assert [x for x in found if x not in WORDS] == text
    assert sum(x in WORDS for x in found) <= 4  # a short line beside the article is smoothed up to it
    select = html_text.selected
    monkeypatch.setattr(html_text, "selected", lambda sizes, tags: ~select(sizes, tags) & (sizes > 0))
    assert html_text.extract(html).split("\n") != found


def test_ratios_smoothing_and_threshold_against_plain_formulas():
    rng = random.Random(11)
    for _ in range(100):
        ratios = [rng.choice([rng.uniform(0, 5), rng.uniform(50, 90)]) for _ in range(rng.randrange(1, 40))]
        weight = lambda d: math.exp(-0.5 * (d / html_text.SIGMA) ** 2) if abs(d) <= 3 * html_text.SIGMA else 0.0
        even = [sum(weight(i - j) * x for j, x in enumerate(ratios)) / sum(weight(i - j) for j in range(len(ratios))) for i in range(len(ratios))]
        assert np.allclose(html_text.smoothed(np.array(ratios)), even)
        low, high = min(even), max(even)
        for _ in range(50):
            under, over = [x for x in even if x <= (low + high) / 2], [x for x in even if x > (low + high) / 2]
            if not under or not over or (low, high) == (sum(under) / len(under), sum(over) / len(over)):
                break
            low, high = sum(under) / len(under), sum(over) / len(over)
        cut = (low + high) / 2 if high >= html_text.APART_BY * low else min(even)
        assert math.isclose(html_text.threshold(np.array(even)), cut)
        sizes, tags = np.array([int(100 * x) for x in ratios]), np.full(len(ratios), 100)
        own = html_text.smoothed(sizes / tags)
        assert html_text.selected(sizes, tags).tolist() == [e >= html_text.threshold(own) and n > 0 for e, n in zip(own.tolist(), sizes.tolist())]


def test_main_text_of_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, "<p>a</p>"), (2, "v", "")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.main_text(pages).collect()) == [(0, "a", 1), (1, "", 0), (2, "", 0)]
    assert html_text.main_text(pages.limit(0)).collect() == []


# 3 mixing


def test_mixing_reaches_targets(spark):
    texts = [prose(i, 40 + i % 50) for i in range(600)]
    rows = [(i, t, ["en", "de", None][i % 3], ["hot", "hot", "hot", "cold"][i % 4], len(t)) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, HEAD).withColumn("topic", F.when(F.col("doc_id") % 5 == 0, "a").otherwise("b"))
    targets = {"source": {"hot": 0.6, "cold": 0.4}, "lang": 0.5, "topic": 1.0}
    p = mixing.probabilities(d, targets, 0.4)
    cells = mixing._celled(d).groupBy("c_source", "c_lang", "c_topic").agg(F.sum("_tokens").alias("t")).join(p, ["c_source", "c_lang", "c_topic"]).collect()
    total = sum(r["t"] * r["probability"] for r in cells)
    assert abs(sum(r["t"] * r["probability"] for r in cells if r["c_source"] == "hot") / total - 0.6) < 1e-3
    assert all(0 <= r["probability"] <= 1 for r in cells)
    same = {tuple(r[:3]): r["probability"] for r in mixing.probabilities(d, targets, 0.4, driver_cells=0).collect()}
    assert all(abs(same[r["c_source"], r["c_lang"], r["c_topic"]] - r["probability"]) < 1e-3 for r in cells)
    one, two = (sorted(r["doc_id"] for r in mixing.mix(x, targets, 0.4).collect()) for x in (d, d.repartition(7)))
    assert one == two and 120 < len(one) < 400


def test_raking_ends_alike_on_both_paths(spark, monkeypatch):
    """Two blocks nearly apart rake slowly: at 30 rounds the weights still move, and both paths must stop at the same one."""
    monkeypatch.setattr(mixing, "ROUNDS", 34)
    n = {("a", "x"): 200, ("a", "y"): 2, ("b", "x"): 2, ("b", "y"): 200}
    cells = [k for k, m in n.items() for _ in range(m)]
    d = spark.createDataFrame([(i, prose(i, 10), lang, source, 0) for i, (source, lang) in enumerate(cells)], HEAD).withColumn("topic", F.lit("t"))
    targets = {"source": {"a": 0.51, "b": 0.49}, "lang": {"x": 0.49, "y": 0.51}, "topic": 1.0}
    one, two = ({tuple(r[:3]): r["probability"] for r in mixing.probabilities(d, targets, 0.5, driver_cells=c).collect()} for c in (100, 0))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-7 for k in one)


# 4 personal data


def test_surrogates(spark):
    text = "Mr. John Smith met Anna Schmidt; Mr Smith wrote a.b@x-y.org and A.B@X-Y.ORG, +1 (017) 555-7713 or +1 017 555 7713. 4111 1111 1111 1111 is 4111111111111111. Мария Иванова, 10.0.0.1, DE89 3704 0044 0532 0130 00, 078-05-1120, token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"."
    rows = {r["doc_id"]: r for r in pii.replace(table(spark, [text, None, "", "nothing 12 here", text]), "k").collect()}
    out = rows[0]["text"]
    assert out == rows[4]["text"] and rows[1]["text"] is None and rows[2]["text"] == "" and rows[3]["text"] == "nothing 12 here"
    for secret in ("John", "Smith", "Anna", "Schmidt", "x-y", "555-7713", "4111 1111", "41111111", "Мария", "Иванова", "10.0.0.1", "3704 0044", "078-05", "24be6443"):
        assert secret not in out
    m = re.fullmatch(
        r"Mr\. (\w+) (\w+) met (\w+) (\w+); Mr (\w+) wrote (\S+@\S+\.org) and (\S+@\S+\.ORG), (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4})\. (\d{4} \d{4} \d{4} \d{4}) is (\d{16})\. (\w+) (\w+), (\d\d\.\d\.\d\.\d), (DE\d\d(?: \d{4}){4} \d\d), (\d{3}-\d\d-\d{4}), token = \"([0-9a-f]{40})\"\.",
        out,
    )
    assert m, out
    assert m[2] == m[5] and m[6].lower() == m[7].lower() and re.sub(r"\D", "", m[8]) == re.sub(r"\D", "", m[9]) and m[10].replace(" ", "") == m[11]
    males, females, cyrillic = (pii.FIRST_NAMES[k].split() for k in ("m", "f", "f-cyrillic"))
    assert m[1] in males and m[3] in females and m[12] in cyrillic and re.fullmatch("[А-Я][а-я]+", m[13])
    digits = [int(c) for c in m[11]]
    assert sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def replaced(spark, *texts):
    return [r["text"] for r in sorted(pii.replace(table(spark, list(texts)), "k").collect(), key=lambda r: r["doc_id"])]


def test_names_stay_one_person(spark):
    """Parts of a name that stand alone in its text are replaced like the whole name."""
    one, two, three, four = replaced(
        spark,
        "John Smith met Smith. Smith said hi; Olivia Brown and Mr. Brown, Brown. SMITH!",
        "Dr. Conor O'Neil saw MR SMITH and Jan de Vries, O'Neil's friend; De Vries, Vries.",
        "Smith stays where no name is found. Vries too.",
        "李小龙，王明先生。电话13800138000",
    )
    m = re.fullmatch(r"(\w+) (\w+) met (\w+)\. (\w+) said hi; (\w+) (\w+) and Mr\. (\w+), (\w+)\. (\w+)!", one)
    assert m and m[2] == m[3] == m[4] == m[9].capitalize() and m[6] == m[7] == m[8] and m[2] != m[6]
    assert not {"John", "Smith", "Olivia", "Brown", "SMITH"} & set(re.findall(r"\w+", one))
    m = re.fullmatch(r"Dr\. (\w+) (\w'\w+) saw MR ([A-Z]+) and (\w+) de (\w+), (\w'\w+)'s friend; De (\w+), (\w+)\.", two)
    assert m and m[2] == m[6] and m[5] == m[7] == m[8] and m[3] != "SMITH" and m[4] != "Jan" and m[5] != "Vries"
    assert three == "Smith stays where no name is found. Vries too."
    assert "李小龙" not in four and "王明" not in four and re.fullmatch(r"\p{Han}{3}，\p{Han}{2}先生。电话\d{11}".replace(r"\p{Han}", "[\u4e00-\u9fff]"), four)


def test_addresses_and_versions(spark):
    texts = ["from 2001:db8::ff00:42:8329 and 2001:0db8:0000:0000:0000:ff00:0042:8329.", "v1.2.3.4 and version 1.2.3.4, a::b, 12:30:45, 999.1.2.3, 1.2.3.4.5", "at 10.1.2.3:80"]
    one, two, three = replaced(spark, *texts)
    m = re.fullmatch(r"from ([0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{2}:[0-9a-f]{4}) and ((?:[0-9a-f]{4}:){7}[0-9a-f]{4})\.", one)
    assert m and not {m[1], m[2]} & set(re.findall(r"[0-9a-f:]+", texts[0]))
    assert two == texts[1] and re.fullmatch(r"at \d\d\.\d\.\d\.\d:80", three) and "10.1.2.3" not in three


def test_marks_of_its_own_stay(spark):
    assert replaced(spark, "a\x01\x03b \x01\x02 \x01", "\x01 a@b.org \x01\x03")[0] == "a\x01\x03b \x01\x02 \x01"
    assert re.fullmatch("\x01 \\S@\\S\\.org \x01\x03", replaced(spark, "\x01 a@b.org \x01\x03")[0])


def test_a_key_is_asked_for(spark):
    with pytest.raises(ValueError, match=pii.KEY_SETTING):
        pii.replace(table(spark, ["a"]))


def test_surrogates_stay_distinct(spark):
    """One-digit parts leave 6561 surrogates: 400 entities collide among themselves and with real ones."""
    ips = [f"{a}.{b}.{c}.{d}" for a, b, c, d in itertools.islice(itertools.product(range(1, 10), repeat=4), 400)]
    d = table(spark, [f"at {ip} and {ip}!" for ip in ips])
    assert pii.exceptions(d, "k").count() > 0
    out = [re.fullmatch(r"at (\S+) and (\S+)!", r["text"]).groups() for r in pii.replace(d, "k").collect()]
    assert all(a == b for a, b in out) and len({a for a, _ in out}) == 400 and not {a for a, _ in out} & set(ips)


def test_full_surrogate_spaces_grow(spark):
    """All 6561 IP numbers of one-digit parts are real, so none of them is left as a surrogate."""
    ips = [".".join(x) for x in itertools.product("123456789", repeat=4)]
    d = table(spark, [" and ".join(ips[i : i + 81]) for i in range(0, len(ips), 81)])
    made = [ip for r in pii.replace(d, "k").collect() for ip in r["text"].split(" and ")]
    assert len(made) == len(set(made)) == len(ips) and not set(made) & set(ips)
    assert all(re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", x) and max(map(int, x.split("."))) < 256 for x in made)


def test_every_kind_grows(spark):
    kinds = {"email": "a@b.de", "ip": "1.2.3.4", "card": "4111111111111111", "ssn": "123-45-6789", "phone": "+49 30 1234", "iban": "DE89370400440532013000", "secret": "AKIA" + "A" * 16, "name": "Li"}
    rows = spark.createDataFrame(list(kinds.items()), "kind string, e string").crossJoin(spark.createDataFrame([(0,), (pii.GROW,)], "salt int"))
    out = rows.select("kind", "salt", pii.surrogate("k", F.col("kind"), F.col("e"), F.col("salt")).alias("s")).collect()
    size = {(r["kind"], r["salt"]): len(r["s"]) for r in out}
    assert all(size[k, pii.GROW] == size[k, 0] + 1 for k in kinds)


# 5 near-duplicates


def python_components(texts, size):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_all_pairs(spark, size):
    rng = random.Random(size)
    texts = [None, "", "One", "one", "a b", "A  B"]
    for k in range(12):
        base = prose(k, rng.randrange(20, 200)).split()
        for _ in range(rng.randrange(1, 9)):
            edited = base[:]
            for _ in range(rng.randrange(0, max(1, len(base) // 8))):
                edited[rng.randrange(len(edited))] = rng.choice(WORDS)
            texts.append(" ".join(edited))
    texts += [prose(99, 80)] * 40
    want, sizes = python_components(texts, size)
    rows = sorted(near_dup.near_duplicates(table(spark, texts), size).collect(), key=lambda r: r["doc_id"])
    assert [r["n_shingles"] for r in rows] == sizes
    assert [r["component_id"] for r in rows] == want
    assert [r["kept"] for r in rows] == [i == c for i, c in enumerate(want)]


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, (1, near_dup.SYMBOLS), dtype=np.uint16)
        b = a.copy()
        at = rng.choice(near_dup.SYMBOLS, near_dup.DISTANCE, replace=False)
        b[0, at] ^= rng.integers(1, 1 << 16, len(at), dtype=np.uint16)
        shared = np.flatnonzero(near_dup.keys(a)[0] == near_dup.keys(b)[0])
        own = [x[0, shared] for x in (near_dup.left_out(a), near_dup.left_out(b))]
        once = shared[(own[0] != own[1]) | (own[0] < 0)]  # where a pair is made
        chunk = np.searchsorted([c for c, _ in near_dup.chunk_bounds()], [shared, shared], side="right")[0]
        assert len(shared) and set(np.searchsorted([c for c, _ in near_dup.chunk_bounds()], once, side="right")) == set(chunk) and len(once) == len(set(chunk))


def test_few_pairs_of_similar_sets_lie_beyond_the_distance():
    k, t = near_dup.SYMBOLS, near_dup.DISTANCE
    assert sum(math.comb(k, d) * 0.2**d * 0.8 ** (k - d) for d in range(t + 1, k + 1)) < 1e-5


# 6 packing


def test_packing(spark):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path())
    texts = HARD + [prose(i, 20 * i) for i in range(60)] + ["<|endoftext|> in a text", "<|endoftext|><|endoftext|>", "a <|endoftext|>  b<|endoftext", "a<|endoftext|>b " * 700]
    d = table(spark, texts)
    rows = packing.pack(d, path()).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = [*found.encode(t or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LENGTH
    assert len(by_sequence) <= 1.1 * sum(r["length"] for r in rows) / packing.LENGTH + 2


def test_a_length_of_many_pieces_has_more_salts(spark, monkeypatch):
    d = table(spark, [prose(i, 5) for i in range(40)] * 10)
    monkeypatch.setattr(packing, "SALTS", 2)
    monkeypatch.setattr(packing, "RANKED", 3)
    rows = packing.pack(d, path()).collect()
    taken = Counter((r["sequence_id"], r["offset"]) for r in rows)
    assert len(rows) == 400 and max(taken.values()) == 1
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all([o for o, _ in sorted(v)] == [sum(n for _, n in sorted(v)[:i]) for i in range(len(v))] for v in by_sequence.values())


def test_patterns_place_every_piece():
    rng = random.Random(5)
    for _ in range(50):
        h = {rng.randrange(1, 65): rng.randrange(1, 30) for _ in range(20)}
        out = packing.patterns(h, 64)
        placed = Counter()
        for packs, pattern in out:
            assert packs > 0 and sum(s * n for s, n in pattern) <= 64
            for s, n in pattern:
                placed[s] += packs * n
        assert placed == h


# 7 quality


def test_features_against_python():
    texts = ["a b c d e a b c d e x", "line\nline\n\n \nline\nother", "## $x é|é", "", "UPPER!! CASE!!", "one two three four five " * 4]
    found = [x.tolist() for x in quality.features(*common.text_bytes(pa.array(texts)))]
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)]
        assert [f[i] for f in found[:5]] == want


def test_votes_decide(spark):
    good, loud, marks = [prose(i, 60) for i in range(60)], [" ".join(w.upper() + "!!" for w in prose(i, 40).split()) for i in range(8)], [" | ".join(prose(i, 40).split()) for i in range(8)]
    rows = {r["doc_id"]: r for r in quality.judge(table(spark, good + loud + marks + ["too short"])).collect()}
    assert all(rows[i]["kept"] for i in range(60)) and not any(rows[i]["kept"] for i in range(60, 77)) and rows[76]["base_failed"]
    kept = sorted(r["doc_id"] for r in quality.good(table(spark, good + loud + marks + ["too short"])).collect())
    assert kept == list(range(60))


@pytest.mark.parametrize("share", [0.001, 0.05, 0.3])
def test_one_weak_bad_vote_is_outvoted(share):
    """Junk of two kinds has several bad votes, a single vote of a rule that it doesn't break against several good ones keeps a text."""

    def pattern(*bad):
        return int(quality.code(np.array([[-1 if r in bad else 1 for r in quality.RULES]]))[0])

    junk, weak = [pattern("symbols", "plain_words"), pattern("shouting", "capitals")], pattern("word_length")
    n = int(10_000 * share)
    p = quality.estimate({pattern(): 10_000 - n - 20, junk[0]: n // 2, junk[1]: n - n // 2, weak: 20})
    assert p[pattern()] >= 0.5 and p[weak] >= 0.5 and all(p[k] < 0.5 for k in junk)


@pytest.mark.parametrize("n_loud", [1, 10, 86])
def test_texts_with_one_bad_vote(spark, n_loud):
    good = [prose(i, 60) for i in range(200)]
    loud = [" ".join(w.upper() + "!!" for w in prose(i, 40).split()) for i in range(n_loud)]
    weak = ["\n".join([prose(7, 12)] * 3 + [prose(8, 240)])]  # only its lines repeat
    kept = {r["doc_id"] for r in quality.good(table(spark, good + loud + weak)).collect()}
    assert kept == {*range(200), 200 + n_loud}


# 8 language


def test_automaton_against_substrings():
    rng = random.Random(2)
    for _ in range(60):
        texts = [np.array([rng.randrange(3) for _ in range(rng.randrange(1, 12))]) for _ in range(rng.randrange(1, 4))]
        a = lang_id.Automaton(texts, 3)
        known = {tuple(x[i:j].tolist()) for x in texts for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
        query = [rng.randrange(3) for _ in range(20)]
        i = count = 0
        while i < len(query):
            k = 1
            while i + k < len(query) and tuple(query[i : i + k + 1]) in known:
                k += 1
            i, count = i + k, count + 1
        assert a.phrases(np.array(query, np.int32)[:, None], np.ones(20, int))[0] == count


def test_phrases_run_on_across_segments(monkeypatch):
    """Whole texts, cut or not, have the phrases that a plain parse of them has."""
    rng = random.Random(9)
    model = lang_id.Model({k: ["".join(rng.choice(v) for _ in range(400))] for k, v in {"aa": "abc ", "bb": "abcd "}.items()})
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 400))) for _ in range(60)] + ["a" * 300, "abab" * 100]
    for segment in (2, 3, 7, 64, 1000):
        monkeypatch.setattr(lang_id, "SEGMENT", segment)
        counts = []
        phrases = lang_id.Automaton.phrases
        monkeypatch.setattr(lang_id.Automaton, "phrases", lambda *a: counts.append(phrases(*a)) or counts[-1])
        langs, scores = model.predict(texts)
        monkeypatch.setattr(lang_id.Automaton, "phrases", phrases)
        segments = sorted(((len(t[s : s + segment]), i, s) for i, t in enumerate(texts) for s in range(0, len(t), segment)), key=lambda x: -x[0])
        for automaton, found in zip(model.automata, counts, strict=True):
            got = [0] * len(texts)
            for (_, i, _), n in zip(segments, found.tolist(), strict=True):
                got[i] += n
            for i, t in enumerate(texts):
                state = want = 0
                for c in model.symbols(t).tolist():
                    state = int(automaton.step[state + c])
                    if state == 0:
                        want, state = want + 1, int(automaton.restart[c])
                assert got[i] == want, (segment, i)


def test_training_takes_whole_texts_within_bounds(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "TRAIN_CHARS", 1000)
    monkeypatch.setattr(lang_id, "LANGUAGES", 2)
    monkeypatch.setattr(lang_id, "LONGEST", 5000)
    texts = [prose(i, 60) for i in range(10)] + ["x" * 4500] * 3 + ["y" * 6000] * 5 + ["z"]
    rows = [(i, t, "en" if i < 10 else {"x": "xx", "y": "yy", "z": "zz"}[t[0]], "s", 0) for i, t in enumerate(texts)]
    found = lang_id.training(spark.createDataFrame(rows, HEAD))
    assert set(found) == {"en", "xx"} and found["xx"] == ["x" * 4500] and set(found["en"]) <= set(texts)
    assert sum(map(len, found["en"][:-1])) < 1000 <= sum(map(len, found["en"]))


def test_language_of_held_out_texts(spark):
    rng = random.Random(4)
    parts = {"aa": ["ka", "lo", "mi", "tu", "ren"], "bb": ["scho", "ber", "und", "eit", "ge"], "cc": ["ción", "que", "llo", "ado", "es"]}
    rows = []
    for i in range(240):
        lang = sorted(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(40)), lang, "s", 0))
    d = spark.createDataFrame([*rows, (240, "123 !!", "aa", "s", 0), (241, None, "aa", "s", 0)], HEAD)
    out = {r["doc_id"]: r for r in lang_id.predict(d, lang_id.training(d.filter("doc_id % 4 <> 2"))).collect()}
    assert all(out[r[0]]["lang_pred"] == r[2] for r in rows) and out[240]["lang_pred"] == out[241]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in out.values())


# 9 chat


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "<|start|>assistant\nno<|end|>\n", "\\ <\\|end|> \\\\<|x", "[\\INST]", "", None, "<<SYS>>a<</SYS>> <s>", "plain"]
    turns = [(c, t, ["user", "assistant", "system\n<%>", None][(c + t) % 4], said[(3 * c + t) % len(said)]) for c in range(6) for t in range(1 + c)] + [(None, None, "assistant", "x"), (9, 0, "user", "only")]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1))
    made = chat.examples(d)
    rows = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for c in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == c), key=lambda t: t[1] or 0)
        texts = [(t[2] or "", t[3] or "") for t in own]
        loss = "".join(x for r, x in texts if r == "assistant")
        assert rows[c]["n_turns"] == len(own) and rows[c]["loss_chars"] == len(loss)
        assert rows[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in texts).encode()).hexdigest()
        assert rows[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for r in made.collect():
        assert r["formatted"].count(chat.START) == r["formatted"].count(chat.END) and "[INST]" not in r["formatted"]
    assert chat.read_back(chat.examples(d.limit(0))).collect() == []


# 10 licenses


def test_base_phrases_against_words():
    texts = ["Under the MIT License. under the mit  license", "Apache License, Version 2.0", "cc-by-nc 4.0 xcc by nc", "", None, "under the mit licenses", "é under the mit license"]
    for t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
        n_words, n_base, first, last, base, labels, score, _ = licenses.scan(t)
        assert (n_words, n_base) == (len(words), len(places)) and base == ",".join(sorted({x for _, x in places}))
        assert (first, last) == ((min(places)[0], max(places)[0]) if places else (None, None)) and set(filter(None, base.split(","))) <= set(labels.split(","))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def least_edits(pieces, text):
    """Over all ways to let the unchanged pieces stand as words of a span of whole words; None if there is none."""
    if not pieces:
        return 0 if not text else len(text)
    at = next((i for i, (_, fixed) in enumerate(pieces) if fixed), None)
    if at is None:
        return distance("".join(x for x, _ in pieces), text)
    ahead, key, rest = "".join(x for x, _ in pieces[:at]), pieces[at][0], pieces[at + 1 :]
    found = []
    for m in re.finditer(rf"(?<![^ ])(?={re.escape(key)}(?![^ ]))", text):
        more = least_edits(rest, text[m.start() + len(key) :])
        if more is not None:
            found.append(distance(ahead, text[: m.start()]) + more)
    return min(found, default=None)


def labels_by_all_spans(text):
    edges = [i for i in range(len(text) + 1) if i in (0, len(text)) or text[i - 1] == " " or text[i] == " "]
    out = set()
    for notice, label in licenses.NOTICES.items():
        plain = notice.replace("|", "")
        k = licenses.edits(plain)
        for b, e in itertools.combinations(edges, 2):
            if abs(e - b - len(plain)) <= k and not text[b:e].startswith(" ") and not text[b:e].endswith(" "):
                n = least_edits(licenses.parts(notice), text[b:e])
                if n is not None and n <= k:
                    out.add(label)
    return out


def test_fuzzy_notices_against_all_spans():
    rng = random.Random(6)
    kept = 0
    for notice in licenses.NOTICES:
        plain = notice.replace("|", "")
        for _ in range(6):
            chars = list(plain)
            for _ in range(rng.randrange(0, licenses.edits(plain) + 2)):
                at = rng.randrange(len(chars))
                chars[at] = rng.choice(["", rng.choice("abcdefghij "), chars[at] + rng.choice("abcdefghij")])
            text = " ".join(f"some words before {''.join(chars)} and after".split())
            want = labels_by_all_spans(text)
            assert {m[0] for m in licenses.fuzzy(text)} == want, text
            kept += bool(want)
    assert kept > 30
    assert licenses.fuzzy(prose(7, 500).lower()) == []


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MPL license", ""),
        ("Released under the MIT licence.", "mit"),
        ("released under the bit licence", ""),
        ("Licensed under the Apache License, Version 1.1", ""),
        ("Licensed under the Apache License, Version 1.0", ""),
        ("Licenced under the Apache Licence, Version 2.0", "apache-2"),
        ("All rights reserved. All rights preserved. ball nights reserved", ""),
        ("Licensed under the GNU Lesser General Public Licence", "lgpl"),
        ("licensed under the gnu general public licence v3", "gpl"),
        ("unreleased under the mit license", "mit"),
    ],
)
def test_names_and_versions_are_exact(text, labels):
    assert licenses.scan(text)[5] == labels


def test_places_in_a_long_text():
    n_words, n_base, first, last, *_ = licenses.scan("Under the MIT license. Released under the mit license; " * 20_000)
    assert (n_words, n_base, first, last) == (180_000, 40_000, 0, 179_996)
