"""Personal data replaced by surrogates.

Entities are found by one pattern; each gets a replacement of its own kind, made from a keyed digest: letters become
letters of the same script and case, digits digits, marks stay. E-mail addresses keep their top-level domain, phone and card
numbers their first digit (a card number that passes the Luhn check still does), IP numbers of version 4 the digits of each
part, IBANs their country. Known first names turn into others of the same gender and script, surnames into
names of the same length, script and case.

Coreference: the digest is of the entity without case and marks, so all spellings of one entity get one surrogate, each in its
own format; a name's parts are replaced one by one. Once a name is found in a text, its parts are replaced wherever they stand
alone in that text, too. Distinctness: over the whole corpus no two entities of a kind
share a surrogate and none is another real entity; where the first digest would, that entity gets a salt, again until
there is no collision, and after GROW salts a longer surrogate, so that every kind has room. Only these exceptions, if any, are joined
back to the documents that hold them.

The key makes surrogates unguessable; it comes from the session's configuration (KEY_SETTING) or the caller, and there is none
in this module.

Main path in DataFrame functions only. Defined results: a null text stays null, an empty one empty; repeated rows are
replaced alike; a column n_entities of the input is replaced; all other columns pass through.
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: The session's setting that holds the key.
KEY_SETTING = "spark.tapeforge.surrogates.key"

#: First names by gender and script.
FIRST_NAMES = {
    "f": "Amelia Andrea Anna Barbara Carmen Catherine Charlotte Chloe Christine Claire Clara Claudia Elena Elizabeth Emily Emma Hannah Ingrid Isabel Jane Jennifer Jessica Julia "
    "Karen Katharina Laura Lena Linda Lisa Lucia Lucy Margaret Maria Marie Marta Mary Michelle Monica Nancy Nicole Olivia Patricia Paula Petra Rebecca Ruth Sandra Sarah Sofia Sophie Susan Teresa",
    "m": "Alexander Andreas Andrew Antonio Benjamin Bernard Carlos Charles Christian Daniel David Diego Edward Fernando Francisco Frank George Hans Henri Henry Jacques Jakob James Jan Javier Jean "
    "Johannes John Jonas Jorge Joseph Juan Julien Kevin Klaus Louis Lukas Luis Manuel Martin Matthew Michael Miguel Nicolas Noah Oliver Pablo Patrick Paul Pedro Peter Philippe Pierre Richard Robert Stefan Thomas Tobias William",
    "f-cyrillic": "Анна Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    "m-cyrillic": "Александр Алексей Андрей Дмитрий Иван Михаил Николай Павел Сергей Юрий",
}
#: Forms of address before names, small words inside names, family names and forms of address of Han script.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Don Doña Господин Госпожа".split()
PARTICLES = "al ben bin da de del della den der di dos du ibn la le ten ter van von zu".split()
HAN_NAMES, HAN_TITLES = "王李张刘陈杨赵吴周徐孙朱胡郭何林罗", "先生 女士 小姐 博士 教授".split()


def _one_of(names: list[str]) -> str:
    """A pattern of any of the names, branching by the first letter; longer ones first."""
    by: dict[str, list[str]] = {}
    for n in sorted(names, key=lambda n: (-len(n), n)):
        by.setdefault(n[0], []).append(n[1:])
    return "(?:" + "|".join(f"{k}(?:{'|'.join(v)})" for k, v in sorted(by.items())) + ")"


#: A name's part: Smith, O'Neil, McKay, Meyer-Lutz; or all in capitals.
_PART = r"(?:(?:\p{Lu}['’]|Mc|Mac)?\p{Lu}\p{Ll}+(?:['’-]\p{Lu}\p{Ll}+)*|(?:\p{Lu}['’])?\p{Lu}{2,}(?:-\p{Lu}{2,})*)"
_SMALL = rf"(?:(?:{'|'.join(PARTICLES)}) )*"
_FIRST = _one_of([x for v in FIRST_NAMES.values() for n in v.split() for x in (n, n.upper())])
_TITLE = _one_of(sorted({*TITLES, *(t.upper() for t in TITLES if t not in ("Ms", "Miss", "Sr", "Don"))}))
_LATIN_NAME = rf"(?:{_TITLE}\.? {_PART}(?: {_SMALL}{_PART})?|{_FIRST} (?:\p{{Lu}}\. )?{_SMALL}{_PART})(?![\p{{L}}\p{{N}}])"
_HAN_NAME = rf"[{HAN_NAMES}](?<!\p{{IsHan}}.)(?:\p{{IsHan}}{{1,2}}(?={'|'.join(HAN_TITLES)})|\p{{IsHan}}{{2}}(?!\p{{IsHan}}))"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Kind and pattern, in order of precedence. An entity starts where no letter, digit or underscore goes before.
PATTERNS = {
    "secret": r"(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z_-]{20,}|xox[abprs]-[0-9A-Za-z-]{10,})(?![\p{L}\p{N}_])",
    "email": r"(?<![.%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "iban": r"[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![\p{L}\p{N}])",
    "ip6": rf"(?<![:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{1,5}}::(?:{_HEX}(?::{_HEX}){{0,4}})?|[0-9A-Fa-f]{{3,4}}::{_HEX}(?::{_HEX}){{0,5}})(?![\p{{L}}\p{{N}}:])",
    "ip": rf"(?<![.])(?<![Vv]ersion )(?<!v\. ){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[\p{{L}}\p{{N}}])",
    "card": r"(?<![+.-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\p{N})",
    "ssn": r"(?<!-)\d{3}-\d{2}-\d{4}(?![\p{N}-])",
    "phone": r"(?<!\+)(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\p{N})",
    "name": f"{_LATIN_NAME}|{_HAN_NAME}",
}
#: Inside a word nothing starts, which one look back tells; Han script has no spaces.
_START = r"(?<![\p{L}\p{N}_&&[^\p{IsHan}]])"
#: Which kinds may start with which character, in order of precedence, so that most alternatives aren't tried at most words.
_BY_FIRST = {"[0-9]": "secret email ip6 ip card ssn phone", "[+(]": "email phone", r"\p{Lu}": "secret email iban ip6 name", r"[^0-9+(\p{Lu}]": "secret email ip6 name"}


def entity(kinds: list[str]) -> str:
    """The pattern of an entity of any of the kinds."""
    branches = []
    for first, may in _BY_FIRST.items():
        if own := [_HAN_NAME if k == "name" and "^" in first else _LATIN_NAME if k == "name" else PATTERNS[k] for k in may.split() if k in kinds]:
            branches.append(f"(?={first})(?:{'|'.join(own)})")
    return f"{_START}(?:{'|'.join(branches)})"


#: Rounds of new salts after which a surrogate grows by a letter or digit, and rounds at most.
GROW, ROUNDS = 8, 120
#: Between the pieces of a text; the text's own first characters of it are told apart by what follows.
_MARK, _OWN = "\x01\x03", "\x01\x02"

_ALPHABETS = (  # pattern of a character, and what it may become
    (r"[0-9]", "0123456789"),
    (r"[aeiou]", "aeiou"),
    (r"[a-z]", "bcdfghjklmnpqrstvwxyz"),
    (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"\p{IsHan}", "王李张刘陈杨黄赵周吴徐孙马朱胡郭何高林罗"),
    (r"\p{IsLatin}", "àáâäçèéêëíîïñóôöùúûü"),
)


def kind_of(entity: Column) -> Column:
    """Which kind of entity the pattern found; the first pattern that fits all of it."""
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        out = F.when(entity.rlike(rf"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def names_in(name: Column) -> Column:
    """The parts of a name that are replaced: all but titles, initials and small words."""
    return F.filter(F.split(name, " "), lambda p: ~_stays(p))


def _stays(part: Column) -> Column:
    """Whether a word of a name stays."""
    return F.lower(F.regexp_replace(part, r"\.$", "")).isin([t.lower() for t in TITLES] + PARTICLES) | part.rlike(r"^\p{Lu}\.$")


def _norm(kind: Column, entity: Column) -> Column:
    """Equal for all spellings of an entity; the dots and colons of an IP number count."""
    return F.when(kind.isin("ip", "ip6"), F.lower(entity)).otherwise(F.regexp_replace(F.lower(entity), r"[^\p{L}\p{N}]", ""))


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _bytes(key: str, kind: Column, norm: Column, salt: Column) -> Column:
    """128 keyed bytes as hexadecimal digits."""
    seed = F.concat_ws("\x01", F.lit(key), kind, salt.cast("string"), norm)
    return F.concat(F.sha2(F.concat(seed, F.lit("\x01a")), 512), F.sha2(F.concat(seed, F.lit("\x01b")), 512))


def _byte(digits: Column, i: Column) -> Column:
    return F.conv(F.substring(digits, F.pmod(i, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, byte: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(byte, F.lit(len(alphabet))) + 1, F.lit(1))


def _let(value: Column, then) -> Column:
    """then(value) with the value computed once: lambdas know no common subexpressions."""
    return F.transform(F.array(value), then)[0]


def _letters(text: Column, digits: Column, hexadecimal: Column, keep: Column) -> Column:
    """Each letter and digit of a text by another of its class; the first ``keep`` of them stay."""

    def changed(c: Column, x: Column) -> Column:
        byte, low = x["byte"], x["low"]
        new = F.when(hexadecimal & low.rlike("[0-9a-f]"), _pick("0123456789abcdef", byte))
        for pattern, alphabet in _ALPHABETS:
            new = new.when(low.rlike(pattern), _pick(alphabet, byte))
        new = new.otherwise(low)
        return F.when((c == F.upper(c)) & (c != low), F.upper(new)).otherwise(new)

    def one(x: Column, n: Column) -> Column:
        other = _let(F.struct(_byte(digits, n).alias("byte"), F.lower(x["c"]).alias("low")), lambda y: changed(x["c"], y))
        return F.struct(x["i"].alias("i"), F.when(n < keep, x["c"]).otherwise(other).alias("c"))

    def together(chars: Column) -> Column:
        """Letters and digits are numbered among themselves and take their places again: time grows with the text."""
        counted = F.filter(chars, lambda x: x["c"].rlike(r"[\p{L}\p{N}]"))
        rest = F.filter(chars, lambda x: ~x["c"].rlike(r"[\p{L}\p{N}]"))
        return F.array_join(F.transform(F.array_sort(F.concat(F.transform(counted, one), rest)), lambda x: x["c"]), "")

    return _let(F.transform(F.split(text, ""), lambda c, i: F.struct(i.alias("i"), c.alias("c"))), together)


def _first_names(key: str) -> dict[str, str]:
    """Each known first name's surrogate: the next in a keyed order of its gender and script."""
    out = {}
    for names in FIRST_NAMES.values():
        order = sorted(names.split(), key=lambda n: hashlib.sha256(f"{key}\x01{n}".encode()).digest())
        out |= {a.lower(): b for a, b in zip(order, order[1:] + order[:1], strict=True)}
    return out


def surrogate(key: str, kind: Column, entity: Column, salt: Column) -> Column:
    """The replacement of an entity, for a name's part one part."""
    return _let(_bytes(key, kind, _norm(kind, entity), salt), lambda digits: _made(key, kind, entity, salt, digits))


def _made(key: str, kind: Column, entity: Column, salt: Column, digits: Column) -> Column:
    tld = F.regexp_extract(entity, r"\.\p{L}+$", 0)
    head = F.substring(entity, F.lit(1), F.char_length(entity) - F.char_length(tld))
    level = F.floor(salt / GROW).cast("int")

    def more(dropped: str) -> Column:
        """What a surrogate has grown by."""
        return F.when(level > 0, F.substring(F.regexp_replace(digits, dropped, ""), F.lit(1), level)).otherwise("")

    def octet(o: Column, i: Column) -> Column:
        b = _byte(digits, i)
        size = F.char_length(o) + F.floor((level + 3 - i) / 4)  # grown from the first part on, to three digits
        return F.when(size == 1, 1 + b % 9).when(size == 2, 10 + b % 90).otherwise(100 + b % 150).cast("string")

    def checked(changed: Column) -> Column:
        """With the last digit that passes the check."""
        tried = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(F.substring(changed, F.lit(1), F.char_length(changed) - 1), d.cast("string")))
        return F.filter(tried, lambda t: _luhn(F.regexp_replace(t, r"\D", "")))[0]

    def finished(changed: Column) -> Column:
        longer = F.concat(changed, more("[^0-9]"))
        card = F.when(_luhn(F.regexp_replace(entity, r"\D", "")), checked(longer)).otherwise(longer)
        known = F.create_map(*[F.lit(x) for pair in sorted(_first_names(key).items()) for x in pair])
        grown = F.concat(changed, more("[0-9]"))
        first = F.try_element_at(known, F.lower(entity))
        first = F.when((entity == F.upper(entity)) & (F.char_length(entity) > 1), F.upper(first)).otherwise(first)
        return F.when(kind == "email", F.concat(more("[0-9]"), changed, tld)).when(kind == "card", card).when(kind == "name", F.coalesce(first, grown)).otherwise(longer)

    body = F.when(kind == "email", head).otherwise(entity)
    keep = F.when(kind.isin("phone", "card"), 1).when(kind == "iban", 2).otherwise(0)
    plain = (kind == "ip6") | (kind == "secret") & entity.rlike("^[0-9a-fA-F]+$")
    letters = _let(plain, lambda hexadecimal: _letters(body, digits, hexadecimal, keep))  # named once, not looked for at each letter
    return F.when(kind == "ip", F.array_join(F.transform(F.split(entity, r"\."), octet), ".")).otherwise(_let(letters, finished))


def pieces(text: Column) -> Column:
    """What stands between entities and the entities, in turn, the former first; null for a text without any. One scan of the text."""
    own = F.replace(text, F.lit("\x01"), F.lit(_OWN))
    numbers = {"iban", "ip6", "ip", "card", "ssn", "phone"}

    def mark(without: set[str]) -> Column:
        return F.regexp_replace(own, entity([k for k in PATTERNS if k not in without]), f"{_MARK}$0{_MARK}")

    # kinds that need a digit or an at sign aren't looked for in a text that has none
    digit, at = text.rlike("[0-9]"), text.contains("@")
    marked = F.when(digit & at, mark(set())).when(digit, mark({"email"})).when(at, mark(numbers)).otherwise(mark({"email", *numbers}))
    return _let(marked, lambda m: F.when(m.contains(_MARK), F.split(m, _MARK)))


def found(pieces: Column) -> Column:
    """The entities among the pieces."""
    return F.filter(pieces, lambda p, i: i % 2 == 1)


def _parts(entities: Column) -> Column:
    """(kind, norm, part) of all that is replaced on its own."""
    each = F.transform(entities, lambda e: F.struct(kind_of(e).alias("kind"), e.alias("e")))
    return F.flatten(
        F.transform(each, lambda x: F.transform(F.when(x["kind"] == "name", names_in(x["e"])).otherwise(F.array(x["e"])), lambda p: F.struct(x["kind"].alias("kind"), _norm(x["kind"], p).alias("norm"), F.lower(p).alias("part"))))
    )


def bare_names(entities: Column) -> Column:
    """A pattern of the parts of all names among the entities, where they stand as words by themselves; null without names."""
    parts = F.array_distinct(F.flatten(F.transform(entities, lambda e: F.when(kind_of(e) == "name", names_in(e)).otherwise(F.array().cast("array<string>")))))
    spelled = F.array_distinct(F.flatten(F.transform(F.filter(parts, lambda p: F.char_length(p) > 1), lambda p: F.array(p, F.upper(p), F.initcap(F.lower(p))))))
    quoted = F.transform(spelled, lambda p: F.concat(F.lit(r"\Q"), p, F.lit(r"\E")))
    return F.when(F.size(quoted) > 0, F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?=\p{Lu}|\p{Lo})(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}_])")))


def exceptions(docs: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """kind, norm, salt of the entities that need a salt other than 0: the collision check over the whole corpus.

    Spaces grow, so that the loop ends; should entities of a kind be as many as there can be surrogates (all IP numbers),
    those left after ``rounds`` keep the surrogate of their last salt, and a warning says so.
    """
    entities = docs.select(F.explode(_parts(found(pieces(F.col("text"))))).alias("x")).select("x.kind", "x.norm", "x.part")
    known = [n.lower() for v in FIRST_NAMES.values() for n in v.split()]  # permuted among themselves: no collision
    real = stored(entities.filter(~((F.col("kind") == "name") & F.col("part").isin(known))).groupBy("kind", "norm").agg(F.min("part").alias("part")))

    def made(salt: Column) -> Column:
        return _norm(F.col("kind"), surrogate(key, F.col("kind"), F.col("part"), salt))

    now = real.select("*", F.lit(0).alias("salt"), made(F.lit(0)).alias("made"))
    for _ in range(rounds):
        now = stored(now)
        first = now.groupBy("kind", "made").agg(F.min(F.struct(-F.col("salt"), "norm")).alias("first"))  # who has a salt keeps its surrogate
        taken = real.select("kind", F.col("norm").alias("made"), F.lit(True).alias("taken"))
        checked = now.join(first, ["kind", "made"]).join(taken, ["kind", "made"], "left")
        checked = stored(checked.select("kind", "norm", "part", "salt", "made", ((F.col("first.norm") != F.col("norm")) | F.col("taken").isNotNull()).alias("again")))
        if checked.filter("again").isEmpty():
            break
        now = checked.withColumn("salt", F.col("salt") + F.col("again").cast("int"))
        now = now.withColumn("made", F.when(F.col("again"), made(F.col("salt"))).otherwise(F.col("made"))).drop("again")
    else:
        logging.getLogger(__name__).warning("after %d rounds some entities still have the surrogate of another", rounds)
    return now.filter("salt > 0").select("kind", "norm", "salt")


def configured_key(spark: SparkSession, otherwise: str | None = None) -> str:
    """The key of the session's configuration."""
    found = spark.conf.get(KEY_SETTING, otherwise)
    if not found:
        raise ValueError(f"surrogates need a secret key: set {KEY_SETTING}")
    return found


def replace(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with surrogates in ``text``, and a column n_entities. Without ``key`` that of the configuration."""
    key = key or configured_key(docs.sparkSession)
    odd = stored(exceptions(docs, key))
    rest = [c for c in docs.columns if c not in ("text", "n_entities")]
    # what else a row has is held in one column, so that no name of the input's is one of these
    rows = docs.select((F.struct(*rest) if rest else F.lit(0)).alias("_row"), "text").withColumn("_pieces", pieces(F.col("text")))
    salts = F.create_map().cast("map<string,int>")
    if not odd.isEmpty():
        # only documents that hold an exception get salts, by a join on a digest of their text
        held = rows.select(F.xxhash64("text").alias("_text"), F.explode(F.array_distinct(_parts(found(F.col("_pieces"))))).alias("x")).select("_text", "x.kind", "x.norm").distinct()
        own = held.join(odd, ["kind", "norm"]).groupBy("_text").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "norm"), "salt"))).alias("_salts"))
        own = stored(own)
        rows = rows.withColumn("_text", F.xxhash64("text")).join(own, "_text", "left").drop("_text")
        salts = F.coalesce("_salts", salts)

    def one(kind: Column, part: Column) -> Column:
        return surrogate(key, kind, part, F.coalesce(F.try_element_at(salts, F.concat_ws(":", kind, _norm(kind, part))), F.lit(0)))

    def whole(e: Column, bare: bool) -> Column:
        if bare:
            return one(F.lit("name"), e)
        return _let(kind_of(e), lambda kind: F.array_join(F.transform(F.when(kind == "name", F.split(e, " ")).otherwise(F.array(e)), lambda p: F.when((kind == "name") & _stays(p), p).otherwise(one(kind, p))), " "))

    def between(p: Column) -> Column:
        """A piece between entities: its bare names, if the text has names."""
        cut = F.split(F.regexp_replace(p, F.col("_bare"), F.lit(f"{_MARK}$0{_MARK}")), _MARK)
        return F.when(F.col("_bare").isNull(), F.array(p)).otherwise(cut)

    rows = rows.withColumn("_bare", bare_names(found(F.col("_pieces"))))
    cut = F.transform("_pieces", lambda p, i: F.when(i % 2 == 1, F.array(p)).otherwise(between(p)))
    rows = rows.withColumn("_cut", F.when(F.col("_pieces").isNotNull(), cut))
    text = F.array_join(F.flatten(F.transform("_cut", lambda c, i: F.transform(c, lambda p, j: F.when(i % 2 == 1, whole(p, False)).when(j % 2 == 1, whole(p, True)).otherwise(p)))), "")
    text = F.replace(text, F.lit(_OWN), F.lit("\x01"))
    count = F.aggregate("_cut", F.lit(0), lambda n, c: n + F.floor(F.size(c) / 2).cast("int")) + F.floor(F.size("_cut") / 2).cast("int")
    rows = rows.withColumn("n_entities", F.coalesce(count, F.lit(0)).cast("long")).withColumn("text", F.when(F.col("_cut").isNotNull(), text).otherwise(F.col("text")))
    return rows.select(*[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c != "n_entities"], "n_entities")
