"""One query for each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import read


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fingerprints as op

    docs = read(spark, sf_dir, "documents")
    return op.fingerprint_edits(docs, op.rarity(op.entropy_counts(docs)))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dup as op

    return op.near_duplicates(read(spark, sf_dir, "documents"), size=2)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_text as op

    return op.main_text(read(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing as op

    return op.mix(read(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "mix_topic", "mix_tokens", "probability")


#: Of the registered queries, whose tables are synthetic; a corpus is given a key of its own by the setting.
TEST_KEY = "synthetic tables"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii as op

    return op.replace(read(spark, sf_dir, "documents"), op.configured_key(spark, TEST_KEY)).select("doc_id", "text", "n_entities")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import packing as op

    return op.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality as op

    out = op.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lang_id as op

    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    texts = op.training(docs.filter(~held_out))
    return op.predict(docs, texts).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat as op

    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return op.read_back(op.examples(turns))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses as op

    return op.licenses(read(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import merkle as op

    return op.manifest(read(spark, sf_dir, "documents"))


def op12_exact_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import exact_dup as op

    return op.exact_duplicates(read(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import repair as op

    return op.repair(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_main_text, op3_mixing, op4_surrogates, op5_near_dup, op6_packing, op7_quality, op8_language, op9_chat, op10_licenses, op11_manifest, op12_exact_dup, op13_repair)}
QUERY_SQL: dict[str, str] = {
    "op11_manifest": oracles.OP11_SQL,
    "op12_exact_dup": oracles.OP12_SQL,
    "op13_repair": oracles.OP13_SQL,
    # the text is split and unescaped again by the query; here it is taken from the table
    "op9_chat": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), w as (
  select *,
    replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') as r,
    regexp_replace(replace(text, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|/?SYS>>|start_of_turn>|end_of_turn>)', '\1\\\2', 'g') as x
  from t
), p as (
  select *, sum(length(r) + length(x) + 18) over (partition by conv_id order by turn, role, text rows unbounded preceding) as ends,
    row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as final from w
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  coalesce(sum(ends) filter (role = 'assistant' or final), 0)::bigint as formatted_chars
from p group by conv_id
""",
}
