"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trigramma.llm import (
    chat_format,
    decontaminate,
    html_text,
    jaccard_join,
    language_id,
    lexical_search,
    line_dedup,
    merkle,
    mixing,
    quality,
    secret_scan,
    toxicity,
    url_filter,
)
from trigramma.llm.common import table

# Target weights of the mix; all other sources weigh 1.
TARGETS = {"src0": 3}
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]

# A vocabulary file of a public tokenizer, which all executors see.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )


def op4_quality_rules(spark, sf_dir):
    return quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op5_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"), TARGETS)


def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language_id(spark, sf_dir):
    return language_id.predict_language(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op9_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    )


def op10_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_chat_format(spark, sf_dir):
    """All conversations, and one whose texts hold control strings."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], talk.schema)
    return chat_format.read_back(chat_format.format_chat(talk.unionByName(odd), TOKENIZER))


def op13_merkle_manifest(spark, sf_dir):
    """Proofs of all rows, checked against rows of which every second has lost its line ends."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    proved = merkle.manifest(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")), even)
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def queries():
    listed = (
        op1_secret_scan, op2_jaccard_join, op3_decontaminate, op4_quality_rules, op5_html_text, op6_mixing, op7_line_dedup, op8_language_id, op9_toxicity,
        op10_url_filter, op11_lexical_search, op12_chat_format, op13_merkle_manifest,
    )
    return {query.__name__: query for query in listed}
