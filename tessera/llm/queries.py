"""The registered queries of the operators: thin, over whole tables, with the digest columns of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.ann import nearest_neighbours
from tessera.llm.bpe import bpe_digests
from tessera.llm.chat import ORACLE as CHAT_ORACLE
from tessera.llm.chat import rotate_perspectives
from tessera.llm.common import parquet
from tessera.llm.fim import ORACLE as FIM_ORACLE
from tessera.llm.fim import fill_in_middle, restore
from tessera.llm.html import extract_main_text
from tessera.llm.jaccard import jaccard_join
from tessera.llm.langid import held_out, identify_language
from tessera.llm.packing import pack_documents
from tessera.llm.passages import ORACLE as PASSAGE_ORACLE
from tessera.llm.passages import passage_dedup
from tessera.llm.phrases import ORACLE as PHRASE_ORACLE
from tessera.llm.phrases import collocations
from tessera.llm.quality import quality_rules
from tessera.llm.sharding import feistel_shards
from tessera.llm.suffixdedup import suffix_dedup


def _tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(parquet(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learn = F.col("doc_id").isNotNull() & ~held_out()
    out = identify_language(docs, learn)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_main_text(parquet(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(parquet(spark, sf_dir, "documents", "doc_id", "text"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nearest_neighbours(parquet(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)
    return out.select("query_id", "rank", "vec_id", "score")


def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(parquet(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op7_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feistel_shards(parquet(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents", "doc_id", "text")
    return pack_documents(docs, tokenizer or _tokenizer_file("byte_bpe_50k.json"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_digests(docs, ranks or _tokenizer_file("byte_bpe_50k.tiktoken"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(parquet(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                        parquet(spark, sf_dir, "labels", "doc_id", "quality"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rules")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(parquet(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup(parquet(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate(F.zip_with("span_starts", "span_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(parquet(spark, sf_dir, "documents", "text", "lang")).withColumnRenamed("stratum", "lang")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def all_oracles() -> dict[str, str]:
    return {"op6_perspective_rotation": CHAT_ORACLE, "op11_fill_in_middle": FIM_ORACLE,
            "op12_passage_dedup": PASSAGE_ORACLE, "op13_phrase_collocations": PHRASE_ORACLE}
