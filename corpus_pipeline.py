"""Corpus pipeline: quality rules, language ID, near duplicates, repeated passages, packing.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet to the shared folder
and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import once, parquet, shuffle_parts
from tessera.llm.jaccard import one_per_class
from tessera.llm.langid import accepted, cutoffs, held_out, learn_languages, predict_languages
from tessera.llm.packing import pack_documents
from tessera.llm.quality import keep_good
from tessera.llm.suffixdedup import suffix_dedup
from tessera.session import fresh_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
FALSE_REJECTION = 0.002          # share of labelled documents, per language, that the language stage may reject


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test and the certified rules keep.

    A null or empty text fails the base test and goes; rows that repeat an id are judged each on its own text; a null id has
    no label and is judged by the rules; a stratum without enough labels has the base test alone; an empty table stays empty.
    """
    return keep_good(docs.select(COLUMNS), parquet(spark, sf_dir, "labels", "doc_id", "quality"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, by the language that their text shows.

    The model learns from labelled documents but for a third of the ids (``held_out``). On that third, per predicted
    language, the least score and byte coverage are set so that at most ``FALSE_REJECTION`` of it would go; a document
    below either goes, as text unlike any that was learned from does. Null and empty texts and texts without a letter go
    (``und``); rows that repeat an id are judged each on its own text, a null id is neither learned from nor held
    out; a language without a held-out document has no cutoffs and keeps all of its own; without a labelled document there
    is no known language and all go; an empty table stays empty.
    """
    docs = docs.select(COLUMNS)
    model = learn_languages(docs, F.col("doc_id").isNotNull() & ~held_out())
    told = predict_languages(docs.where(held_out() & F.col("lang").isNotNull()), model)
    cuts = {lang: (0.0, 0.0) for lang in model[0]} | cutoffs(told, FALSE_REJECTION) if model else {}
    return predict_languages(docs, model, whole_rows=True).where(accepted(cuts)).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id.

    Texts without words are in no class and stay; rows with a null id stay; of equal rows one stays, of unlike texts of one id
    each is judged by its own; an empty table stays empty.
    """
    return one_per_class(docs.select(COLUMNS))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``number`` in the order of ids: the id itself, but where ids repeat one for each (id, text)."""
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn("number", F.col("doc_id"))
    order = ["doc_id", "print"]
    rows = docs.withColumn("print", F.xxhash64("text")).repartitionByRange(shuffle_parts(docs), *order).sortWithinPartitions(*order)
    rows = once(rows.withColumn("number", F.monotonically_increasing_id()))
    first = F.min("number").over(Window.partitionBy(*order))
    return rows.withColumn("number", F.when(F.col("doc_id").isNotNull(), first)).drop("print")


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also occur earlier; each text of a repeated id is cut by its own.

    A null text becomes an empty one; rows with a null id come out whole; equal rows are one text, each is returned; an empty
    table stays empty. ``n_chars`` is that of what is left.
    """
    cut = suffix_dedup(_numbered(docs.select(COLUMNS)), "number", as_text=True, carry=("doc_id", "lang", "source"))
    return cut.select("row.doc_id", F.col("kept").alias("text"), "row.lang", "row.source",
                      F.length("kept").cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences.

    A null or empty text is the closing id alone; every row is packed, also with a null or repeated id; an empty table gives
    no pieces.
    """
    import public_tokenizers
    return pack_documents(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage),
          ("passages", passage_stage), ("packing", packing_stage)]

# trained language models, certified thresholds and token ids have no SQL form; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
