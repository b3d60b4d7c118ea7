"""From raw documents to packed sequences: filter, deduplicate, mix, pack.

Each stage takes all rows its predecessor kept and calls one operator of
``catloom.llm``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.llm import jaccard, mixing, outliers, packing, quality_model
from catloom.llm.common import keep, remainder, table


JUDGED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def aside(docs: DataFrame, made: tuple[str, ...]) -> tuple[DataFrame, list]:
    """``docs`` with columns named like those an operator makes out of the way, and its columns as they were."""
    names = {c: unused(docs, f"given_{c}") for c in docs.columns if c.lower() in made}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, written once, and the key's name."""
    key = unused(docs, "row_key")
    return keep(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows", compression="zstd"), key


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or lie far from their language and source.

    Null, empty and blank texts fail the base rules; null languages and sources are
    groups like others; repeated rows and ids are judged each for itself.
    """
    given, back = aside(docs, JUDGED)
    return outliers.judge(given, *given.columns).where("kept").select(*back)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier, fitted on the labelled ones among them, does not call good.

    Without a label of each kind nothing can be told apart and all stay. Null and
    empty texts get the model's constant.
    """
    model = quality_model.train(docs, table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 4) != 2))
    if not model.weights.any():
        return docs
    given, back = aside(docs, ("score", "predicted"))
    return quality_model.score(given, model).where("predicted = 1").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of linked texts: that of the smallest id, null ids last.

    Rows are linked by keys of their own: rows of one id with different texts are
    different documents, and copies without id are copies. Null and blank texts link
    with nothing and stay.
    """
    rows, key = numbered(docs)
    links = jaccard.link_components(rows.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias(key), "component_id")
    named = links.join(rows.select(key, F.col("doc_id").alias("id"), F.xxhash64("text").alias("print")), key)
    smallest = F.min(F.struct(F.col("id").isNull(), "id", "print", key)).alias("first")
    first = named.groupBy("component_id").agg(smallest).select(F.col("first")[key].alias(key))
    return rows.join(first, key, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each row as often as the mix takes it, whatever its id; one without words may come or go."""
    rows, key = numbered(docs)
    copies, copy = unused(rows, "copies_taken"), unused(rows, "copy")
    taken = mixing.mix(rows, carry=(key,)).select(key, F.col("copies").cast("int").alias(copies))
    repeated = rows.join(taken, key).withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies))))
    return repeated.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 tokens; a null or empty text is its end token alone."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: The classifier is not expressible in SQL; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
