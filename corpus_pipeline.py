"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark
passages, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
and read again as the next one's ``docs``.  All but the last keep the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common as C
from tessera.llm import decontaminate, jaccard, line_quality, mixing, phrases

SHINGLE_WORDS = 5
PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line-chain score reaches the threshold; null or empty texts go.

    The chain is fitted on the labelled rows of the raw documents.
    """
    scored = line_quality.score(docs, line_quality.fitted(spark, sf_dir))
    return scored.where(F.col("score") >= line_quality.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group linked on five-word shingles at 0.8.

    Rows that share a doc_id but not the text are documents of their own; in a
    group they come after those whose doc_id names one text, and among
    themselves by doc_id and text hash.  Rows with equal doc_id and text stay
    once, whichever of them; rows without a doc_id stay; an empty table stays
    empty.
    """
    text_hash = F.xxhash64("text")
    known = docs.where("doc_id is not null")
    of_id = C.stored(known.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(text_hash).alias("lo"), F.max(text_hash).alias("hi"))
                     .where("n > 1"))
    shared = of_id.where("lo <> hi").select(F.col("doc_id").alias("__shared"))
    if shared.isEmpty():
        nodes, rows = docs.select("doc_id", "text"), docs.withColumn("__node", F.col("doc_id"))
    else:
        # numbers in this order, so that the smallest of a group is the one to stay
        order = [F.col("__shared").isNotNull(), F.col("__id"), F.col("__hash")]
        texts = known.select(F.col("doc_id").alias("__id"), text_hash.alias("__hash")).distinct()
        numbers = C.stored(texts.join(shared, F.col("__id") == F.col("__shared"), "left")
                           .repartitionByRange(*order).sortWithinPartitions(*order)
                           .select("__id", "__hash", F.monotonically_increasing_id().alias("__node")))
        rows = docs.join(numbers, (F.col("doc_id") == F.col("__id")) & (text_hash == F.col("__hash")), "left")
        nodes = rows.select(F.col("__node").alias("doc_id"), "text")
    components = jaccard.jaccard_components(nodes, SHINGLE_WORDS, PERCENT)
    dropped = C.stored(components.where("node <> component").select(F.col("node").alias("__node")))
    kept = rows.join(C.small_side(dropped), "__node", "left_anti")
    if not of_id.isEmpty():
        kept = kept.where("__node is not null").dropDuplicates(["__node"]).unionByName(kept.where("__node is null"))
    return kept.select(*C.columns(docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that an earlier document has.

    n_chars follows the text; a document left without a word goes.
    """
    out = phrases.remove_repeated_phrases(docs)
    changed = F.col("n_removed") > 0
    columns = []
    for name, kind in docs.dtypes:
        value = F.col("row").getField(name)
        if name == "text":
            value = F.when(changed, F.col("kept_text")).otherwise(value)
        elif name == "n_chars":
            value = F.when(changed, F.length("kept_text").cast(kind)).otherwise(value)
        columns.append(value.alias(name))
    return out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).select(*columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or re-parameterised."""
    found = decontaminate.contaminated(docs.select("doc_id", "text"), C.read(spark, sf_dir, "benchmark"),
                                       fold_case=True)
    ids = C.small_side(C.stored(found.select("doc_id").distinct()))
    return docs.join(ids, "doc_id", "left_anti").select(*C.columns(docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, target, copies and taken words of every document."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_passages", benchmark_passages), ("mixing", mixed)]

#: The fitted chain, the automata and the knapsack have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them is stored as Parquet."""
    docs = C.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = C.stored(docs)
    return docs
