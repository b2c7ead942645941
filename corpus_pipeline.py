"""Corpus pipeline: toxicity filter, near-duplicate removal, benchmark decontamination, mixing, token files.

A stage is (spark, docs, sf_dir) -> DataFrame; ``run`` writes what each returns as Parquet in the shared folder
and reads it again as the next one's docs.  All but the last return the columns of ``documents``; the mixing stage
adds the training time of each copy, by which the token files are ordered.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import bitplane, curriculum, pigeonhole_join, queries, string_tiling, toxicity_grammar
from sluice.llm.common import scratch, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores ``TOXIC`` or more go; the model is learned from the labelled rows.

    A null or empty text scores as one without a match and stays; every row is judged by its own text, so repeated rows
    and rows without an id stay or go each by itself.  An empty table stays empty."""
    docs = docs.select(*COLUMNS)
    model = toxicity_grammar.learn(docs, queries.training_labels(spark, sf_dir))
    return toxicity_grammar.score(docs, model).where(F.col("score") < TOXIC).drop("score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that five-word shingles and a Jaccard similarity of 0.8 link, the one with the smallest id
    stays; documents without an id come after those with one, and of several with that id, or without one, the one
    whose text has the least hash stays.  Texts without words are nobody's copies and all stay."""
    docs = docs.select(*COLUMNS)
    groups = pigeonhole_join.jaccard_join(docs, n=5, p=80)
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))
    kept = groups.where((F.col("n_shingles") == 0) | first)
    row = {"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "__none": F.isnull("doc_id")}
    kept = kept.withColumns(row).select(*row, F.col("text_hash").alias("__hash"), (F.col("n_shingles") == 0).alias("__empty")).distinct()
    kept = written(kept, "kept")
    out = docs.withColumns(row | {"__hash": F.xxhash64("text")}).join(kept, [*row, "__hash"])
    out = out.withColumn("__own", F.when(F.col("__empty"), F.monotonically_increasing_id()))
    # repeated rows with words are copies; the join has brought them together, texts are not dealt out again
    return out.dropDuplicates([*row, "__hash", "text", "__own"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover half of a benchmark item's words go.

    The verdict is the text's: rows of equal texts go together, whatever their ids.  Null and empty texts match nothing
    and stay, as does every document when there are no items."""
    docs = docs.select(*COLUMNS).withColumn("__hash", F.xxhash64("text"))  # the verdict is the text's, whatever its id
    leaks = string_tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"), doc_id="__hash").select(F.col("doc_id").alias("__hash")).distinct()
    leaks = written(leaks, "leaks")
    return docs.join(leaks, "__hash", "left_anti").select(*COLUMNS)


def scheduled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (none to three times), each copy with its training time; those the mix
    leaves out go.

    The mix numbers the rows of one id, source and size; here the number goes to them in the order of their hashes.
    Equal rows take their copies together."""
    docs = docs.select(*COLUMNS)
    whole = F.xxhash64(*(x for c in COLUMNS for x in (F.isnull(c), F.col(c))))  # a null alone leaves no trace in a hash
    docs = docs.withColumns({"__size": curriculum.n_words(F.col("text")), "__hash": whole})
    equal = docs.groupBy("doc_id", "source", "__size", "__hash").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy("doc_id", "source", "__size").orderBy("__hash").rowsBetween(Window.unboundedPreceding, 0)
    own = equal.withColumn("upto", F.sum("rows").over(upto))
    own = own.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "__size", "__hash", "rows",
                     F.explode(F.sequence(F.col("upto") - F.col("rows") + 1, F.col("upto"))).alias("__n"))
    mixed = curriculum.curriculum(docs).where(F.size("times") > 0)
    taken = mixed.join(own, mixed["doc_id"].eqNullSafe(own["__id"]) & mixed["source"].eqNullSafe(own["__source"])
                       & (mixed["size"] == own["__size"]) & (mixed["n"] == own["__n"]))
    taken = written(taken.select("__id", F.col("__hash").alias("__h"), "rows", F.explode("times").alias("time")), "taken")
    this = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h"))
    # a row of which there are equal ones is there once, for the copies of all of them
    several = docs.join(taken.where("rows > 1"), this, "left_semi").dropDuplicates(["doc_id", "__hash"])
    out = docs.join(taken.where("rows = 1"), this).unionByName(several.join(taken.where("rows > 1"), this))
    return out.select(*COLUMNS, "time")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of ``scheduled`` without their times."""
    return scheduled(spark, docs, sf_dir).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the texts, read back: (doc_id, start, n_tokens, ids_crc32) of every document.

    Documents with a ``time`` lie in the order of their times, others in that of their ids.  A null or empty text is the
    end id alone; repeated rows and rows without an id are documents of their own.  An empty table gives no rows."""
    path = scratch(spark, "pipeline-tokens")
    bitplane.write_tokens(docs, path, queries.tokenizer_path(), order="time" if "time" in docs.columns else None)
    return bitplane.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", scheduled),
    ("token_files", token_files),
]

#: The learned scores, the greedy tiling and the tokenizer are beyond SQL; the tests use a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), os.path.join("pipeline", name))
    return docs
