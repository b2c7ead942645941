"""The registered queries of the operators: each applies its operator, with production parameters, to its
whole table and derives the result columns from what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    automaton_dedup,
    best_position,
    bitplane,
    conversation_trie,
    curriculum,
    hyper_shuffle,
    nra_topk,
    pigeonhole_join,
    pii_spans,
    site_lines,
    string_tiling,
    toxicity_grammar,
    warc,
)
from sluice.llm.common import scratch, table


def held_out():
    """Rows from which no label is learned."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out())


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_grammar.learn(docs, training_labels(spark, sf_dir))
    scored = toxicity_grammar.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = nra_topk.nra_top_k(vectors, "vec_id", nra_topk.floor_256(F.col("embedding")), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op3_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.curriculum(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("times")).cast("long").alias("taken"))


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = string_tiling.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item_words", "n_covered", "coverage", F.size("tiles").alias("n_tiles"))


def op5_bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    bitplane.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return bitplane.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_hyper_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    dealt = hyper_shuffle.hyper_shuffle(table(spark, sf_dir, "documents"), (F.octet_length(text) + 1).cast("long"), F.crc32(text.cast("binary")))
    return dealt.select("doc_id", "size", F.col("checksum").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op7_pigeonhole_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = pigeonhole_join.jaccard_join(table(spark, sf_dir, "documents"), n=3, p=90)
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans.pii_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["rank"] < len(pii_spans.BASE))
    n = {f"n_{k}": _count(k) for k in pii_spans.KINDS}
    return found.select("doc_id", *[n[f"n_{k}"].alias(f"n_{k}") for k in pii_spans.BASE],
                        F.sha2(pii_spans.listed(base), 256).alias("base_sha256"), pii_spans.listed(F.col("pii")).alias("spans"),
                        n["n_iban"].alias("n_iban"), F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"))


def _count(kind: str):
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def op9_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = automaton_dedup.substring_dedup(table(spark, sf_dir, "documents"), length=35, digest=True)
    return kept.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", site_lines.host_of(F.col("url")).alias("host"), site_lines.html_lines(F.col("html")).alias("lines"))
    out = site_lines.drop_site_boilerplate(pages, "host", "lines")
    return out.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), "n_dropped", F.array_join("kept", "\n").alias("text"))


def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    nodes = conversation_trie.prefix_trie(*conversation_trie.rebuilt(turns, shared, F.col("conv_id") - F.col("conv_id") % 100, 5))
    return nodes.drop("h1", "h2")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    index = warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(index, path, payload=False).drop("url")


_QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_toxicity_grammar, op2_nra_topk, op3_curriculum, op4_string_tiling, op5_bitplane,
    op6_hyper_shuffle, op7_pigeonhole_join, op8_pii_spans, op9_automaton_dedup, op10_site_lines,
    op11_best_position, op12_conversation_trie, op13_warc,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}
