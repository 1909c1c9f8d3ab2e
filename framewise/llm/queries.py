"""The registered queries: each operator over its whole table, with digests
of its real outputs where the contract asks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm import (chat, collocations, decontam, html_text, licenses, line_dedup, line_rules, mixing,
                           pieces, ppm, prefix_trie, setsketch, warc)
from framewise.llm.common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/<thousand>/<hundred>/<id>.txt``."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("")),
                                      F.floor(F.col("doc_id") / 1000).cast("string"),
                                      F.floor(F.col("doc_id") / 100).cast("string"),
                                      F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))
    return (licenses.scan(docs, "doc_id", "path").withColumnRenamed("id", "doc_id")
            .withColumns({c: F.round(c, 9) for c in ("file_score", "header_score")}))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs).select("doc_id", "n_tokens", "ids_sha256", "round_trip")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.find_hits(docs, read(spark, sf_dir, "benchmark"), keep_text=False)
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = chat.format_chats(rows.unionByName(odd))
    out = out.select("conv_id", "formatted", chat.turns_of(F.col("formatted")).alias("turns"),
                     chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_rules.judge(docs).select("doc_id", *line_rules.STATS, "boiler_chars", "base_failed", "kept")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return warc.archive_round_trip(pages).drop("url")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return setsketch.near_duplicates(docs).withColumnRenamed("id", "doc_id").select(
        "doc_id", "n_shingles", "component_id", "kept")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ppm.score(docs).withColumnRenamed("id", "doc_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents").select("lang", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie_of(prefix_trie.rebuilt(prefix_trie.conversations(rows)))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.words_taken(mixing.mix_sources(docs)).drop("source")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_line_dedup, op3_html_extraction, op4_sentencepiece, op5_decontamination,
    op6_chat_formatting, op7_quality_rules, op8_warc, op9_minhash_near_dedup, op10_lm_scoring,
    op11_collocations, op12_prefix_trie, op13_source_mix, pipeline)}
