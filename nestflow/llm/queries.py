"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.llm import chat, decontaminate, html_extract, line_dedup, near_dup, packing, quality_knn, quality_rules, ranked_search, simhash, token_codes, turn_trie, warc
from nestflow.sources.sinks import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_bundles(table(spark, sf_dir, "pages"), path)
    return warc.read_bundles(spark, path)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(table(spark, sf_dir, "documents"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = decontaminate.find_items(docs, items)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_codes.write_token_files(table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_codes.read_documents(spark, path)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op8_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_knn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(control).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.format_chats(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = turn_trie.turn_lists(table(spark, sf_dir, "conversations"))
    taken = F.crc32(F.col("conv_id").cast("string")) % 4
    return turn_trie.prefix_nodes(turn_trie.shared_heads(lists, 20, 3, taken))


LLM_QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_packing, op3_warc, op4_line_dedup, op5_decontamination, op6_token_codes,
    op7_quality_rules, op8_quality_knn, op9_chat_formatting, op10_near_duplicates, op11_ranked_search, op12_simhash,
    op13_prefix_trie)}
