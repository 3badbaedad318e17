"""Queries over the given tables, one for each operator.

A query applies its operator to the whole table and derives the columns of its result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import quality_classifier as quality
from starloom.llm import quality_rules as rules
from starloom.llm.chat_formatting import rotate_perspectives
from starloom.llm.fingerprints import add_likeness, add_tree, changed_paragraphs
from starloom.llm.hard_negatives import mine_hard_negatives
from starloom.llm.html_extraction import extract_main_text, train_extractor
from starloom.llm.jaccard_join import near_duplicates
from starloom.llm.neighbours import with_next_text
from starloom.llm.packing import pack_best_fit, token_pieces
from starloom.llm.phrase_mining import mine_phrases
from starloom.llm.piece_encoding import check_pieces
from starloom.llm.secret_scan import KINDS, scan_secrets, train_scanner
from starloom.llm.sharding import feistel_shards
from starloom.llm.token_counts import count_text_tokens
from starloom.session import cut_lineage

# A document of more tokens than this is over the limit.
TOKEN_LIMIT = 4096
SHARDS = 24
# Bytes that a document takes in a shard beside its text.
ROW_OVERHEAD = 8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    return public_tokenizers.path(name)


def document_pieces(docs: DataFrame) -> DataFrame:
    return token_pieces(
        docs,
        tokenizer_file("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        {"<|endoftext|>": 50256},
    )


def op3_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    rotated = rotate_perspectives(table(spark, folder, "conversations"))
    spans = F.transform("mask", lambda span: F.concat_ws(":", span["begin"].cast("string"), span["end"].cast("string")))
    return rotated.withColumn("mask", F.array_join(spans, " "))


def op4_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next_text(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    swapped = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - swapped),
        F.substring("next_text", F.lit(1), swapped),
    )
    trees = pairs.withColumn("edited", edited)
    for text, tree in (("text", "own"), ("edited", "edited_tree"), ("next_text", "next")):
        trees = add_tree(trees, text, tree)
    trees = add_likeness(add_likeness(trees, "own", "edited_tree", "near_edited"), "own", "next", "near_next")
    changed = changed_paragraphs(F.col("own"), F.col("edited_tree"))
    return trees.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("own.root").alias("fingerprint"),
        F.col("edited_tree.root").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        changed["begin"].alias("first_changed_paragraph"),
        (changed["end"] - changed["begin"]).alias("n_changed_paragraphs"),
    )


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack_best_fit(document_pieces(docs), tie=("doc_id", "piece", "ids_crc32"))


def held_out(key: str = "doc_id") -> Column:
    """Rows that no label is learned from."""
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def quality_model(spark: SparkSession, docs: DataFrame, folder: str) -> quality.Model:
    """Fitted on a bounded sample of the labelled documents that are not held out."""
    labels = table(spark, folder, "labels").filter(F.col("quality").isNotNull() & ~held_out())
    # Labels of documents that are not there take no place in the sample.
    labels = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    labels = quality.sample_rows(labels.select("doc_id", F.col("quality").alias("label")))
    return quality.train_classifier(docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id"))


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.add_quality_score(docs, quality_model(spark, docs, folder))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    sharded = feistel_shards(docs, SHARDS, ["doc_id", "text_crc32", "size", "text_hash"])
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    extracted = extract_main_text(pages.select("page_id", "url", "html"), train_extractor(pages))
    return extracted.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    docs = table(spark, folder, "documents").select("doc_id", n_bytes, "text")
    counted = count_text_tokens(docs, tokenizer_file("piece_bpe_32k.model"), "text")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "copy_id", "class_id", "n_links")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    measured = cut_lineage(rules.measure_rules(docs).drop("text"))
    judged = rules.join_verdicts(measured, rules.host_verdicts(measured))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return check_pieces(docs, tokenizer_file("piece_bpe_32k.model")).drop("text")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = (F.col("label").cast("long") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return mine_phrases(table(spark, folder, "documents"))


def op13_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scanned = scan_secrets(docs, train_scanner(docs))
    place = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "learned")
    return scanned.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.array_join(F.transform(base, place), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", place), ",").alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_feistel_sharding,
        op3_perspective_rotation,
        op4_merkle_fingerprints,
        op5_best_fit_packing,
        op6_html_extraction,
        op7_token_counts,
        op8_jaccard_join,
        op9_quality_rules,
        op10_piece_encoding,
        op11_hard_negatives,
        op12_phrase_mining,
        op13_secret_scan,
    )
}
