"""Registered queries of the training-data operators; each runs over its whole table."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroid_clustering, chat_format, embedding_dedup, html_extraction, line_dedup, mixing, quality_rules, simhash_dedup, substring_dedup, token_alignment, token_counts, token_files
from .common import map_batches, new_folder, table, texts
from .oracles import ORACLES as ORACLES


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates under which clean, low-quality and toxic text make up 85, 14 and 1 percent of the expected words."""
    rated, _ = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    columns = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(mixing.DOMAINS)]
    return rated.select("doc_id", "n_tokens", *columns, "rate")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_classes(table(spark, sf_dir, "embeddings"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    return chat_digests(chat_format.formatted(turns.union(more)))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
            turns = chat_format.parse(text)
            loss = "".join(chat_format.unescape(text[s["start"] : s["end"]]) for s in spans)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(formatted, lambda: one, schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    token_files.write_tokens(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )
    return token_files.token_index(token_files.read_tokens(spark, folder))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_classes(table(spark, sf_dir, "documents"), width=3)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encoded(table(spark, sf_dir, "documents"), path, pattern)
    return token_digests(byte_bpe.decoded(coded, path, pattern))


def token_digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of doc_id, ids, text."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = line_dedup.with_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs=10, keep_first=False))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [line_dedup.kept_text(t, b) for t, b in zip(texts(batch.column("text")), batch.column("_bitmap").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([n for _, n, _ in kept], pa.int64()),
                pa.array([n for _, _, n in kept], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t, _, _ in kept], pa.string()),
            ],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return map_batches(marked, lambda: one, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = substring_dedup.with_spans(docs, substring_dedup.removed_spans(docs))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [substring_dedup.kept_words(t, s) for t, s in zip(texts(batch.column("text")), batch.column("_spans").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([n for _, n in kept], pa.int64()),
                pa.array([n - len(words) for words, n in kept], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(words)).hexdigest() for words, _ in kept], pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    return map_batches(marked, lambda: one, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster_report(*centroid_clustering.clusters(table(spark, sf_dir, "embeddings")))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.alignment(table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_embedding_dedup, op3_chat_format, op4_quality_rules, op5_token_files, op6_simhash_dedup,
        op7_byte_bpe, op8_token_counts, op9_line_dedup, op10_substring_dedup,
        op11_centroid_clustering, op12_html_extraction, op13_token_alignment,
    )
}
