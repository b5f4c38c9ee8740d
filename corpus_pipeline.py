"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`. A row is
identified by its id and the hash of its text, so repeated ids are judged row by row; null ids and null texts pass through
every stage as the operators define.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm import byte_bpe, line_dedup, mixing, quality_rules
from salesmill.llm import near_duplicates as similar
from salesmill.llm.common import BLANKS, free_name, map_batches, new_folder, staged, table, texts

#: Rows of more copies than this are dealt over tasks, so many copies at a time.
COPIES = 64


def _row(id_name: str = "_id", hash_name: str = "_hash") -> list:
    """What identifies a row: its id (null as the least) and the hash of its text."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(line_dedup.NO_ID)).alias(id_name),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias(hash_name),
    ]


def _marked(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """`docs` joined with `keys` (_id, _hash and maybe more), the small side, whatever names `docs` has."""
    names = [free_name(c, docs) for c in keys.columns]
    found = docs.select("*", *_row(*names[:2]))
    return found.join(keys.toDF(*names).hint("shuffle_hash"), names[:2], how)


def _only(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """The rows of `docs` whose (_id, _hash) is in `keep`."""
    return _marked(docs, keep.select("_id", "_hash").distinct(), "left_semi").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the document rules or their host's verdict reject go."""

    def marks(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [quality_rules.measures(t) for t in texts(batch.column("text"))]
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_hash"), batch.column("host"), *(pa.array(c, pa.int64()) for c in columns)],
            names=["_id", "_hash", "host", *quality_rules.MEASURES],
        )

    rows = docs.select(*_row(), "text", F.col("source").cast("string").alias("host"))
    measured = staged(map_batches(rows, lambda: marks, "_id long, _hash long, host string, " + ", ".join(f"{m} long" for m in quality_rules.MEASURES)))
    return _only(docs, quality_rules.judged(measured).where("kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more stay in the first one only; a document left without a line goes."""
    names, bitmap = docs.columns, free_name("_bitmap", docs)
    marked = line_dedup.with_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs=10), bitmap_col=bitmap)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [line_dedup.kept_text(t, b)[0] if b is not None else t for t, b in zip(batch.column("text").to_pylist(), batch.column(bitmap).to_pylist())]
        columns = {name: batch.column(name) for name in names} | {"text": pa.array(kept, pa.string())}
        if "n_chars" in columns:
            columns["n_chars"] = pa.array([len(t) if t is not None else None for t in kept]).cast(columns["n_chars"].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    out = map_batches(marked, lambda: cut, docs.schema)
    return out.where(F.col("text").isNull() | F.col("text").rlike(f"[^{BLANKS}]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word-shingle Jaccard >= 0.8 the row with the least id stays (of equal ids, the least text hash; of equal rows, one)."""
    classes = similar.classes_of(docs.select(*_row(), "text"), ["_id", "_hash"])
    first = classes.groupBy("component").agg(F.min(F.struct("_id", "_hash")).alias("k")).select("k.*")
    return _only(docs, first).dropDuplicates(["doc_id", "text"])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are most likely clean stay once, those most likely toxic go, whatever their share of the words.

    The others have fitted rates, scaled so that the expected low-quality words have their weight beside the clean ones.
    A rate of 2.3 gives two copies, and a third one where the hash of id and text says so; a rate of 0.3 none or one.
    """
    clean, low = mixing.WEIGHTS[:2]
    model = mixing.fit_classifier(docs, table(spark, sf_dir, "labels"), mixing.domain_of())
    rows = staged(mixing.posteriors(docs, model))
    p = [F.col("p")[k] for k in range(3)]
    kind = F.when(p[2] >= F.greatest(p[0], p[1]), 2).when(p[0] >= p[1], 0).otherwise(1)
    free = rows.where((kind != 2) | (F.col("n_tokens") == 0))

    def targets(totals):
        return [totals[0], totals[0] * low / clean, totals[2]]

    rated = mixing.with_rates(free, mixing.fit_rates(free, targets)).withColumn("clean", (kind == 0) | (F.col("n_tokens") == 0))
    excess = F.col("n_tokens") * (p[1] * clean - p[0] * low)  # zero in sum where the weights are met
    fixed, flat, fitted = rated.agg(
        F.sum(F.when(F.col("clean"), excess)), F.sum(F.when(~F.col("clean"), excess)), F.sum(F.when(~F.col("clean"), excess * F.col("rate")))
    ).first()
    rate = F.col("rate")
    if not fitted or fitted <= 0:  # the fit leaves nothing of the low-quality documents: all get one rate
        rate, fitted = F.lit(1.0), flat
    scale = max(0.0, -(fixed or 0.0) / fitted) if fitted and fitted > 0 else 0.0
    rate = F.when(F.col("clean"), 1.0).otherwise(rate * scale)
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", "row", F.lit("mixing")), 11) / F.lit(float(1 << 53))
    copies = (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).alias("_copies")
    kept = rated.select(F.coalesce("doc_id", F.lit(line_dedup.NO_ID)).alias("_id"), F.col("row").alias("_hash"), copies).where("_copies > 0")
    marked = _marked(docs, kept.distinct(), "inner")
    copies, block = marked.columns[-1], free_name("_block", marked)
    # The copies of a row are made where it is read: as many as its rate, whose words together are at most the target.
    few = marked.where(F.col(copies) <= COPIES).withColumn(block, F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    if (kept.agg(F.max("_copies")).first()[0] or 0) <= COPIES:
        return few.select(*docs.columns)
    # A row of many copies goes to several tasks, each of which makes some.
    ahead = F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(COPIES).cast("long")))
    many = marked.where(F.col(copies) > COPIES).withColumn(block, ahead).repartition(*marked.columns[:2], block)
    some = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col(copies) - F.col(block))))
    return few.select(*docs.columns).unionByName(many.withColumn(free_name("_copy", many), some).select(*docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids: the encoded documents; a document whose ids don't decode to its text ends the job."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

    def build():
        codec = byte_bpe.codec(path, pattern)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            coded = []
            for text in texts(batch.column("text")):
                coded.append(ids := codec.encode(text))
                if "".join(codec.decode(ids)) != text:
                    raise ValueError("a text does not survive encoding and decoding")
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in coded], pa.int64()), byte_bpe.id_lists(coded)], names=["doc_id", "n_tokens", "ids"])

        return one

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), build, "doc_id long, n_tokens long, ids array<int>")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mixture),
    ("byte_bpe", tokens),
]

#: Classifier, fingerprints and BPE are beyond SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(folder := new_folder(spark))
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
