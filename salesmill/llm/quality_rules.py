"""Quality rules with host-level verdicts.

Every text is measured whole; rules on the measures give failures per document. Failures are summed per host (combined
map-side, so a host with a third of all rows costs one partial row per task), each host's failure rate of each rule is
shrunk towards a beta prior fitted to all hosts, and a host with a shrunk rate above `max_rate` is rejected. The few
rejected hosts are joined back to the measures, never to the texts; each is dealt to `SALTS` tasks, so that a host with a
third of all rows (or the rows without a host) does not land in one.

Null text has no words and fails; a row with a null host has only its own verdict; an empty table gives no rows; equal
rows get equal results; columns other than id, text and host are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, map_batches, staged, texts

#: Tasks over which the rows of one host are dealt when verdicts are joined back.
SALTS = 32

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, host string, " + ", ".join(f"{name} long" for name in MEASURES)


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 20
    max_dup_line_percent: int = 80
    mean_word_chars: tuple[int, int] = (2, 30)
    max_rate: float = 0.6


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) > 2_000_000:  # keep the triple below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[twice + shift] = True
    return int(covered.sum())


def measures(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = text.split("\n")
    with_words = [line for line in lines if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(with_words),
        len(with_words) - len(set(with_words)),
        repeat_words(words),
    )


def _measure_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = np.array([measures(t) for t in texts(batch.column("text"))], np.int64).reshape(-1, len(MEASURES))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("host"), *(pa.array(found[:, i]) for i in range(len(MEASURES)))],
        names=["doc_id", "host", *MEASURES],
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host and the measures of every whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"))
    return map_batches(rows, lambda: _measure_batch, SCHEMA)


def rules(limits: Limits = Limits()) -> dict[str, Column]:
    """The document rules; each is true where it fails. Integer arithmetic only."""
    c = F.col
    low, high = limits.mean_word_chars
    return {
        "short": c("n_words") < limits.min_words,
        "repetitive": 100 * c("n_repeat_words") > limits.max_repeat_percent * c("n_words"),
        "symbols": 100 * c("n_symbols") > limits.max_symbol_percent * c("word_chars"),
        "dup_lines": 100 * c("n_dup_lines") > limits.max_dup_line_percent * c("n_lines"),
        "word_length": (c("word_chars") < low * c("n_words")) | (c("word_chars") > high * c("n_words")),
    }


def host_rates(measures_: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """host, rule, n, failed, rate (raw), shrunk: one row per host and rule.

    The beta prior of a rule has the mean m and variance v of the hosts' raw rates: strength s = m(1-m)/v - 1, at least
    one document, at most a million; where all hosts agree (v = 0) the strength is that maximum.
    """
    failed = rules(limits)
    hosts = (
        measures_.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), *(F.sum(rule.cast("long")).alias(f"failed_{name}") for name, rule in failed.items()))
    )
    long = hosts.select(
        "host", "n", F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.col(f"failed_{k}").alias("failed")) for k in failed))).alias("x")
    ).select("host", "n", "x.rule", "x.failed", (F.col("x.failed") / F.col("n")).alias("rate"))
    m, v = F.col("m"), F.col("v")
    prior = long.groupBy("rule").agg(F.avg("rate").alias("m"), F.var_pop("rate").alias("v"))
    strength = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1e6))).otherwise(F.lit(1e6))
    prior = prior.select("rule", (m * strength).alias("a"), strength.alias("s"))
    return long.join(F.broadcast(prior), "rule").select(  # one row per rule
        "host", "rule", "n", "failed", "rate", ((F.col("failed") + F.col("a")) / (F.col("n") + F.col("s"))).alias("shrunk")
    )


def verdicts(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """doc_id, host, measures, base_failed, host_rejected, kept: one row per row of `docs`."""
    return judged(staged(measured(docs, id_col, text_col, host_col)), limits)


def judged(found: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`found` (a table with host and the measures, read twice) with base_failed, host_rejected and kept."""
    bad = host_rates(found, limits).where(F.col("shrunk") > limits.max_rate).select("host", F.lit(True).alias("bad")).distinct()
    bad = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*found.columns), F.lit(SALTS)).cast("int")
    rule = rules(limits)
    return (
        found.withColumn("_salt", salt).join(bad, ["host", "_salt"], "left").drop("_salt")
        .withColumn("base_failed", rule["short"] | rule["repetitive"])
        .withColumn("host_rejected", F.coalesce("bad", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .drop("bad")
    )
