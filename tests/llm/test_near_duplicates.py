"""The pipeline's near-dedup against all pairs of shingle sets."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from salesmill.llm import near_duplicates

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(rows):
    """The least id of each row's group, by all pairs."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted({min(rows[k][0] for k in range(len(rows)) if root(k) == r) for r in map(root, range(len(rows)))})


def edited(r, words, changes):
    words = list(words)
    for at in r.sample(range(len(words)), changes):
        words[at] = f"new{r.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    """Originals of 20 to 300 words, copies with 1 to 12 changed words, chains, one large group, equal fingerprint sets, nulls."""
    r = random.Random(5)
    fresh = lambda n: [f"w{r.randint(0, 5000)}" for _ in range(n)]
    out = []
    for i in range(60):
        words = fresh(r.choice((20, 60, 200, 300)))
        out.append((i, " ".join(words)))
        for c in (1, 2, 4, 8, 12):
            out.append((1000 * c + i, edited(r, words, c)))
    hub = fresh(150)
    out += [(20_000 + i, edited(r, hub, r.randint(1, 3))) for i in range(80)]
    out += [(30_000, None), (30_001, ""), (30_002, "one"), (30_003, "one"), (30_004, "a b c d e f g h i"), (30_005, "a b c d e f g h")]
    return out


@pytest.mark.parametrize("block_words", [200_000, 1_000, 100])
def test_all_pairs(spark, rows, block_words):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id as _id", "xxhash64(coalesce(text, '')) as _hash", "text")
    found = near_duplicates.classes_of(docs, ["_id", "_hash"], block_words).collect()
    assert len(found) == len(rows)
    least = {}
    for x in found:
        least[x.component] = min(least.get(x.component, x._id), x._id)
    assert sorted(least.values()) == groups(rows)


def test_stage_removes_copies_of_every_similarity(spark, rows):
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(x.doc_id for x in left.collect()) == groups(rows)
