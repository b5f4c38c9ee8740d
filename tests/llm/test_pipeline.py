"""The corpus pipeline stage by stage, and its first three stages against a version in plain Python."""

from __future__ import annotations

import collections
import itertools
import random
import re

import duckdb
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from salesmill.llm import byte_bpe, quality_rules
from salesmill.llm.oracles import ORACLES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, copies, near copies, a common line, junk, short and toxic documents, nulls."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(3000)]
    prose = lambda n: "\n".join(" ".join(r.choice(words) for _ in range(12)) for _ in range(n // 12))
    rows, labels = [], []
    for i in range(120):
        rows.append((i, prose(120) + "\nA common line of every page"))
        labels.append((i, 1, 0))
    for i in range(30):
        rows.append((200 + i, rows[i][1]))
        changed = rows[40 + i][1].split(" ")
        changed[50] = "changed"
        rows.append((300 + i, " ".join(changed)))
    for i in range(40):
        rows.append((400 + i, prose(60) + "\n" + " ".join(r.choice(("vile", "nasty", "awful")) + str(r.randint(0, 99)) + " vile nasty awful" for _ in range(20))))
        labels.append((400 + i, 1, 1))
    rows += [(500 + i, "spam " * 100) for i in range(10)] + [(600, "too short"), (601, None), (602, ""), (None, prose(120)), (0, rows[0][1])]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(i, t, "en", f"s{n % 4}" if n % 9 else None, len(t or "")) for n, (i, t) in enumerate(rows)], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    kept = stages["quality_rules"](spark, docs, folder)
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and not set(ids) & {*range(500, 510), 600, 601, 602}
    want = sum(quality_rules.measures(t or "")[0] >= 50 and not 100 * (m := quality_rules.measures(t or ""))[5] > 50 * m[0] for (t,) in docs.select("text").collect())
    assert len(ids) == want

    cut = stages["line_dedup"](spark, kept, folder)
    assert cut.columns == docs.columns
    assert cut.where("text like '%common line%'").count() == 2  # the row with the least id is there twice
    assert {x.doc_id for x in cut.collect()} == set(ids)

    one = stages["simhash_near_dedup"](spark, cut, folder)
    left = sorted(x.doc_id for x in one.where("doc_id is not null").collect())
    assert one.columns == docs.columns and one.where("doc_id is null").count() == 1
    assert set(range(1, 120)) <= set(left) and left.count(0) <= 2 and not set(left) & set(range(201, 230))

    mixed = stages["mixing"](spark, one, folder)
    left = {x.doc_id for x in mixed.collect()}
    assert mixed.columns == docs.columns and set(range(1, 120)) <= left and len(left & set(range(400, 440))) <= 4

    path = P.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = sorted((str(x.doc_id), library.encode_ordinary(x.text or "")) for x in mixed.collect())
    coded = stages["byte_bpe"](spark, mixed, folder).collect()
    assert sorted((str(x.doc_id), list(x.ids)) for x in coded) == texts and all(x.n_tokens == len(x.ids) for x in coded)


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    left = {x.doc_id for x in rows}
    assert set(range(1, 120)) <= left and not left & {*range(201, 230), *range(500, 510), 600, 601, 602}


def test_edited_copies_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert not {x.doc_id for x in left.collect()} & {*range(300, 330)}


@pytest.mark.parametrize("toxic, low", [(0.005, 0.5), (0.02, 0.05), (0.2, 0.25)])
def test_mixing_keeps_clean_drops_toxic_meets_weights(spark, tmp_path, toxic, low):
    r = random.Random(3)
    kinds = ["river mountain forest valley", "click here buy now", "vile nasty awful hateful"]
    share = [1 - toxic - low, low, toxic]
    rows = []
    for kind in range(3):
        for _ in range(round(2000 * share[kind])):
            rows.append((len(rows), " ".join(r.choice([*kinds[kind].split(), "the", "of"]) for _ in range(60)), kind))
    spark.createDataFrame([(i, int(k == 0), int(k == 2)) for i, _, k in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], DOCS)
    kept = [x.doc_id for x in corpus_pipeline.mixture(spark, docs, str(tmp_path)).collect()]
    kind = {i: k for i, _, k in rows}
    count = [sum(kind[i] == k for i in kept) for k in range(3)]
    clean = [i for i in kept if kind[i] == 0]
    assert sorted(clean) == [i for i, _, k in rows if k == 0] and count[2] == 0
    want = count[0] * 0.14 / 0.85
    assert abs(count[1] - want) <= 0.1 * want


def test_empty(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def plain_python(rows):
    """Ids and texts that the first three stages leave of (id, text, host) rows with ids of their own."""
    with duckdb.connect() as db:
        db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
        kept = {i for (i,) in db.execute(f"SELECT doc_id FROM ({ORACLES['op4_quality_rules']}) WHERE kept").fetchall()}
    docs = {i: t for i, t, _ in sorted(rows) if i in kept}
    key = lambda line: line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    holders = collections.defaultdict(set)
    for i, t in docs.items():
        for line in t.split("\n"):
            holders[key(line)].add(i)
    stays = lambda i, line: not key(line) or len(holders[key(line)]) < 10 or min(holders[key(line)]) == i
    seen = set()
    for i, t in docs.items():
        lines = []
        for line in t.split("\n"):
            common = key(line) and len(holders[key(line)]) >= 10
            if stays(i, line) and not (common and key(line) in seen):
                lines.append(line)
            if common:
                seen.add(key(line))
        docs[i] = "\n".join(lines)
    docs = {i: t for i, t in docs.items() if t.strip(" \t\n\v\f\r")}
    words = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t) for i, t in docs.items()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in words.items()}
    shingles = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(docs, 2):
        shared = len(shingles[a] & shingles[b])
        if shared >= 0.8 * (len(shingles[a]) + len(shingles[b]) - shared):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: t for i, t in docs.items() if root(i) == i}


def test_first_stages_against_plain_python(spark, tmp_path):
    r = random.Random(21)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(2000)]
    prose = lambda n: "\n".join(" ".join(r.choice(words) for _ in range(12)) for _ in range(n // 12))
    rows = []
    for i in range(60):
        rows.append((i, prose(r.choice((48, 60, 120, 240))) + "\n  A Common line " * (i % 3) + "\n\t\n" * (i % 2), f"h{i % 3}"))
    for i in range(60, 120):
        source = rows[r.randrange(60)][1].split(" ")
        for _ in range(r.choice((0, 1, 2, 5, 20))):
            source[r.randrange(len(source))] = r.choice(words)
        rows.append((i, " ".join(source), f"h{i % 5}"))
    rows += [(200 + i, "spam " * 100, "bad") for i in range(12)] + [(230, prose(120), "bad"), (231, None, "h1"), (232, "", None), (233, "*#" * 200 + prose(120), "h0")]
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    got = {x.doc_id: x.text for x in docs.collect()}
    assert got == plain_python(rows)


def test_columns_with_the_stages_own_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(150)
    extra = ["_id", "_hash", "_HASH_", "_bitmap", "_copies", "_copy", "_block", "_doc", "_row", "_text", "row", "doc", "host", "kept", "rate", "p", "component"]
    named = docs.select("*", *[F.lit(n).alias(c) for n, c in enumerate(extra)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, folder)
        assert out.columns == named.columns, name
        plain = sorted(map(str, stage(spark, docs, folder).collect()))
        assert sorted(map(str, out.select(*docs.columns).collect())) == plain, name
        assert out.select(*extra).distinct().collect() == [tuple(range(len(extra)))], name


def test_documents_left_blank_go(spark):
    docs = spark.createDataFrame([(i, "Aaa bbb\n\n \t\nCcc ddd", "en", "s", 5) for i in range(12)] + [(20, None, "en", "s", 0)], DOCS)
    assert sorted((x.doc_id, x.text) for x in corpus_pipeline.lines(spark, docs, "").collect()) == [(0, "Aaa bbb\n\n \t\nCcc ddd"), (20, None)]


def test_many_copies_of_few_rows(spark, tmp_path, monkeypatch):
    """Few low-quality words beside many clean ones: rates far above one, dealt over tasks."""
    r = random.Random(2)
    text = lambda kind: " ".join(r.choice(kind.split() + ["the", "of"]) for _ in range(40))
    rows = [(i, text("river mountain forest valley"), 0) for i in range(400)] + [(400 + i, text("click here buy now"), 1) for i in range(5)]
    spark.createDataFrame([(i, int(k == 0), 0) for i, _, k in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], DOCS)
    whole = sorted(x.doc_id for x in corpus_pipeline.mixture(spark, docs, str(tmp_path)).collect())
    monkeypatch.setattr(corpus_pipeline, "COPIES", 4)
    assert sorted(x.doc_id for x in corpus_pipeline.mixture(spark, docs, str(tmp_path)).collect()) == whole
    assert abs(sum(i >= 400 for i in whole) - 400 * 0.14 / 0.85) <= 10
