"""The training-data operators against brute-force versions on small, awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyarrow import orc
from tokenizers import Tokenizer

from salesmill.llm import byte_bpe, chat_format, embedding_dedup, graph, line_dedup, mixing, quality_rules, simhash_dedup, substring_dedup, token_counts, token_files
from salesmill.llm.common import new_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, host string, row long"


def docs_of(spark, rows):
    """(doc_id, text, source) rows with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", 7) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Nulls, empty and long texts, ties, repeated rows, shared passages and a hot host."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(400)]
    passage = [r.choice(words) for _ in range(70)]
    rows = [(1, None, "h1"), (2, "", "h1"), (3, " \n\t", None), (None, "no id " * 60, "h2"), (None, None, None)]
    base = [r.choice(words) for _ in range(200)]
    for i in range(10, 60):
        text = [r.choice(words) for _ in range(r.choice((1, 3, 49, 50, 51, 120)))]
        if i % 3 == 0:
            text[len(text) // 2 : len(text) // 2] = passage
        if i % 7 == 0:
            text = [*base[: i * 2], r.choice(words), *base[i * 2 :]]
        lines = " ".join(text).replace(words[0], words[0] + "\n").replace(words[1], "\n\n" + words[1])
        rows.append((i, lines + "\nShared LINE \n" * (i % 2), f"h{i % 3}"))
    rows += [(70, " ".join(base), "h0"), (70, " ".join(base), "h0"), (70, "other text " * 40, "h0"), (71, " ".join(base), "h0")]
    rows.append((80, "word " * 20_000 + "x" * 50_000, "h0"))
    return rows


def same(got, want):
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quality_rules(spark, corpus):
    def brute(text):
        words = WORD.findall(text or "")
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = {t for t in set(triples) if triples.count(t) > 1} if len(triples) < 5000 else set(triples[:-2])
        covered = {i + s for i, t in enumerate(triples) if t in many for s in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)

    got = quality_rules.verdicts(docs_of(spark, corpus))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    same([tuple(x) for x in got.select(columns).collect() if x.doc_id != 80], [(i, *brute(t)) for i, t, _ in corpus if i != 80])
    assert got.where("doc_id = 80").select("n_words", "n_repeat_words").first() == (20_001, 20_000)
    assert got.where("base_failed = (n_words >= 50 and 100 * n_repeat_words <= 50 * n_words)").count() == 0


def test_quality_rules_host_verdict(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(60)), f"good{i % 5}") for i in range(100)]
    bad = [(1000 + i, "spam " * 80, "bad") for i in range(60)] + [(2000, " ".join(f"v{j}" for j in range(60)), "bad")]
    got = {x.doc_id: x for x in quality_rules.verdicts(docs_of(spark, good + bad)).collect()}
    assert all(got[i].kept for i in range(100))
    assert not got[2000].base_failed and got[2000].host_rejected and not got[2000].kept


def test_empty_tables(spark):
    none = docs_of(spark, [])
    path, pattern = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN
    assert quality_rules.verdicts(none).count() == 0
    assert line_dedup.line_bitmaps(none).count() == 0
    assert simhash_dedup.simhash_classes(none).count() == 0
    assert substring_dedup.removed_spans(none).count() == 0
    assert byte_bpe.decoded(byte_bpe.encoded(none, path, pattern), path, pattern).count() == 0
    assert token_counts.token_counts(none, P.path("word_bpe_49k.json")).count() == 0
    assert chat_format.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert embedding_dedup.embedding_classes(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    rated, _ = mixing.mixed(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert rated.count() == 0
    token_files.write_tokens(none, folder := new_folder(spark), P.path("byte_bpe_50k.json"), P.PATTERN)
    assert token_files.token_index(token_files.read_tokens(spark, folder)).count() == 0


def test_token_counts(spark, corpus):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    more = [(90, "It's <|endoftext|> ΑΣ Σ İ é x\x1cy 　 中文 <|ENDOFTEXT|>", None)]
    got = token_counts.token_counts(docs_of(spark, corpus + more), path).select("doc_id", "n_bytes", "n_tokens").collect()
    same([tuple(x) for x in got], [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in corpus + more])


def test_byte_bpe_matches_library_on_any_string():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(path, P.PATTERN)
    codec.machine.max_states = 300  # states are dropped and made again
    r, tokens = random.Random(3), list(ranks)
    for i in range(1500):
        raw = b"".join(r.choice(tokens) for _ in range(r.randint(1, 6))) if i % 2 else bytes(r.choice(b"aabeinth\xc3\xa9 ") for _ in range(r.randint(1, 80)))
        assert codec.machine.encode(raw) == library._encode_single_piece(raw)
    letters = "abcdé ÀΣ́\x1c\x85　\t\n  \n'sTre1٣½,.<|>中日가😀‍"
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        ids = codec.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert "".join(codec.decode(ids, chunk=1)) == text


def test_byte_bpe_encodes_a_pretoken_once():
    codec, seen = byte_bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN), []
    codec.machine.encode = lambda raw: [seen.append(raw) or len(raw)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join(a + b + c + d for c in letters for d in letters) for a in letters for b in letters[:8]]
    first, second = ([codec.encode(t).tolist() for t in texts] for _ in range(2))
    assert first == second and first[0][:2] == [4, 5]
    assert len(seen) == len(set(seen)) > 140_000


def test_byte_bpe_emits_while_it_reads():
    machine = byte_bpe.Transducer(byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    raw = "straßenbahnhaltestelle".encode() * 40
    ids = machine.encode(raw)
    assert b"".join(machine.bytes_of[i] for i in ids) == raw
    # What is open stays bounded however long the input is.
    assert max(len(pending) for _, pending, _ in machine.open) <= 2 * machine.longest


def test_byte_bpe_table(spark, corpus):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rows = byte_bpe.decoded(byte_bpe.encoded(docs_of(spark, corpus), path, P.PATTERN), path, P.PATTERN).collect()
    same([(x.doc_id, list(x.ids), x.text) for x in rows], [(i, library.encode_ordinary(t or ""), t or "") for i, t, _ in corpus])


def test_utf8_stream_cuts_anywhere():
    text = "aé中😀" * 5
    raw = text.encode()
    for size in (1, 2, 3, 5):
        stream = byte_bpe.Utf8Stream()
        assert "".join(stream.feed(raw[i : i + size]) for i in range(0, len(raw), size)) + stream.feed(b"", end=True) == text


def test_token_files(spark, corpus):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    more = [(-5, "a <|endoftext|> b   c\n\n\nd  ", None)]
    token_files.write_tokens(docs_of(spark, corpus + more), folder := new_folder(spark), path, P.PATTERN, files=5)
    got = token_files.token_index(token_files.read_tokens(spark, folder)).collect()
    at, want = 0, {}
    for i, t, _ in sorted(corpus + more, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    same([(x.doc_id, x.n_tokens, x.ids_crc32) for x in got], [(i, *v) for i, values in want.items() for v in values])
    ends = sorted((x.start, x.start + x.n_tokens) for x in got)
    assert ends[0][0] == 0 and ends[-1][1] == at and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    order = [x.doc_id for x in sorted(got, key=lambda x: x.start) if x.doc_id is not None]
    assert order == sorted(order)
    # A lookup by id reads the stripes that may hold it.
    assert [len(x.ids) for x in token_files.read_tokens(spark, folder).where("doc_id = 10").collect()] == [want[10][0][0]]


def test_token_files_plain_words_as_the_library():
    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files.Encoder(path, P.PATTERN)
    assert P.PATTERN == token_files.WORDS_WHOLE
    for text in ("a plain word", " a  b", "it's don't 's x's", "a\nb c\n d", "é ab é", "ab1 1ab a.b .a", "a \tb", "", " ", "x" * 300 + " " + "y" * 300):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def rows_scanned(df):
    """The rows that the scan of a collected DataFrame gave to the filter above it."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_stripes_and_bloom_filters_prune(spark, tmp_path):
    """Files of several stripes: an id, an id range, and an id that is nowhere read few rows or none."""
    n = 20_000
    docs = spark.range(n).selectExpr("id * 3 as doc_id", "concat('some words ', id, ' ', id * 7919 % 1009) as text").repartition(3)
    small = {"orc.stripe.size": "60000", "orc.row.index.stride": "1000", "orc.rows.between.memory.checks": "500"}
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs, folder, P.path("byte_bpe_50k.json"), P.PATTERN, files=2, options=small)
    stripes = [orc.ORCFile(f).nstripes for f in tmp_path.glob("tokens/*.orc")]
    assert len(stripes) == 2 and min(stripes) >= 3
    tokens = token_files.read_tokens(spark, folder)
    scanned = {}
    for name, where in {"all": "doc_id >= 0", "one": "doc_id = 30000", "none": "doc_id = 30001", "range": "doc_id between 30000 and 31500"}.items():
        found = tokens.where(where)
        scanned[name] = (len(found.collect()), rows_scanned(found))
    assert scanned["all"] == (n, n)
    assert scanned["one"][0] == 1 and 0 < scanned["one"][1] <= 1000
    assert scanned["none"] == (0, 0)  # inside a stripe's range: only its Bloom filter can tell
    assert scanned["range"][0] == 501 and scanned["range"][1] <= n / 5


def brute_lines(rows, min_docs, keep_first):
    seen, docs = {}, {}
    key = lambda line: line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    h = lambda t: xxhash.xxh64_intdigest((t or "").encode(), 42)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    order = sorted(((line_dedup.NO_ID if i is None else i, signed(h(t)), t or "") for i, t, _ in rows))
    for i, _, t in order:
        for line in t.split("\n"):
            if key(line):
                docs.setdefault(key(line), set()).add(i)
    out = []
    for i, x, t in order:
        kept = []
        for n, line in enumerate(t.split("\n")):
            k = key(line)
            common = bool(k) and len(docs[k]) >= min_docs
            # Equal rows share one bitmap, so the first of them is the first occurrence for both.
            first = seen.setdefault(k, (i, x, n)) == (i, x, n)
            if not common or (keep_first and first):
                kept.append(line)
        out.append((None if i == line_dedup.NO_ID else i, "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs,keep_first", [(10, False), (1, True), (2, True), (3, False)])
def test_line_dedup(spark, corpus, min_docs, keep_first):
    rows = corpus
    docs = docs_of(spark, rows)
    marked = line_dedup.with_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs, keep_first)).collect()
    same([(x.doc_id, line_dedup.kept_text(x.text or "", x._bitmap)[0]) for x in marked], brute_lines(rows, min_docs, keep_first))


def test_line_dedup_hot_line_over_many_partitions(spark):
    docs = docs_of(spark, [(i, f"hot\nown {i}\nhot", "h") for i in range(500)])
    bitmaps = {x.doc: line_dedup.unpack(x.bitmap, 3).tolist() for x in line_dedup.line_bitmaps(docs, 10, False).collect()}
    assert bitmaps == {i: [False, True, False] for i in range(500)}
    first = {x.doc: line_dedup.unpack(x.bitmap, 3).tolist() for x in line_dedup.line_bitmaps(docs).collect()}
    assert first == {i: [i == 0, True, False] for i in range(500)}


def components_of(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(0, 300) if i % 50] + [(400, i) for i in range(401, 500)] + [(r.randint(600, 900), r.randint(600, 900)) for _ in range(250)] + [(5, 5)]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = components_of(1000, links)
    assert got == {i: want[i] for i in {x for link in links if link[0] != link[1] for x in link}}


@pytest.mark.parametrize("limit", [20_000, 8])
def test_simhash(spark, corpus, limit):
    def fp(text, width=3):
        words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = [x for x in corpus if x[0] != 80]
    r = random.Random(2)
    fps = [fp(t) for _, t, _ in rows]
    got = simhash_dedup.simhash_classes(docs_of(spark, rows), width=3, cell_limit=limit).collect()
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = components_of(len(rows), links)
    least = {c: min((rows[i][0] for i in range(len(rows)) if roots[i] == c and rows[i][0] is not None), default=None) for c in set(roots)}
    same([tuple(x) for x in got], [(rows[i][0], f"{fps[i]:016x}", least[roots[i]]) for i in range(len(rows))])
    # Fingerprints around common centres, and at random.
    values = [r.getrandbits(64) for _ in range(150)]
    values += [v ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for v in values[:20] for _ in range(15)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {x.node: x.component for x in graph.components(simhash_dedup.fingerprint_links(table, 3, limit)).collect()}
    want = components_of(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3])
    groups = {}
    for i, c in enumerate(want):
        groups.setdefault(c, set()).add(signed[i])
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(k for k, v in found.items() if v == c) for c in set(found.values())}


def test_embeddings(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + r.normal(size=16) * (0.02 if i % 2 else 0.3)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)] + [(400, [2 * x for x in rows[5][1]])]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] + [1.0] * 15), (503, [float("inf")] + [1.0] * 15), (504, [None] + [1.0] * 15), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, []), (508, [1e-200] * 16), (509, [1.0] * 16)]
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = []
    for a in ok:
        for b in ok:
            if b < a and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links.append((a, b))
    roots, counts = components_of(len(rows), links), [0] * len(rows)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    want = [(rows[i][0], counts[i], rows[roots[i]][0], i == roots[i]) for i in range(len(rows))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for size in (4096, 16):  # whole cells, and cells in blocks
        same([tuple(x) for x in embedding_dedup.embedding_classes(table, pivots=6, block_rows=size).collect()], want)


def brute_substrings(rows, width):
    docs = [(substring_dedup.LAST_ID if i is None else i, WORD.findall(t or "")) for i, t, _ in rows]
    least = {}
    for i, words in docs:
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            least[w] = min(least.get(w, i), i)
    out = []
    for i, words in docs:
        gone = {k + s for k in range(len(words) - width + 1) if least[tuple(words[k : k + width])] < i for s in range(width)}
        out.append((None if i == substring_dedup.LAST_ID else i, " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def test_substring_dedup_sends_a_shard_its_own_words(spark, monkeypatch):
    sent, dealt = [], substring_dedup._dealt
    monkeypatch.setattr(substring_dedup, "_dealt", lambda *a: sent.append(dealt(*a)) or sent[-1])
    parts = [" ".join(f"w{i}_{k}" for k in range(60)) for i in range(30)]
    # Every passage has its own first document; the last document is one run that all shards know a part of.
    docs = docs_of(spark, [*[(i, p, "h") for i, p in enumerate(parts)], (99, " ".join(parts), "h")])
    spans = substring_dedup.removed_spans(docs, shard_words=100).collect()
    gone = {k for x in spans for s in x.spans for k in range(s.start, s.end)}
    assert {x.doc for x in spans} == {99} and gone == set(range(1800))
    streamed = sent[0][0].where("doc = 99").selectExpr("sum(size(split(words, ' '))) AS n", "count(DISTINCT shard) AS shards").first()
    assert streamed.shards > 5 and streamed.n <= 2 * 1800


@pytest.mark.parametrize("options", [{}, {"shard_words": 60, "task_words": 40}, {"shared_limit": 0}, {"width": 5}, {"width": 20, "shard_words": 30, "shared_limit": 0}])
def test_substring_dedup(spark, corpus, options):
    rows = [x for x in corpus if x[0] != 80]
    docs = docs_of(spark, rows)
    spans = substring_dedup.removed_spans(docs, **options)
    want = brute_substrings(rows, options.get("width", 50))
    for limit in (32 << 20, -1):
        marked = substring_dedup.with_spans(docs, spans, limit).collect()
        same([(x.doc_id, b" ".join(substring_dedup.kept_words(x.text or "", x._spans)[0]).decode()) for x in marked], want)


def test_automaton_matching_statistics():
    r = random.Random(9)
    for _ in range(150):
        width = r.randint(2, 4)
        passages = [(d, [r.choice("ab") for _ in range(r.randint(width, 9))]) for d in r.sample(range(20), 4)]
        automaton = substring_dedup.Automaton(width)
        for d, words in passages:
            automaton.add(words, d)
        automaton.finish()
        doc, words = r.randint(0, 20), [r.choice("abc") for _ in range(15)]
        least = {}
        for d, p in passages:
            for k in range(len(p) - width + 1):
                w = tuple(p[k : k + width])
                least[w] = min(d, least.get(w, d))
        want = {k + s for k in range(len(words) - width + 1) if least.get(tuple(words[k : k + width]), doc) < doc for s in range(width)}
        assert {k for a, b in automaton.stream(words, doc) for k in range(a, b)} == want


def test_chat_round_trip_on_any_text():
    r = random.Random(6)
    pieces = [*chat_format.CONTROL, "\\", " ", "[", "]", "ok", "\n", "</", "é", "] x", "[/INST]"]
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "system", "", "a] b", "\\"]), "".join(r.choice(pieces) for _ in range(r.randint(0, 6)))) for _ in range(r.randint(0, 4))]
        text, spans, _ = chat_format.format_turns(turns)
        assert chat_format.parse(text) == turns
        assert [chat_format.unescape(text[a:b]) for a, b in spans] == [t for role, t in turns if role == "assistant"]


def test_chat_table(spark):
    rows = [(1, 2, "assistant", None, 9), (1, 1, "user", "a [/INST] b", 9), (1, 1, "user", "a", 9), (None, 0, None, "x", 9), (2, None, "tool", "</s>", 9), (2, 3, "assistant", "long " * 50_000, 9)]
    got = {x.conv_id: x for x in chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted long")).collect()}
    assert chat_format.parse(got[1].formatted) == [("user", "a"), ("user", "a [/INST] b"), ("assistant", "")] and got[1].n_escaped == 1
    assert chat_format.parse(got[None].formatted) == [("", "x")]
    assert chat_format.parse(got[2].formatted) == [("tool", "</s>"), ("assistant", "long " * 50_000)]


def test_mixing(spark):
    r = random.Random(8)
    kinds = {0: "river mountain forest valley", 1: "click here buy now", 2: "vile nasty awful"}
    rows, labels = [], []
    for i in range(600):
        kind = r.choice((0, 0, 0, 1, 2))
        rows.append((i, " ".join(r.choice(kinds[kind].split() + ["the", "of", "and"]) for _ in range(r.randint(20, 80))), "h"))
        if i % 2:
            labels.append((i, int(kind == 0), int(kind == 2), "extra"))
        rows[-1] = (*rows[-1][:2], str(kind))
    rows += [(None, None, None), (601, "", None), (5, rows[5][1], rows[5][2])]
    labels += [(None, 1, 1, "x"), (10_000, 1, 0, "x"), (3, None, None, "x")]
    rated, fit = mixing.mixed(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"))
    got = rated.toPandas()
    assert len(got) == len(rows) and (got["rate"] >= 0).all()
    p, n, rate = np.stack(got["p"]), got["n_tokens"].to_numpy(), got["rate"].to_numpy()
    assert np.allclose(p.sum(1), 1)
    reached = (rate * n) @ p
    assert np.allclose(reached, fit.reached) and np.abs(reached - fit.targets).max() <= 1e-3 * fit.targets.max()
    held_out = [(int(k), x) for (i, _, k), x in zip(rows, [None] * len(rows)) if i is not None and i < 600 and i % 2 == 0]
    by_id = {int(i): row for i, row in zip(got["doc_id"], p) if i == i and i is not None}
    right = [by_id[i].argmax() == int(k) for i, _, k in rows if i is not None and i < 600 and i % 2 == 0]
    assert len(held_out) == len(right) and np.mean(right) > 0.95
    # Brute force: the same steps over one array.
    total = lambda x: (x * n) @ p
    x, steps = np.ones(len(n)), fit.steps
    for step in steps:
        x = np.maximum(0, x - p @ step)
    assert np.allclose(x, rate) and np.allclose(total(np.ones(len(n))), fit.before)


def nearest_totals(p, n, wanted):
    """The least distance from `wanted` of totals of nonnegative rates, by an active-set solver over single documents."""
    a, x, used = (p * n[:, None]).T, np.zeros(len(n)), np.zeros(len(n), bool)
    for _ in range(1000):
        gain = a.T @ (wanted - a @ x)
        gain[used] = -1
        if gain.max() <= 1e-10 * np.abs(wanted).max() * np.abs(a).max():
            break
        used[gain.argmax()] = True
        while True:
            s = np.zeros(len(n))
            s[used] = np.linalg.lstsq(a[:, used], wanted, rcond=None)[0]
            if (s[used] > 0).all():
                x = s
                break
            low = used & (s <= 0)
            x = x + np.min(x[low] / (x[low] - s[low])) * (s - x)
            used &= x > 1e-15
    return np.linalg.norm(a @ x - wanted)


@pytest.mark.parametrize("shape", [(8, 3, 2), (0.2, 0.2, 0.2), (2, 2, 0)])
@pytest.mark.parametrize("weights", [(0.85, 0.14, 0.01), (0.01, 0.01, 0.98), (1, 0, 0)])
def test_rates_reach_the_least_distance(spark, shape, weights):
    """Targets in reach are met; of others the nearest totals in reach are."""
    r = np.random.default_rng(4)
    p = r.dirichlet([s or 1e-9 for s in shape], 150)
    n = r.integers(0, 400, 150)
    rows = spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(n, p)], "n_tokens long, p array<double>").coalesce(2)
    wanted = np.array(weights) * n.sum()
    fit = mixing.fit_rates(rows, wanted)
    assert fit.solved and fit.error <= nearest_totals(p, n.astype(float), wanted) + 1e-4 * wanted.max()
    rates = mixing.rates_of(p, np.array(fit.steps).reshape(-1, 3))
    assert np.allclose((rates * n) @ p, fit.reached) and (rates >= 0).all()


def test_mixing_without_labels(spark):
    rated, fit = mixing.mixed(docs_of(spark, [(1, "a b", "h"), (2, None, "h")]), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [(x.doc_id, list(x.p)) for x in rated.orderBy("doc_id").collect()] == [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0])]


def test_digest_helpers_agree(spark):
    from salesmill.llm.queries import token_digests

    row = token_digests(spark.createDataFrame([(1, [5, 6], "ab"), (2, [], "")], "doc_id long, ids array<int>, text string")).orderBy("doc_id").collect()
    assert row[0].ids_sha256 == hashlib.sha256(b"5,6").hexdigest() and row[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert row[0].decoded_sha256 == hashlib.sha256(b"ab").hexdigest() and row[1].n_tokens == 0
