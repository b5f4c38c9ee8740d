"""Centroid clustering, HTML extraction and token alignment against brute-force versions on small, awkward tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from salesmill.llm import centroid_clustering, html_extraction, token_alignment
from salesmill.llm.token_counts import byte_symbols

# -- centroid clustering ----------------------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, dims, scale, salt):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x * scale) < 1 << 28 for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in order[:k]]
    nearest = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        mine = collections.defaultdict(list)
        for _, q in kept:
            mine[nearest(q)[1]].append(q)
        for j, members in mine.items():
            centroids[j] = [sum(column) // len(members) for column in zip(*members)]
    return [(i, *reversed(nearest(q))) for i, q in kept], centroids


@pytest.mark.parametrize("leading", [1, 3, 6])
def test_clusters(spark, leading):
    r = random.Random(2)
    rows = [(i, [r.gauss(i % 5, 0.3 + i % 3) for _ in range(6)]) for i in range(120)]
    rows += [(200, rows[0][1]), (200, rows[0][1]), (200, rows[7][1]), (None, rows[3][1]), (None, rows[9][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0] * 5 + [None]), (304, [float("nan")] * 6), (305, [float("inf")] * 6)]
    rows += [(306, [1e30] * 6), (307, [-250_000.0] * 6), (308, [0.0] * 6), (309, [-0.0001] * 6)]
    table = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<double>, cluster int, q string, rest double")
    found, centroids = centroid_clustering.clusters(table, k=8, rounds=4, dims=6, scale=1024, leading=leading)
    want, means = brute_clusters(rows, 8, 4, 6, 1024, 3)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert centroids.tolist() == means
    report = centroid_clustering.cluster_report(found, centroids).collect()
    by_cluster = collections.Counter()
    for _, j, d in want:
        by_cluster[j] += d
    assert len(report) == len(want)
    for row in report:
        assert (row["cluster_inertia"], row["inertia"]) == (by_cluster[row["cluster"]], by_cluster.total())
        assert row["centroid_sha256"] == hashlib.sha256(",".join(map(str, means[row["cluster"]])).encode()).hexdigest()


def test_clusters_few_equal_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    same = [(i, [0.5, 0.5]) for i in range(5)]
    found, centroids = centroid_clustering.clusters(spark.createDataFrame(same, schema), k=8, rounds=3, dims=2)
    assert sorted(map(tuple, found.collect())) == [(i, 0, 0) for i in range(5)]  # ties go to the smaller number
    assert centroids.tolist() == [[512, 512]] * 5
    found, centroids = centroid_clustering.clusters(spark.createDataFrame([], schema), dims=2)
    assert found.collect() == [] and len(centroids) == 0
    assert centroid_clustering.cluster_report(found, centroids).collect() == []


def test_bound_never_hides_the_nearest():
    """Vectors that share their leading part, and ones far from the mean, where a bound is most easily too high."""
    r = np.random.default_rng(1)
    q = np.concatenate([r.integers(-3, 3, (300, 8)), r.integers(-(1 << 27), 1 << 27, (300, 8)), r.integers(1 << 27, (1 << 27) + 3, (300, 8))])
    x = q.astype(float)
    rotation = centroid_clustering.Rotation(len(q), x.sum(axis=0), x.T @ x, 2)
    centroids = q[::90].astype(np.int64)
    cluster, distance = centroid_clustering.nearest(q.astype(np.int64), *rotation(x), centroids, rotation)
    exact = ((q[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


# -- HTML extraction --------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("just  text &amp; more", "just text & more"),
        ("<nav>a</nav><article><h1>T &lt;1&gt;</h1><p>x\n y<b>z</b><br>w<p>u</article><footer>f</footer>", "T <1>\nx yz w\nu"),
        ("<title>t</title><script>var a = '</p>';</script><style>p{}</style><p>x<!-- <p>no</p> -->y", "xy"),
        ("<body class='has-sidebar'><div class=sidebar>s</div><div id=content>c</div><p class='cookie-notice'>n</p>", "c"),
        ("<header><h1>site</h1></header><article><header><h1>T</h1></header><p>p</p><aside>s</aside><form>f</form></article>", "T\np"),
        ("<div class=header><article><p>a</p></article></div>", "a"),
        ("<main><p>a</p><section id=comments><article><p>no</p></article></section></main><div>x</div>", "a"),
        ("<main><article><p>a</p></article><p>aside of it</p></main>", "a"),
        ("<div itemprop='articleBody'><p>a</p><div class='ad'>buy</div><p>b <span class='promo'>no</span>c</p></div><p>x</p>", "a\nb c"),
        ("<article><p>one &amp two &am", "one & two &am"),
        ("<article><p>one</p><p>two</arti", "one\ntwo"),
        ("<article><p>a < b, c <= d</p><p title=it's>e</p><p title='>'>f</p></article>", "a < b, c <= d\ne\nf"),
        ("<article><p><b>Cut<br><p>off &#233;&nbsp;&eacute; &#x1F600;</p></article>", "Cut\noff é é 😀"),
        ("<article><p></p><p> \n</p></article><p>after</p>", "after"),
        ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul></article>", "a\nb\nc\nd"),
    ],
)
def test_page(spark, html, text):
    table = spark.createDataFrame([(1, "http://x.y/z", html, "a", 1, "b", [1])], "page_id long, url string, html string, host string, row int, text string, blocks array<int>")
    assert [tuple(r)[:3] for r in html_extraction.extracted(table).collect()] == [(1, "http://x.y/z", text)]


def test_runs_that_a_host_repeats(spark):
    """Unmarked pages lose what their host repeats, article copies do not make it boilerplate by themselves."""
    notice = "we use cookies to improve this site"
    story = "a story that two of many pages tell in the same words"
    rows = [(i, f"https://user@Host.example:80/{i}", f"<div>{notice}</div><div>own words of page {i} a{i}</div><div>read on {notice} {i}</div>") for i in range(20)]
    rows += [(i, "https://host.example/s", f"<p>{story}</p><p>page number {i}</p>") for i in (50, 51)]
    rows += [(60, "http://other.example", f"<p>{notice}</p>"), (61, None, f"<p>{notice}</p>"), (None, "no url", f"<p>{notice}</p>")]
    rows += [(62, "http://other.example/2", f"<p>{notice}</p>")]  # the same stream: one page
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_repeated"]) for r in html_extraction.extracted(table).collect()}
    for i in range(20):
        # "own words of page" has four words; the run before it joins it to the notice.
        assert got[i][0] == f"{i} a{i}\n{i}", got[i]
    assert got[50] == (f"{story}\npage number 50", 0) and got[51] == (f"{story}\npage number 51", 0)
    assert got[60] == got[61] == got[62] == got[None] == (notice, 0)


def test_hot_host_is_dealt(spark):
    """A host beyond the shard size is split, by a broadcast or a join, and its pages keep their own text."""
    table = spark.range(400).selectExpr("id page_id", "'http://hot.example/' || id url", "concat('<p>', repeat('shared words of the menu ', 3), '</p><p>page', id, ' is mine</p>') html")
    for broadcast_rows in (10, 0):
        got = html_extraction.extracted(table, shard_bytes=4000, broadcast_rows=broadcast_rows).collect()
        assert sorted((r["page_id"], r["text"]) for r in got) == [(i, f"page{i} is mine") for i in range(400)]


def test_shards_do_not_change_results(spark):
    """A run is boilerplate by its whole host, however the host's pages are dealt over shards."""
    rows = [(i, f"http://hot.example/{i}", f"<p>own{i} words{i}</p>" + (f"<p>a line that one page in four repeats</p>" if i % 4 == 0 else "") + f"<p>another that {'few pages' if i % 10 == 0 else f'page{i}'} tell so</p>") for i in range(200)]
    rows += [(i, "http://hot.example/copy", "<p>the same stream on very many pages</p>") for i in range(200, 300)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = lambda **k: sorted(map(tuple, html_extraction.extracted(table, **k).collect()))
    whole = read()
    assert {r[2] for r in whole if r[0] >= 200} == {"the same stream on very many pages"}
    assert all(("repeats" in r[2]) is False for r in whole) and sum("few pages" in r[2] for r in whole) == 20
    assert read(shard_bytes=500) == read(shard_bytes=3000, broadcast_rows=0) == whole


def test_marked_text_loses_what_its_host_repeats(spark):
    """Suffix arrays decide on marked articles too; a few pages that share a passage are copies and keep it."""
    more, menu, told = "read all our other stories right here", "home news sport weather money and more", "six pages of forty tell this in the same words"
    page = lambda inner, around="": f"<nav>{around}</nav><article>{inner}</article>"
    rows = [(i, f"http://big.example/{i}", page(f"<h1>t{i}</h1><p>own{i} text{i} {menu if i == 7 else ''}</p><p>{told if i < 6 else f'a{i}'}</p><p>{more}</p>", f"{menu} {i}")) for i in range(40)]
    rows += [(100 + i, f"http://big.example/copy/{i}", page("<p>one article on very many pages</p>", f"n{i}")) for i in range(60)]  # one text
    rows += [(200 + i, f"http://small.example/{i}", page(f"<p>a near copy of another page s{i}</p>")) for i in range(4)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    whole = None
    for options in ({}, {"shard_bytes": 600}, {"shard_bytes": 2000, "broadcast_rows": 0}):
        got = {r["page_id"]: r["text"] for r in html_extraction.extracted(table, **options).collect()}
        for i in range(40):
            assert got[i] == f"t{i}\nown{i} text{i}\n{told if i < 6 else f'a{i}'}", (i, options)
        assert {got[100 + i] for i in range(60)} == {"one article on very many pages"}
        assert [got[200 + i] for i in range(4)] == [f"a near copy of another page s{i}" for i in range(4)]
        whole = whole or got
        assert got == whole


def test_marked_runs_against_all_windows(spark):
    """Counts over shards equal those over the whole host, whatever the shards name."""
    r = random.Random(7)
    rows = []
    for host, n in (("a", 150), ("b", 12), ("c", 40)):
        pool = [" ".join(r.choice("uvwxyz") + str(r.randint(0, 3)) for _ in range(7)) for _ in range(12)]
        for i in range(n):
            said = [p for k, p in enumerate(pool) if r.random() < (k + 1) / 26] + [f"{host}{r.randint(0, n)} x y"]
            r.shuffle(said)
            rows.append((len(rows), f"http://{host}/", "<article>" + "".join(f"<p>{p}</p>" for p in said) + "</article>"))
    texts = {k: html_extraction.read_page(h)[0] for k, _, h in rows}
    want = {}
    for host in {u for _, u, _ in rows}:
        pages = {texts[k] for k, u, _ in rows if u == host}
        found = collections.Counter(x for t in pages for x in {" ".join(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)})
        common = {x for x, n in found.items() if n >= max(5, -(-len(pages) // 5))}
        for k, u, _ in rows:
            if u == host:
                blocks = texts[k].split("\n")
                want[k] = html_extraction.kept_text(blocks, [False] * len(blocks), html_extraction.unique_words(blocks, common, 5))
    assert sum(want[k] != texts[k] for k in texts) > 50 and sum(want[k] != "" for k in texts) > 50
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for options in ({}, {"shard_bytes": 1000}):
        assert {x["page_id"]: x["text"] for x in html_extraction.extracted(table, **options).collect()} == want


def test_long_page_and_no_pages(spark):
    words = " ".join(f"w{i}" for i in range(200_000))
    table = spark.createDataFrame([(1, "http://a.b/", f"<article>{'<b>' * 3000}{words}</article>"), (2, "http://a.b/", f"<p>{words} {words}")], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extraction.extracted(table).collect()} == {1: words, 2: f"{words} {words}"}
    assert html_extraction.extracted(table.limit(0)).collect() == []


def test_repeated_against_all_windows():
    r = random.Random(4)
    for length in (1, 2, 3, 5, 8):
        pages = [[r.choice("ab") for _ in range(r.randint(0, 30))] for _ in range(6)]
        tokens = np.array([ord(t) for p in pages for t in p])
        of = np.repeat(np.arange(6), [len(p) for p in pages])
        for least in (2, 3):
            want = []
            for p in pages:
                flags = [False] * len(p)
                for i in range(len(p) - length + 1):
                    run = p[i : i + length]
                    if sum(any(o[j : j + length] == run for j in range(len(o) - length + 1)) for o in pages) >= least:
                        flags[i : i + length] = [True] * length
                want += flags
            assert html_extraction.repeated(tokens, of, length, least).tolist() == want


# -- token alignment --------------------------------------------------------------------------------------------

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute_alignment(rows):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte = {s: i for i, s in enumerate(byte_symbols())}
    pieces = lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    facts, held = [], collections.Counter()
    for i, text in rows:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        raw_a, raw_b = [bytes(byte[c] for c in a.id_to_token(x)) for x in ids_a], [pieces(x) for x in ids_b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            facts.append((i, 0, 0, [], []))
            continue
        owner_a = [n for n, raw in enumerate(raw_a) for _ in raw]
        owner_b = [n for n, raw in enumerate(raw_b) for _ in raw]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, from_a, from_b = [], 0, 0
        for at in range(1, len(owner_a) + 1):
            if at == len(owner_a) or owner_a[at] != owner_a[at - 1] and owner_b[at] != owner_b[at - 1]:
                to_a, to_b = owner_a[at - 1] + 1, owner_b[at - 1] + 1
                groups.append(",".join(map(str, ids_a[from_a:to_a])) + "|" + ",".join(map(str, ids_b[from_b:to_b])))
                from_a, from_b = to_a, to_b
        links = [(ids_a[x], ids_b[y]) for x, y in links]
        facts.append((i, len(ids_a), len(ids_b), groups, links))
        held.update(set(links))
    best = collections.defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [
        (
            i, n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, n_a, n_b, groups, links in facts
    ]


@pytest.mark.parametrize("hot_share", [token_alignment.HOT_SHARE, 5, 1])
def test_alignment(spark, hot_share):
    r = random.Random(3)
    bits = ["the", " ", "  ", "\n", "naïve", "été", "日本語", "😀", "<s>", "</s>", "<|endoftext|>", "<0x41>", "don't", "1234", ".", "\t", "ß" * 9, "aaaa", " ", "\x00"]
    rows = [(i, "".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(1, 30)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " "), (203, "   lead and trail  "), (204, "▁mark"), (205, "ﬁ ligature Å"), (206, "a\r\nb")]
    rows += [(300, "same text here")] * 5 + [(None, "no id"), (None, None), (400, "x" * 30_000), (401, "word " * 20_000), (402, "<unk>")]
    table = spark.createDataFrame([(i, t, 1, [2], 3) for i, t in rows], "doc_id long, text string, row int, pairs array<int>, times int").repartition(5)
    got = token_alignment.alignment(table, *PATHS, P.PATTERN, hot_share=hot_share).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_alignment(rows), key=str)


def test_alignment_with_a_small_memo(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "MEMO_WINDOWS", 3)
    monkeypatch.setattr(token_alignment, "MEMO_TOKENS", 4)
    small = token_alignment.Aligner(*PATHS, P.PATTERN)
    texts = ["some words recur, some words don't", "unbelievable extraordinary words", "aaaa bbbb " * 5]
    want = brute_alignment(list(enumerate(texts)))
    assert [f[:5] for t in texts for f in small.aligned([t])] == [(w[1], w[2], w[3], w[4], w[7]) for w in want]


def test_alignment_of_no_documents(spark):
    assert token_alignment.alignment(spark.createDataFrame([], "doc_id long, text string"), *PATHS, P.PATTERN).collect() == []
