"""Main text of web pages: what a page marks as its article, or all its text, without what the pages of its host repeat.

A page is read once, in page order, into blocks of text. Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms and reader comments (by element, class, id or role) are never main text; scripts, styles, comments and
markup are no text. The main text of a page that marks its article (or, without one, its main part) comes from the
blocks in it, that of other pages from all blocks.

All words go through suffix arrays, in two streams per page: its marked blocks, and its other blocks. Equal streams of a
host count as one page. Runs of `min_words` words found on `share` of the distinct pages of the host are boilerplate:
on at least two pages outside marked blocks, and on at least `marked_pages` inside them, since few pages that share a
passage of their articles are copies and no boilerplate. Runs that are boilerplate outside marked blocks are taken out of
the other blocks and counted, and taken out of marked blocks, as are those that are boilerplate inside marked blocks.

Hosts of more than `shard_bytes` of html are dealt over shards, each distinct stream to one. A suffix array of each
shard (suffixes sorted by prefix doubling up to `min_words` words, so that equal neighbours share so many) gives its
runs with the pages that hold them. Numbers are summed over the shards of a host, so a run is boilerplate or not by the
whole host and no result depends on the dealing. Of marked blocks a shard names only the runs that `share` of its pages
hold: a run that no shard names is on less than `share` of all pages, and those whose highest possible number, by the
shards that do not name them, is high enough are then counted in every shard. Common runs go back to the shards of their host, of
which there are at most 1 / `share` times the runs of a mean page. A task holds one shard (or a few pages, if these
are longer) and its host's common runs. Pages move once, compressed; the steps over marked blocks share that one exchange.

Defined cases: null or empty html gives an empty text. Pages with a null url, or one without a host, form one host.
Repeated rows and ids are pages of their own; null ids are kept. Unfinished markup at the end of a page is no text, an
unfinished character reference stays as it is. An empty table gives no rows. Other columns are ignored, so their names
may clash.
"""

from __future__ import annotations

import re
from hashlib import sha256
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, staged

# Elements and names that mark a page's parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg math".split())
CHROME = frozenset("head nav aside footer form menu dialog button select object audio video canvas".split())
CLOSED_BY_BLOCK = frozenset(["p"])
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table select".split())
#: Parts that stay outside the article even if they hold articles of their own.
APART = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted comment comments disqus replies respond related "
    "recommended recommendations".split()
)
#: Parts of the layout around the article.
AROUND = frozenset(
    "banner breadcrumb breadcrumbs consent cookie cookies footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup share sharing sidebar signup social subscribe toolbar widget "
    "complementary contentinfo search alert dialog".split()
)
NOT_NAMES = frozenset("no not has with without is show hide".split())

MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|)[^>=]*+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def named_parts(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id and role name a part apart from the article, one around it, or the article itself."""
    apart = around = article = False
    for kind, *values in NAMES.findall(attributes):
        for name in "".join(values).lower().split():
            if kind.lower() == "itemprop":
                article = article or name == "articlebody"
                continue
            parts = re.split(r"[^a-z0-9]+", name)
            if parts[0] in NOT_NAMES:
                continue
            ends = (parts[0], parts[-1])
            apart = apart or any(p in APART for p in ends)
            around = around or any(p in AROUND for p in ends)
    return apart, around, article


def blocks_of(html: str) -> list[tuple[int, bool, str]]:
    """(level, whether it is boilerplate by its place, text) of each block: level 2 inside an article, 1 inside main."""
    out: list[tuple[int, bool, str]] = []
    words: list[str] = []
    level, chrome, apart, inline_chrome = 0, False, False, False
    # Of each open element: its name and what held before it.
    stack: list[tuple[str, int, bool, bool, bool]] = []
    names: dict[str, int] = {}

    def flush() -> None:
        if words:
            if tokens := "".join(words).split():
                out.append((level, chrome, " ".join(tokens)))
            words.clear()

    def close(name: str, upto: frozenset | tuple = ()) -> None:
        """Close the innermost open `name` and all inside it, unless one of `upto` is open inside it."""
        nonlocal level, chrome, apart, inline_chrome
        if not names.get(name):
            return
        at = len(stack) - 1
        while stack[at][0] != name:
            if stack[at][0] in upto:
                return
            at -= 1
        for open_name, *_ in stack[at:]:
            names[open_name] -= 1
        _, level, chrome, apart, inline_chrome = stack[at]
        del stack[at:]

    at, size = 0, len(html)
    while at < size:
        found = MARKUP.search(html, at)
        start = found.start() if found else size
        if start > at and not inline_chrome:
            text = html[at:start]
            words.append(unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        if found[2] is None:  # comment, doctype
            continue
        name = found[2].lower()
        if name in INLINE:
            if name == "br":
                words.append(" ")
            if found[1]:
                close(name, LISTS)
                continue
            if name in VOID:
                continue
            stack.append((name, level, chrome, apart, inline_chrome))
            names[name] = names.get(name, 0) + 1
            if "=" in found[3] and any(named_parts(found[3])[:2]):
                inline_chrome = True
            continue
        flush()
        if found[1]:
            close(name)
            continue
        if name in RAW:
            if not found[3].endswith("/") or name not in ("svg", "math"):
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = end.start() if end else size
                end = MARKUP.match(html, at)
                at = end.end() if end else size
            continue
        if name == "body":
            close("head")
        close("p", ("button",))
        for kind in OWN_KIND.get(name, ()):
            close(kind, LISTS)
        if name in VOID:
            continue
        stack.append((name, level, chrome, apart, inline_chrome))
        names[name] = names.get(name, 0) + 1
        is_apart, is_around, is_article = named_parts(found[3]) if "=" in found[3] and name not in ("html", "body", "main") else (False, False, False)
        if name == "article" or name == "main" or is_article:
            if is_apart:
                chrome = apart = True
            elif not apart:
                level, chrome = max(level, 1 if name == "main" else 2), False
        elif is_apart or name in CHROME:
            chrome = apart = True
        elif is_around and not level or name == "header" and not level:
            chrome = True
        elif is_around and "header" not in found[3]:
            chrome = True
    flush()
    return out


def read_page(html: str) -> tuple[str | None, list[str], list[bool]]:
    """The marked main text (None: the page marks none), and the other blocks with whether they are boilerplate by place."""
    blocks = blocks_of(html)
    marked = max((level for level, chrome, _ in blocks if not chrome), default=0)
    if marked:
        main = "\n".join([text for level, chrome, text in blocks if level == marked and not chrome])
        blocks = [b for b in blocks if b[1] or b[0] < marked]
    else:
        main = None
    return main, [text for _, _, text in blocks], [chrome for _, chrome, _ in blocks]


def equal_runs(tokens: np.ndarray, pages: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts of all runs of `length` tokens within a page, equal ones side by side; the group of each; the pages of each group.

    tokens: numbers of the words of all pages, one after another; pages: the page of each, ascending. Suffixes are ranked
    by their first 1, 2, 4, ... and at last `length` tokens; equal ranks are neighbours of the suffix array that share so many.
    """
    n, none = len(tokens), np.zeros(0, np.int64)
    if n < length:
        return none, none, none
    rank, known = tokens.astype(np.int64), 1
    while known < length:
        step = min(known, length - known)
        # Past the end of the streams nothing is equal to anything; the pages are looked at below.
        after = np.concatenate([rank[step:], np.full(step, -1, np.int64)])
        _, rank = np.unique(rank * (int(rank.max()) + 2) + after + 1, return_inverse=True)
        known += step
    starts = np.nonzero(pages[: n - length + 1] == pages[length - 1 :])[0]  # runs within one page
    if not len(starts):
        return none, none, none
    order = starts[np.lexsort((pages[starts], rank[starts]))]  # the suffix array, pages ascending among equals
    first = np.append(True, rank[order][1:] != rank[order][:-1])
    new_page = first | np.append(True, pages[order][1:] != pages[order][:-1])
    group = np.cumsum(first) - 1
    return order, group, np.bincount(group, weights=new_page).astype(np.int64)


def repeated(tokens: np.ndarray, pages: np.ndarray, length: int, least: int) -> np.ndarray:
    """Which tokens lie in a run of `length` tokens that occurs on at least `least` pages."""
    n = len(tokens)
    order, group, n_pages = equal_runs(tokens, pages, length)
    common = n_pages[group] >= least
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, order[common], 1)
    np.add.at(edges, order[common] + length, -1)
    return np.cumsum(edges[:n]) > 0


def runs_of(streams: list[list[str]], length: int, least: int = 1) -> tuple[list[str], list[int]]:
    """The distinct runs of `length` words on `least` or more of distinct pages (given as blocks), and on how many each is."""
    numbers: dict[str, int] = {}
    words = [[w for block in blocks for w in block.split(" ")] for blocks in streams]
    tokens = np.array([numbers.setdefault(w, len(numbers)) for page in words for w in page], np.int64)
    order, group, n_pages = equal_runs(tokens, np.repeat(np.arange(len(words)), [len(page) for page in words]), length)
    found = np.nonzero(n_pages >= least)[0]
    if not len(found):
        return [], []
    flat = [w for page in words for w in page]
    at = order[np.nonzero(np.diff(group, prepend=-1))[0][found]].tolist()
    return [" ".join(flat[i : i + length]) for i in at], n_pages[found].tolist()


def unique_words(blocks: list[str], common: set[str], length: int) -> list[bool]:
    """Of a page's words, block after block, whether each is in none of the `common` runs."""
    words = [w for block in blocks for w in block.split(" ")]
    kept = [True] * len(words)
    for i in range(len(words) - length + 1 if common else 0):
        if " ".join(words[i : i + length]) in common:
            kept[i : i + length] = [False] * length
    return kept


def kept_text(blocks: list[str], chrome: list[bool], unique: list[bool]) -> str:
    """The unique words of the blocks that are not boilerplate by place, one line per block that has any."""
    lines, at = [], 0
    for block, dropped in zip(blocks, chrome):
        words = block.split(" ")
        if not dropped and (mine := [w for w, keep in zip(words, unique[at : at + len(words)]) if keep]):
            lines.append(" ".join(mine))
        at += len(words)
    return "\n".join(lines)


#: A shard of long pages holds so many in the mean: in shards of very few, any run is on a large share of the pages.
SHARD_PAGES = 16
ZSTD = pa.Codec("zstd", compression_level=3)


def packed(main: str | None, blocks: list[str], chrome: list[bool]) -> bytes:
    """What `read_page` gives as one value: a letter and the text of each block, which holds no line break, compressed."""
    marked = [] if main is None else [f"m{line}" for line in main.split("\n")]
    text = "\n".join(marked + [("c" if c else "o") + b for b, c in zip(blocks, chrome)]).encode("utf-8", "surrogatepass")
    return len(text).to_bytes(8, "little") + ZSTD.compress(text, asbytes=True)


def unpacked(page: bytes) -> tuple[list[str], list[str], list[bool]]:
    """The marked blocks, the other blocks, and whether these are boilerplate by place."""
    text = ZSTD.decompress(page[8:], int.from_bytes(page[:8], "little"), asbytes=True).decode("utf-8", "surrogatepass")
    lines = text.split("\n") if text else []
    others = [x for x in lines if x[0] != "m"]
    return [x[1:] for x in lines if x[0] == "m"], [x[1:] for x in others], [x[0] == "c" for x in others]


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def shards(pages: DataFrame, shard_bytes: int) -> DataFrame:
    """host, n_shards of the hosts that hold more html than a shard: fewer than all bytes / shard_bytes."""
    size = F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")).alias("bytes")
    sizes = pages.groupBy("host").agg(size, F.count(F.lit(1)).alias("n")).where(F.col("bytes") > shard_bytes)
    n_shards = F.ceil(F.least(F.col("bytes") / shard_bytes, F.col("n") / SHARD_PAGES))
    return staged(sizes.select("host", n_shards.cast("int").alias("n_shards")))


def common_runs(read: DataFrame, large: DataFrame, min_words: int, share: float) -> DataFrame:
    """host, run: the runs that `share` of a host's distinct streams, and two at least, hold. Staged."""

    def of_shard(table: pa.Table) -> pa.Table:
        n_streams = table.num_rows
        # Of a whole host the others are not common.
        least = max(2, int(np.ceil(share * n_streams))) if table.column("n_shards")[0].as_py() == 1 else 1
        runs, n_pages = runs_of(table.column("blocks").to_pylist(), min_words, least)
        host = [table.column("host")[0].as_py()] * (len(runs) + 1)
        # A row without a run counts the streams.
        return pa.table([pa.array(host, pa.string()), pa.array([*runs, None], pa.string()), pa.array([*n_pages, n_streams], pa.int64())], names=["host", "run", "n"])

    streams = read.select("host", "digest", "blocks").dropDuplicates(["host", "digest"]).join(large, "host", "left")
    streams = streams.select("host", "blocks", F.coalesce("n_shards", F.lit(1)).alias("n_shards"), "digest")
    dealt = streams.withColumn("shard", F.pmod(F.xxhash64("digest"), "n_shards")).drop("digest")
    counted = dealt.groupBy("host", "shard").applyInArrow(of_shard, "host string, run string, n long").groupBy("host", "run").agg(F.sum("n").alias("n"))
    counted = staged(counted.where("run is null or n >= 2"))
    streams_of = counted.where("run is null").select("host", F.greatest(F.lit(2), F.ceil(F.lit(share) * F.col("n"))).alias("least"))
    return staged(counted.where("run is not null").join(streams_of, "host").where("n >= least").select("host", "run"))


def spread(runs: DataFrame, large: DataFrame) -> DataFrame:
    """`runs` with every shard of their host."""
    n_shards = F.coalesce("n_shards", F.lit(1)).cast("long")
    return runs.join(large, "host", "left").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), n_shards - 1))).drop("n_shards")


def common_marked_runs(dealt: DataFrame, large: DataFrame, min_words: int, share: float, marked_pages: int) -> DataFrame:
    """host, run: the runs that `share` of a host's distinct marked texts, and `marked_pages` at least, hold."""

    def distinct(table: pa.Table) -> list[list[str]]:
        """The marked blocks of the shard's distinct marked texts."""
        pages = table.column("page").filter(table.column("counted")).to_pylist()
        return [list(t) for t in dict.fromkeys(tuple(unpacked(p)[0]) for p in pages)]

    def candidates(table: pa.Table) -> pa.Table:
        """The runs that `least` of the shard's texts hold, and how many more than one less than that hold it."""
        texts = distinct(table)
        least = max(1, int(np.ceil(share * len(texts) - 1e-9)))
        if table.column("n_shards")[0].as_py() == 1:  # the others of a whole host are not common
            least = max(marked_pages, least)
        runs, n = runs_of(texts, min_words, least)
        # A row without a run gives how many texts of the shard may hold a run that is not among them, and all texts.
        columns = [[table.column("host")[0].as_py()] * (len(runs) + 1), [*runs, None], [*(k - least + 1 for k in n), least - 1], [*[0] * len(runs), len(texts)]]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["host", "run", "n", "n_texts"])

    def exact(table: pa.Table, runs: pa.Table) -> pa.Table:
        n = dict.fromkeys(runs.column("run").to_pylist(), 0)
        for blocks in distinct(table) if n else []:
            words = " ".join(blocks).split(" ")
            for run in n.keys() & {" ".join(words[i : i + min_words]) for i in range(len(words) - min_words + 1)}:
                n[run] += 1
        return runs.select(["host", "run", "least"]).append_column("n", pa.array(n.values(), pa.int64()))

    shards_of, host = dealt.groupBy("host", "shard"), Window.partitionBy("host")
    found = shards_of.applyInArrow(candidates, "host string, run string, n long, n_texts long")
    found = found.groupBy("host", "run").agg(F.sum("n").alias("n"), F.sum("n_texts").alias("n_texts"))
    others = F.max(F.when(F.col("run").isNull(), F.col("n"))).over(host)
    least = F.greatest(F.lit(marked_pages).cast("long"), F.ceil(F.lit(share) * F.max("n_texts").over(host) - F.lit(1e-9)))
    # With all texts that may hold it in the shards where it is none of the candidates.
    possible = found.select("host", "run", (F.col("n") + others).alias("most"), least.alias("least")).where("run is not null and most >= least")
    counted = shards_of.cogroup(spread(possible.drop("most"), large).groupBy("host", "shard")).applyInArrow(exact, "host string, run string, least long, n long")
    return counted.groupBy("host", "run").agg(F.sum("n").alias("n"), F.max("least").alias("least")).where("n >= least").select("host", "run")


def extracted(
    pages: DataFrame, min_words: int = 5, share: float = 0.2, shard_bytes: int = 1 << 20, broadcast_rows: int = 200_000, marked_pages: int = 5
) -> DataFrame:
    """page_id, url, text of each row of `pages` (page_id, url, html).

    n_repeated: how many words outside the marked main text lie in runs that the host's pages repeat.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"), F.xxhash64(F.monotonically_increasing_id()).alias("spot"),
    )
    large = shards(rows.select("host", "html"), shard_bytes)

    def streams(batch: pa.RecordBatch) -> pa.RecordBatch:
        others = [read_page(h or "")[1] for h in batch.column(1).to_pylist()]
        # Blocks hold no line break.
        digests = [sha256("\n".join(b).encode("utf-8", "surrogatepass")).digest() for b in others]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(others, pa.list_(pa.string()))], names=["host", "digest", "blocks"])

    def reader():
        seen: set[tuple[str, bytes]] = set()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            """The first page of a task with some marked text goes to the shard of that text and is counted there, others go anywhere."""
            out, counted, spots = [], [], batch.column(4).to_pylist()
            for i, (html, host) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                read = read_page(html or "")
                out.append(packed(*read))
                digest = None if read[0] is None else sha256(read[0].encode("utf-8", "surrogatepass")).digest()[:16]
                counted.append(digest is not None and (host, digest) not in seen)
                if counted[-1]:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add((host, digest))
                    spots[i] = int.from_bytes(digest[:8], "little", signed=True)
            return pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 1, 3)), pa.array(out, pa.binary()), pa.array(counted, pa.bool_()), pa.array(spots, pa.int64())],
                names=["page_id", "url", "host", "page", "counted", "spot"],
            )

        return one

    # Hosts above the limit are few, unless the corpus is very large: then a join finds them, whose hot keys Spark splits.
    large = F.broadcast(large) if large.count() <= broadcast_rows else large
    others = map_batches(rows.select("host", "html"), lambda: streams, "host string, digest binary, blocks array<string>", rows=200)
    common = common_runs(others, large, min_words, share)

    read = map_batches(rows, reader, "page_id long, url string, host string, page binary, counted boolean, spot long", rows=200)
    n_shards = F.coalesce("n_shards", F.lit(1))
    dealt = read.join(large, "host", "left").select("page_id", "url", "host", "page", "counted", n_shards.alias("n_shards"), F.pmod("spot", n_shards).alias("shard"))
    marked = common_marked_runs(dealt, large, min_words, share, marked_pages)
    both = common.withColumn("marked", F.lit(False)).unionByName(marked.withColumn("marked", F.lit(True)))

    def of_shard(table: pa.Table, runs: pa.Table) -> pa.Table:
        in_marked = set(runs.column("run").to_pylist())
        elsewhere = set(runs.column("run").filter(pc.invert(runs.column("marked"))).to_pylist())
        memo: dict[tuple[str, ...], int] = {}
        texts, n_common = [], []
        for main, blocks, chrome in map(unpacked, table.column("page").to_pylist()):
            key, unique = tuple(blocks), None
            if not main or key not in memo:
                unique = unique_words(blocks, elsewhere, min_words)
                memo[key] = len(unique) - sum(unique)
            n_common.append(memo[key])
            if main:
                texts.append(kept_text(main, [False] * len(main), unique_words(main, in_marked, min_words)) if in_marked else "\n".join(main))
            else:
                texts.append(kept_text(blocks, chrome, unique))
        return pa.table(
            [table.column("page_id"), table.column("url"), pa.array(texts, pa.string()), pa.array(n_common, pa.int64())],
            names=["page_id", "url", "text", "n_repeated"],
        )

    return (
        dealt.groupBy("host", "shard").cogroup(spread(both, large).groupBy("host", "shard"))
        .applyInArrow(of_shard, "page_id long, url string, text string, n_repeated long")
    )
