"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op4_quality_rules"] = rf"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS words FROM documents
), m AS (
  SELECT doc_id, source, words,
    len(words) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) AS n_lines,
    len(list_distinct(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_distinct
  FROM base
), windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM m, LATERAL (SELECT unnest(generate_series(1, n_words - 2)) AS i)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + s) AS n FROM twice, (VALUES (0), (1), (2)) AS x(s) GROUP BY doc_id
), r AS (
  SELECT m.doc_id, source, n_words, word_chars, n_symbols, n_lines, n_lines - n_distinct AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM m LEFT JOIN covered USING (doc_id)
), f AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repetitive,
    100 * n_symbols > 20 * word_chars AS symbols, 100 * n_dup_lines > 80 * n_lines AS dup_lines,
    word_chars < 2 * n_words OR word_chars > 30 * n_words AS word_length
  FROM r
), rates AS (
  SELECT source, count(*) AS n, rule, sum(failed::INT) AS failed, sum(failed::INT) / count(*) AS rate
  FROM (UNPIVOT f ON short, repetitive, symbols, dup_lines, word_length INTO NAME rule VALUE failed)
  GROUP BY source, rule
), prior AS (
  SELECT rule, avg(rate) AS m, CASE WHEN var_pop(rate) > 0
    THEN least(greatest(avg(rate) * (1 - avg(rate)) / var_pop(rate) - 1, 1), 1e6) ELSE 1e6 END AS s
  FROM rates GROUP BY rule
), bad AS (
  SELECT DISTINCT source FROM rates JOIN prior USING (rule) WHERE (failed + m * s) / (n + s) > 0.6
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
  NOT (short OR repetitive) AND source NOT IN (SELECT source FROM bad) AS kept
FROM f
"""

ORACLES["op9_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (key) GROUP BY doc_id
"""

ORACLES["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), component AS (
  SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
), counts AS (
  SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counts USING (vec_id)
"""

# The given conversations hold no control string, so that only the added one has escapes (of "</s>", "[INST] ", " [/INST]").
ORACLES["op3_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), rendered AS (
  SELECT *, CASE
    WHEN conv_id = -1 AND role = 'user' THEN replace(replace(replace(text, '</s>', '\</s>'), '[INST] ', '\[INST] '), ' [/INST]', '\ [/INST]')
    WHEN conv_id = -1 THEN replace(replace(replace(text, '</s>', '\</s>'), '[INST] ', '\[INST] '), ' [/INST]', '\ [/INST]')
    ELSE text END AS body FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(body) + CASE role WHEN 'user' THEN length('<s>[INST] ' || ' [/INST]') WHEN 'assistant' THEN length('<s>[REPLY] ' || '</s>')
    ELSE length('<s>[ROLE ' || role || '] ' || ' [/ROLE]') END)::BIGINT AS formatted_chars
FROM rendered GROUP BY conv_id
"""

ORACLES["op10_substring_dedup"] = r"""
WITH base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS w
  FROM base, LATERAL (SELECT unnest(generate_series(1, len(words) - 49)) AS i)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY w) < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + s AS i FROM later, (SELECT unnest(generate_series(0, 49)) AS s)
), words AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM base
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS t, count(gone.i) AS n_removed
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM base LEFT JOIN kept USING (doc_id)
"""


def _rounds(k: int, rounds: int, dims: int) -> str:
    """Integer k-means, one group of steps per round, over vectors spread to one row per component."""

    def assigned(r: int) -> str:
        return f"""
d{r} AS MATERIALIZED (
  SELECT rid, cluster, sum((l.x - c.x) * (l.x - c.x))::BIGINT AS distance FROM spread l JOIN c{r} c USING (dim) GROUP BY rid, cluster
), a{r} AS MATERIALIZED (
  SELECT rid, cluster, distance FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) = 1
)"""

    def moved(r: int) -> str:
        return f"""
s{r} AS MATERIALIZED (
  SELECT cluster, dim, sum(x)::BIGINT AS s, count(*) AS n FROM spread JOIN a{r} USING (rid) GROUP BY cluster, dim
), c{r + 1} AS MATERIALIZED (
  SELECT cluster, dim, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{r} LEFT JOIN s{r} USING (cluster, dim)
)"""

    steps = ",".join(f"{assigned(r)},{moved(r)}" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), spread AS MATERIALIZED (
  SELECT rid, unnest(q) AS x, generate_subscripts(q, 1) AS dim FROM kept
), first AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS cluster FROM kept
), c0 AS MATERIALIZED (
  SELECT cluster, dim, x FROM spread JOIN first USING (rid) WHERE cluster < {k}
),{steps},{assigned(rounds)}, digests AS (
  SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN digests USING (cluster)
"""


ORACLES["op11_centroid_clustering"] = _rounds(k=8, rounds=10, dims=64)


def _page_blocks(html: str, tags: str) -> str:
    """Trimmed texts between the given tags, other markup taken out and character references decoded, empty ones left out."""
    decoded = "regexp_replace(b, '<br>', ' ', 'g')"
    decoded = f"regexp_replace({decoded}, '<[^>]*(>|$)', '', 'g')"
    for name, char in {"quot": '"', "lt": "<", "gt": ">", "copy": "©", "middot": "·", "amp": "&"}.items():
        decoded = f"regexp_replace({decoded}, '&{name};?', '{char}', 'g')"
    trimmed = f"trim(regexp_replace({decoded}, '\\s+', ' ', 'g'))"
    return f"list_filter(list_transform(string_split_regex({html}, '</?(?:{tags})(?: [^>]*)?>'), lambda b: {trimmed}), lambda b: b <> '')"


# The given pages mark their articles and hold few kinds of markup; hosts are small enough for one suffix array each.
ORACLES["op12_html_extraction"] = rf"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id, url, coalesce(html, '') AS html,
    lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '')) AS host
  FROM pages
), parts AS (
  SELECT rid, page_id, url, host, regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1) AS article,
    regexp_replace(regexp_replace(html, '(?s)<article>.*?(</article>|$)', '<p>'), '(?s)<head>.*?</head>|<!--.*?-->|<!DOCTYPE[^>]*>', '', 'g') AS rest
  FROM p
), blocks AS (
  SELECT rid, page_id, url, host, {_page_blocks("article", "p|h1|div")} AS main, {_page_blocks("rest", "p|html|body|nav|ul|li|div|footer")} AS other
  FROM parts
), streams AS (
  SELECT row_number() OVER () AS sid, host, other, string_split(array_to_string(other, ' '), ' ') AS words, count(*) OVER (PARTITION BY host) AS n_streams
  FROM (SELECT DISTINCT host, other FROM blocks)
), windows AS (
  SELECT sid, host, n_streams, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM streams, LATERAL (SELECT unnest(generate_series(1, len(words) - 4)) AS i)
), common AS (
  SELECT sid, i FROM (SELECT sid, i, n_streams, count(DISTINCT sid) OVER (PARTITION BY host, w) AS n FROM windows)
  WHERE n >= greatest(2, ceil(0.2 * n_streams))
), covered AS (
  SELECT sid, count(DISTINCT i + s) AS n FROM common, (SELECT unnest(generate_series(0, 4)) AS s) GROUP BY sid
)
SELECT page_id, url, array_to_string(main, chr(10)) AS text, length(array_to_string(main, chr(10))) AS n_chars, coalesce(n, 0) AS n_repeated
FROM blocks JOIN streams ON blocks.host = streams.host AND blocks.other = streams.other LEFT JOIN covered USING (sid)
"""
