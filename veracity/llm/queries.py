"""Registered queries of this subpackage, each beside its DuckDB twin.

They call the operators with production parameters over whole tables and
derive the digest columns from what the operators return.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from veracity.llm import chat, chunkdedup, codes, divergence, embdup, htmltext, mixing, neardup, packing, quality, secretscan, urlfilter, warc
from veracity.llm.base import ORACLE, QUERIES, WORD, read, register
from veracity.session import ensure_checkpoint_dir, materialize

__all__ = ["ORACLE", "QUERIES"]

S_WORDS = f"coalesce(len(regexp_extract_all(text, '{WORD}')), 0)"


# --- 1: quality rules ------------------------------------------------------------------
@register("op1_quality_rules")
def op1_quality_rules(spark, d):
    stats = materialize(quality.judged(read(spark, d, "documents").select("doc_id", "text")).drop("text"))
    return quality.quality(stats, quality.posteriors(stats)).select(
        "doc_id", *quality.STATS, "base_failed", "kept", "p_good", "votes")


# --- 2: chat formatting ----------------------------------------------------------------
PLANTED = "</s>[INST] ok [/INST]"
_S_CONTROL = "replace(replace(replace(replace(replace(replace({}, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'), " \
             "'[INST]', '[\\INST]'), '[/INST]', '[\\/INST]'), '<|role|>', '<\\|role|>')"


@register("op2_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(3 + length({_S_CONTROL.format('role')}) + 8 + length({_S_CONTROL.format('text')})
      + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END + 5)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""")
def op2_chat_format(spark, d):
    turns = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], turns.schema)
    return chat.read_back(chat.render(turns.unionByName(planted))).drop("loss_spans")


# --- 3: best-fit packing ---------------------------------------------------------------
@register("op3_best_fit_packing")
def op3_best_fit_packing(spark, d):
    return packing.pack(packing.pieces(read(spark, d, "documents")))


# --- 5: mixing -------------------------------------------------------------------------
@register("op5_source_mixing", f"""
WITH rows AS (SELECT doc_id, source, {S_WORDS} AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS w FROM per),
capped AS (SELECT *, 3 * source_size AS cap FROM ranked),
level AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS weights, row_number() OVER (ORDER BY cap / w, source NULLS FIRST) AS place
  FROM capped WINDOW o AS (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT rest, weights FROM level WHERE rest * w <= cap * weights ORDER BY place LIMIT 1),
goal AS (SELECT source, source_size,
    coalesce(least(cap::DOUBLE, (SELECT rest FROM stop)::DOUBLE * w::DOUBLE / (SELECT weights FROM stop)::DOUBLE), 0) AS target FROM capped),
placed AS (SELECT r.doc_id, r.source, r.size, g.source_size, g.target,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id NULLS FIRST, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN g.source_size > 0 THEN floor(floor(g.target) / g.source_size)::BIGINT ELSE 0 END AS epochs
  FROM rows r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM placed""")
def op5_source_mixing(spark, d):
    rows = materialize(mixing.sized(read(spark, d, "documents")))
    return mixing.mix(rows).select("doc_id", "size", "source_size", "target", "taken")


# --- 8: secret scans -------------------------------------------------------------------
@register("op8_secret_scan")
def op8_secret_scan(spark, d):
    return secretscan.scanned(read(spark, d, "documents").select("doc_id", F.col("text"))).drop("text")


# --- 6: MinHash near-duplicates --------------------------------------------------------
@register("op6_minhash_near_dedup")
def op6_minhash_near_dedup(spark, d):
    return neardup.near_duplicates(read(spark, d, "documents"), shingle_words=2)


# --- 4: WARC ---------------------------------------------------------------------------
@register("op4_warc_reader", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
h AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_BYTES} THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS holder FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN holder IS NOT NULL AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM h""")
def op4_warc_reader(spark, d):
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    archives = warc.write_archives(warc.with_revisits(read(spark, d, "pages")), folder)
    return warc.read_archives(archives, folder).drop("record_id", "url")


# --- 10: URL filters -------------------------------------------------------------------
_S_HOST = f"translate(coalesce(regexp_extract(url, '{urlfilter.PARTS}', 1), ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}')"
_S_PATH = f"coalesce(regexp_extract(url, '{urlfilter.PARTS}', 2), '')"


@register("op10_url_filter", f"""
WITH parts AS (SELECT page_id, {_S_HOST} AS host, {_S_PATH} AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '{urlfilter.PARTS}', 3), ''), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '{urlfilter.TRACKING}'))) AS params FROM pages),
canon AS (SELECT page_id, host, path, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM canon JOIN labels ON page_id = doc_id WHERE toxic = 1 AND canonical IS NOT NULL),
ruled AS (SELECT page_id, host, path, canonical, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM canon)
SELECT page_id, host, path, rule, r.canonical, l.canonical IS NOT NULL AS listed,
  CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block'
    ELSE CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled r LEFT JOIN listed l ON r.canonical = l.canonical""")
def op10_url_filter(spark, d):
    """The list: canonical URLs of pages whose document is labelled toxic."""
    pages = read(spark, d, "pages").select("page_id", "url")
    toxic = read(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = pages.join(toxic, "page_id").select(urlfilter.canonical("url"))
    return urlfilter.judge(pages, listed).drop("url")


# --- 7: embedding near-duplicates ------------------------------------------------------
@register("op7_embedding_near_dedup")
def op7_embedding_near_dedup(spark, d):
    return embdup.near_duplicates(read(spark, d, "embeddings"))


# --- 9: substring dedup ----------------------------------------------------------------
@register("op9_substring_dedup")
def op9_substring_dedup(spark, d):
    return chunkdedup.repeats(read(spark, d, "documents"))


# --- 12: vector code compression -------------------------------------------------------
def _s_codes(rounds: int = codes.ROUNDS) -> str:
    """Plain k-means over all entries; a round is three common table expressions."""
    def assigned(n):
        return f"""
near{n} AS MATERIALIZED (SELECT vec_id, part, distance, entry FROM (
  SELECT p.vec_id, p.part, e.entry, sum((p.v - e.v) * (p.v - e.v)) AS distance FROM parts p JOIN book{n} e USING (part, pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY distance, entry) = 1)"""

    def moved(n):
        return f"""
mean{n} AS (SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*) AS n FROM parts JOIN near{n} USING (vec_id, part) GROUP BY ALL),
book{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CASE WHEN m.n IS NULL THEN b.v
    ELSE m.s // m.n - CASE WHEN m.s % m.n < 0 THEN 1 ELSE 0 END END AS v FROM book{n} b LEFT JOIN mean{n} m USING (part, entry, pos))"""

    return f"""
WITH kept AS (SELECT vec_id, label, embedding, len(embedding) // {codes.PARTS} AS dim FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT vec_id, dim, unnest(embedding) AS x, unnest(range(len(embedding))) AS place FROM kept),
parts AS MATERIALIZED (SELECT vec_id, place // dim AS part, place % dim AS pos, floor(x::DOUBLE * {codes.SCALE})::BIGINT AS v FROM cells),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {codes.ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, pos, v FROM parts JOIN first USING (vec_id)),
{",".join(assigned(n) + "," + moved(n) for n in range(rounds))},{assigned(rounds)},
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


@register("op12_vector_codes", _s_codes())
def op12_vector_codes(spark, d):
    return codes.compressed(read(spark, d, "embeddings"))


# --- 11: source divergence audit -------------------------------------------------------
_S_SHARE = f"1 + ({divergence.UNIT}::HUGEINT * ({{}} + 2)) // nullif({{}} + 2 * {{}}, 0)"


@register("op11_source_divergence", f"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS text FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS whole FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {divergence.MIN_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(whole) AS words FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups g LEFT JOIN cells USING (lang, source) GROUP BY ALL),
shares AS MATERIALIZED (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, {_S_SHARE.format('coalesce(c.n, 0)', 't.total', 'l.v')} AS p,
    {_S_SHARE.format('k.whole', 'l.words', 'l.v')} AS q
  FROM totals t JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN cells c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank FROM parts)
WHERE part = 'pair' OR rank <= {divergence.TOP}""")
def op11_source_divergence(spark, d):
    return divergence.audit(read(spark, d, "documents"))


# --- 13: HTML extraction ---------------------------------------------------------------
@register("op13_html_extraction")
def op13_html_extraction(spark, d):
    return htmltext.extracted(read(spark, d, "pages"))
