"""Registered queries: one Spark plan per operator key plus its DuckDB twin.

``QUERIES[key](spark, sf_dir) -> DataFrame`` runs over the whole driver
tables. ``ORACLE[key]`` is the same computation in DuckDB SQL over the views
``documents labels events pages customer ...``. Keys without an oracle are
value-checked by pytest instead (iterative solvers, exact KS p-values,
streams with side-effect sinks).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.functions import common as C
from veracity.functions import text as T
from veracity.operators import drift as D
from veracity.operators import evaluate as E
from veracity.operators import features as M
from veracity.operators import insight as I
from veracity.operators import models as ML
from veracity.operators import prepare as P
from veracity.plans import fixtures as X
from veracity.plans.fixtures import SQL, sql_hash, sql_hash32
from veracity.session import materialize

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# --- DuckDB spellings of the Python regex classes -------------------------------------
WS = r"[\s\x{0b}\p{Z}\x{1c}-\x{1f}\x{85}]"
NWS = r"[^\s\x{0b}\p{Z}\x{1c}-\x{1f}\x{85}]"
URL = r"(?:http|www)" + NWS + "+"
WORD = r"[\p{L}\p{N}_]"


def s_collapse(x):
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def s_strip(x):
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def s_headline(x):
    return s_collapse(f"regexp_replace(regexp_replace(lower({x}), '{URL}', '', 'g'), '[[:punct:]]', '', 'g')")


def s_normalise(x):
    return s_strip(f"regexp_replace(regexp_replace({x}, '{URL}', 'HTTPURL', 'g'), '@{WORD}+', '@USER', 'g')")


def s_strip_tweet(x):
    return s_collapse(f"regexp_replace(regexp_replace({x}, '{URL}', '', 'g'), '@{WORD}+', '', 'g')")


def s_ascii(x):
    inner = f"regexp_replace(lower({x}), '{URL}', '', 'g')"
    return s_collapse(f"regexp_replace({inner}, '[^a-z0-9\\s\\x{{0b}}\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]', '', 'g')")


def s_tokens(x):
    return f"list_filter(string_split_regex(lower({x}), '{WS}+'), lambda t: t <> '')"


def s_relevant(x, kws):
    ors = " OR ".join(f"contains(lower({x}), '{k}')" for k in kws)
    return f"coalesce(({ors}), false)"


# query parameters: keyword lists that actually occur in the generated prose
HIT_KEYWORDS = ["tion", "ein", "que", "iran", "vote"]
TOPIC_QUERY_TERMS = P.TOPIC_TERMS + ["the", "that", "with"]
COUNT_KEYWORDS = ["the", "tion", "of", "ment", "eau", "und", "que", "ing", "iran", "trump", "ou", "en", "biden"]
HIST_EDGES = [i / 10 for i in range(11)]


# ======================================================================================
# Scalar functions
# ======================================================================================
@register("clean_headline", f"SELECT doc_id, {s_headline('text')} AS clean_title FROM ({SQL['url_texts']})")
def q_clean_headline(spark, d):
    return X.url_texts(spark, d).select("doc_id", T.clean_headline("text").alias("clean_title"))


@register("clean_tweet", f"SELECT doc_id, {s_collapse('text')} AS clean_title FROM ({SQL['url_texts']})")
def q_clean_tweet(spark, d):
    return X.url_texts(spark, d).select("doc_id", T.clean_tweet("text").alias("clean_title"))


@register("normalise_tweet", f"SELECT doc_id, {s_normalise('text')} AS text FROM ({SQL['url_texts']})")
def q_normalise_tweet(spark, d):
    return X.url_texts(spark, d).select("doc_id", T.normalise_tweet("text").alias("text"))


@register("strip_tweet", f"SELECT doc_id, {s_strip_tweet('text')} AS text FROM ({SQL['url_texts']})")
def q_strip_tweet(spark, d):
    return X.url_texts(spark, d).select("doc_id", T.strip_tweet("text").alias("text"))


@register("clean_ascii", f"SELECT doc_id, {s_ascii('text')} AS cleaned FROM ({SQL['url_texts']})")
def q_clean_ascii(spark, d):
    return X.url_texts(spark, d).select("doc_id", T.clean_ascii("text").alias("cleaned"))


@register("event_name", """
SELECT doc_id, split_part(split_part(source || '-' || lang || '-all-rnr-threads', '-all-rnr', 1), '-', 1) AS event
FROM documents""")
def q_event_name(spark, d):
    dirs = X.documents(spark, d).select(
        "doc_id", F.concat_ws("-", "source", "lang", F.lit("all-rnr-threads")).alias("dir"))
    return dirs.select("doc_id", T.event_name("dir").alias("event"))


@register("json_field", """
SELECT event_id,
       CASE WHEN NOT json_valid(props) THEN NULL
            WHEN json_extract(props, '$.k') IS NULL THEN 0
            ELSE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN NOT json_valid(props) THEN NULL
            WHEN json_extract(props, '$.z') IS NULL THEN 0
            ELSE TRY_CAST(json_extract_string(props, '$.z') AS INTEGER) END AS z
FROM events""")
def q_json_field(spark, d):
    ev = X.table(spark, d, "events")
    return ev.select("event_id", C.json_int("props", "k").alias("k"), C.json_int("props", "z").alias("z"))


@register("format_time", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped_at,
       'news_' || strftime(ts, '%Y%m%d_%H%M') || '.csv' AS snapshot_file
FROM events""")
def q_format_time(spark, d):
    ev = X.table(spark, d, "events")
    return ev.select("event_id", C.row_time("ts").alias("scraped_at"), C.snapshot_file_name("ts").alias("snapshot_file"))


@register("logit_to_score", """
SELECT event_id, round(1.0 / (1.0 + exp(-((value - 25.0) / 10.0))), 6) AS score FROM events""")
def q_logit_to_score(spark, d):
    ev = X.table(spark, d, "events")
    return ev.select("event_id", F.round(C.sigmoid((F.col("value") - 25.0) / 10.0), 6).alias("score"))


# ======================================================================================
# Projections and predicates
# ======================================================================================
@register("preprocess_headline", f"SELECT doc_id, label, {s_headline('text')} AS clean_title FROM ({SQL['labelled']})")
def q_preprocess_headline(spark, d):
    return P.preprocess(X.labelled(spark, d), "text", "headline", keep=("doc_id", "label"))


@register("preprocess_tweet", f"SELECT doc_id, label, {s_collapse('text')} AS clean_title FROM ({SQL['labelled']})")
def q_preprocess_tweet(spark, d):
    return P.preprocess(X.labelled(spark, d), "text", "tweet", keep=("doc_id", "label"))


@register("drop_incomplete", f"""
SELECT doc_id, label, clean_title FROM (
  SELECT doc_id, TRY_CAST(label AS INTEGER) AS label, {s_ascii('text')} AS clean_title FROM ({SQL['labelled']}))
WHERE clean_title IS NOT NULL AND clean_title <> '' AND label IS NOT NULL""")
def q_drop_incomplete(spark, d):
    lab = P.once(X.labelled(spark, d).select("doc_id", "label", "text"), "clean_title", T.clean_ascii("text")).drop("text")
    return P.drop_incomplete(lab, "clean_title", "label")


@register("min_length_filter", f"""
SELECT doc_id, text FROM (SELECT doc_id, {s_strip_tweet('text')} AS text FROM ({SQL['url_texts']}))
WHERE length(text) >= 20""")
def q_min_length_filter(spark, d):
    return P.min_length_filter(X.url_texts(spark, d), "text").select("doc_id", "text")


_topic_alt = "|".join(t for t in TOPIC_QUERY_TERMS)


@register("topic_filter", f"""
SELECT doc_id FROM documents
WHERE lang = 'en' AND regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({_topic_alt})([^\\p{{L}}\\p{{N}}_]|$)')""")
def q_topic_filter(spark, d):
    return P.topic_filter(X.documents(spark, d), "text", TOPIC_QUERY_TERMS, lang_col="lang").select("doc_id")


#: A query as a user writes it; flags are columns of the table.
TOPIC_QUERY = '(Iran OR "white house" OR the OR ("des" -lang:en) OR NOT is:long) -is:odd -"of the" (lang:en OR lang:fr)'


@register("topic_query", """
WITH t AS (SELECT *, n_chars > 2000 AS long, doc_id % 2 = 1 AS odd, '[^\\p{L}\\p{N}_]' AS gap FROM documents)
SELECT doc_id FROM t
WHERE (coalesce(regexp_matches(text, '(?i)(^|' || gap || ')(Iran|white house|the)(' || gap || '|$)'), false)
       OR (coalesce(regexp_matches(text, '(?i)(^|' || gap || ')des(' || gap || '|$)'), false) AND lang IS DISTINCT FROM 'en')
       OR NOT coalesce(long, false))
  AND NOT odd AND NOT coalesce(regexp_matches(text, '(?i)(^|' || gap || ')of the(' || gap || '|$)'), false) AND lang IN ('en', 'fr')""")
def q_topic_query(spark, d):
    """P6 from the query's text."""
    from veracity.functions.topic import topic_query
    docs = X.documents(spark, d).withColumns({"long": F.col("n_chars") > 2000, "odd": F.col("doc_id") % 2 == 1})
    return docs.filter(topic_query(TOPIC_QUERY, "text", "lang", {"long": "long", "odd": "odd"})).select("doc_id")


@register("relevancy_flag", f"SELECT doc_id, {s_relevant('text', HIT_KEYWORDS)} AS is_relevant FROM documents")
def q_relevancy_flag(spark, d):
    return P.relevancy_flag(X.documents(spark, d), "text", HIT_KEYWORDS).select("doc_id", "is_relevant")


_LABEL_RULE_SQL = """
CASE WHEN NOT (d.lang = 'en') THEN 1
     WHEN l.doc_id IS NULL THEN NULL
     WHEN (1 - l.quality) = 1 THEN 0
     WHEN l.quality * (1 - l.toxic) = 1 THEN 1
     ELSE NULL END"""


@register("label_rule", f"""
SELECT d.doc_id, ({_LABEL_RULE_SQL}) AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_label_rule(spark, d):
    docs = X.documents(spark, d)
    ann = X.table(spark, d, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("misinformation"),
        (F.col("quality") * (1 - F.col("toxic"))).alias("true"), F.lit(True).alias("has_ann"))
    j = docs.join(ann, "doc_id", "left")
    lab = P.thread_label(F.col("lang") == "en", F.col("misinformation"), F.col("true"),
                         F.coalesce(F.col("has_ann"), F.lit(False)))
    return j.select("doc_id", lab.alias("label"))


@register("thread_annotation_join", f"""
SELECT doc_id, source AS event, {s_normalise('text')} AS text, label FROM (
  SELECT d.doc_id, d.source, d.text, ({_LABEL_RULE_SQL}) AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
WHERE label IS NOT NULL AND {s_strip('text')} <> ''""")
def q_thread_annotation_join(spark, d):
    posts = X.documents(spark, d).select(
        "doc_id", F.col("source").alias("event"), "text", (F.col("lang") == "en").alias("is_rumour"))
    ann = X.table(spark, d, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("misinformation"), (F.col("quality") * (1 - F.col("toxic"))).alias("true"))
    return P.thread_annotation_join(posts, ann, ["doc_id"]).select("doc_id", "event", "text", "label")


@register("verdict", f"""
SELECT doc_id, score, CASE WHEN score > 0.5 THEN 'Real' ELSE 'Fake' END AS verdict,
       round(conf, 6) AS conf, round(conf * 100.0, 1) AS conf_pct
FROM (SELECT doc_id, score, CASE WHEN score > 0.5 THEN score ELSE 1.0 - score END AS conf FROM ({SQL['scored']}))""")
def q_verdict(spark, d):
    v = P.verdict(X.scored_labelled(spark, d).select("doc_id", "score"))
    return v.select("doc_id", "score", "verdict", F.round("conf", 6).alias("conf"),
                    C.confidence_pct("conf").alias("conf_pct"))


# ======================================================================================
# Lookups, merges, snapshots
# ======================================================================================
@register("author_join", """
SELECT e.event_id, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS scraped_at, '@' || coalesce(u.uname, 'unknown') AS source
FROM events e LEFT JOIN (SELECT c_custkey, max(c_name) AS uname FROM customer GROUP BY c_custkey) u
  ON e.user_id * 7 = u.c_custkey""")
def q_author_join(spark, d):
    # seven times the id, so that some authors have no customer
    ev = X.table(spark, d, "events").select("event_id", (F.col("user_id") * 7).alias("user_id"), C.row_time("ts").alias("scraped_at"))
    users = X.table(spark, d, "customer")
    return P.author_join(ev, users, "user_id", "c_custkey", "c_name", order_col="c_acctbal").select("event_id", "scraped_at", "source")


@register("merge_distinct", """
WITH sided AS (SELECT d.doc_id, d.text, d.doc_id NOT IN (SELECT doc_id FROM labels) AS side FROM documents d),
     placed AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY side, doc_id) AS place FROM sided)
SELECT doc_id, text FROM placed WHERE place = 1""")
def q_merge_distinct(spark, d):
    docs = X.documents(spark, d).select("doc_id", "text")
    lab = X.table(spark, d, "labels").select("doc_id")
    master = docs.join(lab, "doc_id", "left_semi")
    new = docs.join(lab, "doc_id", "left_anti")
    return P.merge_distinct(master, new, "text", order_cols=["doc_id"])


@register("merge_bucketed", ORACLE["merge_distinct"])
def q_merge_bucketed(spark, d):
    """U1 on a bucketed master: the new rows are merged twice, the second time without effect."""
    from uuid import uuid4

    from veracity.operators import master as B
    from veracity.streaming.monitor import work_dir
    docs = X.documents(spark, d).select("doc_id", "text")
    lab = X.table(spark, d, "labels").select("doc_id")
    name, path = f"master_{uuid4().hex}", work_dir(spark, "bucketed")
    B.create_master(docs.join(lab, "doc_id", "left_semi"), name, path, "text", ["doc_id"], buckets=16)
    for _ in range(2):
        B.merge_into_master(docs.join(lab, "doc_id", "left_anti"), name, path, "text", ["doc_id"])
    return B.master(spark, name)


@register("latest_snapshot", f"""
WITH s AS ({SQL['snapshots']}),
     f AS (SELECT file, max(ts) AS mtime FROM s GROUP BY file),
     latest AS (SELECT file FROM f ORDER BY mtime DESC, file DESC LIMIT 1)
SELECT event_id, file FROM s WHERE file IN (SELECT file FROM latest)""")
def q_latest_snapshot(spark, d):
    s = X.snapshots(spark, d)
    return P.latest_snapshot(s, "file", "ts").select("event_id", "file")


@register("serving_status", f"""
WITH s AS ({SQL['snapshots']}), latest AS (SELECT file FROM s ORDER BY ts DESC, file DESC LIMIT 1),
     served AS (SELECT *, {sql_hash('event_id', 'serve')} AS score FROM s WHERE file IN (SELECT file FROM latest))
SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS last_sync, 'Healthy' AS status, count(*) FILTER (WHERE score > 0.5) AS n_real,
       count(*) FILTER (WHERE NOT score > 0.5) AS n_fake FROM served""")
def q_serving_status(spark, d):
    served = P.latest_snapshot(X.snapshots(spark, d), "file", "ts").withColumn("score", C.unit_hash("event_id", "serve"))
    return P.serving_status(served, "ts", text_col="event_type")


@register("snapshot_scan", """
SELECT event_type AS text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped_at, 'u"' || user_id || '", ' || event_id AS source FROM events""")
def q_snapshot_scan(spark, d):
    """Every event through the CSV sink and the snapshot-folder source, quotes and commas included."""
    from veracity.sources import files
    from veracity.streaming.monitor import work_dir
    path = work_dir(spark, "snapshots")
    rows = X.table(spark, d, "events").select(
        F.col("event_type").alias("text"), C.row_time("ts").alias("scraped_at"),
        F.concat(F.lit('u"'), F.col("user_id").cast("string"), F.lit('", '), F.col("event_id").cast("string")).alias("source"))
    files.write_table(rows, path, fmt="csv")
    return files.read_snapshots(spark, path).select("text", "scraped_at", "source")


@register("csv_by_header", """
SELECT event_type AS text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped_at,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE 'u"' || user_id || '", ' || event_id END AS source, NULL::VARCHAR AS record, NULL::VARCHAR AS reason FROM events
UNION ALL SELECT NULL, NULL, NULL, o_orderkey || ',"' || o_orderpriority || ', ' || o_custkey || '"', 'fields' FROM orders""")
def q_csv_by_header(spark, d):
    """Events in files of three column orders, one with a column more, one with a column less; orders as records of too few fields."""
    from veracity.sources import files
    from veracity.streaming.monitor import work_dir
    path = work_dir(spark, "headers")
    ev = X.table(spark, d, "events")
    rows = ev.select("event_id", F.col("event_type").alias("text"), C.row_time("ts").alias("scraped_at"),
                     F.concat(F.lit('u"'), F.col("user_id").cast("string"), F.lit('", '), F.col("event_id").cast("string")).alias("source"))
    for n, names in enumerate((["text", "scraped_at", "source"], ["source", "event_id", "text", "scraped_at"], ["scraped_at", "text"])):
        files.write_table(rows.filter(F.col("event_id") % 3 == n).select(*names), f"{path}/{n}", fmt="csv")
    bad = X.table(spark, d, "orders").select(F.concat("o_orderkey", F.lit(',"'), "o_orderpriority", F.lit(", "), "o_custkey", F.lit('"')).alias("value"))
    # each file of the text sink gets a header of its own
    header = spark.createDataFrame([("source,text,scraped_at",)], "value string")
    header.coalesce(1).unionByName(bad.coalesce(1)).coalesce(1).write.text(f"{path}/bad")
    return files.read_csv_by_header(spark, path, glob="part-*").drop("file", "mtime")


@register("snapshot_counts", f"SELECT file, count(*) AS n_articles FROM ({SQL['snapshots']}) GROUP BY file")
def q_snapshot_counts(spark, d):
    return P.snapshot_counts(X.snapshots(spark, d), "file")


# ======================================================================================
# aggregates
# ======================================================================================
@register("class_counts", f"""
SELECT count(*) AS n_total, count(*) FILTER (WHERE label = 0) AS n_fake, count(*) FILTER (WHERE label = 1) AS n_real
FROM ({SQL['labelled']})""")
def q_class_counts(spark, d):
    return E.class_counts(X.labelled(spark, d))


@register("distinct_events", "SELECT DISTINCT source AS event FROM documents")
def q_distinct_events(spark, d):
    return E.distinct_values(X.documents(spark, d).select(F.col("source").alias("event")), "event")


@register("relevancy_rate", f"""
SELECT count(*) AS n_articles, round(avg(CASE WHEN {s_relevant('text', HIT_KEYWORDS)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4)
       AS relevancy_rate FROM documents""")
def q_relevancy_rate(spark, d):
    return D.relevancy_rate(X.documents(spark, d), "text", HIT_KEYWORDS)


@register("score_summary", f"""
SELECT count(score) AS n_scores, round(avg(abs(score - 0.5)) * 2.0, 4) AS avg_confidence,
       round(stddev_pop(score), 4) AS pred_std FROM ({SQL['new']})""")
def q_score_summary(spark, d):
    return D.score_summary(X.new_scores(spark, d))


@register("status_summary", f"""
SELECT count(*) FILTER (WHERE score > 0.5) AS n_real, count(*) FILTER (WHERE NOT (score > 0.5) OR score IS NULL) AS n_fake,
       count(*) AS n_total FROM ({SQL['new']})""")
def q_status_summary(spark, d):
    return I.status_summary(X.new_scores(spark, d))


_TOKENS_SQL = f"""
SELECT doc_id, unnest(toks) AS word, unnest(range(len(toks))) AS pos
FROM (SELECT doc_id, {s_tokens('text')} AS toks FROM documents)"""


@register("token_frequency", f"""
SELECT word, count(*) AS n, min(struct_pack(d := doc_id, p := pos)).d AS first_doc,
       CAST(min(struct_pack(d := doc_id, p := pos)).p AS INTEGER) AS first_pos
FROM ({_TOKENS_SQL}) GROUP BY word""")
def q_token_frequency(spark, d):
    return M.token_frequency(X.documents(spark, d), "doc_id", "text")


def _kw_sql(kws):
    parts = []
    for i, k in enumerate(kws):
        parts.append(
            f"SELECT '{k}' AS keyword, {i} AS kw_pos, CAST(coalesce(sum((length(lower(text)) - length(replace(lower(text), '{k}', ''))) // {len(k)}), 0) AS BIGINT) AS n FROM documents")
    return " UNION ALL ".join(parts)


@register("keyword_counts", _kw_sql(COUNT_KEYWORDS))
def q_keyword_counts(spark, d):
    return I.keyword_counts(X.documents(spark, d), "text", COUNT_KEYWORDS)


@register("top_keywords", f"SELECT * FROM ({_kw_sql(COUNT_KEYWORDS)}) WHERE n > 0 ORDER BY n DESC, kw_pos LIMIT 8")
def q_top_keywords(spark, d):
    return I.top_keywords(X.documents(spark, d), "text", COUNT_KEYWORDS)


# ======================================================================================
# evaluation
# ======================================================================================
_CM_SQL = """count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
             count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp"""


@register("confusion_matrix", f"SELECT {_CM_SQL} FROM ({SQL['scored']})")
def q_confusion_matrix(spark, d):
    return E.confusion_matrix(X.scored_labelled(spark, d))


def _ratio(n, dd):
    return f"(CASE WHEN ({dd}) > 0 THEN ({n})::DOUBLE / ({dd}) ELSE 0.0::DOUBLE END)"


def _metrics_sql(src: str, group: str = "") -> str:
    g_sel = f"{group}, " if group else ""
    g_by = f"GROUP BY {group}" if group else ""
    f1r, f1f = _ratio("2*tp", "2*tp+fp+fn"), _ratio("2*tn", "2*tn+fn+fp")
    pr, pf = _ratio("tp", "tp+fp"), _ratio("tn", "tn+fn")
    rr, rf = _ratio("tp", "tp+fn"), _ratio("tn", "tn+fp")
    hr, hf = "(CASE WHEN tp+fn+fp > 0 THEN 1.0 ELSE 0.0 END)", "(CASE WHEN tn+fp+fn > 0 THEN 1.0 ELSE 0.0 END)"

    def macro(a, b):
        return _ratio(f"{a}*{hf} + {b}*{hr}", f"{hf}+{hr}")

    return f"""
SELECT {g_sel}round({_ratio('tp+tn', 'tp+tn+fp+fn')}, 4) AS accuracy,
       round({macro(pf, pr)}, 4) AS precision_macro, round({macro(rf, rr)}, 4) AS recall_macro,
       round({macro(f1f, f1r)}, 4) AS f1_macro, round({f1f}, 4) AS f1_fake, round({f1r}, 4) AS f1_real
FROM (SELECT {g_sel}{_CM_SQL} FROM ({src}) {g_by})"""


@register("classification_metrics", _metrics_sql(SQL["scored"]))
def q_classification_metrics(spark, d):
    return E.classification_metrics(X.scored_labelled(spark, d))


@register("classification_report", f"""
WITH c AS (SELECT {_CM_SQL} FROM ({SQL['scored']})),
m AS (SELECT tn, fp, fn, tp, tn+fp+fn+tp AS n, tn+fp AS s_f, tp+fn AS s_r,
             {_ratio('tn', 'tn+fn')} AS p_f, {_ratio('tp', 'tp+fp')} AS p_r,
             {_ratio('tn', 'tn+fp')} AS r_f, {_ratio('tp', 'tp+fn')} AS r_r,
             {_ratio('2*tn', '2*tn+fn+fp')} AS f_f, {_ratio('2*tp', '2*tp+fp+fn')} AS f_r,
             {_ratio('tp+tn', 'tn+fp+fn+tp')} AS acc FROM c)
SELECT 'fake' AS "row", round(p_f, 4) AS precision, round(r_f, 4) AS recall, round(f_f, 4) AS f1, CAST(s_f AS BIGINT) AS support FROM m
UNION ALL SELECT 'real', round(p_r, 4), round(r_r, 4), round(f_r, 4), CAST(s_r AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, round(acc, 4), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round((p_f + p_r) / 2, 4), round((r_f + r_r) / 2, 4), round((f_f + f_r) / 2, 4), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round({_ratio('p_f*s_f + p_r*s_r', 'n')}, 4), round({_ratio('r_f*s_f + r_r*s_r', 'n')}, 4),
                 round({_ratio('f_f*s_f + f_r*s_r', 'n')}, 4), CAST(n AS BIGINT) FROM m""")
def q_classification_report(spark, d):
    return E.classification_report(X.scored_labelled(spark, d))


def _auc_sql(src: str, group: str = "") -> str:
    g_sel = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    g_by = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g_sel}CASE WHEN sum(pos) * sum(neg) > 0
            THEN round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 4) END AS auc_roc
FROM (SELECT *, sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
      FROM (SELECT {g_sel}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
            FROM ({src}) GROUP BY {g_sel}score)) {g_by}"""


@register("roc_auc", _auc_sql(SQL["tied"]))
def q_roc_auc(spark, d):
    return E.roc_auc(X.tied_labelled(spark, d))


@register("roc_curve", f"""
SELECT score AS threshold,
       round(CASE WHEN tn_all > 0 THEN cum_neg::DOUBLE / tn_all ELSE 0.0 END, 6) AS fpr,
       round(CASE WHEN tp_all > 0 THEN cum_pos::DOUBLE / tp_all ELSE 0.0 END, 6) AS tpr
FROM (SELECT score, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
             sum(pos) OVER () AS tp_all, sum(neg) OVER () AS tn_all
      FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
            FROM ({SQL['tied']}) GROUP BY score)
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
def q_roc_curve(spark, d):
    return E.roc_curve(X.tied_labelled(spark, d))


def _bin_sql(x: str, edges) -> str:
    terms = " + ".join(f"(CASE WHEN {x} >= {float(e)!r}::DOUBLE THEN 1 ELSE 0 END)" for e in edges[1:-1])
    return f"(CASE WHEN {x} >= {float(edges[0])!r}::DOUBLE AND {x} <= {float(edges[-1])!r}::DOUBLE THEN {terms or '0'} END)"


def _edges_sql(edges) -> str:
    rows = ", ".join(f"({j}, {float(edges[j])!r}::DOUBLE, {float(edges[j + 1])!r}::DOUBLE)" for j in range(len(edges) - 1))
    return f"(VALUES {rows}) AS b(bin, lower, upper)"


@register("confidence_histogram", f"""
WITH c AS (SELECT (CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) = label AS correct, abs(score - 0.5) * 2.0 AS conf
           FROM ({SQL['scored']})),
     g AS (SELECT DISTINCT correct FROM c)
SELECT g.correct, b.bin, b.lower, b.upper,
       (SELECT count(*) FROM c WHERE c.correct = g.correct AND {_bin_sql('c.conf', HIST_EDGES)} = b.bin) AS n
FROM g, {_edges_sql(HIST_EDGES)}""")
def q_confidence_histogram(spark, d):
    s = X.scored_labelled(spark, d)
    c = s.select((E.predicted_class("score") == F.col("label")).alias("correct"), E.confidence("score").alias("conf"))
    return D.histogram(c, "conf", HIST_EDGES, ["correct"])


_ERR_SQL = f"""
SELECT doc_id, text, CASE WHEN label = 0 AND score >= 0.5 THEN 'FP' WHEN label = 1 AND score < 0.5 THEN 'FN' END AS kind,
       abs(score - 0.5) * 2.0 AS conf FROM ({SQL['scored']})"""


@register("error_summary", f"""
SELECT kind, count(*) AS n, round(avg(conf), 4) AS mean_confidence FROM ({_ERR_SQL}) WHERE kind IS NOT NULL GROUP BY kind""")
def q_error_summary(spark, d):
    return E.error_summary(X.scored_labelled(spark, d))


@register("error_examples", f"""
SELECT kind, CAST(rank AS INTEGER) AS rank, doc_id, text, round(conf, 6) AS confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY conf DESC, doc_id ASC) AS rank
  FROM ({_ERR_SQL}) WHERE kind IS NOT NULL) WHERE rank <= 10""")
def q_error_examples(spark, d):
    return E.error_examples(X.scored_labelled(spark, d), "doc_id", "text")


@register("log_loss", f"""
SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS log_loss
FROM (SELECT label::DOUBLE AS label, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM ({SQL['scored']}))""")
def q_log_loss(spark, d):
    return E.log_loss(X.scored_labelled(spark, d))


_CMP_SQL = f"""
SELECT m.model, m.accuracy, m.f1_macro, m.f1_fake, m.f1_real, a.auc_roc
FROM ({_metrics_sql(SQL['models'], 'model')}) m LEFT JOIN ({_auc_sql(SQL['models'], 'model')}) a ON m.model = a.model"""


@register("model_comparison", _CMP_SQL)
def q_model_comparison(spark, d):
    return E.model_comparison(X.model_scores(spark, d))


@register("best_model", f"SELECT model, f1_macro FROM ({_CMP_SQL}) ORDER BY f1_macro DESC, model ASC LIMIT 1")
def q_best_model(spark, d):
    return E.best_model(E.model_comparison(X.model_scores(spark, d)))


_SPLIT_SQL = f"""
SELECT doc_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {sql_hash32('doc_id', '42')}, doc_id)
                            <= ceil(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM ({SQL['labelled']})"""


def _merge_sql():
    models_split = f"SELECT m.*, s.split FROM ({SQL['models']}) m JOIN ({_SPLIT_SQL}) s ON m.doc_id = s.doc_id"
    old = _CMP_SQL.replace(SQL["models"], f"SELECT * FROM ({models_split}) WHERE split = 'train' AND model IN ('hash', 'mixed')")
    new = _CMP_SQL.replace(SQL["models"], f"SELECT * FROM ({models_split}) WHERE split = 'test' AND model IN ('mixed', 'tied')")
    return f"""
WITH o AS ({old}), n AS ({new})
SELECT coalesce(n.model, o.model) AS model,
       CASE WHEN n.model IS NOT NULL THEN n.accuracy ELSE o.accuracy END AS accuracy,
       CASE WHEN n.model IS NOT NULL THEN n.f1_macro ELSE o.f1_macro END AS f1_macro,
       CASE WHEN n.model IS NOT NULL THEN n.f1_fake ELSE o.f1_fake END AS f1_fake,
       CASE WHEN n.model IS NOT NULL THEN n.f1_real ELSE o.f1_real END AS f1_real,
       CASE WHEN n.model IS NOT NULL THEN n.auc_roc ELSE o.auc_roc END AS auc_roc
FROM o FULL OUTER JOIN n ON o.model = n.model"""


_HISTORY_SQL = f"""
SELECT source AS model, doc_id % 12 AS epoch,
       round(avg(-(label * ln(least(greatest(score, 1e-15), 1 - 1e-15)) + (1 - label) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)))), 6) AS loss
FROM ({SQL['scored']}) GROUP BY 1, 2"""


@register("best_epoch", f"""
WITH h AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY epoch) AS place FROM ({_HISTORY_SQL})),
     lows AS (SELECT model, place FROM h a WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.model = a.model AND b.place < a.place AND b.loss <= a.loss)),
     waits AS (SELECT h.model, h.place FROM h WHERE NOT EXISTS (
         SELECT 1 FROM lows l WHERE l.model = h.model AND l.place BETWEEN h.place - {E.PATIENCE - 1} AND h.place) AND h.place >= {E.PATIENCE}),
     ends AS (SELECT model, min(place) AS place FROM waits GROUP BY model),
     run AS (SELECT h.*, e.place AS stop FROM h LEFT JOIN ends e ON e.model = h.model WHERE e.place IS NULL OR h.place <= e.place)
SELECT model, first(epoch ORDER BY loss, epoch) AS best_epoch, min(loss) AS best_loss, count(*) AS epochs_run, max(stop) IS NOT NULL AS stopped_early
FROM run GROUP BY model""")
def q_best_epoch(spark, d):
    """Twelve parts of the labelled rows stand for epochs, their log loss for the validation loss."""
    scored = X.scored_labelled(spark, d).select(F.col("source").alias("model"), (F.col("doc_id") % 12).alias("epoch"), "label", "score")
    return E.best_epoch(E.log_loss(scored, group_cols=["model", "epoch"]), loss_col="log_loss")


@register("merge_results", _merge_sql())
def q_merge_results(spark, d):
    ms = X.model_scores(spark, d)
    split = M.stratified_split(X.labelled(spark, d).select("doc_id", "label"), "doc_id").select("doc_id", "split")
    ms = ms.join(split, "doc_id")
    old = E.model_comparison(ms.filter((F.col("split") == "train") & F.col("model").isin("hash", "mixed")))
    old = old.withColumnRenamed("auc_roc", "roc_auc")  # a legacy record
    new = E.model_comparison(ms.filter((F.col("split") == "test") & F.col("model").isin("mixed", "tied")))
    return E.merge_results(old, new, "model")


# ======================================================================================
# Distributions and drift
# ======================================================================================
def _quantile_sql(src: str) -> str:
    probs = D.decile_probs()
    rows = ", ".join(f"({i}, {p!r}::DOUBLE)" for i, p in enumerate(probs))
    return f"""
WITH s AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS r, count(*) OVER () AS n FROM ({src}) WHERE score IS NOT NULL),
     q AS (SELECT i, p, v, floor(v)::BIGINT AS lo, least(floor(v)::BIGINT + 1, n - 1) AS hi, v - floor(v) AS g
           FROM (SELECT i, p, n, n * p + (1.0::DOUBLE + p * (-1.0::DOUBLE)) - 1.0::DOUBLE AS v
                 FROM (VALUES {rows}) AS t(i, p), (SELECT DISTINCT n FROM s)))
SELECT CAST(i AS INTEGER) AS q_index, p AS prob,
       CASE WHEN g >= 0.5 THEN b - (b - a) * (1.0::DOUBLE - g) ELSE a + (b - a) * g END AS quantile
FROM (SELECT q.i, q.p, q.g, (SELECT score FROM s WHERE r = q.lo) AS a, (SELECT score FROM s WHERE r = q.hi) AS b FROM q)"""


@register("score_quantiles", f"SELECT q_index, prob, round(quantile, 6) AS quantile FROM ({_quantile_sql(SQL['ref'])})")
def q_score_quantiles(spark, d):
    q = D.exact_quantiles(X.reference_scores(spark, d))
    return q.select("q_index", "prob", F.round("quantile", 6).alias("quantile"))


@register("score_histogram", f"""
SELECT b.bin, b.lower, b.upper, (SELECT count(*) FROM ({SQL['new']}) s WHERE {_bin_sql('s.score', HIST_EDGES)} = b.bin) AS n
FROM {_edges_sql(HIST_EDGES)}""")
def q_score_histogram(spark, d):
    return D.histogram(X.new_scores(spark, d), "score", HIST_EDGES)


def _psi_sql(ref: str, new: str, group: str | None = None) -> str:
    """PSI with edges = reference deciles (ends forced to 0 and 1, unique)."""
    g_sel = f"{group}, " if group else ""
    return f"""
WITH qs AS ({_quantile_sql(ref)}),
     e0 AS (SELECT DISTINCT CASE WHEN q_index = 0 THEN 0.0::DOUBLE WHEN q_index = 10 THEN 1.0::DOUBLE ELSE quantile END AS e FROM qs),
     e AS (SELECT e, row_number() OVER (ORDER BY e) - 1 AS j, count(*) OVER () AS k1 FROM e0),
     bins AS (SELECT a.j AS bin, a.e AS lower, b.e AS upper, a.k1 - 1 AS k FROM e a JOIN e b ON b.j = a.j + 1),
     rs AS (SELECT score FROM ({ref})), ns AS (SELECT {g_sel}score FROM ({new})),
     rc AS (SELECT bin, (SELECT count(*) FROM rs WHERE rs.score >= lower AND (rs.score < upper OR (bin = k - 1 AND rs.score <= upper))) AS c FROM bins),
     grp AS (SELECT {g_sel}count(*) AS n FROM ns {'GROUP BY ' + group if group else ''}),
     nc AS (SELECT {'g.' + group + ', ' if group else ''}b.bin,
                   (SELECT count(*) FROM ns WHERE {'ns.' + group + ' = g.' + group + ' AND ' if group else ''}ns.score >= b.lower
                      AND (ns.score < b.upper OR (b.bin = b.k - 1 AND ns.score <= b.upper))) AS c
            FROM bins b, grp g),
     t AS (SELECT {'nc.' + group + ', ' if group else ''}
                  sum((greatest(nc.c::DOUBLE / g.n, 1e-4) - greatest(rc.c::DOUBLE / (SELECT count(*) FROM rs), 1e-4))
                      * ln(greatest(nc.c::DOUBLE / g.n, 1e-4) / greatest(rc.c::DOUBLE / (SELECT count(*) FROM rs), 1e-4))) AS v
           FROM nc JOIN rc ON nc.bin = rc.bin JOIN grp g ON {'g.' + group + ' = nc.' + group if group else 'true'}
           {'GROUP BY nc.' + group if group else ''})
SELECT {g_sel}round(v, 4) AS psi,
       CASE WHEN round(v, 4) < 0.1 THEN 'STABLE' WHEN round(v, 4) < 0.25 THEN 'MODERATE' ELSE 'SIGNIFICANT' END AS psi_status
FROM t"""


@register("psi", _psi_sql(SQL["ref"], SQL["new"]))
def q_psi(spark, d):
    return D.psi(X.reference_scores(spark, d), X.new_scores(spark, d))


_KS_SQL = f"""
WITH u AS (SELECT score, 1 AS r, 0 AS w FROM ({SQL['ref']}) UNION ALL SELECT score, 0, 1 FROM ({SQL['new']})),
     g AS (SELECT score, sum(r) AS r, sum(w) AS w FROM u GROUP BY score),
     c AS (SELECT score, sum(r) OVER o AS cr, sum(w) OVER o AS cw, sum(r) OVER () AS nr, sum(w) OVER () AS nw
           FROM g WINDOW o AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT round(max(abs(cr::DOUBLE / nr - cw::DOUBLE / nw)), 4) AS ks_statistic,
       CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nw) AS BIGINT) AS n_new FROM c"""


@register("ks_statistic", _KS_SQL)
def q_ks_statistic(spark, d):
    return D.ks_statistic(X.reference_scores(spark, d), X.new_scores(spark, d))


@register("ks_pvalue_limit", f"""
SELECT ks_statistic, n_ref, n_new,
       round(CASE WHEN lam <= 0 THEN 1.0 ELSE least(greatest(2.0 * (
           SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)), 0.0), 1.0) END, 4) AS p_value
FROM (SELECT *, ks_statistic * sqrt(n_ref::DOUBLE * n_new / (n_ref + n_new)) AS lam FROM ({_KS_SQL}))""")
def q_ks_pvalue_limit(spark, d):
    ks = D.ks_statistic(X.reference_scores(spark, d), X.new_scores(spark, d))
    en = F.col("n_ref").cast("double") * F.col("n_new") / (F.col("n_ref") + F.col("n_new"))
    return ks.select("ks_statistic", "n_ref", "n_new", F.round(D.ks_limit_pvalue(F.col("ks_statistic"), en), 4).alias("p_value"))


_KS_RAW = _KS_SQL.replace("round(max(abs(cr::DOUBLE / nr - cw::DOUBLE / nw)), 4)", "max(abs(cr::DOUBLE / nr - cw::DOUBLE / nw))")


@register("drift_report", f"""
WITH base AS (SELECT count(*) AS n_articles,
                     round(avg(CASE WHEN {s_relevant('text', HIT_KEYWORDS)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS relevancy_rate,
                     round(avg(abs(score - 0.5)) * 2.0, 4) AS avg_confidence, round(stddev_pop(score), 4) AS pred_std FROM ({SQL['new']})),
     ks AS (SELECT ks_statistic, CASE WHEN lam <= 0 THEN 1.0 ELSE least(greatest(2.0 * (
                SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)), 0.0), 1.0) END AS p
            FROM (SELECT *, ks_statistic * sqrt(n_ref::DOUBLE * n_new / (n_ref + n_new)) AS lam FROM ({_KS_RAW}))),
     p AS ({_psi_sql(SQL['ref'], SQL['new'])})
SELECT 'documents' AS source_file, n_articles, relevancy_rate, avg_confidence, pred_std, round(ks_statistic, 4) AS ks_statistic,
       round(ks.p, 4) AS ks_p_value, ks.p < 0.05 AS ks_drift_detected, psi, psi_status,
       relevancy_rate < 0.3 OR avg_confidence < 0.3 OR ks.p < 0.05 OR psi >= 0.25 AS retrain_needed,
       concat_ws(',', CASE WHEN relevancy_rate < 0.3 THEN 'low_relevancy' END, CASE WHEN avg_confidence < 0.3 THEN 'low_confidence' END,
                 CASE WHEN ks.p < 0.05 THEN 'ks_drift' END, CASE WHEN psi >= 0.25 THEN 'psi_significant' END) AS reasons
FROM base, ks, p""")
def q_drift_report(spark, d):
    """D5-D7 under the limiting KS law, as for each snapshot."""
    return D.drift_report(X.new_scores(spark, d), X.reference_scores(spark, d), "text", "score",
                          HIT_KEYWORDS, source_file="documents")


def _ks_by_source_sql():
    ref, new = SQL["ref"], SQL["new"]
    return f"""
WITH rs AS (SELECT score FROM ({ref})), ns AS (SELECT source, score FROM ({new})),
     pts AS (SELECT DISTINCT ns.source, p.score FROM (SELECT score FROM rs UNION SELECT score FROM ns) p, (SELECT DISTINCT source FROM ns) ns),
     f AS (SELECT pts.source, pts.score,
                  (SELECT count(*) FROM rs WHERE rs.score <= pts.score)::DOUBLE / (SELECT count(*) FROM rs) AS fr,
                  (SELECT count(*) FROM ns WHERE ns.source = pts.source AND ns.score <= pts.score)::DOUBLE
                    / (SELECT count(*) FROM ns n2 WHERE n2.source = pts.source) AS fg
           FROM pts)
SELECT source, max(abs(fr - fg)) AS ks_statistic,
       (SELECT count(*) FROM rs) AS n_ref, (SELECT count(*) FROM ns n3 WHERE n3.source = f.source) AS n_new
FROM f GROUP BY source"""


@register("ks_pvalue_finite", f"""
WITH RECURSIVE ks AS MATERIALIZED ({_ks_by_source_sql()}),
sized AS (SELECT *, round_even(n_ref::DOUBLE * n_new / (n_ref + n_new), 0)::BIGINT AS n FROM ks),
band AS (SELECT *, floor(n * ks_statistic)::BIGINT + 1 AS k, floor(n * ks_statistic) + 1 - n * ks_statistic AS h FROM sized),
steps AS MATERIALIZED (SELECT source, n, k, list_transform(range(1, 2 * k), lambda j: list_transform(range(1, 2 * k), lambda i:
    ((CASE WHEN i - j + 1 < 0 THEN 0.0 ELSE 1.0 END) - (CASE WHEN j = 1 THEN pow(h, i) ELSE 0.0 END) - (CASE WHEN i = 2 * k - 1 THEN pow(h, 2 * k - j) ELSE 0.0 END)
     + (CASE WHEN j = 1 AND i = 2 * k - 1 THEN pow(greatest(2 * h - 1, 0.0), 2 * k - 1) ELSE 0.0 END)) / gamma(greatest(i - j + 1, 0) + 1.0)::DOUBLE)) AS columns FROM band),
walk AS (SELECT source, 0::BIGINT AS t, list_transform(range(1, 2 * k), lambda i: CASE WHEN i = k THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS v FROM steps
  UNION ALL SELECT w.source, w.t + 1, list_transform(s.columns, lambda c: list_dot_product(w.v, c) * (w.t + 1) / s.n) FROM walk w JOIN steps s USING (source) WHERE w.t < s.n),
ended AS (SELECT w.source, w.v[s.k] AS cdf FROM walk w JOIN steps s ON w.source = s.source AND w.t = s.n)
SELECT source, round(ks_statistic, 4) AS ks_statistic, n_ref, n_new, round(least(greatest(1.0 - cdf, 0.0), 1.0), 6) AS p_value FROM ks JOIN ended USING (source)""")
def q_ks_pvalue_finite(spark, d):
    """D4 under the finite-sample law: each source's scores against the reference."""
    ks = D.ks_statistic_by_group(X.reference_scores(spark, d), X.new_scores(spark, d), ["source"], digits=None)
    p = F.round(D.ks_pvalue("ks_statistic", "n_ref", "n_new", "finite"), 6)
    return ks.select("source", F.round("ks_statistic", 4).alias("ks_statistic"), "n_ref", "n_new", p.alias("p_value"))


def _drift_by_snapshot_sql():
    ref, new = SQL["ref"], SQL["new"]
    ks = _ks_by_source_sql()
    return f"""
WITH base AS (SELECT source, count(*) AS n_articles,
                     round(avg(CASE WHEN {s_relevant('text', HIT_KEYWORDS)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS relevancy_rate,
                     round(avg(abs(score - 0.5)) * 2.0, 4) AS avg_confidence, round(stddev_pop(score), 4) AS pred_std
              FROM ({new}) GROUP BY source),
     ks0 AS (SELECT source, ks_statistic,
                   (CASE WHEN lam <= 0 THEN 1.0 ELSE least(greatest(2.0 * (
                       SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)), 0.0), 1.0) END) AS p
            FROM (SELECT *, ks_statistic * sqrt(n_ref::DOUBLE * n_new / (n_ref + n_new)) AS lam FROM ({ks}))),
     ks AS (SELECT source, round(ks_statistic, 4) AS ks_statistic, round(p, 4) AS ks_p_value, p < 0.05 AS drifted FROM ks0),
     p AS ({_psi_sql(ref, new, 'source')})
SELECT b.source, b.n_articles, b.relevancy_rate, b.avg_confidence, b.pred_std, ks.ks_statistic, ks.ks_p_value, p.psi, p.psi_status,
       (coalesce(b.relevancy_rate < 0.3, false) OR coalesce(b.avg_confidence < 0.3, false)
        OR coalesce(ks.drifted, false) OR coalesce(p.psi >= 0.25, false)) AS retrain_needed
FROM base b LEFT JOIN ks ON b.source = ks.source LEFT JOIN p ON b.source = p.source"""


@register("drift_by_snapshot", _drift_by_snapshot_sql())
def q_drift_by_snapshot(spark, d):
    return D.drift_by_snapshot(X.new_scores(spark, d), X.reference_scores(spark, d), "source", "text", "score",
                               HIT_KEYWORDS)


# ======================================================================================
# O1: serving
# ======================================================================================
@register("latest_scored", f"""
SELECT event_id, text, scraped_at, source, CASE WHEN score > 0.5 THEN 'Real' ELSE 'Fake' END AS verdict,
       round(CASE WHEN score > 0.5 THEN score ELSE 1.0 - score END, 6) AS conf
FROM (SELECT e.event_id, e.event_type AS text, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS scraped_at,
             '@' || coalesce(u.uname, 'unknown') AS source, {sql_hash('e.event_id', 'serve')} AS score
      FROM events e LEFT JOIN (SELECT c_custkey, max(c_name) AS uname FROM customer GROUP BY c_custkey) u
        ON e.user_id * 7 = u.c_custkey
      WHERE e.event_type IS NOT NULL
      ORDER BY scraped_at DESC, e.event_id DESC LIMIT 10)""")
def q_latest_scored(spark, d):
    ev = X.table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("text"), "ts", (F.col("user_id") * 7).alias("user_id"))
    # the newest rows first, so that only they are joined and scored
    top = materialize(P.latest_rows(ev, "ts", ["event_id"], 10)).withColumn("scraped_at", C.row_time("ts"))
    posts = P.author_join(top, X.table(spark, d, "customer"), "user_id", "c_custkey", "c_name")
    scored = posts.withColumn("score", C.unit_hash("event_id", "serve"))
    v = P.verdict(scored)
    return v.select("event_id", "text", "scraped_at", "source", "verdict", F.round("conf", 6).alias("conf"))


# ======================================================================================
# features
# ======================================================================================
@register("stratified_split", _SPLIT_SQL)
def q_stratified_split(spark, d):
    return M.stratified_split(X.labelled(spark, d).select("doc_id", "label"), "doc_id")


@register("random_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {sql_hash32('doc_id', '42')}, doc_id)
                         <= ceil(count(*) OVER () * 0.1::DOUBLE) THEN 'valid' ELSE 'train' END AS split
FROM documents""")
def q_random_split(spark, d):
    return M.random_split(X.documents(spark, d).select("doc_id"), "doc_id")


@register("oversample_minority", f"""
WITH l AS (SELECT doc_id, label FROM ({SQL['labelled']})),
     c AS (SELECT count(*) FILTER (WHERE label = 0) AS f, count(*) FILTER (WHERE label <> 0) AS r FROM l),
     m AS (SELECT l.doc_id, l.label, c.r // c.f AS q,
                  row_number() OVER (ORDER BY {sql_hash32('l.doc_id', '42')}, l.doc_id) <= c.r % c.f AS extra
           FROM l, c WHERE l.label = 0)
SELECT doc_id, label, 0 AS replica FROM l WHERE label <> 0
UNION ALL
SELECT doc_id, label, unnest(range(q + CASE WHEN extra THEN 1 ELSE 0 END))::INTEGER AS replica FROM m""")
def q_oversample_minority(spark, d):
    return M.oversample_minority(X.labelled(spark, d).select("doc_id", "label"), "doc_id")


@register("class_weights", f"""
SELECT label, n_class, round(sum(n_class) OVER () / (count(*) OVER () * n_class), 6) AS weight
FROM (SELECT label, count(*) AS n_class FROM ({SQL['labelled']}) GROUP BY label)""")
def q_class_weights(spark, d):
    cw = M.class_weights(X.labelled(spark, d))
    return cw.select("label", "n_class", F.round("weight", 6).alias("weight"))


@register("vocabulary", f"""
SELECT word, CAST(row_number() OVER (ORDER BY n DESC, first_doc, first_pos) + 1 AS INTEGER) AS id, n
FROM (SELECT word, count(*) AS n, min(struct_pack(d := doc_id, p := pos)).d AS first_doc,
             min(struct_pack(d := doc_id, p := pos)).p AS first_pos FROM ({_TOKENS_SQL}) GROUP BY word
      ORDER BY n DESC, first_doc, first_pos LIMIT 19998)""")
def q_vocabulary(spark, d):
    return M.build_vocabulary(X.documents(spark, d), "doc_id", "text")


_VOCAB_SQL = ORACLE["vocabulary"]


@register("encode_sequences", f"""
WITH v AS ({_VOCAB_SQL}),
     t AS (SELECT doc_id, unnest(toks[1:128]) AS word, unnest(range(len(toks[1:128]))) AS pos
           FROM (SELECT doc_id, {s_tokens('text')} AS toks FROM documents)),
     e AS (SELECT t.doc_id, list(coalesce(v.id, 1) ORDER BY t.pos) AS ids FROM t LEFT JOIN v ON t.word = v.word GROUP BY t.doc_id),
     a AS (SELECT d.doc_id, coalesce(e.ids, []::INTEGER[]) AS ids FROM documents d LEFT JOIN e ON d.doc_id = e.doc_id)
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(128 - len(ids)), lambda x: 0)), ' ') AS ids FROM a""")
def q_encode_sequences(spark, d):
    docs = X.documents(spark, d)
    vocab = M.build_vocabulary(docs, "doc_id", "text")
    e = M.encode_sequences(docs, vocab, "doc_id", "text")
    return e.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@register("encode_drop_oov", f"""
WITH v AS ({_VOCAB_SQL}),
     t AS ({_TOKENS_SQL}),
     e AS (SELECT t.doc_id, list(v.id ORDER BY t.pos) FILTER (WHERE v.id IS NOT NULL) AS ids
           FROM t LEFT JOIN v ON t.word = v.word GROUP BY t.doc_id),
     a AS (SELECT d.doc_id, coalesce(e.ids, []::INTEGER[])[1:100] AS ids FROM documents d LEFT JOIN e ON d.doc_id = e.doc_id)
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(100 - len(ids)), lambda x: 0)), ' ') AS ids FROM a""")
def q_encode_drop_oov(spark, d):
    docs = X.documents(spark, d)
    vocab = M.build_vocabulary(docs, "doc_id", "text")
    e = M.encode_drop_oov(docs, vocab, "doc_id", "text")
    return e.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


_TERMS_SQL = f"""
SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS terms
FROM (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}{{2,}}') AS t FROM documents)"""


@register("tfidf_terms", f"SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, array_to_string(terms, '|') AS terms FROM ({_TERMS_SQL})")
def q_tfidf_terms(spark, d):
    t = X.documents(spark, d).select("doc_id", T.ngram_terms("text").alias("terms"))
    return t.select("doc_id", F.size("terms").alias("n_terms"), F.array_join("terms", "|").alias("terms"))


_TFIDF_SQL = f"""
WITH tc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM ({_TERMS_SQL})) GROUP BY doc_id, term),
     st AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM tc GROUP BY term ORDER BY cf DESC, term ASC LIMIT 30000),
     v AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0 AS idf FROM st),
     w AS (SELECT tc.doc_id, tc.term, (1.0 + ln(tc.tf)) * v.idf AS w FROM tc JOIN v ON tc.term = v.term)
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w"""


@register("tfidf_weights", f"SELECT doc_id, term, round(weight, 6) AS weight FROM ({_TFIDF_SQL})")
def q_tfidf_weights(spark, d):
    _, w = M.tfidf_fit_transform(X.documents(spark, d), "doc_id", "text")
    return w.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@register("linear_score", f"""
WITH w AS ({_TFIDF_SQL}),
     m AS (SELECT doc_id, sum(weight * (({sql_hash('term', 'coef')}) - 0.5) * 4.0) AS margin FROM w GROUP BY doc_id)
SELECT d.doc_id, round(1.0 / (1.0 + exp(-coalesce(m.margin, 0.0))), 6) AS score
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id""")
def q_linear_score(spark, d):
    docs = X.documents(spark, d)
    vocab, weights = M.tfidf_fit_transform(docs, "doc_id", "text")
    coef = vocab.select("term", ((C.unit_hash("term", "coef") - 0.5) * 4.0).alias("coef"))
    s = ML.linear_score(docs, weights, coef, "doc_id", intercept=0.0)
    return s.select("doc_id", F.round("score", 6).alias("score"))


# Fitted on labelled rows, scores of all documents (no SQL form: iterative solvers)
def _train_test(spark, d):
    rows = materialize(M.stratified_split(X.labelled(spark, d).select("doc_id", "label"), "doc_id"))
    texts = X.documents(spark, d).select("doc_id", "text").join(rows, "doc_id")
    return texts.filter("split = 'train'").drop("split"), texts.filter("split = 'test'").drop("split")


@register("logreg_scores")
def q_logreg_scores(spark, d):
    model = ML.fit_logreg(_train_test(spark, d)[0], "doc_id", "text")
    return ML.score(model, X.documents(spark, d).select("doc_id", "text"), "doc_id", "text").select("doc_id", F.round("score", 6).alias("score"))


@register("svm_scores")
def q_svm_scores(spark, d):
    model = ML.fit_svm(_train_test(spark, d)[0], "doc_id", "text")
    return ML.score(model, X.documents(spark, d).select("doc_id", "text"), "doc_id", "text").select("doc_id", F.round("score", 6).alias("score"))


@register("model_tournament")
def q_model_tournament(spark, d):
    return E.model_comparison(ML.model_tournament(*_train_test(spark, d), "doc_id", "text"))


# ======================================================================================
# Streams over a landing folder (run with availableNow, then read back)
# ======================================================================================
def _stream_input(spark, df, file_col, max_files):
    from veracity.streaming import monitor as S
    landing = S.work_dir(spark, "landing")
    S.stage_files(df, landing, file_col)
    return S, S.read_landing(spark, landing, df.schema, max_files)


#: Files of the streams below: a document's is the remainder of its id.
LANDINGS = 5


@register("stream_ingest", f"""
SELECT doc_id, text FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY landing, doc_id) AS place
  FROM (SELECT doc_id, doc_id % {LANDINGS} AS landing, {s_strip_tweet('text')} AS text FROM documents) WHERE length(text) >= 20)
WHERE place = 1""")
def q_stream_ingest(spark, d):
    """One batch after the other: a text that several files hold stays as the first file brought it."""
    from veracity.streaming import monitor as S
    docs = X.documents(spark, d).select("doc_id", "text").withColumn("landing", F.col("doc_id") % LANDINGS)
    landing, master, ckpt = (S.work_dir(spark, x) for x in ("landing", "master", "ckpt"))
    for n in range(LANDINGS):  # as runs of a daily job: a file lands, the stream reads what is new
        docs.filter(F.col("landing") == n).select("doc_id", "text").write.mode("append").parquet(landing)
        stream = S.read_landing(spark, landing, "doc_id long, text string")
        S.run_available(S.start_ingest(stream, master, ckpt, "text", order_cols=["doc_id"]))
    return spark.read.parquet(master).select("doc_id", "text")


@register("stream_monitor", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_articles,
       round(avg(CASE WHEN {s_relevant('event_type', ['error', 'click'])} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS relevancy_rate,
       round(avg(abs({sql_hash('event_id', 'serve')} - 0.5) * 2.0), 4) AS avg_confidence
FROM events GROUP BY 1""")
def q_stream_monitor(spark, d):
    ev = X.snapshots(spark, d).select("event_id", "ts", F.col("event_type").alias("text"),
                                      C.unit_hash("event_id", "serve").alias("score"), "file")
    S, stream = _stream_input(spark, ev, "file", 10)
    out, ckpt = S.work_dir(spark, "monitor"), S.work_dir(spark, "ckpt")
    S.run_available(S.start_monitor(stream, out, ckpt, "ts", "text", "score", ["error", "click"], delay="60 days"))
    return S.read_latest(spark, out, "window_start")


@register("stream_drift", ORACLE["drift_by_snapshot"])
def q_stream_drift(spark, d):
    """Every file holds rows of every source, so each batch adds to what the state has of them.

    A batch is a landing, in however many Parquet files it was written, as in :func:`q_stream_ingest`:
    a batch reads the state of all sources, so the number of batches must not follow the input's size."""
    from veracity.streaming import monitor as S
    landed = F.coalesce(F.pmod("doc_id", F.lit(LANDINGS)), F.lit(0))  # rows without an id land with the first
    new, ref = X.new_scores(spark, d), X.reference_scores(spark, d)
    landing, out, ckpt = (S.work_dir(spark, x) for x in ("landing", "drift", "ckpt"))
    for n in range(LANDINGS):
        new.filter(landed == n).write.mode("append").parquet(landing)
        stream = S.read_landing(spark, landing, new.schema)
        S.run_available(S.start_drift(stream, ref, out, ckpt, "source", "text", "score", HIT_KEYWORDS))
    return S.read_latest(spark, out, "source")
