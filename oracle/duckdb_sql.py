"""Independent DuckDB statements for every key of ``queries()``.

Written on the raw driver views (documents, events, conversations, orders,
lineitem, customer, nation, region, pages); each statement rebuilds the staged
table from scratch as a CTE chain, then runs the key's query.  Counts are cast
to BIGINT and ratios to DOUBLE so the schemas line up with Spark's.
"""

from __future__ import annotations

import html.entities

from courtview.params import (COMMERCE_PARAMS, CONTENT_PARAMS, FIXTURE_LEXICON, PRIORITY_BOTH,
                              PRIORITY_ENGAGEMENT, PRIORITY_NEGATIVE, PRIORITY_SHORT, PRIORITY_STANDARD, REFERENCE_CONTENT_DEFAULT,
                              REFERENCE_CONTENT_RULES, REFERENCE_THEME_DEFAULT, REFERENCE_THEME_RULES, Params)

ENTITY_RE = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
SQUISH_RE = r"[\t\n\f\r\p{Z}]+"


def rnd(e: str, d: int) -> str:
    """Spark's ``round`` on a double: round the decimal form (12 places first), half away from zero."""
    return f"CAST(round(CAST({e} AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def mean(e: str) -> str:
    return f"avg({e})"


def smean(e: str) -> str:
    """A sheet's AVG, published at 1e-10 resolution."""
    return rnd(f"avg({e})", 10)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def squish(e: str) -> str:
    return f"trim(regexp_replace({e}, {q(SQUISH_RE)}, ' ', 'g'))"


def _cp_chr(v: str) -> str:
    return f"(CASE WHEN {v} BETWEEN 1 AND 1114111 AND NOT ({v} BETWEEN 55296 AND 57343) THEN chr(CAST({v} AS INTEGER)) END)"


def html_decode(e: str) -> str:
    items = sorted((k[:-1], v) for k, v in html.entities.html5.items() if k.endswith(";"))
    m = "MAP([" + ", ".join(q(k) for k, _ in items) + "], [" + ", ".join(q(v) for _, v in items) + "])"
    hex_cp = "try_cast('0x' || x[3:] AS BIGINT)"
    dec_cp = "try_cast(x[2:] AS BIGINT)"
    one = (f"coalesce(CASE WHEN x[1] = '#' THEN (CASE WHEN lower(x[2]) = 'x' THEN {_cp_chr(hex_cp)} "
           f"ELSE {_cp_chr(dec_cp)} END) ELSE {m}[x] END, '&' || x || ';')")
    re_ = q(ENTITY_RE)
    decoded = f"list_transform(regexp_extract_all({e}, {re_}, 1), lambda x: {one})"
    joined = (f"array_to_string(list_transform(string_split_regex({e}, {re_}), "
              f"lambda p, i: coalesce(p, '') || coalesce({decoded}[i], '')), '')")
    return f"(CASE WHEN strpos({e}, '&') > 0 THEN {joined} ELSE {e} END)"


def rules_case(title: str, duration: str | None, rules, default: str) -> str:
    parts = []
    for label, tp, dp in rules:
        conds = []
        if tp:
            conds.append(f"regexp_matches({title}, {q(tp)})")
        if dp and duration:
            conds.append(f"regexp_matches({duration}, {q(dp)})")
        if conds:
            parts.append(f"WHEN {' OR '.join(conds)} THEN {q(label)}")
    return f"(CASE {' '.join(parts)} ELSE {q(default)} END)" if parts else q(default)


def label3(e: str, t: str = "0.15") -> str:
    return f"(CASE WHEN {e} > {t} THEN 'Positive' WHEN {e} < -{t} THEN 'Negative' ELSE 'Neutral' END)"


# ---------------------------------------------------------------------------
# bindings -> raw model tables
# ---------------------------------------------------------------------------
CONTENT_RAW = """
ev AS (
  SELECT user_id, min(ts) AS first_ts,
         count(*) FILTER (WHERE event_type = 'view') AS n_view,
         count(*) FILTER (WHERE event_type = 'click') AS n_click,
         count(*) FILTER (WHERE event_type = 'signup') AS n_signup
  FROM events GROUP BY user_id),
vr AS (
  SELECT d.source AS team, upper(d.source) AS team_abbreviation, d.lang AS conference,
         'CH-' || d.source AS channel_id, CAST(d.doc_id AS VARCHAR) AS video_id,
         strftime(e.first_ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at, d.source AS channel_title,
         d.text AS video_title, d.text AS video_description,
         e.n_view AS view_count, e.n_click AS like_count, e.n_signup AS comment_count,
         CASE WHEN d.n_chars < 60 THEN 'PT' || d.n_chars || 'S'
              ELSE 'PT' || (d.n_chars // 60) || 'M' || (d.n_chars % 60) || 'S' END AS duration
  FROM documents d LEFT JOIN ev e ON d.doc_id = e.user_id),
cm AS MATERIALIZED (
  SELECT CAST(conv_id AS VARCHAR) AS video_id, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id,
         text AS comment_text, turn AS comment_like_count, row_number() OVER () AS rid
  FROM conversations),
lex(word, value) AS (VALUES {lexicon}),
lexu AS (SELECT word, CAST(sum(value) AS DECIMAL(18,4)) AS value FROM lex GROUP BY word),
tok AS (
  SELECT rid,
         unnest(list_distinct(string_split_regex(lower({clean}), '[^a-z'']+'))) AS word
  FROM cm),
hits AS (SELECT t.rid, sum(l.value) AS score FROM tok t JOIN lexu l ON t.word = l.word GROUP BY t.rid),
sc AS (SELECT c.*, {clean} AS comment_text_clean, coalesce(h.score, 0) AS sentiment_score
       FROM cm c LEFT JOIN hits h ON c.rid = h.rid)
"""

COMMERCE_RAW = """
geo AS (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
cu AS (SELECT c.c_custkey, c.c_name, c.c_mktsegment, g.* FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey),
ls AS (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n_like, count(*) AS n_comment
       FROM lineitem GROUP BY l_orderkey),
vr AS (
  SELECT cu.n_name AS team, upper(substr(cu.n_name, 1, 3)) AS team_abbreviation, cu.r_name AS conference,
         'CH-' || CAST(cu.n_nationkey AS VARCHAR) AS channel_id, CAST(o.o_orderkey AS VARCHAR) AS video_id,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published_at, cu.n_name AS channel_title,
         concat_ws(' ', cu.c_mktsegment, o.o_orderpriority) AS video_title, cu.c_name AS video_description,
         CAST(floor(o.o_totalprice) AS BIGINT) AS view_count, ls.n_like AS like_count, ls.n_comment AS comment_count,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'PT' || (o.o_orderkey % 60) || 'S'
              ELSE 'PT' || (1 + o.o_orderkey % 20) || 'M' || (o.o_orderkey % 60) || 'S' END AS duration
  FROM orders o LEFT JOIN cu ON o.o_custkey = cu.c_custkey LEFT JOIN ls ON o.o_orderkey = ls.l_orderkey),
sc AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS video_id,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS comment_id,
         CAST((CAST(round(l_discount * 100) AS INTEGER) - 5) * 0.05 AS DECIMAL(9,4)) AS sentiment_score
  FROM lineitem)
"""

FEATURES = """
summ AS (
  SELECT video_id, count(*) AS comments_pulled,
         CAST(sum(sentiment_score) AS DOUBLE) / count(*) AS avg_comment_sentiment,
         CAST(count(*) FILTER (WHERE sentiment_score > 0.15) AS DOUBLE) / count(*) AS positive_comment_pct,
         CAST(count(*) FILTER (WHERE sentiment_score BETWEEN -0.15 AND 0.15) AS DOUBLE) / count(*) AS neutral_comment_pct,
         CAST(count(*) FILTER (WHERE sentiment_score < -0.15) AS DOUBLE) / count(*) AS negative_comment_pct
  FROM sc GROUP BY video_id),
j AS (
  SELECT v.*, s.comments_pulled AS s_n, s.avg_comment_sentiment AS s_avg, s.positive_comment_pct AS s_pos,
         s.neutral_comment_pct AS s_neu, s.negative_comment_pct AS s_neg,
         CAST(strptime(v.published_at, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS pts
  FROM vr v LEFT JOIN summ s ON v.video_id = s.video_id AND v.comment_count > 0),
j2 AS (
  SELECT *, {title_dec} AS title_d, {desc_dec} AS desc_d, CAST(pts AS DATE) AS pdate,
         date_diff('day', CAST(pts AS DATE), DATE '{as_of}') AS days,
         coalesce(like_count, 0) AS like_c, coalesce(comment_count, 0) AS comment_c
  FROM j),
feat AS (
  SELECT video_id, team, team_abbreviation, conference, channel_id, channel_title,
         title_d AS video_title, desc_d AS video_description, pts AS published_at,
         pdate AS published_date, CAST(hour(pts) AS INTEGER) AS published_hour,
         CAST(date_trunc('month', pdate) AS DATE) AS published_month, duration,
         {content_case} AS content_type, {theme_case} AS message_theme,
         view_count, like_count, comment_count, like_c AS like_count_clean, comment_c AS comment_count_clean,
         like_c + comment_c AS engagement_count,
         CASE WHEN view_count > 0 THEN (like_c + comment_c) / view_count END AS engagement_rate,
         CASE WHEN view_count > 0 THEN like_c / view_count * 1000 END AS likes_per_1k_views,
         CASE WHEN view_count > 0 THEN comment_c / view_count * 1000 END AS comments_per_1k_views,
         CASE WHEN days IS NULL THEN NULL WHEN days > 0 THEN view_count / days
              ELSE CAST(view_count AS DOUBLE) END AS views_per_day,
         coalesce(s_n, 0) AS comments_pulled, coalesce(s_avg, 0.0) AS avg_comment_sentiment,
         coalesce(s_pos, 0.0) AS positive_comment_pct, coalesce(s_neu, 0.0) AS neutral_comment_pct,
         coalesce(s_neg, 0.0) AS negative_comment_pct,
         {bucket} AS sentiment_bucket
  FROM j2),
thr AS (SELECT quantile_cont(engagement_rate, {p}) AS eng_t, quantile_cont(negative_comment_pct, {p}) AS neg_t FROM feat),
fl AS (SELECT feat.*, engagement_rate >= thr.eng_t AS he,
              negative_comment_pct >= thr.neg_t AND comments_pulled >= {min_comments} AS hn
       FROM feat, thr),
stg AS (
  SELECT * EXCLUDE (he, hn),
         CASE WHEN he AND hn THEN '{both}' WHEN hn THEN '{neg}' WHEN he THEN '{eng}' ELSE '{std}' END
           AS monitoring_priority
  FROM fl)
"""


def _lexicon_values() -> str:
    return ", ".join(f"({q(w)}, CAST({v} AS DECIMAL(9,4)))" for w, v in FIXTURE_LEXICON)


def staged_ctes(binding: str) -> str:
    params: Params = CONTENT_PARAMS if binding == "content" else COMMERCE_PARAMS
    if binding == "content":
        raw = CONTENT_RAW.format(lexicon=_lexicon_values(), clean=squish("comment_text"))
    else:
        raw = COMMERCE_RAW
    title_clean = squish("lower(title_d)")
    feats = FEATURES.format(
        title_dec=html_decode("video_title"), desc_dec=html_decode("video_description"),
        as_of=params.as_of.isoformat(),
        content_case=rules_case(title_clean, "duration", params.content_rules, params.content_default),
        theme_case=rules_case(title_clean, None, params.theme_rules, params.theme_default),
        bucket=label3("coalesce(s_avg, 0.0)"), p=params.quantile, min_comments=params.min_comments,
        both=PRIORITY_BOTH, neg=PRIORITY_NEGATIVE, eng=PRIORITY_ENGAGEMENT, std=PRIORITY_STANDARD,
    )
    return raw.strip() + ",\n" + feats.strip()


def on_stg(binding: str, select: str) -> str:
    return f"WITH {staged_ctes(binding)}\n{select}"


PARAMS = {"content": CONTENT_PARAMS, "commerce": COMMERCE_PARAMS}
WER = rnd("CAST(sum(engagement_count) AS DOUBLE) / CAST(nullif(sum(view_count), 0) AS DOUBLE)", 4) + " AS weighted_engagement_rate"


def S(col: str, alias: str | None = None) -> str:
    return f"CAST(sum({col}) AS BIGINT) AS {alias or col}"


def A(col: str, d: int, alias: str) -> str:
    return f"{rnd(mean(col), d)} AS {alias}"


STAGED_SELECT = ("video_id, team, team_abbreviation, conference, channel_id, channel_title, video_title, "
                 "video_description, published_at, published_date, published_hour, published_month, duration, "
                 "content_type, message_theme, view_count, like_count, comment_count, like_count_clean, "
                 "comment_count_clean, engagement_count, engagement_rate, likes_per_1k_views, comments_per_1k_views, "
                 "views_per_day, comments_pulled, avg_comment_sentiment, positive_comment_pct, neutral_comment_pct, "
                 "negative_comment_pct, sentiment_bucket, monitoring_priority")


def report_sql(binding: str, wrap: bool = True) -> dict[str, str]:
    p = PARAMS[binding]
    not_std = f"monitoring_priority <> '{PRIORITY_STANDARD}'"
    out = {
        "q00_preview": f"SELECT {STAGED_SELECT} FROM stg ORDER BY video_id LIMIT 10",
        "q00_top_viewed": ("SELECT team, video_title, view_count, like_count_clean, comment_count_clean FROM stg "
                           "ORDER BY view_count DESC NULLS LAST, video_id LIMIT 20"),
        "q00_team_kpi": (f"SELECT team, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                         f"{S('engagement_count', 'total_engagements')}, {WER} FROM stg GROUP BY team"),
        "s05_team_kpi": (f"SELECT team, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                         f"{S('like_count_clean', 'total_likes')}, {S('comment_count_clean', 'total_comments')}, "
                         f"{S('engagement_count', 'total_engagements')}, {WER}, "
                         f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')} FROM stg GROUP BY team"),
        "s05_content_perf": (f"SELECT content_type, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                             f"{S('engagement_count', 'total_engagements')}, {WER}, "
                             f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg GROUP BY content_type"),
        "s05_monitoring": ("SELECT team, video_title, content_type, message_theme, view_count, "
                           "CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                           "CAST(round(CAST(negative_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS negative_comment_pct, monitoring_priority "
                           f"FROM stg WHERE {not_std}"),
        "q01_exec_kpi": (f"SELECT count(*) AS total_videos, count(DISTINCT team) AS total_teams, "
                         f"{S('view_count', 'total_views')}, {S('like_count_clean', 'total_likes')}, "
                         f"{S('comment_count_clean', 'total_comments')}, {S('engagement_count', 'total_engagements')}, "
                         f"{WER}, {A('avg_comment_sentiment', 4, 'avg_comment_sentiment')}, "
                         f"{A('positive_comment_pct', 4, 'avg_positive_comment_pct')}, "
                         f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg"),
        "q01_team_perf": (f"SELECT team, conference, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                          f"{S('like_count_clean', 'total_likes')}, {S('comment_count_clean', 'total_comments')}, "
                          f"{S('engagement_count', 'total_engagements')}, {WER}, "
                          f"{A('views_per_day', 2, 'avg_views_per_day')}, "
                          f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')}, "
                          f"{A('positive_comment_pct', 4, 'avg_positive_comment_pct')}, "
                          f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg GROUP BY team, conference"),
        "q01_content_perf": (f"SELECT content_type, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                             f"{S('engagement_count', 'total_engagements')}, {WER}, "
                             f"{A('views_per_day', 2, 'avg_views_per_day')}, "
                             f"{A('comments_per_1k_views', 2, 'avg_comments_per_1k_views')}, "
                             f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')}, "
                             f"{A('positive_comment_pct', 4, 'avg_positive_comment_pct')}, "
                             f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg GROUP BY content_type"),
        "q01_theme_perf": (f"SELECT message_theme, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                           f"{S('engagement_count', 'total_engagements')}, {WER}, "
                           f"{A('views_per_day', 2, 'avg_views_per_day')}, "
                           f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')}, "
                           f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg GROUP BY message_theme"),
        "q01_top_views": ("SELECT team, video_title, content_type, message_theme, published_date, view_count, "
                          "like_count_clean, comment_count_clean, engagement_count, "
                          "CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                          "CAST(round(CAST(avg_comment_sentiment AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_comment_sentiment "
                          "FROM stg ORDER BY view_count DESC NULLS LAST, video_id LIMIT 25"),
        "q01_top_engagement": ("SELECT team, video_title, content_type, message_theme, published_date, view_count, "
                               "engagement_count, CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                               "CAST(round(CAST(positive_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS positive_comment_pct, "
                               "CAST(round(CAST(negative_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS negative_comment_pct "
                               f"FROM stg WHERE view_count >= {p.min_views} "
                               "ORDER BY CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) DESC NULLS LAST, video_id LIMIT 25"),
        "q01_sentiment_team": (f"SELECT team, count(*) AS total_videos, "
                               f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')}, "
                               f"{A('positive_comment_pct', 4, 'avg_positive_comment_pct')}, "
                               f"{A('neutral_comment_pct', 4, 'avg_neutral_comment_pct')}, "
                               f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg GROUP BY team"),
        "q01_sentiment_content": (f"SELECT content_type, count(*) AS total_videos, "
                                  f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')}, "
                                  f"{A('positive_comment_pct', 4, 'avg_positive_comment_pct')}, "
                                  f"{A('neutral_comment_pct', 4, 'avg_neutral_comment_pct')}, "
                                  f"{A('negative_comment_pct', 4, 'avg_negative_comment_pct')} FROM stg GROUP BY content_type"),
        "q01_monitoring": ("SELECT team, video_title, content_type, message_theme, published_date, view_count, "
                           "CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                           "CAST(round(CAST(negative_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS negative_comment_pct, "
                           "CAST(round(CAST(avg_comment_sentiment AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_comment_sentiment, monitoring_priority "
                           f"FROM stg WHERE {not_std}"),
        "q01_hour_perf": (f"SELECT published_hour, count(*) AS total_videos, {S('view_count', 'total_views')}, "
                          f"{A('views_per_day', 2, 'avg_views_per_day')}, {WER}, "
                          f"{A('avg_comment_sentiment', 4, 'avg_comment_sentiment')} FROM stg "
                          f"GROUP BY published_hour HAVING count(*) >= {p.min_group}"),
        "q02_video_export": ("SELECT video_id, team, team_abbreviation, conference, channel_title, video_title, "
                             "published_date, published_hour, published_month, duration, content_type, message_theme, "
                             "view_count, like_count_clean, comment_count_clean, engagement_count, "
                             "CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                             "CAST(round(CAST(likes_per_1k_views AS DECIMAL(38,12)), 2) AS DOUBLE) AS likes_per_1k_views, "
                             "CAST(round(CAST(comments_per_1k_views AS DECIMAL(38,12)), 2) AS DOUBLE) AS comments_per_1k_views, "
                             "CAST(round(CAST(views_per_day AS DECIMAL(38,12)), 2) AS DOUBLE) AS views_per_day, comments_pulled, "
                             "CAST(round(CAST(avg_comment_sentiment AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_comment_sentiment, "
                             "CAST(round(CAST(positive_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS positive_comment_pct, "
                             "CAST(round(CAST(neutral_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS neutral_comment_pct, "
                             "CAST(round(CAST(negative_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS negative_comment_pct, "
                             "sentiment_bucket, monitoring_priority FROM stg"),
        "q02_monitoring_export": ("SELECT team, video_title, content_type, message_theme, published_date, view_count, "
                                  "engagement_count, CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                                  "CAST(round(CAST(views_per_day AS DECIMAL(38,12)), 2) AS DOUBLE) AS views_per_day, "
                                  "CAST(round(CAST(positive_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS positive_comment_pct, "
                                  "CAST(round(CAST(negative_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS negative_comment_pct, "
                                  "CAST(round(CAST(avg_comment_sentiment AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_comment_sentiment, monitoring_priority "
                                  f"FROM stg WHERE {not_std}"),
        "s06_monitoring": ("SELECT team, video_title, content_type, message_theme, published_date, view_count, "
                           "CAST(round(CAST(engagement_rate AS DECIMAL(38,12)), 4) AS DOUBLE) AS engagement_rate, "
                           "CAST(round(CAST(negative_comment_pct AS DECIMAL(38,12)), 4) AS DOUBLE) AS negative_comment_pct, "
                           "CAST(round(CAST(avg_comment_sentiment AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_comment_sentiment, monitoring_priority "
                           f"FROM stg WHERE {not_std}"),
        "qa_clean": ("SELECT count(*) AS total_videos, count(DISTINCT team) AS teams, "
                     "CAST(coalesce(sum(view_count), 0) AS BIGINT) AS total_views, "
                     "CAST(coalesce(sum(engagement_count), 0) AS BIGINT) AS total_engagements, "
                     f"{rnd(mean('engagement_rate'), 8)} AS avg_engagement_rate, "
                     f"{rnd(mean('avg_comment_sentiment'), 8)} AS avg_sentiment FROM stg"),
        "qa_types": "SELECT content_type, count(*) AS n FROM stg GROUP BY content_type",
        "qa_themes": "SELECT message_theme, count(*) AS n FROM stg GROUP BY message_theme",
        "qa_priorities": "SELECT monitoring_priority, count(*) AS n FROM stg GROUP BY monitoring_priority",
        "qa_fast": ("SELECT team, video_title, content_type, message_theme, view_count, views_per_day, engagement_rate, "
                    "negative_comment_pct, monitoring_priority FROM stg "
                    "ORDER BY views_per_day DESC NULLS LAST, video_id"),
        "cat_rowcount": "SELECT count(*) AS total_rows FROM stg",
        "feat_video_clean": f"SELECT {STAGED_SELECT} FROM stg",
    }
    return {k: on_stg(binding, v) for k, v in out.items()} if wrap else out


def raw_sql(binding: str) -> dict[str, str]:
    """Keys over the raw (pre-feature) tables."""
    out = {
        "qa_raw": ("SELECT count(*) AS total_videos, count(DISTINCT team) AS teams, "
                   "CAST(coalesce(sum(view_count), 0) AS BIGINT) AS total_views, "
                   "CAST(coalesce(sum(like_count), 0) AS BIGINT) AS total_likes, "
                   "CAST(coalesce(sum(comment_count), 0) AS BIGINT) AS total_comments, "
                   "count(*) FILTER (WHERE view_count IS NULL) AS missing_view_count, "
                   "count(*) FILTER (WHERE like_count IS NULL) AS missing_like_count, "
                   "count(*) FILTER (WHERE comment_count IS NULL) AS missing_comment_count FROM vr"),
        "qa_raw_list": ("SELECT team, video_title, published_at, view_count, like_count, comment_count, duration "
                        "FROM vr ORDER BY view_count DESC NULLS LAST, video_id"),
        "qa_count_by_team": "SELECT team, count(*) AS videos_collected FROM vr GROUP BY team",
    }
    return {k: on_stg(binding, v) for k, v in out.items()}


SHORT_CASE = ("CASE " + " ".join(f"WHEN monitoring_priority = {q(k)} THEN {q(v)}" for k, v in PRIORITY_SHORT.items())
              + " ELSE 'Standard' END")


def xsum(e: str) -> str:
    """A sheet's SUM of a double measure, published at 1e-10 resolution."""
    return rnd(f"sum({e})", 10)


WER_RAW = "CAST(sum(engagement_count) AS DOUBLE) / CAST(nullif(sum(view_count), 0) AS DOUBLE)"


def attr(e: str) -> str:
    return (f"CASE WHEN min(CAST({e} AS VARCHAR)) = max(CAST({e} AS VARCHAR)) THEN min(CAST({e} AS VARCHAR)) "
            f"WHEN min(CAST({e} AS VARCHAR)) IS NOT NULL THEN '*' END")


def dash_sql(binding: str, wrap: bool = True) -> dict[str, str]:
    p = PARAMS[binding]
    shares = ("positive_comment_pct", "neutral_comment_pct", "negative_comment_pct")
    flagged = ", ".join(q(x) for x in (PRIORITY_ENGAGEMENT, PRIORITY_BOTH, PRIORITY_NEGATIVE))
    short_order = ", ".join(q(x) for x in ("High Eng. + High Neg.", "High Neg. Sentiment", "High Engagement", "Standard"))
    mix_avgs = ", ".join(f"{smean(c)} AS avg_{c}" for c in shares)
    mix_refs = ", ".join(f"{rnd(f'avg(avg_{c}) OVER ()', 10)} AS ref_{c}" for c in shares)
    long_cases = " UNION ALL ".join(
        f"SELECT content_type, {q(c)} AS measure_name, CAST({i + 1} AS BIGINT) AS measure_order, {smean(c)} AS measure_value "
        f"FROM stg GROUP BY content_type" for i, c in enumerate(shares))
    pv_measures = ("view_count", "engagement_rate", "negative_comment_pct")
    pv_long = " UNION ALL ".join(
        f"SELECT video_title, monitoring_priority, team, {q(m)} AS measure_name, CAST({i + 1} AS BIGINT) AS measure_order, "
        f"CAST({m} AS DOUBLE) AS measure_value FROM pv" for i, m in enumerate(pv_measures))
    out = {
        "v_avg_sentiment": f"SELECT {smean('avg_comment_sentiment')} AS avg_comment_sentiment FROM stg",
        "v_neg_card": f"SELECT {smean('negative_comment_pct')} AS avg_negative_comment_pct FROM stg",
        "v_engagements_card": "SELECT CAST(sum(engagement_count) AS BIGINT) AS total_engagements FROM stg",
        "v_views_card": "SELECT CAST(sum(view_count) AS BIGINT) AS total_views FROM stg",
        "v_wer_card": f"SELECT {WER_RAW} AS weighted_engagement_rate FROM stg",
        "v_sentiment_mix": (f"SELECT content_type, {', '.join('avg_' + c for c in shares)}, {mix_refs} FROM "
                            f"(SELECT content_type, {mix_avgs} FROM stg GROUP BY content_type) g"),
        "v_sentiment_mix_long": long_cases,
        "v_neg_by_team": f"SELECT team, {smean('negative_comment_pct')} AS avg_negative_comment_pct FROM stg GROUP BY team",
        "v_neg_by_type": (f"SELECT content_type, {smean('negative_comment_pct')} AS avg_negative_comment_pct "
                          f"FROM stg GROUP BY content_type"),
        "v_discussion_by_type": (f"SELECT content_type, {smean('comments_per_1k_views')} AS avg_comments_per_1k_views "
                                 f"FROM stg GROUP BY content_type"),
        "v_views_by_type": (f"SELECT content_type, CAST(sum(view_count) AS BIGINT) AS total_views, "
                            f"count(video_id) AS n_videos, {xsum('avg_comment_sentiment')} AS sum_avg_comment_sentiment, "
                            f"{WER_RAW} AS weighted_engagement_rate, {attr('content_type')} AS attr_content_type "
                            f"FROM stg GROUP BY content_type"),
        "v_wer_by_type": (f"SELECT content_type, {WER_RAW} AS weighted_engagement_rate, "
                          f"CAST(sum(view_count) AS BIGINT) AS total_views, count(video_title) AS n_titles "
                          f"FROM stg GROUP BY content_type"),
        "v_views_by_theme": (f"SELECT message_theme, CAST(sum(view_count) AS BIGINT) AS total_views, "
                             f"count(video_title) AS n_titles, {WER_RAW} AS weighted_engagement_rate, "
                             f"{xsum('avg_comment_sentiment')} AS sum_avg_comment_sentiment "
                             f"FROM stg GROUP BY message_theme"),
        "v_views_by_team": "SELECT team, CAST(sum(view_count) AS BIGINT) AS total_views FROM stg GROUP BY team",
        "v_wer_by_team": f"SELECT team, {WER_RAW} AS weighted_engagement_rate FROM stg GROUP BY team",
        "v_views_by_day": ("SELECT CAST(published_at AS DATE) AS published_day, "
                           "CAST(sum(view_count) AS BIGINT) AS total_views, count(DISTINCT video_id) AS n_videos "
                           "FROM stg GROUP BY 1"),
        "v_priority_breakdown": (f"SELECT s, monitoring_priority, n_videos, "
                                 f"CAST(nullif(list_position([{short_order}], s), 0) AS BIGINT) AS sort_order FROM "
                                 f"(SELECT {SHORT_CASE} AS s, monitoring_priority, count(DISTINCT video_id) AS n_videos "
                                 f"FROM stg GROUP BY 1, 2) g").replace("SELECT s,", "SELECT s AS monitoring_priority_short,"),
        "v_priority_videos": (f", pv AS (SELECT video_title, monitoring_priority, team, "
                              f"CAST(sum(view_count) AS BIGINT) AS view_count, "
                              f"{xsum('engagement_rate')} AS engagement_rate, "
                              f"{xsum('negative_comment_pct')} AS negative_comment_pct "
                              f"FROM stg WHERE monitoring_priority IN ({flagged}) "
                              f"GROUP BY video_title, monitoring_priority, team) {pv_long}"),
        "v_scatter": (f", marks AS (SELECT monitoring_priority, video_id, "
                      f"{xsum('engagement_rate')} AS sum_engagement_rate, "
                      f"{xsum('negative_comment_pct')} AS sum_negative_comment_pct, "
                      f"CAST(sum(view_count) AS BIGINT) AS sum_view_count, {attr('video_title')} AS attr_video_title, "
                      f"{attr('team')} AS attr_team FROM stg GROUP BY monitoring_priority, video_id), "
                      f"ref AS (SELECT {smean('sum_engagement_rate')} AS ref_engagement_rate, "
                      f"{smean('sum_negative_comment_pct')} AS ref_negative_comment_pct FROM marks) "
                      f"SELECT * FROM marks, ref"),
        "v_top_videos": (f", top AS (SELECT video_title FROM stg GROUP BY video_title "
                         f"ORDER BY sum(view_count) DESC NULLS LAST, video_title ASC NULLS LAST LIMIT {p.top_titles}) "
                         f"SELECT video_title, team, CAST(sum(view_count) AS BIGINT) AS total_views, "
                         f"{WER_RAW} AS weighted_engagement_rate, "
                         f"{xsum('negative_comment_pct')} AS sum_negative_comment_pct, "
                         f"{smean('negative_comment_pct')} AS avg_negative_comment_pct "
                         f"FROM stg WHERE video_title IN (SELECT video_title FROM top) GROUP BY video_title, team"),
    }
    if not wrap:
        return {k: ("WITH " + v[2:] if v.startswith(", ") else v) for k, v in out.items()}
    res = {}
    for k, v in out.items():
        if v.startswith(", "):
            res[k] = f"WITH {staged_ctes(binding)}{v}"
        else:
            res[k] = on_stg(binding, v)
    return res


def operator_sql() -> dict[str, str]:
    from courtview.functions.text import NEWLINE_RUN
    from courtview.schemas import STAGED_COLUMNS
    cp, tp = COMMERCE_PARAMS, CONTENT_PARAMS
    content = "WITH " + CONTENT_RAW.format(lexicon=_lexicon_values(), clean=squish("comment_text")).strip() + "\n"
    commerce = "WITH " + COMMERCE_RAW.strip() + "\n"
    stg_all = f"SELECT {STAGED_SELECT} FROM stg"
    channels = ("SELECT n.n_name AS team, upper(substr(n.n_name, 1, 3)) AS team_abbreviation, r.r_name AS conference, "
                "CAST(row_number() OVER (PARTITION BY r.r_name ORDER BY n.n_nationkey) AS INTEGER) AS seed, "
                "'CH-' || CAST(n.n_nationkey AS VARCHAR) AS channel_id, n.n_name AS channel_name, "
                "coalesce(s.subscribers, 0) AS subscribers "
                "FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey "
                "LEFT JOIN (SELECT c_nationkey, count(*) AS subscribers FROM customer GROUP BY c_nationkey) s "
                "ON n.n_nationkey = s.c_nationkey")
    base = ("team, team_abbreviation, conference, channel_id, video_id, published_at, channel_title, video_title, "
            "video_description")
    newest = "strptime(published_at, '%Y-%m-%dT%H:%M:%SZ') DESC NULLS LAST, video_id"
    safe_cols = []
    for c in STAGED_COLUMNS:
        if c in ("video_id", "team", "team_abbreviation", "conference", "channel_id", "channel_title", "video_title",
                 "duration", "content_type", "message_theme", "sentiment_bucket", "monitoring_priority"):
            safe_cols.append(f"regexp_replace({c}, {q(NEWLINE_RUN)}, ' ', 'g') AS {c}")
        elif c == "video_description":
            safe_cols.append(f"{squish('regexp_replace(' + c + ', ' + q(NEWLINE_RUN) + ', ' + q(' ') + ', ' + q('g') + ')')} AS {c}")
        else:
            safe_cols.append(c)
    scored = (content + ", lab AS (SELECT *, " + label3("sentiment_score") + " AS sentiment_label FROM sc)\n")
    summ = (f"SELECT video_id, count(*) AS comments_pulled, CAST(sum(sentiment_score) AS DOUBLE) / count(*) "
            f"AS avg_comment_sentiment, CAST(count(*) FILTER (WHERE sentiment_score > 0.15) AS DOUBLE) / count(*) "
            f"AS positive_comment_pct, CAST(count(*) FILTER (WHERE sentiment_score BETWEEN -0.15 AND 0.15) AS DOUBLE) "
            f"/ count(*) AS neutral_comment_pct, CAST(count(*) FILTER (WHERE sentiment_score < -0.15) AS DOUBLE) "
            f"/ count(*) AS negative_comment_pct FROM sc GROUP BY video_id")
    rules = tp.content_rules[1:]
    doc_clean = squish("lower(text)")
    hits = ", ".join(f"regexp_matches({doc_clean}, {q(p)}) AS hit_{i}" for i, (_, p, _) in enumerate(rules, start=1))
    flagged = on_stg("commerce", "SELECT video_id, he AS high_engagement_flag, hn AS high_negative_sentiment_flag, "
                     "CASE WHEN he AND hn THEN " + q(PRIORITY_BOTH) + " WHEN hn THEN " + q(PRIORITY_NEGATIVE) +
                     " WHEN he THEN " + q(PRIORITY_ENGAGEMENT) + " ELSE " + q(PRIORITY_STANDARD) +
                     " END AS monitoring_priority FROM fl")
    q_rows = []
    for b in ("commerce", "content"):
        q_rows.append(f"SELECT '{b}' AS binding, {rnd('eng_t', 12)} AS engagement_p90, "
                      f"{rnd('neg_t', 12)} AS negative_p90 FROM thr")
    out = {
        "src_inline": f"SELECT * EXCLUDE (subscribers) FROM ({channels})",
        "src_csv": on_stg("commerce", stg_all),
        "src_csv_content": on_stg("content", stg_all),
        "exp_video_safe": on_stg("content", "SELECT " + ", ".join(safe_cols) + " FROM stg"),
        "src_typed_csv": on_stg("commerce", stg_all),
        "src_extract": on_stg("commerce", stg_all),
        "snk_table": on_stg("commerce", stg_all),
        "prj_clean_names": on_stg("commerce", stg_all),
        "prj_clean_captions": on_stg("commerce", "SELECT video_id, team AS equipe, conference AS teams_conf, channel_title AS conf_team, "
                                     "engagement_rate AS engagement_rate_percent, likes_per_1k_views AS x1k_views_likes, "
                                     "comments_pulled AS number_comments_pulled, published_month AS yyyy_month, published_hour AS video_id_2 FROM stg"),
        "json_channels": (f"SELECT channel_id AS checked_channel_id, CASE WHEN subscribers > 0 THEN channel_name END "
                          f"AS channel_title, CASE WHEN subscribers > 0 THEN CAST(subscribers AS DOUBLE) END "
                          f"AS subscriber_count, subscribers > 0 AS valid_channel FROM ({channels})"),
        "json_uploads_id": (f"SELECT channel_id, CASE WHEN subscribers > 0 THEN 'UU' || channel_id END "
                            f"AS uploads_playlist_id FROM ({channels})"),
        "json_channel_search": (f"SELECT conference AS query, channel_name AS channel_title, channel_id, "
                                f"team AS channel_description FROM (SELECT *, row_number() OVER (PARTITION BY "
                                f"conference ORDER BY channel_id) AS rn FROM ({channels})) WHERE rn <= 5"),
        "json_playlist_items": (commerce + f"SELECT channel_id, video_id, published_at, channel_title, video_title, "
                                f"video_description FROM (SELECT *, row_number() OVER (PARTITION BY channel_id "
                                f"ORDER BY {newest}) AS rn FROM vr) WHERE rn <= {cp.list_cap}"),
        "json_video_stats": commerce + "SELECT video_id, view_count, like_count, comment_count, duration FROM vr",
        "json_comments": (content + "SELECT video_id, comment_id, comment_text, comment_like_count, "
                          "CAST(NULL AS VARCHAR) AS comment_published_at FROM cm"),
        "unnest_nested": commerce + ("SELECT channel_id, CAST((row_number() OVER (ORDER BY channel_id, " + newest + ") - 1) "
                                     "// 50 AS BIGINT) AS page, video_id FROM vr"),
        "json_event_props": "SELECT event_id, TRY_CAST(json_extract_string(TRY_CAST(props AS JSON), '$.k') AS BIGINT) AS prop_k FROM events",
        "feat_windowed_build": ("WITH " + staged_ctes("commerce").replace(
            "\nsumm AS (", f"""
capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY {newest}) AS rn FROM vr) WHERE rn <= 100),
win AS (SELECT * FROM capped WHERE CAST(strptime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS DATE)
        BETWEEN DATE '{cp.start_date}' AND DATE '{cp.as_of}'),
vw AS (SELECT * EXCLUDE (rn, rn2) FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY {newest}) AS rn2 FROM win) WHERE rn2 <= 20),
summ AS (""", 1).replace("FROM vr v LEFT JOIN summ", "FROM vw v LEFT JOIN summ") + f"\nSELECT {', '.join(STAGED_COLUMNS)} FROM stg"),
        "fn_reference_rules": (f"SELECT doc_id, {rules_case('t', None, REFERENCE_CONTENT_RULES, REFERENCE_CONTENT_DEFAULT)} AS content_type, "
                               f"{rules_case('t', None, REFERENCE_THEME_RULES, REFERENCE_THEME_DEFAULT)} AS message_theme "
                               f"FROM (SELECT doc_id, {squish('lower(text)')} AS t FROM documents)"),
        "set_union": ("SELECT CAST(conv_id AS VARCHAR) AS video_id, CAST(conv_id AS VARCHAR) || '-' || "
                      "CAST(turn AS VARCHAR) AS comment_id, text AS comment_text, "
                      "CAST(NULL AS DECIMAL(9,4)) AS sentiment_score FROM conversations UNION ALL "
                      "SELECT CAST(l_orderkey AS VARCHAR), CAST(l_orderkey AS VARCHAR) || '-' || "
                      "CAST(l_linenumber AS VARCHAR), NULL, CAST((CAST(round(l_discount * 100) AS INTEGER) - 5) "
                      "* 0.05 AS DECIMAL(9,4)) FROM lineitem"),
        "win_topn_group": (commerce + f", capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "
                           f"channel_id ORDER BY {newest}) AS rn FROM vr) WHERE rn <= {cp.list_cap}), "
                           f"win AS (SELECT * FROM capped WHERE CAST(strptime(published_at, '%Y-%m-%dT%H:%M:%SZ') "
                           f"AS DATE) BETWEEN DATE '{cp.start_date}' AND DATE '{cp.as_of}') "
                           f"SELECT {base} FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY {newest}) "
                           f"AS rn2 FROM win) WHERE rn2 <= {cp.top_n_per_team}"),
        "win_cap_group": (commerce + f"SELECT {base} FROM (SELECT *, row_number() OVER (PARTITION BY channel_id "
                          f"ORDER BY {newest}) AS rn FROM vr) WHERE rn <= {cp.list_cap}"),
        "flt_daterange": (content + f"SELECT video_id, team, published_at FROM vr WHERE "
                          f"CAST(strptime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS DATE) BETWEEN "
                          f"DATE '{tp.start_date}' AND DATE '{tp.as_of}'"),
        "prj_id_batches": (commerce + f"SELECT CAST((rn - 1) // {cp.batch_size} + 1 AS BIGINT) AS batch, "
                           f"string_agg(video_id, ',' ORDER BY video_id) AS ids, count(*) AS n_ids FROM "
                           f"(SELECT video_id, row_number() OVER (ORDER BY video_id) AS rn FROM "
                           f"(SELECT DISTINCT video_id FROM vr WHERE video_id IS NOT NULL)) GROUP BY 1"),
        "flt_has_comments": commerce + "SELECT DISTINCT video_id FROM vr WHERE comment_count > 0",
        "prj_distinct_ids": content + "SELECT DISTINCT video_id FROM cm",
        "join_video_stats": commerce + f"SELECT {base}, view_count, like_count, comment_count, duration FROM vr",
        "srt_topn_members": on_stg("commerce", f"SELECT video_title, CAST(sum(view_count) AS BIGINT) AS total_views "
                                               f"FROM stg GROUP BY video_title ORDER BY sum(view_count) DESC NULLS LAST, "
                                               f"video_title LIMIT {cp.top_titles}"),
        "agg_count_distinct": on_stg("commerce", "SELECT conference, count(DISTINCT team) AS n_teams FROM stg "
                                                 "GROUP BY conference"),
        "agg_quantile": (f"SELECT * FROM ({on_stg('commerce', q_rows[0])}) UNION ALL "
                         f"SELECT * FROM ({on_stg('content', q_rows[1])})"),
        # the merged sketches are held to their error bound by exact counts; the bound itself has no SQL form
        "agg_quantile_sketch": " UNION ALL ".join(
            f"SELECT * FROM ({on_stg(b, f"SELECT '{b}' AS binding, '{c}' AS measure, count({c}) AS n, true AS within_bound FROM stg")})"
            for b in ("commerce", "content") for c in ("engagement_rate", "negative_comment_pct")),
        "feat_flags": flagged,
        "sent_score": content + "SELECT video_id, comment_id, CAST(sentiment_score AS DECIMAL(18,4)) AS sentiment_score FROM sc",
        "sent_label": scored + "SELECT video_id, comment_id, sentiment_label FROM lab",
        "comments_sentiment": (scored + "SELECT c.video_id, c.comment_id, c.comment_text, c.comment_like_count, "
                               "CAST(NULL AS VARCHAR) AS comment_published_at, v.team, v.team_abbreviation, v.conference, "
                               "v.channel_title, v.video_title, v.published_at, c.comment_text_clean, "
                               "CAST(c.sentiment_score AS DECIMAL(18,4)) AS sentiment_score, c.sentiment_label "
                               "FROM lab c JOIN vr v ON c.video_id = v.video_id WHERE v.comment_count > 0"),
        "sent_rollup": content + summ,
        "qa_labels": (scored + "SELECT sentiment_label, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) "
                      "OVER () AS pct FROM lab GROUP BY sentiment_label ORDER BY n DESC, sentiment_label"),
        "qa_negative": (content + f"SELECT * FROM ({summ}) ORDER BY negative_comment_pct DESC NULLS LAST, "
                        f"video_id"),
        "join_comment_video": (content + "SELECT c.video_id, c.comment_id, c.comment_text, c.comment_like_count, "
                               "CAST(NULL AS VARCHAR) AS comment_published_at, v.team, v.team_abbreviation, "
                               "v.conference, v.channel_title, v.video_title, v.published_at "
                               "FROM cm c JOIN vr v ON c.video_id = v.video_id WHERE v.comment_count > 0"),
        "fn_squish": f"SELECT doc_id, {squish('text')} AS text_squished FROM documents",
        "fn_lower": "SELECT doc_id, lower(text) AS text_lower FROM documents",
        "fn_strip_newlines": f"SELECT doc_id, regexp_replace(text, {q(NEWLINE_RUN)}, ' ', 'g') AS text_one_line FROM documents",
        "fn_html_decode": f"SELECT page_id, {html_decode('html')} AS html_decoded FROM pages",
        "fn_regex_detect": f"SELECT doc_id, {hits} FROM documents",
        "fn_date_parts": (f"SELECT event_id, pts AS published_at, CAST(pts AS DATE) AS published_date, "
                          f"CAST(hour(pts) AS INTEGER) AS published_hour, "
                          f"CAST(date_trunc('month', CAST(pts AS DATE)) AS DATE) AS published_month, "
                          f"CAST(date_diff('day', CAST(pts AS DATE), DATE '{tp.as_of}') AS INTEGER) AS days_since_published "
                          f"FROM (SELECT event_id, strptime(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') "
                          f"AS pts FROM events)"),
    }
    return out


def inventory_sql() -> dict[str, str]:
    from courtview.functions.text import NEWLINE_RUN
    from courtview.schemas import STAGED
    cp, tp = COMMERCE_PARAMS, CONTENT_PARAMS
    content_raw = "WITH " + CONTENT_RAW.format(lexicon=_lexicon_values(), clean=squish("comment_text")).strip() + "\n"
    commerce_raw = "WITH " + COMMERCE_RAW.strip() + "\n"
    rep_c, rep_t = report_sql("commerce", wrap=False), report_sql("content", wrap=False)
    base = ("team, team_abbreviation, conference, channel_id, video_id, published_at, channel_title, video_title, "
            "video_description")
    across = ", ".join(
        f"regexp_replace({f.name}, {q(NEWLINE_RUN)}, ' ', 'g') AS {f.name}" if f.dataType.typeName() == "string"
        else f.name for f in STAGED.fields)
    flagged = ", ".join(q(x) for x in (PRIORITY_ENGAGEMENT, PRIORITY_BOTH, PRIORITY_NEGATIVE))
    short_order = ", ".join(q(x) for x in ("High Eng. + High Neg.", "High Neg. Sentiment", "High Engagement",
                                          "Standard"))
    rank_case = (f"CASE WHEN monitoring_priority = {q(PRIORITY_BOTH)} THEN 1 WHEN monitoring_priority = "
                 f"{q(PRIORITY_NEGATIVE)} THEN 2 WHEN monitoring_priority = {q(PRIORITY_ENGAGEMENT)} THEN 3 ELSE 4 END")
    prio_case = (f"CASE WHEN he AND hn THEN {q(PRIORITY_BOTH)} WHEN hn THEN {q(PRIORITY_NEGATIVE)} "
                 f"WHEN he THEN {q(PRIORITY_ENGAGEMENT)} ELSE {q(PRIORITY_STANDARD)} END")
    channels = ("SELECT n.n_name AS team, upper(substr(n.n_name, 1, 3)) AS team_abbreviation, "
                "'CH-' || CAST(n.n_nationkey AS VARCHAR) AS channel_id, n.n_name AS channel_name, "
                "coalesce(s.subscribers, 0) AS subscribers FROM nation n LEFT JOIN "
                "(SELECT c_nationkey, count(*) AS subscribers FROM customer GROUP BY c_nationkey) s "
                "ON n.n_nationkey = s.c_nationkey")
    out = {
        "prj_select": commerce_raw + f"SELECT {base} FROM vr",
        "prj_across_str": on_stg("content", f"SELECT {across} FROM stg"),
        "prj_coalesce": content_raw + "SELECT video_id, coalesce(channel_title, team) AS channel_name FROM vr",
        "prj_fill": on_stg("content", "SELECT video_id, like_count, like_count_clean, comment_count, "
                                      "comment_count_clean, comments_pulled, avg_comment_sentiment, "
                                      "negative_comment_pct FROM stg"),
        "prj_preview": on_stg("content", rep_t["q00_preview"]),
        "flt_members": on_stg("commerce", f"SELECT video_id, monitoring_priority FROM stg "
                                          f"WHERE monitoring_priority IN ({flagged})"),
        "join_sentiment": on_stg("content", "SELECT video_id, comment_count, s_n AS comments_pulled, "
                                            "s_avg AS avg_comment_sentiment, s_neg AS negative_comment_pct FROM j"),
        "join_lexicon": content_raw + ("SELECT c.video_id, c.comment_id, CAST(h.score AS DECIMAL(18,4)) AS sentiment_score "
                                       "FROM hits h JOIN cm c ON h.rid = c.rid"),
        "semi_topn_members": on_stg("commerce", f"SELECT video_id, video_title, team FROM stg WHERE video_title IN "
                                                f"(SELECT video_title FROM stg GROUP BY video_title ORDER BY "
                                                f"sum(view_count) DESC NULLS LAST, video_title ASC NULLS LAST "
                                                f"LIMIT {cp.top_titles})"),
        "cross_scalar": on_stg("commerce", "SELECT video_id, engagement_rate >= eng_t AS at_or_above_eng, "
                                           "negative_comment_pct >= neg_t AS at_or_above_neg FROM feat, thr"),
        "agg_cond_share": on_stg("commerce", "SELECT video_id, positive_comment_pct, neutral_comment_pct, "
                                             "negative_comment_pct FROM summ"),
        "agg_missing": content_raw + ("SELECT count(*) FILTER (WHERE view_count IS NULL) AS missing_view_count, "
                                      "count(*) FILTER (WHERE like_count IS NULL) AS missing_like_count, "
                                      "count(*) FILTER (WHERE comment_count IS NULL) AS missing_comment_count, "
                                      "count(*) FILTER (WHERE published_at IS NULL) AS missing_published_at FROM vr"),
        "agg_weighted_rate": on_stg("commerce", f"SELECT conference, {WER} FROM stg GROUP BY conference"),
        "agg_attr": on_stg("commerce", f"SELECT video_title, {attr('team')} AS attr_team, "
                                       f"{attr('conference')} AS attr_conference FROM stg GROUP BY video_title"),
        "agg_count_sort": on_stg("commerce", "SELECT sentiment_bucket, count(*) AS n FROM stg GROUP BY 1"),
        "agg_having": on_stg("content", f"SELECT team, content_type, count(*) AS total_videos FROM stg "
                                        f"GROUP BY team, content_type HAVING count(*) >= {tp.min_group}"),
        "win_pct_total": on_stg("commerce", "SELECT content_type, count(*) AS n, CAST(count(*) AS DOUBLE) / "
                                            "CAST(sum(count(*)) OVER () AS DOUBLE) AS pct FROM stg GROUP BY 1"),
        "win_reference_avg": on_stg("commerce", "SELECT team, avg_negative_comment_pct, "
                                                f"{rnd('avg(avg_negative_comment_pct) OVER ()', 10)} AS "
                                                "ref_negative_comment_pct FROM (SELECT team, "
                                                f"{smean('negative_comment_pct')} AS avg_negative_comment_pct "
                                                "FROM stg GROUP BY team)"),
        "win_flag_quantile": on_stg("content", "SELECT video_id, he AS high_engagement_flag, "
                                               "hn AS high_negative_sentiment_flag FROM fl"),
        "srt_topk": on_stg("content", rep_t["q01_top_views"]),
        "srt_case_rank": on_stg("content", f"SELECT video_id, monitoring_priority, {rank_case} AS priority_rank, "
                                           f"view_count FROM stg WHERE monitoring_priority <> 'Standard'"),
        "srt_manual": on_stg("commerce", f"SELECT {SHORT_CASE} AS monitoring_priority_short, count(*) AS n, "
                                         f"CAST(nullif(list_position([{short_order}], {SHORT_CASE}), 0) AS BIGINT) "
                                         f"AS sort_order FROM stg GROUP BY 1"),
        "srt_by_measure": on_stg("commerce", "SELECT team, count(*) AS total_videos, CAST(row_number() OVER (ORDER BY "
                                             "sum(engagement_count) DESC NULLS LAST, team) AS INTEGER) AS sort_rank "
                                             "FROM stg GROUP BY team"),
        "srt_multi_qa": on_stg("content", rep_t["qa_fast"]),
        "fn_parse_ts": content_raw + ("SELECT video_id, published_at, CAST(strptime(published_at, "
                                      "'%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS published_ts FROM vr"),
        "fn_day_trunc": "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
        "fn_iso_bound": on_stg("content", "SELECT video_id, strftime(published_date, '%Y-%m-%d') || 'T00:00:00Z' "
                                          "AS day_start FROM stg"),
        "fn_try_numeric": content_raw + "SELECT video_id, CAST(view_count AS DOUBLE) / 4 AS view_count FROM vr",
        "fn_date_to_text": on_stg("content", "SELECT video_id, CAST(published_date AS VARCHAR) AS published_date_text, "
                                             "CAST(published_month AS VARCHAR) AS published_month_text FROM stg"),
        "fn_safe_ratio": on_stg("content", "SELECT video_id, engagement_rate, likes_per_1k_views, "
                                           "comments_per_1k_views FROM stg"),
        "fn_rate_per_day": on_stg("content", "SELECT video_id, view_count, views_per_day FROM stg"),
        "fn_round": on_stg("content", f"SELECT video_id, {rnd('engagement_rate', 4)} AS engagement_rate, "
                                      f"{rnd('views_per_day', 2)} AS views_per_day FROM stg"),
        "fn_label_3way": on_stg("content", "SELECT video_id, avg_comment_sentiment, sentiment_bucket FROM stg"),
        "fn_rules_first_match": on_stg("content", "SELECT video_id, duration, content_type, message_theme FROM stg"),
        "fn_recode": on_stg("commerce", f"SELECT video_id, monitoring_priority, {SHORT_CASE} AS "
                                        f"monitoring_priority_short FROM stg"),
        "fn_bool_combine": on_stg("content", f"SELECT video_id, he AS high_engagement_flag, "
                                             f"hn AS high_negative_sentiment_flag, {prio_case} AS monitoring_priority "
                                             f"FROM fl"),
        "feat_engagement": on_stg("commerce", "SELECT video_id, like_count_clean, comment_count_clean, "
                                              "engagement_count, engagement_rate, likes_per_1k_views, "
                                              "comments_per_1k_views, views_per_day FROM stg"),
        "feat_content_type": on_stg("commerce", "SELECT video_id, content_type FROM stg"),
        "feat_message_theme": on_stg("commerce", "SELECT video_id, message_theme FROM stg"),
        "feat_sentiment_bucket": on_stg("commerce", "SELECT video_id, sentiment_bucket FROM stg"),
        "feat_priority": on_stg("content", "SELECT video_id, monitoring_priority FROM stg"),
        "snk_csv": on_stg("commerce", rep_c["s06_monitoring"]),
        "qa_channels": (f"SELECT team, team_abbreviation, channel_id, CASE WHEN subscribers > 0 THEN channel_name END "
                        f"AS channel_title, CASE WHEN subscribers > 0 THEN CAST(subscribers AS DOUBLE) END AS "
                        f"subscriber_count, subscribers > 0 AS valid_channel FROM ({channels}) "
                        f"ORDER BY channel_id"),
    }
    return out


def extract_sql(binding: str = "commerce") -> dict[str, str]:
    """Long-form dashboard extracts: each sheet's statement, unpivoted measure by measure."""
    dash = dash_sql(binding, wrap=False)
    flagged = ", ".join(q(x) for x in (PRIORITY_ENGAGEMENT, PRIORITY_BOTH, PRIORITY_NEGATIVE))
    pv_wide = (f"SELECT video_title, monitoring_priority, team, CAST(sum(view_count) AS BIGINT) AS view_count, "
               f"{xsum('engagement_rate')} AS engagement_rate, "
               f"{xsum('negative_comment_pct')} AS negative_comment_pct FROM stg "
               f"WHERE monitoring_priority IN ({flagged}) GROUP BY video_title, monitoring_priority, team")
    content = {
        "views_by_type": (dash["v_views_by_type"], ["content_type"],
                          ["total_views", "n_videos", "sum_avg_comment_sentiment", "weighted_engagement_rate"]),
        "sentiment_mix": (dash["v_sentiment_mix"], ["content_type"],
                          [f"{a}_{c}" for a in ("avg", "ref") for c in ("positive_comment_pct", "neutral_comment_pct",
                                                                       "negative_comment_pct")]),
        "views_by_theme": (dash["v_views_by_theme"], ["message_theme"],
                           ["total_views", "n_titles", "weighted_engagement_rate", "sum_avg_comment_sentiment"]),
        "discussion_by_type": (dash["v_discussion_by_type"], ["content_type"], ["avg_comments_per_1k_views"]),
        "wer_by_type": (dash["v_wer_by_type"], ["content_type"], ["weighted_engagement_rate", "total_views", "n_titles"]),
    }
    monitoring = {
        "priority_breakdown": (dash["v_priority_breakdown"], ["monitoring_priority_short", "monitoring_priority"],
                               ["n_videos", "sort_order"]),
        "neg_by_team": (dash["v_neg_by_team"], ["team"], ["avg_negative_comment_pct"]),
        "scatter": (dash["v_scatter"], ["monitoring_priority", "video_id"],
                    ["sum_engagement_rate", "sum_negative_comment_pct", "sum_view_count", "ref_engagement_rate",
                     "ref_negative_comment_pct"]),
        "priority_videos": (pv_wide, ["video_title", "monitoring_priority", "team"],
                            ["view_count", "engagement_rate", "negative_comment_pct"]),
    }

    overview = {
        "avg_sentiment": (dash["v_avg_sentiment"], [], ["avg_comment_sentiment"]),
        "neg_card": (dash["v_neg_card"], [], ["avg_negative_comment_pct"]),
        "engagements_card": (dash["v_engagements_card"], [], ["total_engagements"]),
        "views_card": (dash["v_views_card"], [], ["total_views"]),
        "wer_card": (dash["v_wer_card"], [], ["weighted_engagement_rate"]),
        "views_by_team": (dash["v_views_by_team"], ["team"], ["total_views"]),
        "wer_by_team": (dash["v_wer_by_team"], ["team"], ["weighted_engagement_rate"]),
        "views_by_day": (dash["v_views_by_day"], ["published_day"], ["total_views", "n_videos"]),
    }

    def build(sheets: dict) -> str:
        parts = []
        for name, (sql, dims, measures) in sheets.items():
            mark = ("concat_ws('|', " + ", ".join(f"coalesce(CAST({d} AS VARCHAR), '')" for d in dims) + ")"
                    if dims else "''")
            for m in measures:
                parts.append(f"SELECT {q(name)} AS sheet, {mark} AS mark, {q(m)} AS measure_name, "
                             f"CAST({m} AS DOUBLE) AS measure_value, CAST(NULL AS VARCHAR) AS measure_text FROM ({sql}) s")
            for m in {"views_by_type": ["attr_content_type"], "scatter": ["attr_video_title", "attr_team"]}.get(name, []):
                parts.append(f"SELECT {q(name)}, {mark}, {q(m)}, CAST(NULL AS DOUBLE), {m} FROM ({sql}) s")
        return on_stg(binding, "\nUNION ALL\n".join(parts))

    return {"d_content": build(content), "d_monitoring": build(monitoring), "d_overview": build(overview)}
