"""DuckDB SQL that recomputes each registered query from the raw testdata views.

This is the independent side of the correctness gate: plain SQL over the
pre-registered views, written from the operator semantics, not generated from
the Spark plans. The fixed values (regex classes, thresholds, ranges) are the
same constants the Spark side uses.
"""

from __future__ import annotations

from murmur.functions import text as T
from murmur.operators import bots as B
from murmur.sources import fixtures as FX

WS = T.WS_RUN
EMO = T.EMOTION_PATTERN


def q(s: str) -> str:
    """Quote a Python string as a SQL literal."""
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------------------
# Fixture CTEs
# ---------------------------------------------------------------------------
def comments_cte(overlay: bool = True, name: str = "comments") -> str:
    made = ""
    if overlay:
        made = f"""
  UNION ALL
  SELECT doc_id + k * {FX.OVERLAY_OFFSET}, doc_id + {FX.OVERLAY_OFFSET},
         TIMESTAMP '{FX.OVERLAY_START}' + to_seconds({FX.OVERLAY_STEP_SEC} * k),
         CASE (doc_id // 10) % 3 WHEN 0 THEN repeat(split_part(text, ' ', 1) || ' ', 6)
                                 WHEN 1 THEN substr(text, 1, 120) ELSE text END, source
  FROM {name}_d, range(1, {FX.OVERLAY_COMMENTS + 1}) t(k) WHERE doc_id % 10 = 0"""
    return f"""{name}_d AS (
  SELECT d.doc_id, d.text, d.source, e.user_id, CAST(e.ts AS TIMESTAMP) AS ts
  FROM (SELECT *, doc_id * greatest(1, (SELECT count(*) FROM events) // (SELECT count(*) FROM documents)) AS eid
        FROM documents) d JOIN events e ON d.eid = e.event_id),
{name} AS (
  SELECT comment_id, comment_author_id, comment_published, comment_text, channel,
         strftime(comment_published, '%m%d') || '_' || strftime(comment_published, '%m%d') AS time_label
  FROM (SELECT doc_id AS comment_id, user_id AS comment_author_id, ts AS comment_published, text AS comment_text,
               source AS channel FROM {name}_d{made}))"""


def words_sql(t: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({t}, ''), {q(WS)}), lambda x: x <> '')"


def length_sql(t: str) -> str:
    return f"length(coalesce({t}, ''))"


def rep_sql(t: str) -> str:
    w = words_sql(t)
    return f"(CASE WHEN len({w}) > 0 THEN 1.0 - len(list_distinct({w})) / len({w}) ELSE 0.0 END)"


def ai_sql(t: str, single_var: float | None) -> str:
    tt = f"coalesce({t}, '')"
    seg = f"list_transform(list_filter(string_split({tt}, '.'), lambda x: length(x) > 0), lambda x: CAST(length(x) AS DOUBLE))"
    mean = f"(list_sum({seg}) / len({seg}))"
    var = f"(list_sum(list_transform({seg}, lambda x: (x - {mean}) * (x - {mean}))) / len({seg}))"
    fb = "NULL" if single_var is None else repr(float(single_var))
    a = f"coalesce(CAST((CASE WHEN len({seg}) > 1 THEN {var} ELSE {fb} END) < 50 AS DOUBLE), 0.0)"
    punct = f"(length({tt}) - length(regexp_replace({tt}, '[.!?]', '', 'g')))"
    dots = f"(length({tt}) - length(replace({tt}, '.', '')))"
    b = f"CAST({punct} / ({dots} + 1) > 0.8 AS DOUBLE)"
    c = f"CAST((NOT regexp_matches({tt}, {q(EMO)})) AND length({tt}) > 50 AS DOUBLE)"
    return f"(({a} + {b} + {c}) / 3.0)"


def measured_cte(variant: str) -> str:
    single_var, _ = B.VARIANTS[variant]
    return f"""measured AS (
  SELECT comment_author_id, comment_id,
         epoch_us(comment_published) - lag(epoch_us(comment_published))
            OVER (PARTITION BY comment_author_id ORDER BY comment_published, comment_id) AS gap_us,
         {length_sql('comment_text')} AS len,
         {rep_sql('comment_text')} AS rep,
         {ai_sql('comment_text', single_var)} AS ai
  FROM comments WHERE comment_published IS NOT NULL AND comment_author_id IS NOT NULL)"""


def exact_var_sql(x: str, n: str, ddof: int, scale: str = "1.0") -> str:
    """Variance from exact HUGEINT moments, converted once to double."""
    s1 = f"sum(CAST({x} AS HUGEINT))"
    s2 = f"sum(CAST({x} AS HUGEINT) * {x})"
    k = f"({s1} // {n})"
    m = f"CAST({s2} - 2 * {k} * {s1} + {n} * {k} * {k} AS DOUBLE)"
    r = f"CAST({s1} - {n} * {k} AS DOUBLE)"
    return f"({m} - {r} * {r} / CAST({n} AS DOUBLE)) / CAST({n} - {ddof} AS DOUBLE) / {scale}"


def raw_stats_cte() -> str:
    return f"""raw_stats AS (
  SELECT comment_author_id, count(*) AS comment_count,
         CASE WHEN count(gap_us) >= 2 THEN {exact_var_sql('gap_us', 'count(gap_us)', 0, '1e12')} END AS time_var_sec,
         CASE WHEN count(*) >= 2 THEN {exact_var_sql('len', 'count(*)', 1)} END AS length_var,
         sum(rep) / count(*) AS avg_rep_ratio, sum(ai) / count(*) AS avg_ai_prob
  FROM measured GROUP BY comment_author_id)"""


def stats_cte(variant: str) -> str:
    _, min_flags = B.VARIANTS[variant]
    return f"""filled AS (
  SELECT comment_author_id, coalesce(comment_count, 0) AS comment_count,
         coalesce(time_var_sec, 0) AS time_var_sec, coalesce(length_var, 0) AS length_var,
         coalesce(avg_rep_ratio, 0) AS avg_rep_ratio, coalesce(time_var_sec / 3600.0, 0) AS time_var_hr,
         coalesce(avg_ai_prob, 0) AS avg_ai_prob
  FROM raw_stats),
flagged AS (
  SELECT *,
    CAST(comment_count >= {B.MIN_COMMENTS_FOR_SPEED} AND time_var_hr < {B.MAX_TIME_VAR_HR} AS INTEGER) AS cond_speed,
    CAST(avg_ai_prob > {B.MIN_AI} AS INTEGER) AS cond_ai,
    CAST(length_var < {B.MAX_LEN_VAR} AS DOUBLE) * {B.LOW_VAR_WEIGHT}
      + CAST(avg_rep_ratio > {B.MIN_REP} AS DOUBLE) * {B.HIGH_REP_WEIGHT} AS suspicious_score,
    CAST(avg_rep_ratio > {B.MIN_REP} AS INTEGER) AS high_rep,
    CAST(length_var < {B.MAX_LEN_VAR} AS INTEGER) AS low_len_var
  FROM filled),
stats AS (
  SELECT comment_author_id, comment_count, time_var_sec, length_var, avg_rep_ratio, time_var_hr, avg_ai_prob,
         cond_speed, cond_ai, suspicious_score, CAST(suspicious_score > {B.MIN_SUSPICIOUS} AS INTEGER) AS cond_suspicious,
         high_rep, low_len_var,
         (cond_speed + cond_ai + CAST(suspicious_score > {B.MIN_SUSPICIOUS} AS INTEGER) + high_rep + low_len_var)
           >= {min_flags} AS is_bot
  FROM flagged)"""


def bot_chain(variant: str, overlay: bool = True) -> str:
    return ",\n".join([comments_cte(overlay), measured_cte(variant), raw_stats_cte(), stats_cte(variant)])


def rnd(expr: str, digits: int = 6) -> str:
    """Round like Spark's ``round`` on a double: HALF_UP on the shortest decimal
    repr (``round(x, 6)`` in DuckDB scales in binary first and can land on the
    other side of a tie for large magnitudes)."""
    return f"CAST(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def r6(expr: str, alias: str) -> str:
    return f"{rnd(expr)} AS {alias}"


TS_SQL = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def comment_cols(prefix: str = "") -> str:
    p = prefix
    return (f"{p}comment_id, {p}comment_author_id, {TS_SQL.format(c=p + 'comment_published')} AS comment_published, "
            f"{p}comment_text, {p}channel, {p}time_label")


STATS_SELECT = (
    "comment_author_id, CAST(comment_count AS BIGINT) AS comment_count, "
    + ", ".join(r6(c, c) for c in ["time_var_sec", "length_var", "avg_rep_ratio", "time_var_hr", "avg_ai_prob"])
    + ", CAST(cond_speed AS BIGINT) AS cond_speed, CAST(cond_ai AS BIGINT) AS cond_ai, "
    + r6("suspicious_score", "suspicious_score")
    + ", CAST(cond_suspicious AS BIGINT) AS cond_suspicious, CAST(high_rep AS BIGINT) AS high_rep, "
      "CAST(low_len_var AS BIGINT) AS low_len_var, is_bot"
)


def kept_sql(variant: str) -> str:
    return (f"WITH {bot_chain(variant)}\nSELECT {comment_cols('c.')} FROM comments c "
            "WHERE c.comment_published IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stats s "
            "WHERE s.is_bot AND s.comment_author_id = c.comment_author_id)")


ORACLE: dict[str, str] = {}


def _bots() -> None:
    O = ORACLE
    O["bot_news"] = f"WITH {bot_chain('news')}\nSELECT {STATS_SELECT} FROM stats"
    O["bot_video"] = f"WITH {bot_chain('video')}\nSELECT {STATS_SELECT} FROM stats"
    O["bot_flags"] = (f"WITH {bot_chain('news')}\nSELECT comment_author_id, CAST(cond_speed AS BIGINT) AS cond_speed, "
                      "CAST(cond_ai AS BIGINT) AS cond_ai, " + r6("suspicious_score", "suspicious_score")
                      + ", CAST(cond_suspicious AS BIGINT) AS cond_suspicious, CAST(high_rep AS BIGINT) AS high_rep, "
                      "CAST(low_len_var AS BIGINT) AS low_len_var FROM stats")
    O["bot_filter"] = kept_sql("news")
    O["drop_bot_authors"] = kept_sql("video")
    O["drop_helpers"] = (f"WITH {bot_chain('news')}\nSELECT count(*) AS kept_rows, count(DISTINCT c.comment_author_id) "
                         "AS kept_authors FROM comments c WHERE NOT EXISTS (SELECT 1 FROM stats s WHERE s.is_bot AND "
                         "s.comment_author_id = c.comment_author_id)")
    O["author_stats"] = (f"WITH {comments_cte()}, {measured_cte('news')}, {raw_stats_cte()}\n"
                         "SELECT comment_author_id, CAST(comment_count AS BIGINT) AS comment_count, "
                         + ", ".join(r6(c, c) for c in ["time_var_sec", "length_var", "avg_rep_ratio"])
                         + " FROM raw_stats")
    O["author_ai_mean"] = (f"WITH {comments_cte()}, {measured_cte('news')}, {raw_stats_cte()}\n"
                           "SELECT comment_author_id, " + r6("avg_ai_prob", "avg_ai_prob") + " FROM raw_stats")
    O["stats_x_ai"] = (f"WITH {bot_chain('news')}\nSELECT comment_author_id, CAST(comment_count AS BIGINT) AS comment_count, "
                       + ", ".join(r6(c, c) for c in ["time_var_sec", "length_var", "avg_rep_ratio", "time_var_hr",
                                                      "avg_ai_prob"]) + " FROM stats")
    O["unit_conv"] = (f"WITH {bot_chain('news')}\nSELECT comment_author_id, "
                      + r6("time_var_sec", "time_var_sec") + ", " + r6("time_var_hr", "time_var_hr") + " FROM stats")
    O["author_gap"] = (f"WITH {comments_cte()}, {measured_cte('news')}\n"
                       "SELECT comment_id, comment_author_id, " + r6("gap_us / 1e6", "gap_sec") + " FROM measured")
    O["text_length"] = (f"WITH {comments_cte()}\nSELECT comment_id, CAST({length_sql('comment_text')} AS BIGINT) "
                        "AS text_length FROM comments")
    O["repetition_ratio"] = (f"WITH {comments_cte()}\nSELECT comment_id, "
                             + r6(rep_sql('comment_text'), "repetition_ratio") + " FROM comments")
    O["ai_likeness"] = (f"WITH {comments_cte()}\nSELECT comment_id, "
                        + r6(ai_sql('comment_text', None), "ai_news") + ", "
                        + r6(ai_sql('comment_text', 0.0), "ai_video") + " FROM comments")
    O["drop_bad_ts"] = (f"WITH {comments_cte()}\nSELECT {comment_cols()} FROM comments "
                        "WHERE comment_published IS NOT NULL")
    O["sort_comments"] = (f"WITH {comments_cte()}\nSELECT {comment_cols()} FROM comments "
                          "ORDER BY comment_author_id NULLS LAST, comment_published, comment_id")


_bots()
