"""Queries over the events, conversations and orders tables: calls, presence, labels, eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import text as tx
from tidewell.operators import calls
from tidewell.sources.tables import table

SHIFT = ("08:00", "20:00")
GAP_MINUTES = 60.0
NAMES = {"by": "user_id", "start": "ts", "seconds": "value", "ident": "event_id"}


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


def call_gaps(spark: SparkSession, d: str) -> DataFrame:
    return calls.call_gaps(_events(spark, d), GAP_MINUTES, **NAMES).select("event_id", "user_id", F.bround("gap_seconds", 2).alias("gap_seconds"))


GAPS_SQL = """
WITH g AS (SELECT event_id, user_id, ts, value, lag(ts) OVER w AS p, lag(value) OVER w AS pv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
x AS (SELECT *, (epoch_us(ts) - epoch_us(p)) / 1e6 - pv AS gap FROM g)
"""


def _alerts(spark: SparkSession, d: str) -> DataFrame:
    """Gaps in the shift, errors as offline alerts and signups as idle alerts, one row each."""
    gaps = calls.shift_gaps(_events(spark, d), GAP_MINUTES, SHIFT, **NAMES).select("day", F.col("user_id").alias("who"), F.lit("gap").alias("kind"), F.bround(F.col("gap_seconds") / 60, 1).alias("minutes"))
    told = _events(spark, d).filter(F.col("event_type").isin("error", "signup") & tx.in_shift(F.col("ts"), *SHIFT))
    told = told.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("user_id").alias("who"), F.when(F.col("event_type") == "error", "offline").otherwise("idle").alias("kind"), F.lit(None).cast("double").alias("minutes"))
    return gaps.unionByName(told)


def _logouts(spark: SparkSession, d: str) -> DataFrame:
    polls = _events(spark, d).select(F.col("user_id").alias("extension"), F.col("ts").alias("at"), F.when(F.col("event_type") != "view", F.col("event_type") != "error").alias("online"))
    return calls.logout_sessions(polls, shift=SHIFT)


def logout_sessions(spark: SparkSession, d: str) -> DataFrame:
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return _logouts(spark, d).select("extension", "day", us("out_at").alias("out_us"), us("back_at").alias("back_us"))


LOGOUT_CTE = f"""
poll AS (SELECT user_id, ts, event_type <> 'error' AS online FROM events WHERE event_type <> 'view'),
lo AS (SELECT user_id, ts, online, lag(online) OVER w AS before, lag(strftime(ts, '%Y-%m-%d')) OVER w AS day_before,
              min(CASE WHEN online THEN ts END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS back
       FROM poll WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
out AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, ts, back FROM lo
        WHERE before AND NOT online AND day_before = strftime(ts, '%Y-%m-%d') AND strftime(ts, '%H:%M') BETWEEN '{SHIFT[0]}' AND '{SHIFT[1]}')
"""


def daily_summary(spark: SparkSession, d: str) -> DataFrame:
    """Gaps, alerts and log-outs of each operator and day: the flagship report."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    away = _logouts(spark, d).select("day", F.col("extension").alias("who"), F.bround((us("back_at") - us("out_at")) / 60e6, 0).alias("minutes"))
    out = calls.daily_summary(_alerts(spark, d), away)
    rounded = [F.bround(F.col(c).cast("decimal(18,1)"), 1).cast("double").alias(c) for c in ("longest", "lost", "away")]
    return out.select("day", "who", "offline", "idle", "gaps", "logouts", "open", *rounded, "longest_text")


SUMMARY_SQL = f"""
{GAPS_SQL}, {LOGOUT_CTE},
al AS (SELECT strftime(p, '%Y-%m-%d') AS day, user_id AS who, 'gap' AS kind, round_even(gap / 60, 1) AS minutes FROM x
       WHERE gap > {GAP_MINUTES * 60} AND strftime(p, '%H:%M') BETWEEN '{SHIFT[0]}' AND '{SHIFT[1]}'
       UNION ALL SELECT strftime(ts, '%Y-%m-%d'), user_id, CASE WHEN event_type = 'error' THEN 'offline' ELSE 'idle' END, NULL FROM events
       WHERE event_type IN ('error', 'signup') AND strftime(ts, '%H:%M') BETWEEN '{SHIFT[0]}' AND '{SHIFT[1]}'),
a AS (SELECT day, who, count_if(kind = 'offline') AS offline, count_if(kind = 'idle') AS idle, count_if(kind = 'gap') AS gaps,
             max(minutes) AS longest, sum(minutes::DECIMAL(18,1)) AS lost FROM al GROUP BY 1, 2),
l AS (SELECT day, user_id AS who, count(*) AS logouts, sum(round_even((epoch_us(back) - epoch_us(ts)) / 60e6, 0)) AS away, bool_or(back IS NULL) AS open FROM out GROUP BY 1, 2),
j AS (SELECT coalesce(a.day, l.day) AS day, coalesce(a.who, l.who) AS who, coalesce(offline, 0)::BIGINT AS offline, coalesce(idle, 0)::BIGINT AS idle,
             coalesce(gaps, 0)::BIGINT AS gaps, coalesce(logouts, 0)::BIGINT AS logouts, coalesce(open, false) AS open, coalesce(longest, 0)::DOUBLE AS longest,
             coalesce(lost, 0)::DOUBLE AS lost, coalesce(away, 0)::DOUBLE AS away FROM a FULL JOIN l ON a.day = l.day AND a.who = l.who)
SELECT *, CASE WHEN longest = 0 THEN '' WHEN round_even(longest, 0) >= 60
    THEN printf('%d h %02d min', round_even(longest, 0)::INT // 60, round_even(longest, 0)::INT % 60) ELSE printf('%d min', round_even(longest, 0)::INT) END AS longest_text
FROM j
"""


def new_gap_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Gap alerts not told before; those told are the ones that ended with a purchase or a click."""
    found = calls.call_gaps(_events(spark, d), GAP_MINUTES, **NAMES)
    seen = _events(spark, d).filter(F.col("event_type").isin("purchase", "click")).select("event_id")
    return calls.unseen(found, seen, "event_id").select("event_id", "user_id")


def outcome_labels(spark: SparkSession, d: str) -> DataFrame:
    """The label of every order read as a call: status as interest, year part as months, priority as booking."""
    o = table(spark, d, "orders")
    months = F.when(F.col("o_orderkey") % 7 != 0, F.month("o_orderdate").cast("double"))
    label = tx.outcome_label(F.col("o_orderstatus") != "F", months, F.substring("o_orderpriority", 1, 1).isin("1", "2"))
    return o.groupBy(label.alias("outcome")).agg(F.count("*").alias("n"))


OUTCOME_SQL = """
WITH f AS (SELECT o_orderstatus <> 'F' AS i, CASE WHEN o_orderkey % 7 <> 0 THEN month(o_orderdate)::DOUBLE END AS m, o_orderpriority[1] IN ('1', '2') AS b FROM orders)
SELECT CASE WHEN NOT coalesce(i, false) THEN 'none' WHEN m IS NULL THEN 'needs_arrival_date' WHEN b AND m < 4 THEN 'qualified_appointment' WHEN b AND m <= 6 THEN 'engagement_appointment'
            WHEN b THEN 'follow_up_appointment' WHEN m < 4 THEN 'needs_review' WHEN m <= 6 THEN 'engagement' ELSE 'follow_up' END AS outcome, count(*) AS n
FROM f GROUP BY 1
"""


def attempt_categories(spark: SparkSession, d: str) -> DataFrame:
    """Categories of all turns of conversations and all documents' texts, by first category and number of hits."""
    notes = table(spark, d, "conversations").select("text").union(table(spark, d, "documents").select("text"))
    return notes.select(tx.attempt_categories(F.coalesce("text", F.lit(""))).alias("c")).groupBy(F.get("c", 0).alias("category"), F.size("c").cast("bigint").alias("hits")).agg(F.count("*").alias("n"))


def _attempt_sql() -> str:
    each = ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{c}' END" for c, p in tx.ATTEMPT_RULES)
    return f"""
WITH t AS (SELECT lower(coalesce(text, '')) AS t FROM (SELECT text FROM conversations UNION ALL SELECT text FROM documents)),
h AS (SELECT t, list_filter([{each}], lambda x: x IS NOT NULL) AS h FROM t),
c AS (SELECT CASE WHEN contains(t, 'respond well') OR len(h) = 0 THEN ['other'] ELSE h END AS c FROM h)
SELECT c[1] AS category, len(c)::BIGINT AS hits, count(*) AS n FROM c GROUP BY 1, 2
"""


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    out = calls.transcripts(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"))
    return out.select("conv_id", F.md5(F.encode("transcript", "UTF-8")).alias("transcript_md5"), "answered")


TRANSCRIPT_SQL = """
SELECT conv_id, md5(t) AS transcript_md5, length(trim(t)) > 40 AS answered
FROM (SELECT conv_id, string_agg(concat_ws(': ', role, text), chr(10) ORDER BY turn, concat_ws(': ', role, text)) AS t FROM conversations GROUP BY 1)
"""


def campaign_state(spark: SparkSession, d: str) -> DataFrame:
    """The state of every customer after all orders, read as calls."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", "none").otherwise("qualified_appointment").alias("outcome"), (F.col("o_totalprice") > 50_000).alias("answered"))
    return calls.after_calls(rows, "o_custkey", "o_orderkey", "outcome", "answered")


STATE_SQL = """
WITH l AS (SELECT o_custkey, count(*) AS attempts_total, max(o_orderkey) AS k FROM orders GROUP BY 1)
SELECT l.o_custkey, attempts_total, CASE WHEN o_orderstatus = 'F' THEN 'none' ELSE 'qualified_appointment' END AS last_outcome,
       CASE WHEN o_totalprice > 50000 AND o_orderstatus <> 'F' THEN 'done' WHEN o_totalprice <= 50000 THEN 'pending' ELSE 'calling' END AS status
FROM l JOIN orders o ON o.o_orderkey = l.k
"""


def eligible_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers who may still be called: status, calls of their last day, and different priorities as contacts tried."""
    o = table(spark, d, "orders")
    per = o.groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"), F.max(F.to_date("o_orderdate")).alias("last"), F.collect_set("o_orderpriority").alias("tried")
    )
    today = o.join(per.select("o_custkey", "last"), "o_custkey").filter(F.to_date("o_orderdate") == F.col("last")).groupBy("o_custkey").agg(F.count("*").alias("today"))
    status = F.when(F.col("s") == "F", "done").otherwise("pending")
    return per.join(today, "o_custkey").filter(calls.eligible(status, F.col("today"), F.col("tried"), 2, 5)).select("o_custkey", "today", F.size("tried").cast("bigint").alias("contacts"))


ELIGIBLE_SQL = """
WITH p AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s, max(o_orderdate::DATE) AS last, count(DISTINCT o_orderpriority) AS contacts FROM orders GROUP BY 1),
t AS (SELECT o.o_custkey, count(*) AS today FROM orders o JOIN p USING (o_custkey) WHERE o_orderdate::DATE = last GROUP BY 1)
SELECT o_custkey, today, contacts FROM p JOIN t USING (o_custkey) WHERE s <> 'F' AND today < 2 AND contacts < 5
"""


QUERIES = {
    "daily_summary": (daily_summary, SUMMARY_SQL),
    "call_gaps": (call_gaps, GAPS_SQL + f"SELECT event_id, user_id, round_even(gap, 2) AS gap_seconds FROM x WHERE gap > {GAP_MINUTES * 60}"),
    "new_gap_alerts": (new_gap_alerts, GAPS_SQL + f"SELECT event_id, user_id FROM x WHERE gap > {GAP_MINUTES * 60} AND event_id NOT IN (SELECT event_id FROM events WHERE event_type IN ('purchase', 'click'))"),
    "logout_sessions": (logout_sessions, f"WITH {LOGOUT_CTE} SELECT user_id AS extension, day, epoch_us(ts) AS out_us, epoch_us(back) AS back_us FROM out"),
    "outcome_labels": (outcome_labels, OUTCOME_SQL),
    "attempt_categories": (attempt_categories, _attempt_sql()),
    "transcripts": (transcripts, TRANSCRIPT_SQL),
    "campaign_state": (campaign_state, STATE_SQL),
    "eligible_customers": (eligible_customers, ELIGIBLE_SQL),
}
