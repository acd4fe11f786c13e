"""Windows, stream-shaped joins, anomalies, duplicates and late rows over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.operators import anomaly, dedup, joins, quality, windows
from eventlake.plans import activity as plans
from eventlake.queries import feeds
from eventlake.queries.feeds import CLICKS, TXNS, plain_times

DAY_US = 86_400_000_000


def click_decode(spark, sf_dir):
    return plain_times(plans.clicks(feeds.click_messages(spark, sf_dir)).drop("referrer"))


def txn_decode(spark, sf_dir):
    return plain_times(plans.transactions(feeds.txn_messages(spark, sf_dir)))


def tumbling_counts(spark, sf_dir):
    rows = windows.tumbling_window(
        feeds.events(spark, sf_dir), "ts", "5 minutes", ["event_type"], {"*": "count"}
    )
    return plain_times(rows.withColumnRenamed("*_count", "row_count"))


def tumbling_stats(spark, sf_dir):
    """Every aggregation of the window operators, in daily windows."""
    rows = windows.tumbling_window(
        plans.clicks(feeds.click_messages(spark, sf_dir)), "event_time", "1 day", ["country"],
        [("*", "COUNT", "rows"), ("page_url", "count", "pages"), ("page_load_ms", "sum", "load_sum"),
         ("page_load_ms", "avg", "load_avg"), ("page_load_ms", "max", "load_max"),
         ("page_load_ms", "min", "load_min")],
    )
    return plain_times(rows.withColumn("load_avg", F.round("load_avg", 6)))


def sliding_counts(spark, sf_dir):
    """Page views per country and device, five minutes sliding by one."""
    rows = plans.page_views(plans.clicks(feeds.click_messages(spark, sf_dir)))
    return plain_times(rows.withColumn("avg_page_load_ms", F.round("avg_page_load_ms", 6)))


def hop_counts(spark, sf_dir):
    """The same operator with the argument order of SQL, an hour sliding by a quarter."""
    rows = windows.hop_window(
        plans.clicks(feeds.click_messages(spark, sf_dir)), "event_time", "15 minutes", "1 hour",
        ["device_type"], [("*", "count", "rows"), ("page_load_ms", "max", "load_max")],
    )
    return plain_times(rows)


def session_windows(spark, sf_dir):
    return plain_times(plans.user_sessions(plans.clicks(feeds.click_messages(spark, sf_dir))))


def session_windows_hot(spark, sf_dir):
    """Sessions per device type: few keys, each holding a fifth of all rows."""
    rows = windows.session_window(
        plans.clicks(feeds.click_messages(spark, sf_dir)), "event_time", "30 minutes",
        ["device_type"],
        [("*", "count", "rows"), ("page_load_ms", "avg", "load_avg"),
         ("page_load_ms", "max", "load_max")],
    )
    return plain_times(
        windows.with_session_seconds(rows).withColumn("load_avg", F.round("load_avg", 6))
    )


def _purchases_and_clicks(spark, sf_dir):
    base = feeds.events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", "value")
    return (
        base.where("event_type = 'purchase'").drop("event_type"),
        base.where("event_type = 'click'").drop("event_type"),
    )


def _pairs(spark, sf_dir, how):
    left, right = _purchases_and_clicks(spark, sf_dir)
    rows = joins.interval_join(left, right, "user_id", "ts", "ts", "12 hours", how)
    return plain_times(rows.select("event_id", "user_id", "ts", "r_event_id", "r_ts"))


def interval_join(spark, sf_dir):
    """Purchases with the clicks of their user in the twelve hours before."""
    return _pairs(spark, sf_dir, "inner")


def interval_join_left(spark, sf_dir):
    return _pairs(spark, sf_dir, "left")


def interval_join_right(spark, sf_dir):
    return _pairs(spark, sf_dir, "right_outer")


def interval_join_full(spark, sf_dir):
    return _pairs(spark, sf_dir, "outer")


def interval_join_hot(spark, sf_dir):
    """Errors with the signups of the ten minutes before, joined on one key for all rows."""
    base = feeds.events(spark, sf_dir).select("event_id", "event_type", "ts")
    base = base.withColumn("site", F.lit("main"))
    left = base.where("event_type = 'error'").drop("event_type")
    right = base.where("event_type = 'signup'").drop("event_type")
    rows = joins.interval_join(left, right, "site", "ts", "ts", "10 minutes")
    return rows.select("event_id", "r_event_id")


def _alert_columns(rows):
    return plain_times(rows.select(
        "txn_id", "user_id", "amount", "event_time", F.round("avg_amount", 6).alias("avg_amount"),
        F.round("std_amount", 6).alias("std_amount"), "txn_count",
        F.round("z_score", 6).alias("z_score"), "alert_type", "severity",
        F.array_join("user_targets", ",").alias("user_targets"),
    ))


def zscore_alerts(spark, sf_dir):
    """Amounts far from the user's own last 24 hours."""
    txns = plans.transactions(feeds.txn_messages(spark, sf_dir))
    return _alert_columns(plans.alerts(txns, frame="24 hours"))


def trailing_stats(spark, sf_dir):
    """The statistics behind the alerts, for every row and for few, heavy keys."""
    txns = plans.transactions(feeds.txn_messages(spark, sf_dir))
    rows = anomaly.trailing_stats(txns, "merchant", "amount", "event_time", "2 hours")
    # Means of cents over 32 or more rows can lie exactly between two roundings.
    return rows.select(
        "txn_id", F.round(F.col("avg_amount") + 1e-9, 6).alias("avg_amount"),
        F.round("std_amount", 6).alias("std_amount"), "txn_count",
    )


def zscore_alerts_windowed(spark, sf_dir):
    """Amounts far from the last closed 24-hour window, sliding by one hour."""
    txns = plans.transactions(feeds.txn_messages(spark, sf_dir))
    rows = anomaly.windowed_alerts(txns, size="24 hours", slide="1 hour")
    return _alert_columns(rows)


def dedup_first_per_window(spark, sf_dir):
    """Each user's events once per twelve hours since the last kept one."""
    rows = dedup.first_per_window(
        feeds.events(spark, sf_dir).drop("props"), "user_id", "ts", "12 hours", ["event_id"],
        windows_per_chunk=4,
    )
    return plain_times(rows)


def dedup_hot_keys(spark, sf_dir):
    """The same with five keys for all rows and a window of one hour."""
    rows = dedup.first_per_window(
        feeds.events(spark, sf_dir).select("event_type", "ts", "event_id"), "event_type", "ts",
        "1 hour", ["event_id"],
    )
    return plain_times(rows)


def _arrivals(spark, sf_dir):
    """Events out of order: each arrives up to a few hundred positions late."""
    arrival = F.col("event_id") + (F.col("event_id") * 7919) % 401
    return feeds.events(spark, sf_dir).select(
        "event_id", "ts", "user_id", (F.col("user_id") % 3).alias("source"),
        arrival.alias("arrival"),
    )


def late_events(spark, sf_dir):
    rows = dedup.with_lateness(
        _arrivals(spark, sf_dir), "ts", "source", ["arrival", "event_id"], "1 hour",
        chunk_rows=1_000,
    )
    return plain_times(rows.select("event_id", "source", "max_seen", "is_late"))


def out_of_orderness(spark, sf_dir):
    return dedup.out_of_orderness(
        _arrivals(spark, sf_dir), "ts", "source", ["arrival", "event_id"]
    )


def load_shed_sample(spark, sf_dir):
    """All errors and one in a hundred of the rest, chosen by the key itself."""
    rows = quality.shed_load(
        feeds.events(spark, sf_dir), F.col("event_type") == "error", F.col("event_id"), 1,
        hashed=False,
    )
    return rows.select("event_id", "event_type")


def load_shed_hashed(spark, sf_dir):
    """The same by a hash of the key."""
    rows = quality.shed_load(feeds.events(spark, sf_dir), F.col("event_type") == "error", F.col("event_id"))
    return rows.select("event_id", "event_type")


QUERIES = {
    f.__name__: f for f in (
        click_decode, txn_decode, tumbling_counts, tumbling_stats, sliding_counts, hop_counts,
        session_windows, session_windows_hot, interval_join, interval_join_left,
        interval_join_right, interval_join_full, interval_join_hot, zscore_alerts,
        trailing_stats, zscore_alerts_windowed, dedup_first_per_window, dedup_hot_keys,
        late_events, out_of_orderness, load_shed_sample, load_shed_hashed,
    )
}


def _sessions_sql(key: str, columns: str) -> str:
    return f"""WITH {CLICKS}, marked AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens
  FROM clicks WINDOW w AS (PARTITION BY {key} ORDER BY event_time)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY event_time) AS n FROM marked)
SELECT {key}, min(event_time) AS session_start, max(event_time) + INTERVAL 30 MINUTE AS session_end,
  {columns},
  CAST(floor(epoch_us(max(event_time) + INTERVAL 30 MINUTE) / 1000000)
    - floor(epoch_us(min(event_time)) / 1000000) AS BIGINT) AS session_duration_sec
FROM numbered GROUP BY {key}, n"""


def _pairs_sql(how: str) -> str:
    return f"""WITH l AS (SELECT * FROM events WHERE event_type = 'purchase'),
r AS (SELECT * FROM events WHERE event_type = 'click')
SELECT l.event_id, l.user_id, l.ts, r.event_id AS r_event_id, r.ts AS r_ts
FROM l {how} JOIN r ON l.user_id = r.user_id AND r.ts <= l.ts AND l.ts <= r.ts + INTERVAL 12 HOUR"""


def _dedup_sql(columns: str, key: str, hours: int) -> str:
    # Per key, hop from a kept row to the first row at least the window later.
    return f"""WITH RECURSIVE kept AS (
  SELECT {key} AS k, min(ts) AS t FROM events GROUP BY {key}
  UNION ALL
  SELECT k, (SELECT min(e.ts) FROM events e WHERE e.{key} = k AND e.ts >= t + INTERVAL {hours} HOUR)
  FROM kept WHERE t IS NOT NULL)
SELECT {columns} FROM events e JOIN (SELECT k, t FROM kept WHERE t IS NOT NULL) s
  ON e.{key} = s.k AND e.ts = s.t"""


_LABELS = """'anomalous_amount' AS alert_type, 'WARNING' AS severity, user_id || ',ops-team' AS user_targets"""
_Z = "(amount - avg_amount) / std_amount"
_SCORED = f"""SELECT txn_id, user_id, amount, event_time, round(avg_amount, 6) AS avg_amount,
  round(std_amount, 6) AS std_amount, txn_count, round({_Z}, 6) AS z_score, {_LABELS}
FROM scored WHERE std_amount > 0 AND txn_count >= 5 AND abs({_Z}) > 3"""
_SEEN = """arrivals AS (
  SELECT event_id, ts, user_id % 3 AS source, event_id + (event_id * 7919) % 401 AS arrival FROM events),
seen AS (SELECT *, max(ts) OVER (PARTITION BY source ORDER BY arrival, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_seen FROM arrivals)"""

SQL = {
    "load_shed_hashed": """SELECT event_id, event_type FROM events WHERE event_type = 'error'
  OR CAST('0x' || md5(CAST(event_id AS VARCHAR))[1:15] AS BIGINT) % 100 < 1""",
    "click_decode": f"""WITH {CLICKS}
SELECT user_id, 's' || user_id[2:] AS session_id, page_url, device_type, country, event_time,
  page_load_ms FROM clicks""",
    "txn_decode": f"WITH {TXNS} SELECT * FROM txns",
    "tumbling_counts": """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type,
  count(*) AS row_count FROM events GROUP BY ALL""",
    "tumbling_stats": f"""WITH {CLICKS}
SELECT time_bucket(INTERVAL 1 DAY, event_time) AS window_start,
  time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS window_end, country,
  count(*) AS rows, count(page_url) AS pages, CAST(sum(page_load_ms) AS BIGINT) AS load_sum,
  round(avg(page_load_ms), 6) AS load_avg, max(page_load_ms) AS load_max,
  min(page_load_ms) AS load_min FROM clicks GROUP BY ALL""",
    "sliding_counts": f"""WITH {CLICKS}, w AS (
  SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) - to_minutes(k) AS window_start
  FROM clicks, range(5) AS r(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, country, device_type,
  count(*) AS page_view_count, round(avg(page_load_ms), 6) AS avg_page_load_ms FROM w GROUP BY ALL""",
    "hop_counts": f"""WITH {CLICKS}, w AS (
  SELECT *, time_bucket(INTERVAL 15 MINUTE, event_time) - to_minutes(k * 15) AS window_start
  FROM clicks, range(4) AS r(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, device_type,
  count(*) AS rows, max(page_load_ms) AS load_max FROM w GROUP BY ALL""",
    "session_windows": _sessions_sql("user_id", "count(page_url) AS page_view_count"),
    "session_windows_hot": _sessions_sql(
        "device_type",
        "count(*) AS rows, round(avg(page_load_ms), 6) AS load_avg, max(page_load_ms) AS load_max",
    ),
    "interval_join": _pairs_sql("INNER"),
    "interval_join_left": _pairs_sql("LEFT"),
    "interval_join_right": _pairs_sql("RIGHT"),
    "interval_join_full": _pairs_sql("FULL"),
    "interval_join_hot": """SELECT l.event_id, r.event_id AS r_event_id FROM events l JOIN events r
  ON l.event_type = 'error' AND r.event_type = 'signup' AND r.ts <= l.ts
  AND l.ts <= r.ts + INTERVAL 10 MINUTE""",
    "zscore_alerts": f"""WITH {TXNS}, scored AS (
  SELECT *, avg(amount) OVER w AS avg_amount, stddev_samp(amount) OVER w AS std_amount,
    count(*) OVER w AS txn_count FROM txns
  WINDOW w AS (PARTITION BY user_id ORDER BY event_time
    RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))
{_SCORED}""",
    "trailing_stats": f"""WITH {TXNS}
SELECT txn_id, round(avg(amount) OVER w + 1e-9, 6) AS avg_amount,
  round(stddev_samp(amount) OVER w, 6) AS std_amount, count(*) OVER w AS txn_count FROM txns
WINDOW w AS (PARTITION BY merchant ORDER BY event_time
  RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
    "zscore_alerts_windowed": f"""WITH {TXNS}, spread AS (
  SELECT user_id, amount, time_bucket(INTERVAL 1 HOUR, event_time) + to_hours(k + 1) AS window_end
  FROM txns, range(24) AS r(k)),
stats AS (SELECT user_id, window_end, avg(amount) AS avg_amount, stddev_samp(amount) AS std_amount,
  count(*) AS txn_count FROM spread GROUP BY ALL),
scored AS (SELECT t.*, avg_amount, std_amount, txn_count FROM txns t JOIN stats s
  ON t.user_id = s.user_id AND t.event_time > s.window_end
  AND t.event_time <= s.window_end + INTERVAL 1 HOUR)
{_SCORED}""",
    "dedup_first_per_window": _dedup_sql(
        "e.event_id, e.ts, e.user_id, e.event_type, e.value", "user_id", 12),
    "dedup_hot_keys": _dedup_sql("e.event_type, e.ts, e.event_id", "event_type", 1),
    "late_events": f"""WITH {_SEEN}
SELECT event_id, source, max_seen, coalesce(ts < max_seen - INTERVAL 1 HOUR, false) AS is_late
FROM seen""",
    "out_of_orderness": f"""WITH {_SEEN}, lag AS (
  SELECT source, coalesce(greatest(epoch_us(max_seen) - epoch_us(ts), 0) // 1000, 0) AS ms FROM seen)
SELECT source, count(*) AS row_count, count(*) FILTER (ms > 0) AS out_of_order,
  quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms,
  quantile_disc(ms, 0.99) AS p99_ms, max(ms) AS max_ms FROM lag GROUP BY source""",
    "load_shed_sample": """SELECT event_id, event_type FROM events
WHERE event_type = 'error' OR event_id % 100 < 1""",
}
