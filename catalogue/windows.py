"""Window columns, plain and with their groups split over tasks."""

from catalogue.registry import query, result, step

# Values tie within a type; event_id never does. A mean may lie exactly between
# two rounded values, so it is moved off by a billionth first.
_KEYED = step("add_column", name="k", expression="cast(value as int)")
_FALLING = [{"column": "k", "desc": True}]
_UNIQUE = [{"column": "k", "desc": True}, {"column": "event_id"}]
_IN_TIME = [{"column": "ts"}, {"column": "event_id"}]

_ORACLE_KEYED = "WITH e AS (SELECT *, CAST(trunc(value) AS INTEGER) AS k FROM events) "


def _window(name, expression, partition_by=(), order_by=(), hot_rows=None):
    return step("window", name=name, expression=expression, partition_by=list(partition_by),
                order_by=list(order_by), hot_rows=hot_rows)


def _a_tenth(spark, sf_dir):
    """Rows a tenth of the events have, so that every event type is split."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").count() // 10


_RANKS = _ORACLE_KEYED + """
    SELECT event_id,
           CAST(row_number() OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST, event_id) AS INTEGER) AS place,
           CAST(rank() OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS INTEGER) AS rnk,
           CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS INTEGER) AS dense,
           CAST(ntile(7) OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST, event_id) AS INTEGER) AS tile,
           percent_rank() OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS pct,
           cume_dist() OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS cume
    FROM e
"""


def _ranks(spark, sf_dir, hot_rows):
    return result(
        spark, sf_dir, "events", _KEYED,
        _window("place", "row_number()", ["event_type"], _UNIQUE, hot_rows),
        _window("rnk", "rank()", ["event_type"], _FALLING, hot_rows),
        _window("dense", "dense_rank()", ["event_type"], _FALLING, hot_rows),
        _window("tile", "ntile(7)", ["event_type"], _UNIQUE, hot_rows),
        _window("pct", "percent_rank()", ["event_type"], _FALLING, hot_rows),
        _window("cume", "cume_dist()", ["event_type"], _FALLING, hot_rows),
        step("select", columns=["event_id", "place", "rnk", "dense", "tile", "pct", "cume"]),
    )


@query(_RANKS)
def window_rank(spark, sf_dir):
    return _ranks(spark, sf_dir, None)


@query(_RANKS)
def window_rank_split(spark, sf_dir):
    return _ranks(spark, sf_dir, _a_tenth(spark, sf_dir))


_NEIGHBOURS = """
    SELECT event_id,
           lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before,
           lead(event_id, 3, -1) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS third_after,
           first_value(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS opening,
           last_value(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS closing,
           nth_value(value, 5) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS fifth
    FROM events
"""


def _neighbours(spark, sf_dir, hot_rows):
    return result(
        spark, sf_dir, "events",
        _window("before", "lag(value)", ["event_type"], _IN_TIME, hot_rows),
        _window("third_after", "lead(event_id, 3, -1L)", ["event_type"], _IN_TIME, hot_rows),
        _window("opening", "first_value(value)", ["event_type"], _IN_TIME, hot_rows),
        _window("closing", "last_value(value)", ["event_type"], _IN_TIME, hot_rows),
        _window("fifth", "nth_value(value, 5)", ["event_type"], _IN_TIME, hot_rows),
        step("select", columns=["event_id", "before", "third_after", "opening", "closing", "fifth"]),
    )


@query(_NEIGHBOURS)
def window_lag(spark, sf_dir):
    return _neighbours(spark, sf_dir, None)


@query(_NEIGHBOURS)
def window_lag_split(spark, sf_dir):
    return _neighbours(spark, sf_dir, _a_tenth(spark, sf_dir))


# With an order the frame ends at the current row's ties.
_RUNNING = _ORACLE_KEYED + """
    SELECT event_id,
           round(sum(value) OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST), 2) AS total,
           count(*) OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS n,
           round(avg(value) OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) + 1e-9, 6) AS mean,
           min(event_id) OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS earliest,
           max(user_id) OVER (PARTITION BY event_type ORDER BY k DESC NULLS LAST) AS highest
    FROM e
"""


def _running(spark, sf_dir, hot_rows):
    return result(
        spark, sf_dir, "events", _KEYED,
        _window("total", "sum(value)", ["event_type"], _FALLING, hot_rows),
        _window("n", "count(*)", ["event_type"], _FALLING, hot_rows),
        _window("mean", "avg(value)", ["event_type"], _FALLING, hot_rows),
        _window("earliest", "min(event_id)", ["event_type"], _FALLING, hot_rows),
        _window("highest", "max(user_id)", ["event_type"], _FALLING, hot_rows),
        step("add_column", name="total", expression="round(total, 2)"),
        step("add_column", name="mean", expression="round(mean + 1e-9, 6)"),
        step("select", columns=["event_id", "total", "n", "mean", "earliest", "highest"]),
    )


@query(_RUNNING)
def window_running(spark, sf_dir):
    return _running(spark, sf_dir, None)


@query(_RUNNING)
def window_running_split(spark, sf_dir):
    return _running(spark, sf_dir, _a_tenth(spark, sf_dir))


@query("""
    SELECT event_id, round(sum(value) OVER (PARTITION BY user_id), 2) AS total,
           round(value / sum(value) OVER (PARTITION BY event_type), 8) AS share
    FROM events
""")
def window_whole_group(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        _window("total", "sum(value)", ["user_id"]),
        _window("share", "sum(value)", ["event_type"]),
        step("add_column", name="total", expression="round(total, 2)"),
        step("add_column", name="share", expression="round(value / share, 8)"),
        step("select", columns=["event_id", "total", "share"]),
    )


@query("""
    SELECT event_id, round(value - avg(value) OVER () + 1e-9, 6) AS off, count(*) OVER () AS n FROM events
""")
def window_global(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        _window("mean", "avg(value)"),
        _window("n", "count(*)"),
        step("add_column", name="off", expression="round(value - mean + 1e-9, 6)"),
        step("select", columns=["event_id", "off", "n"]),
    )


@query("""
    SELECT o_orderkey,
           CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place,
           round(sum(o_totalprice) OVER (ORDER BY o_totalprice DESC, o_orderkey), 2) AS upto
    FROM orders
""")
def window_global_order(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count() // 8
    order = [{"column": "o_totalprice", "desc": True}, {"column": "o_orderkey"}]
    return result(
        spark, sf_dir, "orders",
        _window("place", "row_number()", [], order, rows),
        _window("upto", "sum(o_totalprice)", [], order, rows),
        step("add_column", name="upto", expression="round(upto, 2)"),
        step("select", columns=["o_orderkey", "place", "upto"]),
    )


@query("""
    WITH c AS (SELECT event_id, event_type, max(CASE WHEN event_type = 'click' THEN ts END)
                      OVER (PARTITION BY user_id ORDER BY ts) AS click_ts FROM events)
    SELECT event_id, click_ts FROM c WHERE event_type = 'purchase'
""")
def join_as_of(spark, sf_dir):
    """The latest click of the same user at or before each purchase."""
    return result(
        spark, sf_dir, "events",
        _window("click_ts", "max(case when event_type = 'click' then ts end)", ["user_id"], ["ts"]),
        step("filter", condition="event_type = 'purchase'"),
        step("select", columns=["event_id", "click_ts"]),
    )


@query("""
    WITH d AS (SELECT event_type, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS day,
                      sum(value) AS total FROM events GROUP BY 1, 2)
    SELECT event_type, day,
           round(sum(total) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS three,
           round(max(total) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING), 2) AS peak,
           count(*) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS remaining
    FROM d
""")
def frames(spark, sf_dir):
    # Days are aggregated first, so a window group is as long as the calendar.
    return result(spark, sf_dir, "events", step("sql", query="""
        WITH d AS (SELECT event_type, datediff(CAST(ts AS DATE), DATE'2024-01-01') AS day, sum(value) AS total
                   FROM events GROUP BY 1, 2)
        SELECT event_type, day,
               round(sum(total) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS three,
               round(max(total) OVER (PARTITION BY event_type ORDER BY day RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING), 2) AS peak,
               count(*) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS remaining
        FROM d"""))
