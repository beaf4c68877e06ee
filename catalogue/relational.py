"""Projections, joins, aggregation and what SQL text reaches."""

from catalogue.registry import query, result, step

_CUSTKEY = [
    step("rename", source="orders", mapping={"o_custkey": "custkey"}),
    step("rename", source="customer", mapping={"c_custkey": "custkey"}),
]


@query("""
    SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice > 100000
    GROUP BY c_mktsegment
""")
def segment_revenue(spark, sf_dir):
    return result(
        spark, sf_dir, "orders customer",
        step("filter", condition="o_totalprice > 100000"),
        *_CUSTKEY,
        step("join", right="customer", on="custkey"),
        step("aggregate", group_by=["c_mktsegment"],
             aggs={"orders": "count(*)", "revenue": "round(sum(o_totalprice), 2)"}),
    )


@query("""
    SELECT l_shipdate, l_orderkey, l_quantity FROM lineitem
    WHERE l_quantity > 25 AND l_returnflag = 'R'
""")
def filter_select(spark, sf_dir):
    return result(
        spark, sf_dir, "lineitem",
        step("filter", condition="l_quantity > 25 and l_returnflag = 'R'"),
        step("select", columns=["l_shipdate", "l_orderkey", "l_quantity"]),
    )


@query("SELECT p_partkey, p_type AS p_name, p_name AS p_type, p_size, p_retailprice FROM part")
def drop_rename_swap(spark, sf_dir):
    return result(
        spark, sf_dir, "part",
        step("drop_columns", columns=["p_brand", "no_such_column"]),
        step("rename", mapping={"p_name": "p_type", "p_type": "p_name"}),
    )


@query("""
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
           round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross,
           l_quantity * 2 AS l_quantity
    FROM lineitem
""")
def add_column_expr(spark, sf_dir):
    return result(
        spark, sf_dir, "lineitem",
        step("add_column", name="net", expression="round(l_extendedprice * (1 - l_discount), 4)"),
        step("add_column", name="gross", expression="round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6)"),
        step("add_column", name="l_quantity", expression="l_quantity * 2"),
        step("select", columns=["l_orderkey", "l_linenumber", "net", "gross", "l_quantity"]),
    )


@query("""
    SELECT o_orderpriority, count(*) AS n, min(o_totalprice) AS lowest
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority
""")
def sql_step_rebound_view(spark, sf_dir):
    return result(
        spark, sf_dir, "orders",
        step("filter", condition="o_orderstatus <> 'P'"),
        step("sql", query="SELECT o_orderpriority, count(*) AS n, min(o_totalprice) AS lowest"
                          " FROM orders GROUP BY o_orderpriority"),
    )


# Joins. Customers are filtered so that there are orders without a partner; for joins that
# keep customers without an order, dear orders are taken. The
# order's key is text, so that NULLs among numbers compare alike everywhere.

_DEAR = [step("filter", source="orders", condition="o_totalprice > 250000")]
_SIDES = [
    *_CUSTKEY,
    step("filter", source="customer", condition="c_acctbal > 0"),
    step("add_column", source="orders", name="o_orderkey", expression="cast(o_orderkey as string)"),
    step("select", source="orders", columns=["custkey", "o_orderkey"]),
    step("select", source="customer", columns=["custkey", "c_mktsegment"]),
]

_ORACLE_SIDES = """
    WITH o AS (SELECT o_custkey AS custkey, CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders),
         c AS (SELECT c_custkey AS custkey, c_mktsegment FROM customer WHERE c_acctbal > 0)
"""


_ORACLE_DEAR = _ORACLE_SIDES.replace("FROM orders)", "FROM orders WHERE o_totalprice > 250000)")


def _joined(spark, sf_dir, how, first=(), **settings):
    return result(
        spark, sf_dir, "orders customer", *first, *_SIDES, step("join", right="customer", on="custkey", how=how, **settings)
    )


@query(_ORACLE_SIDES + "SELECT custkey, o_orderkey, c_mktsegment FROM o JOIN c USING (custkey)")
def join_inner(spark, sf_dir):
    return _joined(spark, sf_dir, "inner")


@query(_ORACLE_SIDES + "SELECT custkey, o_orderkey, c_mktsegment FROM o LEFT JOIN c USING (custkey)")
def join_left(spark, sf_dir):
    return _joined(spark, sf_dir, "left")


@query(_ORACLE_DEAR + "SELECT c.custkey, o_orderkey, c_mktsegment FROM o RIGHT JOIN c ON o.custkey = c.custkey")
def join_right(spark, sf_dir):
    return _joined(spark, sf_dir, "right_outer", _DEAR)


_FULL = """SELECT coalesce(o.custkey, c.custkey) AS custkey, o_orderkey, c_mktsegment
           FROM o FULL JOIN c ON o.custkey = c.custkey"""


@query(_ORACLE_DEAR + _FULL)
def join_full(spark, sf_dir):
    return _joined(spark, sf_dir, "full", _DEAR)


@query(_ORACLE_SIDES + "SELECT custkey, o_orderkey FROM o WHERE custkey IN (SELECT custkey FROM c)")
def join_semi(spark, sf_dir):
    return _joined(spark, sf_dir, "left_semi")


@query(_ORACLE_SIDES + "SELECT custkey, o_orderkey FROM o WHERE custkey NOT IN (SELECT custkey FROM c)")
def join_anti(spark, sf_dir):
    return _joined(spark, sf_dir, "left_anti")


@query("""
    SELECT n_regionkey AS regionkey, n_nationkey, n_name, r_name
    FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def join_cross_keyed(spark, sf_dir):
    return result(
        spark, sf_dir, "nation region",
        step("rename", source="nation", mapping={"n_regionkey": "regionkey"}),
        step("rename", source="region", mapping={"r_regionkey": "regionkey"}),
        step("join", right="region", on="regionkey", how="cross"),
    )


# The same joins with keys split off that have more rows than usual.

@query(_ORACLE_DEAR + "SELECT c.custkey, o_orderkey, c_mktsegment FROM o RIGHT JOIN c ON o.custkey = c.custkey")
def join_right_hot_keys(spark, sf_dir):
    return _joined(spark, sf_dir, "right", _DEAR, hot_rows=6)


@query(_ORACLE_DEAR + _FULL)
def join_full_hot_keys(spark, sf_dir):
    return _joined(spark, sf_dir, "full", _DEAR, hot_rows=6)


@query("""
    WITH l AS (SELECT l_suppkey AS suppkey, l_linestatus AS status, count(*) AS kept FROM lineitem
               WHERE l_returnflag <> 'R' GROUP BY 1, 2),
         r AS (SELECT l_suppkey AS suppkey, l_linestatus AS status, count(*) AS returned FROM lineitem
               WHERE l_returnflag = 'R' GROUP BY 1, 2)
    SELECT suppkey, status, kept, returned FROM l JOIN r USING (suppkey, status)
""")
def join_two_keys(spark, sf_dir):
    keys = {"l_suppkey": "suppkey", "l_linestatus": "status"}
    return result(
        spark, sf_dir, "lineitem",
        step("rename", output="lines", mapping=keys),
        step("filter", source="lines", output="r", condition="l_returnflag = 'R'"),
        step("filter", source="lines", output="l", condition="l_returnflag <> 'R'"),
        step("aggregate", source="r", group_by=["suppkey", "status"], aggs={"returned": "count(*)"}),
        step("aggregate", source="l", group_by=["suppkey", "status"], aggs={"kept": "count(*)"}),
        step("join", left="l", right="r", on=["suppkey", "status"], output="lineitem"),
    )


# Aggregation

@query("""
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_net,
           round(avg(l_discount) + 1e-9, 6) AS avg_disc, count(*) AS n, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def agg_group(spark, sf_dir):
    return result(
        spark, sf_dir, "lineitem",
        step("aggregate", group_by=["l_returnflag", "l_linestatus"], aggs={
            "sum_qty": "round(sum(l_quantity), 2)",
            "sum_net": "round(sum(l_extendedprice * (1 - l_discount)), 2)",
            "avg_disc": "round(avg(l_discount) + 1e-9, 6)",
            "n": "count(*)",
            "last_ship": "max(l_shipdate)",
        }),
    )


@query("SELECT count(*) AS n, round(sum(value), 2) AS total, min(value) AS low, max(value) AS high FROM events")
def agg_global(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        step("aggregate", aggs={"n": "count(*)", "total": "round(sum(value), 2)", "low": "min(value)",
                                "high": "max(value)"}),
    )


@query("""
    SELECT event_type, count(DISTINCT user_id) AS users,
           count(*) FILTER (WHERE value > 50) AS large, round(sum(value) FILTER (WHERE value <= 50), 2) AS small_total
    FROM events GROUP BY event_type
""")
def agg_distinct_filter(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        step("aggregate", group_by=["event_type"], aggs={
            "users": "count(distinct user_id)",
            "large": "count(*) FILTER (WHERE value > 50)",
            "small_total": "round(sum(value) FILTER (WHERE value <= 50), 2)",
        }),
    )


@query("""
    SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_discount), 8) AS var,
           round(corr(l_quantity, l_extendedprice), 6) AS r, round(covar_pop(l_tax, l_discount), 8) AS cov
    FROM lineitem GROUP BY l_returnflag
""")
def agg_statistics(spark, sf_dir):
    return result(
        spark, sf_dir, "lineitem",
        step("aggregate", group_by=["l_returnflag"], aggs={
            "sd": "round(stddev_samp(l_quantity), 6)",
            "var": "round(var_pop(l_discount), 8)",
            "r": "round(corr(l_quantity, l_extendedprice), 6)",
            "cov": "round(covar_pop(l_tax, l_discount), 8)",
        }),
    )


@query("""
    SELECT user_id, arg_max(event_id, ts) AS last_event, arg_min(event_type, ts) AS first_type,
           array_to_string(list_sort(list_distinct(list(event_type))), ',') AS types,
           bool_or(value > 90) AS any_large
    FROM events GROUP BY user_id
""")
def agg_max_by_and_sets(spark, sf_dir):
    return result(
        spark, sf_dir, "events",
        step("aggregate", group_by=["user_id"], aggs={
            "last_event": "max_by(event_id, ts)",
            "first_type": "min_by(event_type, ts)",
            "types": "array_join(sort_array(collect_set(event_type)), ',')",
            "any_large": "bool_or(value > 90)",
        }),
    )


@query("SELECT DISTINCT event_type, TRUE AS users_close, TRUE AS median_close FROM events")
def agg_approx(spark, sf_dir):
    """Approximate aggregates, and whether they lie within their error."""
    return result(
        spark, sf_dir, "events",
        step("aggregate", output="guess", group_by=["event_type"], aggs={
            "users": "approx_count_distinct(user_id, 0.02)",
            "median": "percentile_approx(value, 0.5)",
        }),
        step("aggregate", output="truth", group_by=["event_type"], aggs={"exact": "count(distinct user_id)"}),
        step("join", left="guess", right="truth", on="event_type"),
        step("join", right="guess", on="event_type"),
        step("aggregate", group_by=["event_type"], aggs={
            "users_close": "max(abs(users - exact)) <= 0.1 * max(exact)",
            "median_close": "avg(if(value < median, 1, 0)) <= 0.51 and avg(if(value <= median, 1, 0)) >= 0.49",
        }),
    )


# Reached through SQL text

def _sql(spark, sf_dir, tables, text):
    return result(spark, sf_dir, tables, step("sql", query=text))


_TOPK = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"


@query(_TOPK)
def topk(spark, sf_dir):
    return _sql(spark, sf_dir, "orders", _TOPK)


_OFFSET = "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 15 OFFSET 10"


@query(_OFFSET)
def topk_offset(spark, sf_dir):
    return _sql(spark, sf_dir, "customer", _OFFSET)


_SORTED = "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem ORDER BY l_shipdate DESC, l_orderkey, l_linenumber"


@query(_SORTED)
def sorted_rows(spark, sf_dir):
    return _sql(spark, sf_dir, "lineitem", _SORTED)


_LATERAL = """
    SELECT n_name, best, customers
    FROM nation, LATERAL (SELECT max(c_acctbal) AS best, count(*) AS customers
                          FROM customer WHERE c_nationkey = n_nationkey) AS its
"""


@query(_LATERAL)
def join_lateral(spark, sf_dir):
    return _sql(spark, sf_dir, "nation customer", _LATERAL)


_SETOPS = """
    SELECT 'union' AS op, k FROM (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer) a
    UNION ALL
    SELECT 'intersect', k FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer) b
    UNION ALL
    SELECT 'except', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) c
    UNION ALL
    SELECT 'except all', k FROM (SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer) d
    UNION ALL
    SELECT 'intersect all', k FROM (SELECT user_id AS k FROM events INTERSECT ALL SELECT o_custkey FROM orders) e
    UNION ALL
    SELECT 'distinct', k FROM (SELECT DISTINCT user_id AS k FROM events) f
"""


@query(_SETOPS)
def setops(spark, sf_dir):
    return _sql(spark, sf_dir, "orders customer events", _SETOPS)


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS gid
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
def cube(spark, sf_dir):
    return _sql(spark, sf_dir, "lineitem", """
        SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS gid
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")


_ROLLUP = """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS high
    FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
"""


@query(_ROLLUP)
def rollup(spark, sf_dir):
    return _sql(spark, sf_dir, "orders", _ROLLUP)


_GROUPING_SETS = """
    SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR(10)) AS nation, count(*) AS n
    FROM customer GROUP BY GROUPING SETS ((c_mktsegment), (c_nationkey), ())
"""


@query(_GROUPING_SETS)
def grouping_sets(spark, sf_dir):
    return _sql(spark, sf_dir, "customer", _GROUPING_SETS)


_THETA = """
    SELECT o_orderpriority, count(*) AS n
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate AND l_quantity * 5000 < o_totalprice
    GROUP BY o_orderpriority
"""


@query(_THETA)
def join_theta(spark, sf_dir):
    return _sql(spark, sf_dir, "orders lineitem", _THETA)


@query("""
    WITH shipped AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CAST(coalesce(sum(n), 0) AS BIGINT) AS shipped
    FROM orders LEFT JOIN shipped ON day >= CAST(o_orderdate AS DATE) AND day <= CAST(o_orderdate AS DATE) + 3
    GROUP BY o_orderkey
""")
def join_range(spark, sf_dir):
    # Days are the bins: a span of days meets the days it covers by equality.
    return _sql(spark, sf_dir, "orders lineitem", """
        WITH shipped AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1),
             spans AS (SELECT o_orderkey, explode(sequence(CAST(o_orderdate AS DATE),
                                                           date_add(CAST(o_orderdate AS DATE), 3))) AS day
                       FROM orders)
        SELECT o_orderkey, coalesce(sum(n), 0) AS shipped
        FROM spans LEFT JOIN shipped USING (day) GROUP BY o_orderkey""")


_SUBQUERIES = """
    WITH busy AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean FROM orders GROUP BY o_custkey)
    SELECT c_custkey, c_mktsegment,
           (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS largest
    FROM customer
    WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)
      AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
      AND c_custkey IN (SELECT o_custkey FROM busy WHERE n >= 3)
      AND NOT EXISTS (SELECT 1 FROM busy WHERE o_custkey = c_custkey AND mean < 100000)
"""


@query(_SUBQUERIES)
def subqueries(spark, sf_dir):
    return _sql(spark, sf_dir, "customer orders", _SUBQUERIES)


@query("""
    SELECT doc_id, len(string_split(text, ' ')) AS pieces, length(replace(text, ' ', '')) AS dense,
           CAST(strpos(text, 'the') AS INTEGER) AS the_at, md5(text) AS digest, concat_ws('-', upper(lang), source) AS tag,
           lpad(CAST(doc_id AS VARCHAR), 8, '0') AS padded, len(regexp_extract_all(text, '[0-9]+')) AS numbers,
           length(regexp_replace(text, '[aeiou]+', '', 'g')) AS consonants, text LIKE '%and%' AS has_and
    FROM documents
""")
def strings(spark, sf_dir):
    columns = {
        "pieces": "cast(size(split(text, ' ')) as bigint)",
        "dense": "cast(length(replace(text, ' ', '')) as bigint)",
        "the_at": "instr(text, 'the')",
        "digest": "md5(text)",
        "tag": "concat_ws('-', upper(lang), source)",
        "padded": "lpad(cast(doc_id as string), 8, '0')",
        "numbers": "cast(size(regexp_extract_all(text, '[0-9]+', 0)) as bigint)",
        "consonants": "cast(length(regexp_replace(text, '[aeiou]+', '')) as bigint)",
        "has_and": "text like '%and%'",
    }
    return result(
        spark, sf_dir, "documents",
        *[step("add_column", name=name, expression=text) for name, text in columns.items()],
        step("select", columns=["doc_id", *columns]),
    )


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
           CAST(dayofyear(o_orderdate) AS INTEGER) AS doy,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
           strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end,
           strftime(CAST(o_orderdate AS DATE) + 45, '%Y-%m-%d') AS due,
           CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS age
    FROM orders
""")
def dates(spark, sf_dir):
    columns = {
        "y": "year(o_orderdate)",
        "q": "quarter(o_orderdate)",
        "doy": "dayofyear(o_orderdate)",
        "month_start": "date_format(date_trunc('month', o_orderdate), 'yyyy-MM-dd')",
        "month_end": "date_format(last_day(o_orderdate), 'yyyy-MM-dd')",
        "due": "date_format(date_add(cast(o_orderdate as date), 45), 'yyyy-MM-dd')",
        "age": "datediff(cast(o_orderdate as date), date'1995-01-01')",
    }
    return result(
        spark, sf_dir, "orders",
        *[step("add_column", name=name, expression=text) for name, text in columns.items()],
        step("select", columns=["o_orderkey", *columns]),
    )


@query("""
    SELECT c_custkey, CAST(floor(c_acctbal) AS BIGINT) AS down, CAST(ceil(c_acctbal) AS BIGINT) AS up,
           abs(c_acctbal) AS size, c_custkey % 7 AS rest, round(sqrt(abs(c_acctbal)), 6) AS root,
           CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
           coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment,
           greatest(c_acctbal, 0.0) AS credit, least(c_nationkey, 10) AS nation
    FROM customer
""")
def math_and_nulls(spark, sf_dir):
    columns = {
        "down": "floor(c_acctbal)",
        "up": "ceil(c_acctbal)",
        "size": "abs(c_acctbal)",
        "rest": "c_custkey % 7",
        "root": "round(sqrt(abs(c_acctbal)), 6)",
        "band": "case when c_acctbal < 0 then 'debt' when c_acctbal < 5000 then 'low' else 'high' end",
        "segment": "coalesce(nullif(c_mktsegment, 'BUILDING'), 'none')",
        "credit": "greatest(c_acctbal, 0.0D)",
        "nation": "least(c_nationkey, 10)",
    }
    return result(
        spark, sf_dir, "customer",
        *[step("add_column", name=name, expression=text) for name, text in columns.items()],
        step("select", columns=["c_custkey", *columns]),
    )


@query("""
    SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 4) AS norm,
           CAST(list_max(embedding) AS DOUBLE) AS top, len(list_filter(embedding, lambda x: x > 0)) AS positive,
           CAST(embedding[1] AS DOUBLE) AS head
    FROM embeddings
""")
def arrays(spark, sf_dir):
    columns = {
        "n": "cast(size(embedding) as bigint)",
        "norm": "round(aggregate(embedding, 0D, (a, x) -> a + cast(x as double) * x), 4)",
        "top": "cast(array_max(embedding) as double)",
        "positive": "cast(size(filter(embedding, x -> x > 0)) as bigint)",
        "head": "cast(embedding[0] as double)",
    }
    return result(
        spark, sf_dir, "embeddings",
        *[step("add_column", name=name, expression=text) for name, text in columns.items()],
        step("select", columns=["vec_id", *columns]),
    )


@query("""
    SELECT label, CAST(i AS INTEGER) AS place, round(avg(CAST(x AS DOUBLE)), 6) AS mean
    FROM (SELECT label, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS i FROM embeddings)
    GROUP BY label, i
""")
def arrays_exploded(spark, sf_dir):
    return _sql(spark, sf_dir, "embeddings", """
        SELECT label, place, round(avg(CAST(x AS DOUBLE)), 6) AS mean
        FROM embeddings LATERAL VIEW posexplode(embedding) AS place, x
        GROUP BY label, place""")


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type AS kind,
           array_to_string(list_sort(json_keys(props)), ',') AS names, CAST(1 AS INTEGER) AS n_names,
           user_id AS who
    FROM events
""")
def maps_and_structs(spark, sf_dir):
    return _sql(spark, sf_dir, "events", """
        SELECT event_id, m['k'] AS k, st.kind AS kind, array_join(sort_array(map_keys(m)), ',') AS names,
               size(m) AS n_names, st.inner.who AS who
        FROM (SELECT event_id, from_json(props, 'map<string,int>') AS m,
                     named_struct('kind', event_type, 'inner', named_struct('who', user_id)) AS st
              FROM events)""")


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS text,
           json_extract_string(props, '$.missing') AS missing
    FROM events
""")
def json_text(spark, sf_dir):
    columns = {
        "k": "from_json(props, 'k int').k",
        "text": "get_json_object(props, '$.k')",
        "missing": "get_json_object(props, '$.missing')",
    }
    return result(
        spark, sf_dir, "events",
        *[step("add_column", name=name, expression=text) for name, text in columns.items()],
        step("select", columns=["event_id", *columns]),
    )
