"""Schema reconciliation, partition columns and sinks.

Each query writes under the shared folder, into a database of its own, and
gives back what a reader then finds.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.registry import files, job, query, result, step
from tidewright import Job, SchemaMismatch
from tidewright.functions.schema import conform, merge_schema, void_free_schema
from tidewright.work import new_folder

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _database(spark: SparkSession) -> str:
    name = f"catalogue_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, 'database')}'")
    return name


def _events(sf_dir: str, text: str, **settings) -> Job:
    return job(sf_dir, "events", step("sql", query=text), **settings)


# Schemas

@query("SELECT event_id, event_type AS kind, value FROM events")
def void_free(spark, sf_dir):
    df = _events(sf_dir, """
        SELECT event_id, NULL AS nothing, array() AS nothings, map('k', NULL) AS no_map,
               named_struct('a', NULL, 'b', named_struct('c', NULL)) AS empty,
               named_struct('kind', event_type, 'gone', NULL) AS st, array(named_struct('v', value, 'gone', NULL)) AS vs
        FROM events""").result(spark)
    clean = conform(df, void_free_schema(df.schema))
    fields = [name for name in clean.columns if name not in ("event_id", "st", "vs")]
    return clean.select("event_id", "st.*", F.col("vs")[0]["v"].alias("value"), *fields)


@query("""
    SELECT event_id, CAST(NULL AS DOUBLE) AS value, event_type AS kind, user_id AS who, CAST(NULL AS VARCHAR) AS note,
           CASE WHEN event_type <> 'error' THEN CAST(event_id % 50 AS VARCHAR) END AS code,
           event_id % 7 AS extra
    FROM events
""")
def merge_conform(spark, sf_dir):
    """A reordered, retyped, incomplete batch, brought to a merged schema."""
    live = "event_id bigint, value double, st struct<kind:string,who:bigint,note:string>, code int"
    live = spark.createDataFrame([], live).schema
    batch = _events(sf_dir, """
        SELECT event_id % 7 AS extra, if(event_type = 'error', 'oops', cast(event_id % 50 AS string)) AS code,
               named_struct('who', user_id, 'kind', event_type) AS st, event_id, NULL AS nothing
        FROM events""").result(spark)
    out = conform(batch, merge_schema(live, void_free_schema(batch.schema)))
    return out.select("event_id", "value", "st.*", F.col("code").cast("string"), "extra")


@query("SELECT event_id, event_type AS kind FROM events")
def kind_guard(spark, sf_dir):
    """A batch of another kind is refused and leaves the table as it was."""
    database = _database(spark)
    sink = {"sink_type": "table", "database": database, "table": "guarded", "mode": "append"}
    _events(sf_dir, "SELECT event_id, named_struct('kind', event_type) AS st FROM events", sink=sink).run(spark)
    try:
        _events(sf_dir, "SELECT event_id, array(event_type) AS st FROM events", sink=sink).run(spark)
    except SchemaMismatch:
        return spark.table(f"{database}.guarded").select("event_id", "st.kind")
    raise AssertionError("the batch was not refused")


# Partition columns

_NO_FILE = {"sink_type": "file", "path": "never written here"}


@query("""
    SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
    FROM orders
""")
def partition_columns(spark, sf_dir):
    return result(
        spark, sf_dir, "orders", step("select", columns=["o_orderkey", "o_orderdate"]),
        partition_by=["year", "month", "day"], partition_timestamp_column="o_orderdate", sink=_NO_FILE,
    )


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_time, CAST(0 AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day
    FROM events
""")
def partition_columns_from_text(spark, sf_dir):
    """The default column, holding text; a month that is there already stays."""
    return result(
        spark, sf_dir, "events",
        step("sql", query="SELECT event_id, date_format(ts, 'yyyy-MM-dd') AS event_time, 0 AS month FROM events"),
        partition_by=["month", "day"], sink=_NO_FILE,
    )


@query("SELECT event_id, TRUE AS stamped, TRUE AS consistent FROM events")
def ingestion_timestamp(spark, sf_dir):
    stamped = result(
        spark, sf_dir, "events", step("select", columns=["event_id"]),
        partition_by=["year"], create_timestamp=True, sink=_NO_FILE,
    )
    return stamped.selectExpr(
        "event_id", "ingestion_timestamp IS NOT NULL AS stamped", "year(ingestion_timestamp) = year AS consistent"
    )


# Sinks

@query("SELECT event_id, value, event_type FROM events")
def file_sink_roundtrip(spark, sf_dir):
    path = new_folder(spark, "files")
    out = job(
        sf_dir, "events", step("select", columns=["event_id", "value", "event_type"]),
        sink={"sink_type": "file", "path": path, "partition_by": ["event_type"]},
    )
    out.run(spark)
    out.run(spark)  # overwrites
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_name, c_acctbal, f.format FROM customer, (VALUES ('csv'), ('json'), ('orc')) f(format)")
def file_formats_roundtrip(spark, sf_dir):
    sources, union = [], []
    for format in ("csv", "json", "orc"):
        path = new_folder(spark, format)
        options = {"header": "true"} if format == "csv" else {}
        job(
            sf_dir, "customer", step("select", columns=["c_custkey", "c_name", "c_acctbal"]),
            sink={"sink_type": "file", "path": path, "format": format, "mode": "append", "options": options},
        ).run(spark)
        sources.append({"name": format, "source_type": "file", "path": path, "format": format, "options": options})
        union.append(f"SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal,"
                     f" '{format}' AS format FROM {format}")
    steps = [step("sql", query=" UNION ALL ".join(union))]
    return Job.from_dict({"sources": sources, "transforms": steps}).result(spark)


@query("""
    SELECT event_id, value, event_type AS kind, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE CAST(user_id AS VARCHAR) END AS who,
           CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE props END AS note,
           CASE WHEN event_type IN ('click', 'view') THEN CAST(event_id % 10 AS VARCHAR) END AS code
    FROM events
""")
def table_create_evolve_append(spark, sf_dir):
    database = _database(spark)
    sink = {"sink_type": "table", "database": database, "table": "evolving", "mode": "append"}
    _events(sf_dir, """
        SELECT event_id, value, named_struct('kind', event_type) AS st, CAST(event_id % 10 AS INT) AS code, NULL AS nothing
        FROM events WHERE event_type IN ('click', 'view')""", sink=sink).run(spark)
    _events(sf_dir, """
        SELECT props AS note, cast(value AS string) AS value, named_struct('who', user_id, 'kind', event_type) AS st, event_id
        FROM events WHERE event_type NOT IN ('click', 'view')""", sink=sink).run(spark)
    numbers = [F.col(path).cast("string").alias(name) for path, name in (("st.who", "who"), ("code", "code"))]
    return spark.table(f"{database}.evolving").select("event_id", "value", "st.kind", "note", *numbers)


@query("""
    SELECT event_id, CASE WHEN day(ts) BETWEEN 10 AND 15 THEN value * 2 ELSE value END AS value,
           CASE WHEN day(ts) BETWEEN 10 AND 15 THEN event_type END AS label, CAST(day(ts) AS INTEGER) AS day
    FROM events
""")
def table_overwrite_partitions(spark, sf_dir):
    """Days 10 to 15 are replaced, and bring a column; the others stay."""
    database = _database(spark)
    settings = {
        "partition_by": ["day"],
        "partition_timestamp_column": "ts",
        "sink": {"sink_type": "table", "database": database, "table": "daily"},
    }
    _events(sf_dir, "SELECT event_id, value, ts FROM events", **settings).run(spark)
    _events(sf_dir, "SELECT event_type AS label, event_id, value * 2 AS value, ts FROM events"
                    " WHERE day(ts) BETWEEN 10 AND 15", **settings).run(spark)
    return spark.table(f"{database}.daily").select("event_id", "value", "label", "day")


@query("""
    SELECT event_id, event_type, CASE WHEN day(ts) > 15 THEN value END AS inner_value
    FROM events
""")
def table_nested_fields(spark, sf_dir):
    """A partitioned table whose struct gains a field; old rows read NULL."""
    database = _database(spark)
    sink = {"sink_type": "table", "database": database, "table": "nested", "mode": "append",
            "partition_by": ["event_type"]}
    _events(sf_dir, "SELECT event_id, named_struct('u', user_id) AS st, event_type FROM events WHERE day(ts) <= 15",
            sink=sink).run(spark)
    _events(sf_dir, "SELECT event_id, named_struct('v', value, 'u', user_id) AS st, event_type FROM events"
                    " WHERE day(ts) > 15", sink=sink).run(spark)
    return spark.table(f"{database}.nested").selectExpr("event_id", "event_type", "st.v AS inner_value")


@query("SELECT c_custkey, c_name, k.copy FROM customer, (VALUES (1), (2)) k(copy)")
def catalog_append(spark, sf_dir):
    database = _database(spark)
    spark.sql(f"CREATE TABLE {database}.existing (c_name STRING, copy INT, c_custkey BIGINT) USING parquet")
    for copy in (1, 2):
        job(
            sf_dir, "customer", step("add_column", name="copy", expression=str(copy)),
            sink={"sink_type": "catalog", "database": database, "table": "existing"},
        ).run(spark)
    return spark.table(f"{database}.existing")


@query("SELECT r_regionkey, r_name, n_name FROM region JOIN nation ON r_regionkey = n_regionkey")
def catalog_read(spark, sf_dir):
    database = _database(spark)
    for table in ("region", "nation"):
        job(sf_dir, table, sink={"sink_type": "table", "database": database, "table": table}).run(spark)
    config = {
        "sources": [
            {"name": t, "source_type": "catalog", "database": database, "table": t, "columns": columns}
            for t, columns in (("region", ["r_regionkey", "r_name"]), ("nation", ["n_regionkey", "n_name"]))
        ],
        "transforms": [
            step("rename", source="nation", mapping={"n_regionkey": "r_regionkey"}),
            step("join", right="nation", on="r_regionkey"),
        ],
    }
    return Job.from_dict(config).result(spark)


@query("SELECT event_id, user_id, value FROM events")
def incremental_two_runs(spark, sf_dir):
    """Two drops of files, a run after each and one more that finds nothing."""
    landing, out = new_folder(spark, "landing"), new_folder(spark, "incremental")
    config = {
        "sources": [{"name": "landed", "source_type": "file", "path": landing}],
        "transforms": [step("select", columns=["event_id", "user_id", "value"])],
        "sink": {"sink_type": "file", "path": out, "mode": "append"},
        "bookmark": "enabled",
        "state_path": new_folder(spark, "bookmark"),
    }
    for condition in ("event_type IN ('click', 'error')", "event_type NOT IN ('click', 'error')"):
        job(sf_dir, "events", step("filter", condition=condition),
            sink={"sink_type": "file", "path": landing, "mode": "append"}).run(spark)
        Job.from_dict(config).run(spark)
    Job.from_dict(config).run(spark)
    return spark.read.parquet(out)


@query("""
    SELECT o_orderkey, count(l_linenumber) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
""")
def incremental_two_sources(spark, sf_dir):
    """Orders and their lines arrive in two drops. The second run breaks off; the next one repeats its batch."""
    landing, out, state = (new_folder(spark, label) for label in ("landing", "incremental", "bookmark"))
    tables = {"orders": "o_orderkey", "lineitem": "l_orderkey"}

    class BrokenOff(Exception):
        pass

    def break_off(spark, frames):
        raise BrokenOff

    def paired(*first):
        return Job.from_dict({
            "sources": [{"name": t, "source_type": "file", "path": f"{landing}/{t}"} for t in tables],
            "transforms": [
                *first,
                step("aggregate", source="lineitem", group_by=["l_orderkey"],
                     aggs={"lines": "count(l_linenumber)", "units": "cast(sum(l_quantity) as bigint)"}),
                step("rename", source="lineitem", mapping={"l_orderkey": "o_orderkey"}),
                step("join", right="lineitem", on="o_orderkey", how="left"),
                step("add_column", name="lines", expression="coalesce(lines, 0)"),
                step("select", columns=["o_orderkey", "lines", "units"]),
            ],
            "sink": {"sink_type": "file", "path": out, "mode": "append"},
            "bookmark": "enabled", "state_path": state,
        })

    for part in (0, 1, 2):
        for table, key in tables.items():
            job(sf_dir, table, step("filter", condition=f"{key} % 3 = {part}"),
                sink={"sink_type": "file", "path": f"{landing}/{table}", "mode": "append"}).run(spark)
        if part == 1:
            # Its batch is begun, but not written; the third drop arrives before the next run.
            try:
                paired(step("custom", function=break_off)).run(spark)
            except BrokenOff:
                continue
        paired().run(spark)
    return spark.read.parquet(out)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def multi_path_read(spark, sf_dir):
    paths = []
    for condition in ("o_orderstatus = 'O'", "o_orderstatus <> 'O'"):
        paths.append(new_folder(spark, "part"))
        job(sf_dir, "orders", step("filter", condition=condition),
            sink={"sink_type": "file", "path": paths[-1]}).run(spark)
    source = {"name": "orders", "source_type": "s3", "path": paths, "columns": ["o_orderkey", "o_totalprice"],
              "engine": "spark"}
    return Job.from_dict({"sources": [source]}).result(spark)


def _sum(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.sum("n_chars").alias("chars"))


@query("SELECT source, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def custom_step(spark, sf_dir):
    return result(
        spark, sf_dir, "documents", step("custom", function=lambda spark, frames: _sum(frames["documents"]))
    )


@query("SELECT source, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def body_replaces_steps(spark, sf_dir):
    return Job.from_dict({
        "sources": files(sf_dir, "documents"),
        "body": lambda spark, frames: _sum(frames["documents"]),
    }).result(spark)
