import json
import os
import shutil

import pandas as pd
import pandas as pd
import pytest
from pyspark.sql import Row, functions as F

from tidewright import Job, JobError
from tidewright.sources import fetch_records, read_http_json


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def data(spark, folder):
    spark.range(6).selectExpr("id", "id % 3 as customer_id", "id * 50 as amount").write.parquet(f"{folder}/orders")
    spark.range(2).selectExpr("id as customer_id", "concat('n', id) as name").write.parquet(f"{folder}/customers")
    return folder


def config(data, **more):
    sources = [
        {"name": n, "source_type": "s3", "format": "parquet", "path": f"{data}/{n}"} for n in ("orders", "customers")
    ]
    return {"sources": sources, **more}


def test_a_whole_job(spark, data):
    job = Job.from_dict(config(
        data,
        transforms=[
            {"transform_type": "aggregate", "source": "orders", "output": "totals", "group_by": ["customer_id"],
             "aggs": {"spent": "sum(amount)", "n": "count(*)"}},
            {"transform_type": "join", "left": "customers", "right": "totals", "on": "customer_id", "how": "left",
             "output": "spending"},
            {"transform_type": "add_column", "source": "spending", "name": "big", "expression": "coalesce(spent, 0) > 200"},
        ],
        sink={"source": "spending", "sink_type": "file", "path": f"{data}/spending", "mode": "overwrite"},
    ))
    job.run(spark)
    spent = {}
    for row in spark.read.parquet(f"{data}/orders").collect():
        spent[row["customer_id"]] = spent.get(row["customer_id"], 0) + row["amount"]
    names = [row["customer_id"] for row in spark.read.parquet(f"{data}/customers").collect()]
    written = {row["customer_id"]: (row["spent"], row["big"]) for row in spark.read.parquet(f"{data}/spending").collect()}
    assert written == {name: (spent.get(name), spent.get(name, 0) > 200) for name in names}
    assert job.frames(spark)["totals"].count() == len(spent)


def test_names(spark, data):
    steps = [
        {"transform_type": "filter", "condition": "amount > 100"},
        {"transform_type": "add_column", "output": "wide", "name": "x", "expression": "amount + 1"},
        {"transform_type": "select", "columns": ["id"]},
        {"transform_type": "rename", "source": "customers", "mapping": {"name": "n"}},
        {"transform_type": "sql", "query": "select count(*) as n from wide"},
    ]
    frames = Job.from_dict(config(data, transforms=steps)).frames(spark)
    assert frames["wide"].columns == ["id", "customer_id", "amount", "x"]
    assert frames["customers"].columns == ["customer_id", "n"]
    assert frames["orders"].collect() == [Row(n=3)]


def test_partitions_and_masking_come_with_the_sink(spark, data):
    more = dict(
        transforms=[{"transform_type": "sql", "query": "select id, '123-45-6789' as t, "
                     "timestamp'2024-05-06 00:00:00' as event_time from orders"}],
        partition_by=["year", "month"], mask_pii=["USA_SSN"])
    assert Job.from_dict(config(data, **more)).result(spark).columns == ["id", "t", "event_time"]
    job = Job.from_dict(config(data, sink={"sink_type": "table", "database": "jobs_db", "table": "t",
                                           "mode": "append", "path": f"{data}/t"}, **more))
    job.run(spark)
    try:
        table = spark.table("jobs_db.t")
        assert [c.name for c in spark.catalog.listColumns("jobs_db.t") if c.isPartition] == ["year", "month"]
        assert {(r.t, r.year, r.month) for r in table.collect()} == {("****", 2024, 5)}
    finally:
        spark.sql("drop database jobs_db cascade")


def test_body_and_custom_steps_and_functions(spark, data):
    @F.pandas_udf("long")
    def twice(v: pd.Series) -> pd.Series:
        return v * 2

    job = Job.from_dict(config(
        data, functions={"twice": twice},
        transforms=[
            {"transform_type": "custom", "output": "both",
             "function": lambda spark, frames: frames["orders"].join(frames["customers"], "customer_id")},
            {"transform_type": "add_column", "source": "both", "name": "d", "expression": "twice(amount)"},
        ], sink={"sink_type": "file", "path": "unused", "source": "both"}))
    assert {r.d - 2 * r.amount for r in job.result(spark).collect()} == {0}
    body = Job.from_dict(config(data, body=lambda spark, frames: frames["orders"].filter("id = 1")))
    assert body.result(spark).count() == 1


@pytest.mark.parametrize("broken", [
    {"transforms": [{"transform_type": "pivot"}]},
    {"transforms": [{"transform_type": "join", "on": "customer_id"}]},
    {"transforms": [{"transform_type": "join", "right": "customers"}]},
    {"transforms": [{"transform_type": "filter", "source": "nope"}]},
    {"transforms": [{"transform_type": "add_column"}]},
    {"transforms": [{"transform_type": "window", "name": "w"}]},
    {"sink": {"sink_type": "ftp"}},
    {"sink": {"sink_type": "s3", "source": "nope"}},
    {"sources": [{"name": "a", "source_type": "carrier pigeon"}]},
    {"mask_pii": ["SHOE_SIZE"], "sink": {"sink_type": "s3", "path": "x"}},
    {"surprise": 1},
    {"bookmark": "maybe"},
])
def test_mistakes_are_refused(spark, data, broken):
    with pytest.raises(JobError):
        Job.from_dict({**config(data), **broken}).run(spark)


def test_frames_from_code_and_functions_by_name(spark):
    doubled = {"twice": lambda spark, frames: frames["mine"].union(frames["mine"])}
    mine = {"name": "mine", "source_type": "frame", "frame": spark.range(3)}
    step = {"transform_type": "custom", "function": "twice"}
    assert Job.from_dict({"sources": [mine], "functions": doubled, "transforms": [step]}).result(spark).count() == 6
    assert Job.from_dict({"sources": [mine], "functions": doubled, "body": "twice"}).result(spark).count() == 6
    with pytest.raises(JobError):
        Job.from_dict({"sources": [mine], "body": "thrice"}).result(spark)


def test_yaml(spark, data):
    pytest.importorskip("yaml")
    job = Job.from_yaml(f"""
sources:
  - {{name: orders, source_type: s3, path: {data}/orders}}
transforms:
  - {{transform_type: window, name: n, expression: row_number(), partition_by: [customer_id],
      order_by: [{{column: id, desc: true}}]}}
""")
    assert rows(job.result(spark).filter("n = 1").select("id")) == [(3,), (4,), (5,)]


def test_settings_of_a_service_and_imports(spark, data):
    job = Job.from_dict(config(
        data, job_type="any", config={"service": {"bookmark": "enabled", "workers": 2}}, state_path=f"{data}/state",
        imports=[{"name": "capwords", "from": "string"}],
        transforms=[{"transform_type": "sql", "source": "customers", "query":
                     "select capwords(concat('new ', name)) as name from customers"}],
        sink={"sink_type": "table", "database": "svc_db", "table": "t", "path": f"{data}/svc", "catalog": "none"}))
    assert job.bookmark == "enabled"
    job.run(spark)
    try:
        assert rows(spark.table("svc_db.t")) == [("New N0",), ("New N1",)]
    finally:
        spark.sql("drop database svc_db cascade")
    with pytest.raises(JobError):
        Job.from_dict({"imports": [{"name": "nope", "from": "string"}]})


@pytest.mark.parametrize("catalog", ["none", "lake", None])
def test_an_iceberg_sink_needs_its_catalog(spark, data, catalog):
    spark.conf.set("spark.sql.catalog.lake", "some.other.Catalog")
    ran = []
    job = Job.from_dict(config(
        data, transforms=[{"transform_type": "custom", "function": lambda spark, frames: ran.append(1)}],
        sink={"sink_type": "iceberg", "database": "d", "table": "t", "path": f"{data}/ice", "catalog": catalog}))
    try:
        with pytest.raises(JobError, match="Iceberg catalog"):
            job.run(spark)
    finally:
        spark.conf.unset("spark.sql.catalog.lake")
    assert not ran and not os.path.exists(f"{data}/ice")


def incremental(data, **sink):
    return Job.from_dict(config(
        data, bookmark="enabled", state_path=f"{data}/state",
        transforms=[{"transform_type": "join", "right": "customers", "on": "customer_id", "how": "left"}],
        sink={"sink_type": "s3", "path": f"{data}/out", "mode": "append", **sink}))


def test_incremental_runs(spark, data):
    incremental(data).run(spark)
    assert spark.read.parquet(f"{data}/out").count() == 6
    incremental(data).run(spark)
    assert spark.read.parquet(f"{data}/out").count() == 6
    spark.range(100, 102).selectExpr("id", "0L as customer_id", "id as amount").write.mode("append").parquet(
        f"{data}/orders")
    incremental(data).run(spark)
    out = spark.read.parquet(f"{data}/out")
    assert out.count() == 8 and out.filter("id >= 100 and name is null").count() == 2


def test_incremental_run_over_partitions_and_odd_names(spark, folder):
    spark.sql("select 1 as id, 'a b%:c' as p union all select 2, 'x'").write.partitionBy("p").parquet(f"{folder}/in")
    spark.sql("select 3 as id").coalesce(1).write.parquet(f"{folder}/tmp")
    [part] = [f for f in os.listdir(f"{folder}/tmp") if f.endswith(".parquet")]
    os.makedirs(f"{folder}/in/p=y")
    shutil.copy(f"{folder}/tmp/{part}", f"{folder}/in/p=y/odd [1] {{2}}.parquet")
    job = Job.from_dict({
        "sources": [{"name": "s", "source_type": "file", "path": f"{folder}/in"}], "bookmark": "enabled",
        "state_path": f"{folder}/state", "sink": {"sink_type": "file", "path": f"{folder}/out", "mode": "append"}})
    job.run(spark)
    job.run(spark)
    assert rows(spark.read.parquet(f"{folder}/out")) == [(1, "a b%:c"), (2, "x"), (3, "y")]


def test_incremental_run_over_a_table(spark, folder):
    spark.sql("create database followed")
    try:
        spark.sql("create table followed.t (id int, p string) using csv options (header 'true', sep ';')"
                  f" partitioned by (p) location '{folder}/t'")
        job = Job.from_dict({
            "sources": [{"name": "s", "source_type": "catalog", "database": "followed", "table": "t"}],
            "transforms": [{"transform_type": "sql", "query": "select * from s"}],
            "bookmark": "enabled", "state_path": f"{folder}/state",
            "sink": {"sink_type": "file", "path": f"{folder}/out", "mode": "append"}})
        for row in ("1, 'a'", "2, 'b'"):
            spark.sql(f"insert into followed.t values ({row})")
            job.run(spark)
        assert rows(spark.read.parquet(f"{folder}/out")) == [(1, "a"), (2, "b")]
    finally:
        spark.sql("drop database followed cascade")


@pytest.mark.parametrize("source", [
    {"source_type": "file", "path": ["a", "b"]}, {"source_type": "file", "path": "a", "format": "delta"},
    {"source_type": "file", "path": "a", "options": {"maxFilesPerTrigger": 1}},
    {"source_type": "jdbc", "table": "t", "connection_url": "jdbc:x"}])
def test_sources_that_cannot_be_followed(spark, folder, source):
    with pytest.raises(JobError):
        Job.from_dict({"sources": [{"name": "s", **source}], "bookmark": "enabled", "state_path": folder}).run(spark)


def test_a_failed_run_is_repeated(spark, data):
    with pytest.raises(Exception):
        incremental(data, format="nonsense").run(spark)
    incremental(data).run(spark)
    assert spark.read.parquet(f"{data}/out").count() == 6


def test_http_json(spark, folder):
    for page in range(3):
        with open(f"{folder}/{page}.json", "w") as file:
            json.dump([{"id": page * 10 + i, "st": {"a": "x"}, "at": "2024-01-02T03:04:05Z"} for i in range(2)], file)
    with open(f"{folder}/one.json", "w") as file:
        json.dump({"id": 7, "st": None, "more": 1.5}, file)
    schema = "id bigint, st struct<a:string>, at timestamp"
    pages = read_http_json(spark, f"file://{folder}/{{page}}.json", schema, {"Accept": "x"}, {"first": 0, "last": 2})
    assert [r.id for r in pages.orderBy("id").collect()] == [0, 1, 10, 11, 20, 21]
    assert pages.schema.simpleString() == "struct<id:bigint,st:struct<a:string>,at:timestamp>"
    several = [f"file://{folder}/0.json", f"file://{folder}/one.json"]
    assert rows(read_http_json(spark, several, "id int")) == [(0,), (1,), (7,)]
    assert read_http_json(spark, several).columns == ["at", "id", "more", "st"]
    with pytest.raises(Exception):
        read_http_json(spark, f"file://{folder}/none.json", schema).collect()


def test_api_pages_follow_their_links(spark, folder):
    """Chains of pages of different lengths; every document is fetched once."""
    def page(chain, n, last):
        name = f"{folder}/{chain}-{n}.json"
        link = None if n == last else f"file://{folder}/{chain}-{n + 1}.json"
        with open(name, "w") as file:
            json.dump({"data": {"items": [{"id": 100 * chain + 10 * n + i, "s": "x\ny"} for i in range(3)]}, "paging": {"next": link}}, file)

    for chain, last in ((1, 0), (2, 1), (3, 4)):
        for n in range(last + 1):
            page(chain, n, last)
    source = {"name": "api", "source_type": "api", "url": [f"file://{folder}/{c}-0.json" for c in (1, 2, 3)], "headers": {"Accept": "x"},
              "options": {"next": "$.paging.next", "records": "$.data.items"}}
    expected = sorted(100 * c + 10 * n + i for c, last in ((1, 0), (2, 1), (3, 4)) for n in range(last + 1) for i in range(3))
    for schema in ("id int, s string", None):
        found = Job.from_dict({"sources": [{**source, "schema": schema}]}).result(spark)
        assert sorted(r.id for r in found.collect()) == expected and {r.s for r in found.collect()} == {"x\ny"}
    # A page that links back to one that was fetched ends the chain.
    with open(f"{folder}/ring.json", "w") as file:
        json.dump({"items": [{"id": 1}], "next": f"file://{folder}/ring.json"}, file)
    ring = read_http_json(spark, f"file://{folder}/ring.json", "id int", next="$.next", records="$.items")
    assert rows(ring) == [(1,)]
    with pytest.raises(JobError):
        Job.from_dict({"sources": [{**source, "options": {"nxt": "$"}}]}).result(spark)


def test_documents_are_handed_over_in_batches_of_a_bounded_size(spark):
    from tidewright.sources import http_json

    small = spark.range(4_000).selectExpr("concat('data:application/json,', url_encode(to_json(struct(id)))) as url").coalesce(1)
    assert fetch_records(small, "url", "id int").count() == 4_000
    urls = pd.DataFrame({"url": ["data:application/json,%22" + "a" * n + "%22" for n in (10, 700, 3, 4)]})
    frames = http_json._fetched(iter([urls]), {}, 5, 600)
    assert [[len(v) for v in frame["value"]] for frame in frames] == [[12, 702], [5, 6]]


def test_fetch_from_a_frame_of_urls(spark):
    urls = spark.range(5).selectExpr("concat('data:application/json,', id) as url")
    with pytest.raises(Exception):
        fetch_records(urls, "url", "id int").collect()
    urls = spark.range(5).selectExpr("concat('data:application/json,', url_encode(to_json(struct(id)))) as url")
    assert rows(fetch_records(urls, F.col("url"), "id int")) == [(i,) for i in range(5)]


def test_http_documents_are_fetched_once_and_keep_their_digits(spark, folder):
    page = f"{folder}/exact.json"
    with open(page, "w") as file:
        file.write('[{"d": 0.12345678901234567890},\n {"d": 1}]')
    read = read_http_json(spark, f"file://{page}", "d decimal(30,20)")
    os.remove(page)
    assert [str(row["d"]) for row in read.union(read).collect()][:2] == ["0.12345678901234567890", "1.00000000000000000000"]
