"""Percentiles, as-of joins and overlap joins against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewright.errors import JobError
from tidewright.operators import aggregate, sketches
from tidewright.operators.asof import join_as_of
from tidewright.operators.overlaps import join_overlapping
from tidewright.operators.percentiles import exact_percentiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.731, 0.99, 1.0]


def same(a, b):
    if a is None or b is None:
        return a is b
    return all(math.isnan(x) and math.isnan(y) or x == y or math.isclose(x, y, rel_tol=1e-12) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("bins", [7, 1024])
def test_percentiles_are_sparks_own(spark, bins):
    rng, rows = random.Random(bins), []
    kinds = {
        "few": lambda: float(rng.randrange(5)), "wide": lambda: rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300),
        "even": lambda: rng.uniform(-5, 5), "same": lambda: 7.5, "odd": lambda: rng.choice([math.inf, -math.inf, math.nan, 1.0, 2.0]),
        None: lambda: rng.gauss(0, 1), "one": lambda: 3.0, "nulls": lambda: None, "huge": lambda: rng.choice((-1.7e308, 1.7e308, 0.0)),
        "close": lambda: 1e15 + rng.randrange(100) / 8,
    }
    for kind, make in kinds.items():
        rows += [(kind, make()) for _ in range(1 if kind == "one" else 300)]
        rows.append((kind, None))
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.percentiles for r in exact_percentiles(df, "v", SHARES, ["g"], bins=bins).collect()}
    shares = ", ".join(map(str, SHARES))
    expected = {r.g: r.p for r in df.groupBy("g").agg(F.expr(f"percentile(v, array({shares}))").alias("p")).collect()}
    assert set(got) == set(expected)
    for group in got:
        # Between infinite or very large values, Spark's order of operations decides.
        if group not in ("odd", "huge"):
            assert same(got[group], expected[group]), (group, got[group], expected[group])
    assert got["huge"][0] == -1.7e308 and got["huge"][-1] == 1.7e308 and math.isnan(got["odd"][-1]) and got["odd"][0] == -math.inf


def test_percentiles_of_everything_and_of_nothing(spark):
    df = spark.range(1001).select((F.col("id") * 3 % 1001).cast("decimal(10,2)").alias("v"))
    assert exact_percentiles(df, "v * 2", [0.5, 0.001]).collect()[0][0] == [1000.0, 2.0]
    assert exact_percentiles(df.where("false"), "v", [0.5]).collect()[0][0] is None
    assert exact_percentiles(df.where("false").withColumn("g", F.lit(1)), "v", [0.5], ["g"]).collect() == []
    with pytest.raises(JobError):
        exact_percentiles(df, "v", [1.5])


def test_percentiles_never_gather_a_group(spark):
    df = spark.range(50_000).select((F.col("id") % 3).alias("g"), F.hash("id").alias("v"))
    plan = exact_percentiles(df, "v", [0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert " percentile(" not in plan and "Window" not in plan


def test_hot_groups_of_an_aggregate(spark):
    df = spark.range(3_000).select(F.expr("if(id % 4 < 3, id % 4 div 2, null)").alias("g"), F.hash("id").alias("v"), (F.col("id") % 7).alias("w"))
    aggs = {"m": "median(v)", "p": "percentile(w, 0.9)", "n": "count(*)", "both": "max(w) - min(w)", "q": "PERCENTILE(v, 0.25)"}
    for group_by in (["g"], [], ["g", "w"]):
        plain = aggregate(df, group_by, aggs)
        split = aggregate(df, group_by, aggs, hot_rows=800)
        assert split.schema == plain.schema
        assert sorted(split.collect(), key=str) == sorted(plain.collect(), key=str)
    assert "percentile(" in aggregate(df, ["g", "w"], aggs, hot_rows=800)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in aggregate(df, [], aggs, hot_rows=800)._jdf.queryExecution().executedPlan().toString()


def as_of_brute(left, right, forward, strict, within):
    out = []
    for key, time, tag in left:
        fits = []
        for other, at, rank in right:
            if key is None or time is None or other != key or at is None or (strict and at == time):
                continue
            if (at >= time if forward else at <= time) and (within is None or abs(at - time) <= within):
                fits.append((-at if forward else at, rank, at))
        best = max(fits, default=(None, None, None))
        out.append((tag, best[2], best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within", [None, 4])
def test_as_of(spark, forward, strict, within):
    rng = random.Random(5)

    def keyed():
        return rng.choice([0, 0, 0, 0, 1, 2, 3, None]), rng.choice([None, *range(60)])

    left = [(*keyed(), tag) for tag in range(300)]
    right = [(*keyed(), rank) for rank in range(150)]
    found = join_as_of(
        spark.createDataFrame(left, "k int, t int, tag int"), spark.createDataFrame(right, "k int, at int, `a rank` int"),
        "k", "t", "at", tie_by=["a rank"], forward=forward, strict=strict, within=within and str(within), buckets=9)
    assert found.columns == ["k", "t", "tag", "at", "a rank"]
    assert sorted(((r.tag, r.at, r["a rank"]) for r in found.collect()), key=str) == as_of_brute(left, right, forward, strict, within)


def test_as_of_hot_key_is_several_tasks_and_empty_sides(spark):
    left = spark.range(20_000).selectExpr("0 as k", "id as t")
    right = spark.range(100).selectExpr("0 as k", "id * 200 as at", "id as n")
    found = join_as_of(left, right, ["k"], "t", "at", right_columns=["n"], buckets=8)
    assert found.where("n <> t div 200").count() == 0 and found.count() == 20_000
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert join_as_of(left, right.where("false"), "k", "t", "at").where("n is null").count() == 20_000
    assert join_as_of(left.where("false"), right, "k", "t", "at").count() == 0
    with pytest.raises(JobError):
        join_as_of(left, right.withColumnRenamed("at", "t"), "k", "t", "t")


def spans_of(rng, n, longest):
    return [(rng.choice([1, 1, 2, None]), s, s + rng.choice([-1, 0, 0, 1, 5, rng.randrange(longest)]), i)
            for i, s in enumerate(rng.randrange(-300, 300) for _ in range(n))]


def overlap_brute(left, right, keyed):
    return sorted((a[3], b[3]) for a in left for b in right
                  if (not keyed or a[0] is not None and a[0] == b[0]) and a[1] <= a[2] and b[1] <= b[2] and a[1] <= b[2] and b[1] <= a[2])


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("longest", [1, 3, 40, 2_000])
def test_overlaps(spark, keyed, longest):
    rng = random.Random(longest)
    left, right = spans_of(rng, 90, longest), spans_of(rng, 70, 2 * longest)
    a = spark.createDataFrame(left, f"{'k' if keyed else 'ka'} int, s int, e int, i int")
    b = spark.createDataFrame(right, f"{'k' if keyed else 'kb'} int, start long, `end` long, j int")
    found = join_overlapping(a, b, ("s", "e"), ("start", "end"), ["k"] if keyed else [])
    assert sorted((r.i, r.j) for r in found.collect()) == overlap_brute(left, right, keyed)


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_overlaps_of_dates_and_timestamps(spark, kind):
    rng = random.Random(3)
    left, right = spans_of(rng, 60, 12_000), spans_of(rng, 60, 100)
    point = "date_add(date'1970-01-02', {0})" if kind == "date" else "timestamp_micros({0} * 3600000000L + 7)"
    a, b = (spark.createDataFrame(rows, "k int, s int, e int, i int").selectExpr(
        f"{point.format('s')} as s{side}", f"{point.format('e')} as e{side}", f"i as i{side}") for side, rows in (("a", left), ("b", right)))
    found = join_overlapping(a, b, ("sa", "ea"), ("sb", "eb"))
    assert sorted((r.ia, r.ib) for r in found.collect()) == overlap_brute(left, right, False)


def test_postings_grow_with_the_logarithm_of_the_length(spark):
    from tidewright.operators import overlaps

    long = spark.range(100).selectExpr("id as `from`", "id + 10000000 as `to`", "id as row")
    assert overlaps._covers(long).count() <= 100 * 2 * 24
    nulls = spark.sql("select cast(null as int) s, 3 e union all select 3, cast(null as int) union all select 5, 4")
    assert join_overlapping(nulls, spark.sql("select 1 p, 9 q"), ("s", "e"), ("p", "q")).count() == 0
    with pytest.raises(JobError):
        join_overlapping(nulls, spark.sql("select 'a' p, 'b' q"), ("s", "e"), ("p", "q"))
    with pytest.raises(JobError):
        join_overlapping(nulls, nulls, ("s", "e"), ("s", "e"))


def test_overlap_joins_broadcast_no_postings(spark, folder):
    """A table under the limit for broadcasts has many times its size in postings."""
    spark.range(1_000).selectExpr("id % 9 as k", "id as s", "id + 5000 as e").write.parquet(f"{folder}/a")
    spark.range(1_000).selectExpr("id % 9 as k", "id * 7 as b", "id * 7 as c").write.parquet(f"{folder}/b")
    a, b = (spark.read.parquet(f"{folder}/{name}") for name in "ab")
    for left, right, spans in ((a, b, (("s", "e"), ("b", "c"))), (b, a, (("b", "c"), ("s", "e")))):
        found = join_overlapping(left, right, *spans, "k")
        assert found.count() == a.alias("a").join(b.alias("b"), F.expr("a.k = b.k and s <= c and b <= e")).count()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_overlap_joins_shuffle_rows_of_small_keys_once(spark, monkeypatch):
    from tidewright.operators import overlaps

    rng = random.Random(8)
    left, right = spans_of(rng, 300, 5_000), spans_of(rng, 200, 9)
    right += [(7, s, s + 3, 1_000 + s) for s in range(50)]
    left += [(7, 40, 9_000, 1_000), (7, 60, 9_000, 1_001)]
    a, b = spark.createDataFrame(left, "k int, s int, e int, i int"), spark.createDataFrame(right, "k int, start int, `end` int, j int")
    want = overlap_brute(left, right, True)
    # No key, some keys and all keys have many rows; marked by a broadcast or by a merge.
    for few, many in ((500, 9), (60, 9), (60, 0), (0, 9)):
        monkeypatch.setattr(overlaps, "_FEW", few)
        monkeypatch.setattr(overlaps, "_MANY_KEYS", many)
        found = join_overlapping(a, b, ("s", "e"), ("start", "end"), "k")
        assert sorted((r.i, r.j) for r in found.collect()) == want
        assert found.columns == ["k", "s", "e", "i", "start", "end", "j"]
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert ("Generate" in plan) == (few < 500) and plan.count("SortMergeJoin") == (1 if many else 3)


def test_sketches_are_merged_over_batches(spark):
    df = spark.range(40_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 5_000).alias("who"), (F.col("id") / 7).alias("v"))
    measures = {"people": ("distinct", "who"), "size": ("quantiles", "v")}
    parts = [sketches.sketch(df.where(f"who % 4 = {n}"), ["g"], measures) for n in range(4)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    merged = sketches.merge(states, ["g"], measures)
    assert merged.count() == 3 and merged.columns == ["g", "people", "size"]
    exact = {r.g: r for r in df.groupBy("g").agg(F.countDistinct("who").alias("n"), F.expr("percentile(v, 0.5)").alias("m")).collect()}
    for row in sketches.estimate(merged, ["g"], measures, [0.5]).collect():
        assert abs(row.people / exact[row.g].n - 1) < sketches.DISTINCT_ERROR
        assert abs(row["size"][0] / exact[row.g].m - 1) < 0.1
    assert sketches.merge(sketches.sketch(df.where("false"), ["g"], measures), ["g"], measures).count() == 0
    nulls = sketches.sketch(df.select("g", F.lit(None).cast("long").alias("who"), F.lit(None).cast("double").alias("v")), ["g"], measures)
    assert {(r.people, r["size"]) for r in sketches.estimate(nulls, ["g"], measures, [0.5]).collect()} <= {(0, None), (None, None)}
    with pytest.raises(JobError):
        sketches.sketch(df, ["g"], {"x": ("mode", "v")})


def test_variant_schemas_evolve(spark):
    from tidewright.functions import variants

    first = spark.createDataFrame([(1, '{"k": 3}'), (2, None), (3, "not json"), (4, '{"k": null, "deep": {"a": [1, 2]}}')], "id int, j string")
    second = spark.createDataFrame([(5, '{"deep": {"b": "x", "a": []}, "k": 2.5}'), (6, "[1]")], "id int, j string")
    typed = variants.typed(first, "j")
    assert typed.schema["j"].dataType.simpleString() == "struct<deep:struct<a:array<bigint>>,k:bigint>"
    assert [r.j and r.j.asDict(True) for r in typed.orderBy("id").collect()] == [
        {"deep": None, "k": 3}, None, None, {"deep": {"a": [1, 2]}, "k": None}]
    # Where kinds differ between rows, the part stays a variant's text.
    assert variants.json_type(second, "j") .simpleString() == "string"
    merged = variants.typed(second.where("id = 5"), "j", typed.schema["j"].dataType)
    assert merged.schema["j"].dataType.simpleString() == "struct<deep:struct<a:array<bigint>,b:string>,k:bigint>"
    assert merged.first().j.asDict(True) == {"deep": {"a": [], "b": "x"}, "k": 2}
    assert variants.typed(first.where("false"), "j").schema["j"].dataType.simpleString() == "string"
