import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row
from pyspark.sql import types as T

from tidewright.errors import SchemaMismatch
from tidewright.functions.schema import (
    conform,
    has_void,
    kind_mismatches,
    merge_schema,
    nullable,
    void_free,
    void_free_ddl,
    void_free_schema,
)


def ddl(text):
    return T._parse_datatype_string(text)


def test_has_void(spark):
    assert has_void(T.NullType())
    assert has_void(T.StructType([]))
    assert has_void(T.ArrayType(T.StructType([T.StructField("a", T.NullType())])))
    assert has_void(T.MapType(T.StringType(), T.NullType()))
    assert not has_void(ddl("a int, b array<map<string,int>>"))


def test_void_parts_are_dropped_and_collapse_upward(spark):
    void = T.NullType()
    schema = T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("v", void),
            T.StructField("xs", T.ArrayType(void)),
            T.StructField("m", T.MapType(T.StringType(), void)),
            T.StructField("empty", T.StructType([])),
            T.StructField("only_void", T.StructType([T.StructField("a", T.StructType([T.StructField("b", void)]))])),
            T.StructField("st", T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", void)])),
        ]
    )
    assert void_free_schema(schema) == ddl("id bigint, st struct<a:int>")
    assert void_free(T.StructType([])) is None


def test_void_free_ddl(spark):
    quoted = T.StructType([T.StructField("a`b", T.IntegerType()), T.StructField("v", T.NullType())])
    assert void_free_ddl(quoted) == "struct<`a``b`:int>"
    assert void_free_ddl(T.StructType([T.StructField("v", T.NullType())])) == "struct<>"
    assert void_free_ddl(T.ArrayType(T.NullType())) is None
    assert void_free_ddl(ddl("m map<string,array<int>>")) == "struct<`m`:map<string,array<int>>>"


@pytest.mark.parametrize(
    "live, batch, merged",
    [
        ("id bigint, v int", "id bigint, v int, w string", "id bigint, v int, w string"),
        ("id bigint, v int", "id bigint", "id bigint, v int"),
        ("v int", "v string", "v int"),
        ("st struct<a:int>", "st struct<a:int,b:string>", "st struct<a:int,b:string>"),
        ("st struct<a:int,b:string>", "st struct<b:string,a:int>", "st struct<a:int,b:string>"),
        ("xs array<struct<a:int>>", "xs array<struct<a:int,b:int>>", "xs array<struct<a:int,b:int>>"),
        ("m map<int,struct<a:int>>", "m map<string,struct<z:int>>", "m map<int,struct<a:int,z:int>>"),
    ],
)
def test_merge(spark, live, batch, merged):
    assert merge_schema(ddl(live), ddl(batch)) == ddl(merged)


@pytest.mark.parametrize(
    "live, batch, path",
    [
        ("st struct<a:int>", "st array<int>", "st: array cannot become struct"),
        ("v int", "v struct<a:int>", "v: struct cannot become scalar"),
        ("st struct<a:struct<b:int>>", "st struct<a:map<string,int>>", "st.a: map cannot become struct"),
        ("xs array<struct<a:array<int>>>", "xs array<struct<a:int>>", "xs[].a: scalar cannot become array"),
    ],
)
def test_kind_mismatch(spark, live, batch, path):
    assert kind_mismatches(ddl(batch), ddl(live)) == [path]


def test_conform_by_name_at_every_depth(spark):
    batch = spark.createDataFrame(
        [
            (Row(b="x", a="1"), [Row(b=5)], {"k": Row(z=1, a="7")}, "12", 3),
            (None, None, None, "oops", None),
            (Row(b=None, a="no"), [None, Row(b=6)], {}, None, 4),
        ],
        "st struct<b:string,a:string>, xs array<struct<b:int>>, m map<string,struct<z:int,a:string>>, v string, extra int",
    )
    target = ddl(
        "v int, st struct<a:int,b:string,c:date>, xs array<struct<a:int,b:int>>, m map<string,struct<a:int,z:int>>, w string"
    )
    out = conform(batch, target)
    assert nullable(out.schema) == target
    first, second, third = out.collect()
    assert first == Row(v=12, st=Row(a=1, b="x", c=None), xs=[Row(a=None, b=5)], m={"k": Row(a=7, z=1)}, w=None)
    assert second == Row(v=None, st=None, xs=None, m=None, w=None)
    assert third.st == Row(a=None, b=None, c=None) and third.xs == [None, Row(a=None, b=6)] and third.m == {}


def test_conform_keeps_fitting_columns_untouched(spark, folder):
    spark.range(10).selectExpr("id", "cast(id as string) s").write.parquet(f"{folder}/t")
    df = conform(spark.read.parquet(f"{folder}/t"), ddl("s int, id bigint")).filter("id = 3")
    assert "EqualTo(id,3)" in df._jdf.queryExecution().toString()
    assert df.collect() == [Row(s=3, id=3)]


def test_conform_refuses_other_kinds_and_strict_casts_fail(spark):
    df = spark.createDataFrame([("oops",)], "v string")
    with pytest.raises(SchemaMismatch):
        conform(df, ddl("v array<int>"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, ddl("v int"), strict=True).collect()


def test_conform_reads_void_as_null(spark):
    df = spark.sql("select 1 as id, null as v, named_struct('a', null, 'b', 2) as st")
    out = conform(df, ddl("id int, v string, st struct<a:string,b:int>"))
    assert out.collect() == [Row(id=1, v=None, st=Row(a=None, b=2))]


scalars = st.sampled_from([T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.DateType(), T.NullType()])


def structs(children):
    fields = st.dictionaries(st.sampled_from("abcdef"), children, min_size=1, max_size=4)
    return fields.map(lambda d: T.StructType([T.StructField(k, v, True) for k, v in d.items()]))


types = st.recursive(
    scalars,
    lambda inner: st.one_of(
        structs(inner), inner.map(lambda e: T.ArrayType(e, True)), inner.map(lambda v: T.MapType(T.StringType(), v, True))
    ),
    max_leaves=8,
)


@settings(max_examples=200, deadline=None)
@given(structs(types), structs(types))
def test_merge_properties(live, batch):
    assert merge_schema(live, live) == live
    live, batch = void_free_schema(live), void_free_schema(batch)
    assert not live.fields or not has_void(live)
    merged = merge_schema(live, batch)
    assert merged.fieldNames()[: len(live.fields)] == live.fieldNames()
    assert set(merged.fieldNames()) == set(live.fieldNames()) | set(batch.fieldNames())
    assert merge_schema(merged, batch) == merged


@settings(max_examples=25, deadline=None)
@given(source=structs(types), target=structs(types))
def test_conform_properties(spark, source, target):
    target = void_free_schema(target)
    source = void_free_schema(source)
    if not target.fields or not source.fields or kind_mismatches(source, target):
        return
    df = spark.createDataFrame([tuple(None for _ in source.fields)], source)
    try:
        out = conform(df, target)
    except Exception as error:  # pairs of scalar types Spark never casts
        assert "DATATYPE_MISMATCH" in str(error)
        return
    assert nullable(out.schema) == target
    assert nullable(conform(out, target).schema) == target
