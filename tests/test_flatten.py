import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from nestweave.entities import CONVERSATIONS, TICKETS
from nestweave.functions import naming
from nestweave.operators.flatten import array_free_fields, array_parents, flatten
from nestweave.operators.normalize import base_table, child_table, join_children, normalize


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def documents(spark, *records, schema=None):
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(spark.sparkContext.parallelize(list(records)))


def test_golden(spark):
    df = documents(spark, '{"id":"1","a":{"b":1,"c":{"d":2}},"t":[{"k":"x"},{"k":"y"}]}')
    assert array_parents(df.schema) == ["t"]
    assert array_free_fields(df.schema) == ["a", "id"]
    tables = normalize(df, CONVERSATIONS)
    base = tables["conversation_history_rest_of_fields"]
    child = tables["conversation_history_t"]
    assert base.first().asDict() == {"__id__": "1", "__a_b__": 1, "__a_c_d__": 2}
    assert child.columns == ["__id__", "__t_k__"]
    assert rows(child) == [("1", "x"), ("1", "y")]


def test_sibling_arrays_multiply_and_empty_ones_keep_their_row(spark):
    schema = "a array<int>, b array<string>"
    assert len(rows(flatten(documents(spark, '{"a":[1,2],"b":["x","y"]}', schema=schema)))) == 4
    assert rows(flatten(documents(spark, '{"a":[],"b":null}', schema=schema))) == [(None, None)]


def test_empty_map_drops_its_row_unless_outer(spark):
    df = documents(spark, '{"m":{"a":1}}', '{"m":{}}', "{}", schema="m map<string,int>")
    assert rows(flatten(df)) == [("a", 1)]
    assert len(rows(flatten(df, map_outer=True))) == 3
    assert flatten(df).columns == ["m_key", "m_value"]


def test_nested_generators(spark):
    df = documents(
        spark,
        '{"id":1,"s":{"x":[{"y":[1,2],"m":{"k":{"z":[5]}}},{"y":[]}]}}',
        schema="id int, s struct<x:array<struct<y:array<int>,m:map<string,struct<z:array<int>>>>>>",
    )
    flat = flatten(df)
    assert flat.columns == ["id", "s_x_y", "s_x_m_key", "s_x_m_value_z"]
    assert rows(flat) == [(1, 1, "k", 5), (1, 2, "k", 5)]


def test_arrays_under_map_values_are_found(spark):
    schema = spark.createDataFrame([], "m map<string,array<int>>, n map<string,int>, s struct<a:int>").schema
    assert array_parents(schema) == ["m"]
    assert array_free_fields(schema) == ["n", "s"]


def test_dotted_names(spark):
    df = spark.range(1).select(F.struct(F.struct(F.lit(1).alias("b.c")).alias("x.y")).alias("a.b"))
    assert flatten(df).columns == ["a.b_x.y_b.c"]
    assert rows(flatten(df)) == [(1,)]


def test_collisions_get_suffixes(spark):
    df = spark.range(1).select(
        F.lit(1).alias("a_b"), F.struct(F.lit(2).alias("b")).alias("a"), F.lit(3).alias("a_b_2")
    )
    flat = flatten(df)
    assert dict(zip(flat.columns, flat.first())) == {"a_b": 1, "a_b_2": 3, "a_b_3": 2}
    assert naming.distinct_names(["x", "X", "x"]) == ["x", "X_2", "x_3"]
    assert naming.column_names(["a-b c", "abc", "d.e"]) == ["__abc__", "__abc_2__", "__d.e__"]
    assert naming.distinct_names(["n" * 128, "n" * 128], 128)[1] == "n" * 126 + "_2"


def test_sanitise_cleans_all_levels_and_keeps_values(spark):
    df = spark.range(1).select(
        F.lit("v").alias("What is it? (x/y).z!"),
        F.struct(F.array(F.struct(F.lit(1).alias("a:b"))).alias("c d")).alias("e,f"),
        F.create_map(F.lit("k"), F.struct(F.lit(2).alias("g!"))).alias("h"),
        F.create_map(F.lit("k"), F.lit(3)).alias("i"),
        F.array(F.array(F.struct(F.lit(4).alias("j k")))).alias("l"),
        F.lit(5).alias("m" * 200),
    )
    clean = naming.sanitise(df)
    assert clean.columns == ["Whatisitxyz", "ef", "h", "i", "l", "m" * 128]
    assert clean.schema["ef"].dataType.simpleString() == "struct<cd:array<struct<ab:int>>>"
    assert clean.schema["h"].dataType.simpleString() == "map<string,struct<g:int>>"
    assert "j k" in clean.schema["l"].dataType.simpleString()
    before, after = df.first(), clean.first()
    assert after["Whatisitxyz"] == before[0]
    assert after["ef"]["cd"][0]["ab"] == 1
    assert after["h"]["k"]["g"] == 2


def test_no_base_fields(spark):
    df = documents(spark, '{"t":[1]}')
    assert base_table(df) is None
    with_id = documents(spark, '{"id":1,"t":[1]}')
    assert list(normalize(with_id.select("t", "id"), TICKETS)) == [
        "intercom_tickets_rest_of_fields",
        "intercom_tickets_t",
    ]


def test_random_documents(spark):
    """Rows per document: the product of array sizes, empty arrays counting as one."""
    rng = random.Random(5)
    sizes = [(i, rng.choice([None, 0, 1, 2, 5]), rng.choice([None, 0, 1, 3])) for i in range(300)]
    data = [
        (i, None if a is None else list(range(a)), None if b is None else [(str(k),) for k in range(b)])
        for i, a, b in sizes
    ]
    df = spark.createDataFrame(data, "id int, x array<int>, y array<struct<z:string>>")
    nested = df.select("id", F.struct("x", F.struct("y").alias("in")).alias("s"))
    child = child_table(nested, "s")
    assert not any(isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in child.schema)
    counts = {r["__id__"]: r["count"] for r in child.groupBy("__id__").count().collect()}
    assert counts == {i: max(1, a or 0) * max(1, b or 0) for i, a, b in sizes}
    assert base_table(df).count() == 300


def test_join_children_keeps_childless_documents(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "__id__ string, n int")
    child = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "__id__ string, k string")
    assert rows(join_children(base, child)) == rows(base.join(child, "__id__", "left"))


@pytest.mark.parametrize("entity", [CONVERSATIONS, TICKETS])
def test_plans_stay_in_the_jvm_and_do_not_shuffle(spark, plan, entity):
    df = documents(
        spark,
        "{}",
        schema="id string, a struct<b:int>, t array<struct<k:string,u:array<int>>>, m map<string,int>",
    )
    path = str(spark.conf.get("spark.checkpoint.dir")) + f"/flat-{entity.name}"
    df.write.mode("overwrite").parquet(path)
    for table in normalize(spark.read.parquet(path), entity).values():
        text = plan(table)
        for word in ("Python", "MapIn", "ExistingRDD", "Exchange"):
            assert word not in text
    child = normalize(spark.read.parquet(path), entity)[entity.child_table("t")]
    assert "ReadSchema: struct<id:string,t:array" in plan(child)


def test_one_huge_document_is_dealt_out(spark):
    wide = spark.range(1).selectExpr("id", "sequence(1, 20000) AS a", "sequence(1, 200) AS b", "array() AS none")
    flat = flatten(wide, spread_rows=64)
    per_task = [r["n"] for r in flat.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(per_task) == 20_000 * 200 and len(per_task) == tasks
    assert max(per_task) <= 2 * sorted(per_task)[tasks // 2]
    assert flat.distinct().count() == 20_000 * 200


def test_dealing_out_changes_no_row(spark):
    rows = [(1, [1, 2, 3, 4, 5], ["x", "y"]), (2, [], ["z"]), (3, None, None), (4, [None, 7], [])]
    df = spark.createDataFrame(rows, "id int, a array<int>, b array<string>")
    for size in (1, 2, 100):
        assert sorted(map(repr, flatten(df, spread_rows=size).collect())) == sorted(map(repr, flatten(df).collect()))
