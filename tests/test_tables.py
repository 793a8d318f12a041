import json

import pytest
from pyspark.sql import functions as F

from nestweave.entities import CONVERSATIONS, TICKETS
from nestweave.functions.sqltypes import sql_type
from nestweave.operators.drift import ddl_feed, new_columns, registry_records, table_columns
from nestweave.operators.normalize import normalize
from nestweave.operators.worklist import enrich, failed, pending_ids, succeeded
from nestweave.plans.runs import fetch_run, normalize_run
from nestweave.sinks.tables import (
    land,
    land_in_parts,
    landed_ids,
    landing_failures,
    latest_objects,
    parse_objects,
    read_landing,
    write_objects,
    write_registry,
)
from nestweave.sources.capture import typed, unexpected
from nestweave.sources.documents import (
    documents_if_any,
    parsed_documents,
    raw_documents,
    read_documents,
    read_documents_if_any,
    split_unreadable,
)
from nestweave.sources.inference import as_type, learn, learned_schema, merged, settled
from nestweave.sources.registry import read_registry
from nestweave.session import spread
from nestweave.sources.worklist import landed_file_ids, listed_ids, listed_texts, read_worklist
from nestweave.streaming.incremental import append_batch, run_incremental
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructType


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=1))


# ---- sources


def test_multiline_documents(spark, tmp_path):
    write(tmp_path / "in/1", {"id": "1", "b": 2.5})
    write(tmp_path / "in/2", [{"id": "2", "a": [1]}, {"id": "3"}])
    df = read_documents(spark, str(tmp_path / "in"))
    assert df.columns == ["a", "b", "id"]
    assert rows(df.select("id")) == [("1",), ("2",), ("3",)]


def test_no_documents(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("empty", "missing"):
        df = read_documents_if_any(spark, str(tmp_path / folder), "id string, t array<int>")
        tables = normalize(df, TICKETS)
        assert [t.count() for t in tables.values()] == [0, 0]


def test_unreadable_files_are_set_apart(spark, tmp_path):
    write(tmp_path / "in/good", {"id": "1"})
    write(tmp_path / "in/bad", '{"id": ')
    schema = spark.createDataFrame([], "id string").schema
    write(tmp_path / "in/other", {"id": {"a": 1}, "b": 2})
    good, bad = split_unreadable(spark, str(tmp_path / "in"), schema)
    assert rows(good) == [("1",), ('{"a":1}',)]
    assert [r["file"].rsplit("/", 1)[1] for r in bad.collect()] == ["bad"]


def test_worklist_files(spark, tmp_path):
    write(tmp_path / "w/a.json", '{"id": 1}\n{"id": "x"}\n{"id": null}\n')
    write(tmp_path / "w/b.json", '{"other": 1}\n')
    write(tmp_path / "t/a.json", '{"__ticket_id__": 5}\n')
    assert rows(read_worklist(spark, str(tmp_path / "w"), CONVERSATIONS)) == [("1",), ("x",)]
    assert rows(read_worklist(spark, str(tmp_path / "t"), TICKETS)) == [("5",)]
    assert rows(read_worklist(spark, str(tmp_path / "t"), CONVERSATIONS)) == []


def test_landed_files_without_reading_them(spark, plan, tmp_path):
    for name in ("7", "8"):
        write(tmp_path / "raw" / name, {"id": name})
    ids = landed_file_ids(spark, str(tmp_path / "raw"))
    assert rows(ids) == [("7",), ("8",)]
    assert "ReadSchema: struct<>" in plan(ids)


def test_ids_listed_by_tasks(spark, tmp_path):
    for shard, name in ((0, "7"), (0, "8"), (1, "9"), (1, "7"), (1, "deep/er/10")):
        write(tmp_path / f"raw/{shard}" / name, {"id": name})
    write(tmp_path / "raw/0/_SUCCESS", "")
    paths = [(f"file://{tmp_path}/raw/{shard}",) for shard in (0, 1, 2)] + [(None,)]
    prefixes = spark.createDataFrame(paths, "prefix string")
    assert rows(listed_ids(prefixes)) == [("10",), ("7",), ("8",), ("9",)]
    assert rows(listed_ids(prefixes, "/deep/.*/([^/]+)$")) == [("10",)]
    many = listed_ids(prefixes.limit(1), listing=lambda prefix: (f"{prefix}/{k}" for k in range(25_000)))
    assert many.count() == 25_000


def test_objects_are_written_and_read_by_tasks(spark, tmp_path):
    root = f"file:{tmp_path}/raw"
    objects = [("0/a.json", '{"id": "1"}'), ("0/b.json", None), ("1/x/c.json", "é"), ("1/x/c.json", "é"), ("1/.d", "hidden")]
    for _ in range(2):  # a run that is repeated replaces its files
        write_objects(spark.createDataFrame(objects, "path string, value string"), root)
    files = sorted(str(f.relative_to(tmp_path / "raw")) for f in (tmp_path / "raw").rglob("*") if f.is_file())
    assert files == ["0/a.json", "0/b.json", "1/.d", "1/x/c.json"]
    prefixes = spark.createDataFrame([(f"file://{tmp_path}/raw/{k}",) for k in (0, 1, 2)] + [(None,)], "prefix string")
    found = {r["file"].rsplit("/", 1)[1]: r["text"] for r in listed_texts(prefixes).collect()}
    assert found == {"a.json": '{"id": "1"}\n', "b.json": "\n", "c.json": "é\né\n"}


def test_documents_below_prefixes_are_those_of_the_reader(spark, tmp_path):
    texts = ['{"id": 1, "p": {"x": "a"}}', '[{"id": 2}, {"id": 3, "p": {}}]', "[]", "", " \n", '{"id": ', '{"id": "q"}', '{"id": 4}\n{"id": 5}']
    for k, text in enumerate(texts):
        write(tmp_path / f"in/{k}.json", text)
    schema = "id bigint, p struct<x:string>"
    prefixes = spark.createDataFrame([(f"file://{tmp_path}/in",)], "prefix string")
    found = rows(read_documents(spark, prefixes, schema))
    assert found == rows(read_documents(spark, str(tmp_path / "in"), schema))
    assert len(found) == 6
    typed_schema = spark.createDataFrame([], schema).schema
    assert rows(read_documents(spark, prefixes, typed_schema)) == found
    with pytest.raises(ValueError):
        read_documents(spark, prefixes)


@pytest.mark.parametrize("name", ["layout_scan", "landed_listing", "multiline_json"])
def test_files_are_not_committed_one_by_one_by_the_driver(spark, name, monkeypatch):
    import __spark_entry__ as entry
    from pyspark.sql import DataFrameWriter

    def refuse(self, *columns):
        raise AssertionError(f"a folder per value of {columns}")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refuse)
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_spread_of_one_row_group_in_many_splits(spark, tmp_path):
    spark.range(50_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    read, least = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = {key: spark.conf.get(key) for key in (read, least)}
    try:
        spark.conf.set(read, 4096)
        spark.conf.set(least, 1)
        df = spark.read.parquet(str(tmp_path / "one"))
        assert df.rdd.getNumPartitions() >= 8
        sizes = spread(df).rdd.glom().map(len).collect()
        assert max(sizes) < 10_000 and sum(sizes) == 50_000
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


# ---- schemas and what lies outside them


DOCUMENTS = [
    {"id": "1", "a": 1, "n": {"x": 1, "zz": [1, 2]}, "l": [{"k": 1}, {"k": "q", "m": 2}]},
    {"id": "2", "a": "x", "new f": 0.5, "none": None, "empty": {}, "list": []},
    {"id": 3, "a": 3.5, "n": 7, "l": None, "new f": 1, "deep": [[{"b": True}]]},
    {"id": "4", "n": {"x": 2.5, "y": None}, "big": 12345678901234567890, "l": [{"m": 1.5}]},
]


def test_learned_schemas_equal_full_inference(spark, tmp_path):
    raw, store, checkpoint = (str(tmp_path / n) for n in ("raw", "store", "checkpoint"))
    assert learned_schema(spark, store).fields == []
    for k, document in enumerate(DOCUMENTS):
        write(tmp_path / f"raw/{k}", document)
        found = learn(spark, raw, store, checkpoint)
        full = read_documents(spark, raw).schema
        assert found.simpleString() == full.simpleString()
    assert len(list((tmp_path / "store").glob("batch=*"))) == len(DOCUMENTS)
    one_pass = learn(spark, raw, str(tmp_path / "again"), str(tmp_path / "fresh"))
    assert one_pass == found


def test_merging_schemas_takes_any_order(spark, tmp_path):
    import itertools
    from functools import reduce

    kinds = [as_type(t) for t in ("OBJECT<a: BIGINT, b: ARRAY<VOID>>", "OBJECT<a: VOID, `c d`: OBJECT<>>",
                                  "OBJECT<a: DECIMAL(3,1), b: ARRAY<OBJECT<x: BOOLEAN>>>", "OBJECT<a: DECIMAL(20,0)>")]
    results = {settled(reduce(merged, some)).simpleString() for some in itertools.permutations(kinds)}
    assert results == {"struct<a:double,b:array<struct<x:boolean>>>"}


def test_unexpected_values(spark, tmp_path):
    schema = StructType.fromDDL("id string, a int, n struct<x:bigint>, l array<struct<k:int>>")
    for k, document in enumerate(DOCUMENTS):
        write(tmp_path / f"in/{k}", document)
    documents = parsed_documents(raw_documents(spark.read, str(tmp_path / "in")))
    assert rows(typed(documents, schema).select("id", "a", "n.x", "l.k")) == [
        ("1", 1, 1, [1, None]), ("2", None, None, None), ("3", 3, None, None), ("4", None, 2, [None])]
    key = F.try_variant_get("document", "$.id", "string").alias("id")
    found = rows(unexpected(documents.select(key, "document"), schema, ["id"]))
    assert found == [
        ("1", "l[].k", "mistyped", '"q"'), ("1", "l[].m", "unknown", "2"), ("1", "n.zz", "unknown", "[1,2]"),
        ("2", "a", "mistyped", '"x"'), ("2", "empty", "unknown", "{}"), ("2", "list", "unknown", "[]"),
        ("2", "new f", "unknown", "0.5"), ("2", "none", "unknown", "null"),
        ("3", "deep", "unknown", '[[{"b":true}]]'), ("3", "n", "mistyped", "7"), ("3", "new f", "unknown", "1"),
        ("4", "big", "unknown", "12345678901234567890"), ("4", "l[].m", "unknown", "1.5"), ("4", "n.y", "unknown", "null"),
    ]


# ---- worklist and landing


def test_pending_ids(spark):
    work = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string")
    landed = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    assert rows(pending_ids(work, landed, CONVERSATIONS)) == [("2",)]
    assert rows(pending_ids(work, None, CONVERSATIONS)) == [("1",), ("2",)]
    assert rows(pending_ids(work, landed, TICKETS)) == [("1",), ("2",), ("2",)]


def test_enrich_isolates_errors(spark):
    def fetch(value):
        if value == "3":
            raise RuntimeError(value)
        return (200, f"<{value}>") if value != "2" else (500, None)

    out = enrich(spark.range(5), fetch, 2)
    assert out.rdd.getNumPartitions() == 2
    assert rows(succeeded(out)) == [("0", 200, "<0>"), ("1", 200, "<1>"), ("4", 200, "<4>")]
    assert rows(failed(out)) == [("2", 500, None), ("3", None, "RuntimeError: 3")]


def test_enrich_hands_bodies_on_in_bounded_frames(spark):
    """Ten thousand bodies of one megabyte; a worker must hold but a few of them."""

    def fetch(value):
        import resource

        if resource.getrusage(resource.RUSAGE_SELF).ru_maxrss > 1 << 20:  # kilobytes
            raise MemoryError
        return 200, value[:1] * (1 << 20)

    fetched = enrich(spark.range(10_000), fetch, 8)
    found = fetched.agg(F.count("*"), F.count("error"), F.sum(F.length("body"))).first()
    assert tuple(found) == (10_000, 0, 10_000 << 20)


def test_a_batch_in_parts_goes_on_where_it_ended(spark, tmp_path):
    root, calls = str(tmp_path / "landing"), []
    pending = spark.createDataFrame([(str(k),) for k in range(40)], "id string")

    def attempt(ends_at):
        def fetched(rows):
            calls.append(rows.count())
            if len(calls) == ends_at:
                raise InterruptedError
            return enrich(rows, lambda key: (200, f"{ends_at}"), 2)

        return fetched

    with pytest.raises(InterruptedError):
        land_in_parts(pending, attempt(3), root, 7, 5)
    assert 0 < read_landing(spark, root).count() < 40
    land_in_parts(pending.limit(0), attempt(None), root, 7, 5)  # the rows of the first attempt count
    landing = read_landing(spark, root)
    assert sorted(int(r["id"]) for r in landing.collect()) == list(range(40))
    assert len(calls) == 6 and {r["body"] for r in landing.collect()} == {"3", "None"}
    land_in_parts(pending, attempt(None), root, 7, 5)
    assert len(calls) == 6


def test_landing_replaces_a_batch_and_reads_the_latest(spark, tmp_path):
    root = str(tmp_path / "landing")
    schema = "id string, status int, body string"
    first = [("1", 200, '{"id":1,"v":"a"}'), ("2", 404, None), ("3", None, None)]
    land(spark.createDataFrame(first, schema), root, 1)
    land(spark.createDataFrame([("1", 200, '{"id":1,"v":"b"}'), ("4", 500, None)], schema), root, 2)
    land(spark.createDataFrame([("1", 200, '{"id":1,"v":"c"}')], schema), root, 2)
    landing = read_landing(spark, root)
    assert landing.count() == 4
    assert rows(landed_ids(landing).distinct()) == [("1",)]
    assert rows(landing_failures(landing)) == [("2", 404, None, 1), ("3", None, None, 1)]
    latest = latest_objects(landing)
    assert rows(parse_objects(latest)) == [(1, "c")]
    assert rows(parse_objects(latest, "v string")) == [("c",)]


def test_fetch_run(spark, tmp_path):
    write(tmp_path / "w/a.json", '{"id": 1}\n{"id": 2}\n{"id": 2}\n')
    root = str(tmp_path / "landing")

    def fetch(url):
        return 200, json.dumps({"url": url})

    def run(batch, landed):
        fetch_run(spark, CONVERSATIONS, str(tmp_path / "w"), landed, root, batch, "https://h", fetch)

    run(1, spark.createDataFrame([("1",)], "id string"))
    assert rows(read_landing(spark, root).select("id", "body")) == [
        ("2", '{"url": "https://h/conversations/2?display_as=string"}')
    ]
    run(2, landed_ids(read_landing(spark, root)))
    assert rows(read_landing(spark, root).select("id", "batch")) == [("1", 2), ("2", 1)]


# ---- drift


@pytest.mark.parametrize(
    ("dtype", "base", "child"),
    [
        (IntegerType(), "INT", "INT"),
        (DateType(), "DATETIME", "DATETIME"),
        (StringType(), "NVARCHAR(MAX)", "NVARCHAR(MAX)"),
        (DoubleType(), "FLOAT", "NVARCHAR(MAX)"),
        (LongType(), "NVARCHAR(MAX)", "NVARCHAR(MAX)"),
        (BooleanType(), "NVARCHAR(MAX)", "NVARCHAR(MAX)"),
    ],
)
def test_sql_types(dtype, base, child):
    assert sql_type(dtype) == base
    assert sql_type(dtype, child=True) == child
    assert sql_type(DoubleType(), child=True, child_double_as_text=False) == "FLOAT"


REGISTRY = "table string, name string, type string"


@pytest.mark.parametrize(
    ("entity", "statement"),
    [
        (CONVERSATIONS, "ALTER TABLE conversation_history_rest_of_fields ADD [__n__] FLOAT;"),
        (TICKETS, "ALTER TABLE intercom_tickets_rest_of_fields ADD __n__ FLOAT;"),
    ],
)
def test_drift_golden(spark, entity, statement):
    df = spark.createDataFrame([("1", 0.5)], "id string, n double")
    current = table_columns(spark, normalize(df, entity), entity)
    known = spark.createDataFrame([(entity.base_table, "__id__", "NVARCHAR(MAX)")], REGISTRY)
    drift = new_columns(current, known)
    assert rows(drift) == [(entity.base_table, "__n__", "FLOAT", "new")]
    assert rows(ddl_feed(drift, entity)) == [(entity.base_table, statement)]
    again = new_columns(current, current)
    assert rows(ddl_feed(again, entity)) == [(entity.noop_table, entity.noop_statement)]


def test_type_change_and_dropped_columns(spark):
    current = spark.createDataFrame([("t", "a", "INT"), ("t", "b", "INT"), ("u", "A", "INT")], REGISTRY)
    known = spark.createDataFrame([("t", "a", "FLOAT"), ("t", "gone", "INT"), ("u", "a", "INT")], REGISTRY)
    assert rows(new_columns(current, known)) == [
        ("t", "a", "INT", "type_change"),
        ("t", "b", "INT", "new"),
        ("u", "A", "INT", "new"),
    ]


def test_registry_round_trip(spark, tmp_path):
    root = str(tmp_path / "registry")
    empty = read_registry(spark, root)
    assert empty.count() == 0
    first = spark.createDataFrame([("t", "b", "INT"), ("t", "a", "INT"), ("u", "x", "INT")], REGISTRY)
    write_registry(empty, new_columns(first, empty), root)
    untouched = {p.name for p in (tmp_path / "registry/table=u").glob("*.json")}
    known = read_registry(spark, root)
    assert rows(known) == rows(first)
    write_registry(known, spark.createDataFrame([("t", "c", "INT")], REGISTRY), root)
    assert rows(read_registry(spark, root).where("table = 't'").select("name")) == [("a",), ("b",), ("c",)]
    assert {p.name for p in (tmp_path / "registry/table=u").glob("*.json")} == untouched
    (one_file,) = (tmp_path / "registry/table=t").glob("*.json")
    record = json.loads(one_file.read_text())
    assert json.loads(record["columns"])[0] == {"name": "a", "type": "INT"}
    records = registry_records(read_registry(spark, root))
    assert rows(records.select("table")) == [("t",), ("u",)]


def test_normalize_run(spark, tmp_path):
    def run(documents):
        write(tmp_path / "in/1", documents)
        return normalize_run(
            read_documents(spark, str(tmp_path / "in")),
            CONVERSATIONS,
            *(str(tmp_path / name) for name in ("tables", "registry", "ddl")),
        )

    def statements():
        return sorted(r["statement"] for r in spark.read.json(str(tmp_path / "ddl")).collect())

    run([{"id": "1", "t": [{"k": 1}]}, {"id": "2"}])
    assert statements() == [
        "ALTER TABLE conversation_history_rest_of_fields ADD [__id__] NVARCHAR(MAX);",
        "ALTER TABLE conversation_history_t ADD [__id__] NVARCHAR(MAX), [__t_k__] NVARCHAR(MAX);",
    ]
    child = spark.read.parquet(str(tmp_path / "tables/conversation_history_t"))
    assert rows(child) == [("1", 1), ("2", None)]
    run([{"id": "1", "t": [{"k": 1}]}])
    assert statements() == [CONVERSATIONS.noop_statement]
    run([{"id": "1", "t": [{"k": 1}], "new one": 0.5}])
    assert statements() == ["ALTER TABLE conversation_history_rest_of_fields ADD [__newone__] FLOAT;"]
    assert read_registry(spark, str(tmp_path / "registry")).count() == 4


# ---- incremental


def test_incremental_handles_each_document_once(spark, tmp_path):
    raw, root, checkpoint = (str(tmp_path / n) for n in ("raw", "tables", "checkpoint"))
    schema = "id string, t array<int>"

    def run():
        run_incremental(spark, raw, schema, TICKETS, root, checkpoint)
        return rows(spark.read.parquet(f"{root}/intercom_tickets_t").select("__id__", "__t__"))

    write(tmp_path / "raw/1", {"id": "1", "t": [1, 2]})
    write(tmp_path / "raw/2", {"id": "2"})
    assert run() == [("1", 1), ("1", 2), ("2", None)]
    write(tmp_path / "raw/3", {"id": "3", "t": [3]})
    assert run() == [("1", 1), ("1", 2), ("2", None), ("3", 3)]
    assert run() == [("1", 1), ("1", 2), ("2", None), ("3", 3)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    root, schema = str(tmp_path), StructType.fromDDL("id string, t array<int>")
    raw = lambda *texts: spark.createDataFrame([("f", t) for t in texts], "file string, text string")
    for _ in range(2):
        append_batch(raw('{"id": "1", "t": [1], "more": 1}', "{"), 4, schema, TICKETS, root)
    assert spark.read.parquet(f"{root}/intercom_tickets_t").count() == 1
    assert rows(spark.read.parquet(f"{root}/_statements").select("statement")) == [
        ("ALTER TABLE intercom_tickets_rest_of_fields ADD __id__ NVARCHAR(MAX), __more__ NVARCHAR(MAX);",),
        ("ALTER TABLE intercom_tickets_t ADD __id__ NVARCHAR(MAX), __t__ INT;",),
    ]
    assert spark.read.parquet(f"{root}/_unreadable").count() == 1


def test_fields_that_grow_and_values_that_do_not_fit(spark, tmp_path):
    root, schema = str(tmp_path / "tables"), StructType.fromDDL("id string, a int")
    texts = ['{"id": "1", "a": 1}', '{"id": "2", "a": "x", "b": 0.5}', '{"id": "3", "a": 3, "b": "y"}']
    for batch, text in enumerate(texts):
        append_batch(spark.createDataFrame([("f", text)], "file string, text string"), batch, schema, TICKETS, root)
    base = spark.read.option("mergeSchema", True).parquet(f"{root}/intercom_tickets_rest_of_fields")
    assert rows(base.select("__id__", "__a__", "__b__")) == [("1", 1, None), ("2", None, 0.5), ("3", 3, None)]
    assert rows(spark.read.parquet(f"{root}/_unexpected").select("batch", "path", "kind", "value")) == [
        (1, "a", "mistyped", '"x"'), (2, "b", "mistyped", '"y"')]
    statements = spark.read.parquet(f"{root}/_statements").select("batch", "statement")
    assert [s for b, s in rows(statements) if b == 1] == ["ALTER TABLE intercom_tickets_rest_of_fields ADD __b__ FLOAT;"]
    assert [s for b, s in rows(statements) if b == 2] == [TICKETS.noop_statement]
    pinned = str(tmp_path / "pinned")
    append_batch(spark.createDataFrame([("f", texts[1])], "file string, text string"), 0, schema, TICKETS, pinned, evolve=False)
    assert rows(spark.read.parquet(f"{pinned}/_unexpected").select("path", "kind")) == [("a", "mistyped"), ("b", "unknown")]


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("empty", "missing"):
        documents = documents_if_any(spark, str(tmp_path / folder))
        where = [str(tmp_path / name) for name in ("tables", "registry", "ddl")]
        assert documents is None and normalize_run(documents, CONVERSATIONS, *where) == {}
        assert not any((tmp_path / name).exists() for name in ("tables", "registry", "ddl"))
