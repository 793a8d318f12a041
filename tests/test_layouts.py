import base64
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from nestweave.operators.chunks import document_chunks, document_groups, document_texts, explode_chunks
from nestweave.operators.headings import group_pages, h1_groups
from nestweave.operators.responses import response_envelopes, responses
from nestweave.operators.sections import document_sections, drop_footers, explode_sections
from nestweave.operators.stream import composed, run_effect, stream_chunks, stream_groups
from nestweave.plans.runs import chunk_run
from nestweave.sources.documents import parse_layouts, read_layouts
from nestweave.sources.envelope import decode_payload, read_requests, route_payloads
from tests.model import chunks_of, groups_of, packed


def layouts(spark, *results):
    """``(doc, analyzeResult)`` of layout results, numbered from 0."""
    data = [(i, json.dumps({"analyzeResult": r})) for i, r in enumerate(results)]
    return parse_layouts(spark.createDataFrame(data, "doc int, layout string"), "doc", "layout")


def sections(spark, *results):
    return document_sections(layouts(spark, *results))


def section(content, h1=None, h2=None, h3=None, page=None, y=None):
    out = {"content": content, "sections": {"h1": h1, "h2": h2, "h3": h3}, "pageNumber": page}
    return out if y is None else {**out, "boundingPolygons": [[{"x": 0, "y": y}]]}


def markdown(*rows):
    return {"markdown": {"sections": list(rows)}}


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ---- sections and footers


def test_markdown_sections_win_even_if_empty(spark):
    pages = {"pages": [{"pageNumber": 3, "blocks": [{"content": "b"}]}]}
    df = sections(
        spark, {**markdown(section("a", "H")), **pages}, {**markdown(), **pages}, {"markdown": {}, **pages}, {}
    )
    found = {r["doc"]: [(s["content"], s["h1"], s["pageNumber"]) for s in r["sections"]] for r in df.collect()}
    assert found == {0: [("a", "H", None)], 1: [], 2: [("b", None, 3)], 3: []}


def test_null_lists_count_as_missing(spark):
    df = sections(
        spark,
        {"markdown": {"sections": None}, "pages": [{"blocks": [{"content": "b"}]}, {"blocks": None}, {}]},
        {"pages": None},
    )
    assert [len(r["sections"]) for r in df.orderBy("doc").collect()] == [1, 0]


def test_blocks_in_page_order_with_headings(spark):
    pages = [
        {"pageNumber": 1, "blocks": [{"category": "sectionHeading", "content": "T"}, {"content": "x"}]},
        {"pageNumber": 2, "blocks": [{"category": "text", "content": "y", "boundingPolygons": [[{"y": 1}]]}]},
    ]
    df = explode_sections(sections(spark, {"pages": pages})).orderBy("seq")
    assert values(df, "seq", "content", "h1", "h2", "pageNumber", "boundingPolygons") == [
        (0, "T", "T", None, 1, "[]"),
        (1, "x", None, None, 1, "[]"),
        (2, "y", None, None, 2, '[[{"y":1}]]'),
    ]


FOOTERS = ["", "  ", "12", " ٣ ", "Inspection Report 2020", None]


def test_footers(spark):
    kept = [section("12a"), section("high", y=0.85), section("low", y=0.05), section("odd", y="0.99")]
    dropped = [*map(section, FOOTERS), section("high", y=0.86), section("low", y=0.04)]
    df = sections(spark, markdown(*kept, *dropped))
    assert [s[0] for s in values(drop_footers(explode_sections(df)), "content")] == [
        "12a",
        "high",
        "low",
        "odd",
    ]
    content = "\n".join(["12a", "high", "low", "odd"])
    assert values(explode_chunks(document_chunks(df)), "content") == [(content,)]
    everything = document_chunks(df, footer_high=2, footer_low=-1)
    assert values(explode_chunks(everything), "content") == [(content + "\nhigh\nlow",)]


def test_polygons_given_as_text_count_as_mid_page(spark):
    row = {**section("x"), "boundingPolygons": '[[{"y": 0.99}]]'}
    df = sections(spark, markdown(row))
    assert values(explode_chunks(document_chunks(df)), "content") == [("x",)]
    assert drop_footers(explode_sections(df)).count() == 1


def test_layout_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"analyzeResult": markdown(section("t", "H"))}, indent=1))
    (tmp_path / "in/b.json").write_text("{}")
    assert read_layouts(spark, str(tmp_path / "in")).count() == 2
    chunk_run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    found = {r["doc"].rsplit("/", 1)[1]: [c["content"] for c in r["chunks"]] for r in out.collect()}
    assert found == {"a.json": ["H\nt"], "b.json": []}


def test_no_layout_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("empty", "missing"):
        chunk_run(spark, str(tmp_path / folder), str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == 0


def test_layout_errors_are_of_the_text_only(spark):
    pages = ["3", 3.0, 3, "x", None, [3], {"a": 1}, 2.9]
    texts = [json.dumps({"analyzeResult": {"markdown": {"sections": [{"content": "x", "pageNumber": p}]}}}) for p in pages]
    texts += ['{"analyzeResult": {"markdown": {', None, "", "{}", '{"analyzeResult": 5}', '{"analyzeResult": {"markdown": {"sections": "x"}}}',
              '{"analyzeResult": {"pages": [{"pageNumber": "2", "blocks": [{"content": 7, "category": 1}, "junk", null]}]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, layout string")
    parsed = parse_layouts(df, "doc", "layout")
    errors = [r["error"] for r in parsed.orderBy("doc").collect()]
    assert errors == [None] * 8 + ["layout result is not valid JSON", "no layout result", "layout result is not valid JSON"] + [None] * 4
    found = values(explode_sections(document_sections(parsed)).orderBy("doc", "seq"), "doc", "content", "pageNumber")
    assert found[:8] == [(k, "x", p) for k, p in enumerate([3, 3, 3, None, None, None, None, 2])]
    assert found[8:] == [(14, "7", 2), (14, "", 2), (14, "", 2)]


# ---- folds


GOLDEN = markdown(
    section("A", "A", page=1),
    section("intro", page=1),
    section("text b", "A", "B", page=2),
    section("7", page=2),
    section("more", "A", page=3),
    section("C start", "C", page=4),
)


def test_golden_chunks(spark, plan):
    df = explode_chunks(document_chunks(sections(spark, GOLDEN)))
    columns = ["content", "h1", "h2", "h3", "sectionPath", "sectionLevel", "pageStart", "pageEnd"]
    assert values(df.orderBy("chunk"), *columns) == [
        ("A\nintro", "A", None, None, "A", 1, 1, 1),
        ("B\ntext b\nmore", "A", "B", None, "A > B", 2, 2, 3),
        ("C start", "C", None, None, "C", 1, 4, 4),
    ]


def test_rows_before_headings_and_late_pages(spark):
    df = sections(spark, markdown(section("x"), section("y", "", ""), section("H z", "H"), section("w", page=5)))
    out = explode_chunks(document_chunks(df)).orderBy("chunk")
    assert values(out, "content", "h1", "sectionPath", "sectionLevel", "pageStart", "pageEnd") == [
        ("x\ny", None, "", 0, None, None),
        ("H z\nw", "H", "H", 1, 5, 5),
    ]


def test_empty_heading_next_to_a_real_one_is_kept_as_it_is(spark):
    out = explode_chunks(document_chunks(sections(spark, markdown(section("x", "A", "", "")))))
    assert values(out, "h1", "h2", "h3", "sectionPath", "sectionLevel") == [("A", "", "", "A", 1)]


def test_a_heading_on_a_dropped_row_is_lost(spark):
    df = sections(spark, markdown(section(" ", "A"), section("x")))
    assert values(explode_chunks(document_chunks(df)), "content", "h1") == [("x", None)]


@pytest.mark.parametrize(
    ("texts", "chunks"),
    [
        (["aaaa", "bb", "cccccccc"], ["aaaa\nbb", "b\ncccccccc"]),
        (["cccccccccc"], ["", "cccccccccc"]),
        ([], []),
        ([" ", " "], []),
    ],
)
def test_packing(spark, texts, chunks):
    df = spark.createDataFrame([("d", texts)], "doc string, texts array<string>")
    assert [c for (c,) in values(document_texts(df, 8, 2).orderBy("chunk"), "content")] == chunks
    kept = document_texts(df, 8, 2, drop_empty=True)
    assert [c for (c,) in values(kept.orderBy("chunk"), "content")] == [c for c in chunks if c]


def test_no_overlap_repeats_nothing(spark):
    df = spark.createDataFrame([("d", ["aaaa", "bbbb", "cccc"])], "doc string, texts array<string>")
    assert [c for (c,) in values(document_texts(df, 6, 0).orderBy("chunk"), "content")] == [
        "aaaa",
        "bbbb",
        "cccc",
    ]


def test_lengths_count_characters(spark):
    df = spark.createDataFrame([("d", ["🙂🙂", "éé", "x"])], "doc string, texts array<string>")
    assert [c for (c,) in values(document_texts(df, 6, 2).orderBy("chunk"), "content")] == [
        "🙂🙂\néé",
        "é\nx",
    ]


def random_rows(rng, levels):
    size, share = rng.choice([1, 2, 5, 9, 30, 60]), rng.choice([0, 0.05, 0.3, 0.7])
    texts = ["  x", "A b", "B", "q\n r", "🙂", "y" * rng.randint(1, 70), "z" * rng.randint(1, 12)]
    return [
        (
            *(rng.choice(["A", "B", ""]) if k < levels and rng.random() < share else None for k in range(3)),
            rng.choice(texts),
            rng.choice([None, 1, 2, 3]),
        )
        for _ in range(size)
    ]


@pytest.fixture(scope="module", params=[1, 3])
def random_documents(spark, request):
    """Rows per document, and the stream with gaps where footers were."""
    rng = random.Random(request.param)
    documents, stream = {}, []
    for doc in range(250):
        rows = random_rows(rng, request.param)
        kept = [i for i in range(len(rows)) if rng.random() < 0.8]
        documents[doc] = [rows[i] for i in kept]
        stream += [(doc, i, *rows[i]) for i in kept]
    schema = "doc bigint, seq bigint, h1 string, h2 string, h3 string, content string, pageNumber int"
    return documents, spark.createDataFrame(stream, schema).repartition(8), request.param


def test_array_folds_equal_the_model(spark, random_documents):
    documents, stream, _ = random_documents
    row = F.struct("seq", "content", "h1", "h2", "h3", "pageNumber")
    arrays = stream.groupBy("doc").agg(F.sort_array(F.collect_list(row)).alias("sections"))
    found = {}
    for r in document_groups(arrays).orderBy("doc", "no").collect():
        found.setdefault(r["doc"], []).append(
            [(r["h1"], r["h2"], r["h3"]), r["texts"], r["pageStart"], r["pageEnd"]]
        )
    assert found == {d: groups_of(rows) for d, rows in documents.items() if rows}


@pytest.mark.parametrize("block_rows", [1, 3, 7, 4096])
def test_block_folds_equal_the_model(random_documents, block_rows):
    documents, stream, levels = random_documents
    found = {}
    chunks = stream_chunks(stream, 40, 9, block_rows=block_rows)
    for r in chunks.orderBy("doc", "group", "block", "part").collect():
        found.setdefault(r["doc"], []).append(
            (r["content"], r["h1"], r["h2"], r["h3"], r["pageStart"], r["pageEnd"])
        )
    assert found == {d: chunks_of(rows, 40, 9) for d, rows in documents.items() if chunks_of(rows, 40, 9)}

    expected = {
        d: [(*h, len(texts), first, last) for h, texts, first, last in groups_of(rows)]
        for d, rows in documents.items()
        if rows
    }
    found = {}
    for r in stream_groups(stream, block_rows).orderBy("doc", "group").collect():
        found.setdefault(r["doc"], []).append(
            (r["h1"], r["h2"], r["h3"], r["rows"], r["pageStart"], r["pageEnd"])
        )
    assert found == expected
    if levels == 1:
        found = {}
        for r in group_pages(h1_groups(stream, block_rows)).orderBy("doc", "group").collect():
            found.setdefault(r["doc"], []).append(
                (r["heading"], None, None, r["rows"], r["pageStart"], r["pageEnd"])
            )
        assert found == expected


def test_rows_without_a_document_are_kept(spark):
    rows = [(None, i, "A" if i == 3 else None, None, None, f"t{i}", i) for i in range(10)]
    schema = "doc string, seq bigint, h1 string, h2 string, h3 string, content string, pageNumber int"
    stream = spark.createDataFrame(rows, schema)
    expected = [(3, 0, 2), (7, 3, 9)]
    for groups in (stream_groups(stream, 4), group_pages(h1_groups(stream, 4))):
        assert values(groups.orderBy("group"), "rows", "pageStart", "pageEnd") == expected
    chunks = stream_chunks(stream, 6, 1, block_rows=4).orderBy("group", "block", "part")
    assert len(chunks.collect()) == len(chunks_of([(*r[2:6], r[6]) for r in rows], 6, 1))


def test_one_large_document_is_not_gathered_in_one_task(spark, plan):
    rows = [(0, i, "H" if i % 1000 == 999 else None, None, None, f"text {i}", i // 50) for i in range(6000)]
    schema = "doc int, seq bigint, h1 string, h2 string, h3 string, content string, pageNumber int"
    stream = spark.createDataFrame(rows, schema)
    chunks = stream_chunks(stream, 200, 20, block_rows=64)
    got = [r["content"] for r in chunks.orderBy("group", "block", "part").collect()]
    assert got == [c[0] for c in chunks_of([(*r[2:6], r[6]) for r in rows], 200, 20)]


def after_texts(lengths, limit, overlap, size):
    full = max(limit, overlap)
    for length in lengths:
        added = length + 1
        size = min(size + added if size + added <= limit else min(size, overlap) + added, full)
    return size


def effect_at(effect, size, full):
    pieces = list(zip(effect[0::3], effect[1::3], effect[2::3]))
    assert [p[0] for p in pieces] == sorted({p[0] for p in pieces}) and pieces[0][0] == 0
    start, value, slope = [p for p in pieces if p[0] <= size][-1]
    return min(value + slope * (size - start), full)


def random_lengths(rng, most=12):
    return [rng.choice([0, 1, 3, 7, rng.randint(0, 60)]) for _ in range(rng.randint(0, most))]


def test_buffer_effect():
    rng = random.Random(2)
    for _ in range(600):
        limit, overlap = rng.choice([5, 20, 40]), rng.choice([0, 1, 9, 30, 60])
        full = max(limit, overlap)
        runs = [random_lengths(rng, rng.choice([12, 40])) for _ in range(3)]
        effects = [run_effect(run, limit, overlap) for run in runs]
        together = [0, 0, 1]
        for effect in effects:
            together = composed(together, effect, full)
        for before in range(full + 1):
            for run, effect in zip(runs, effects):
                assert effect_at(effect, before, full) == after_texts(run, limit, overlap, before)
            assert effect_at(together, before, full) == after_texts(sum(runs, []), limit, overlap, before)


@pytest.mark.parametrize(("length", "overlap"), [(1, 200), (1, 1990), (90, 200), (1900, 200)])
def test_buffer_effect_of_long_blocks(length, overlap):
    began = time.monotonic()
    effect = run_effect([length] * 4096, 2000, overlap)
    assert time.monotonic() - began < 0.5
    for before in (0, 1, 199, 1000, 1999, 2000):
        assert effect_at(effect, before, 2000) == after_texts([length] * 4096, 2000, overlap, before)


@pytest.mark.parametrize("rows", [255, 256, 257, 70_000])
def test_folds_across_segments(spark, rows):
    """One array of several segments, and of more segments than are gathered at a time."""
    changes = "i % 3 = 0 OR i % 7 = 0"
    section = f"""named_struct('content', concat('t', i), 'h1', if(i % 11 = 0, concat('H', i % 5), null),
        'h2', if({changes}, concat('K', i % 4), null), 'h3', if(i % 5 = 3, 'L', null), 'pageNumber', i)"""
    df = spark.range(1).selectExpr("id AS doc", f"transform(sequence(0, {rows - 1}), i -> {section}) AS sections")
    model = [
        (f"H{i % 5}" if i % 11 == 0 else None, f"K{i % 4}" if i % 3 == 0 or i % 7 == 0 else None,
         "L" if i % 5 == 3 else None, f"t{i}", i)
        for i in range(rows)
    ]
    found = document_groups(df).orderBy("no").collect()
    assert [[(r["h1"], r["h2"], r["h3"]), r["texts"], r["pageStart"], r["pageEnd"]] for r in found] == groups_of(model)
    texts = spark.range(1).selectExpr("id AS doc", f"transform(sequence(0, {rows - 1}), i -> repeat('y', i % 9)) AS texts")
    chunks = [r["content"] for r in document_texts(texts, 60, 9).orderBy("chunk").collect()]
    assert chunks == packed(["y" * (i % 9) for i in range(rows)], 60, 9)


def test_model_packing_is_a_suffix_buffer():
    assert packed(["aaaa", "bb", "cccccccc"], 8, 2) == ["aaaa\nbb", "b\ncccccccc"]


def test_chunk_plans(spark, plan):
    df = layouts(spark, GOLDEN)
    path = spark.conf.get("spark.checkpoint.dir") + "/layout-plan"
    spark.createDataFrame([("d", "{}")], "doc string, layout string").write.mode("overwrite").parquet(path)
    stored = parse_layouts(spark.read.parquet(path), "doc", "layout")
    text = plan(explode_chunks(document_chunks(document_sections(stored))))
    for word in ("Python", "MapIn", "ExistingRDD", "Exchange"):
        assert word not in text
    assert plan(document_groups(document_sections(stored))).count("Generate") == 2
    assert df.count() == 1


# ---- requests and responses


@pytest.mark.parametrize(
    "data", ["YWI=", "YWJj", "YW\nJj", "Y*W!I=", "YWI", "YQ=", "YQ==", "Y", "abcde", "", "===="]
)
def test_base64_as_a_lenient_decoder_does(spark, data):
    try:
        expected = base64.b64decode(data)
    except ValueError:
        expected = None
    row = spark.createDataFrame([(data,)], "d string").select(decode_payload(F.col("d"))).first()
    assert (None if row[0] is None else bytes(row[0])) == expected


def test_base64_without_expressions_over_each_character(spark, plan):
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choice("Ab9+/==-\n\r é\0") for _ in range(rng.randrange(14))) for _ in range(4000)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "d string").repartition(4)
    found = df.select(decode_payload(F.col("d")).alias("new"), "d")
    assert "regexp" not in plan(found.select("new")).lower() and "rlike" not in plan(found).lower()
    digits = F.regexp_replace("d", "[^A-Za-z0-9+/]", "")
    left, padding = F.length(digits) % 4, F.length(F.regexp_extract("d", "(=*)[^A-Za-z0-9+/=]*$", 1))
    whole = F.when(left == 0, True).otherwise((left != 1) & (left + padding >= 4))
    assert found.where(~F.col("new").eqNullSafe(F.when(whole, F.unbase64(digits)))).count() == 0
    assert found.where("new is null").count() > 100


def test_requests_to_responses(spark, tmp_path):
    records = [
        {"recordId": "a", "data": {"file_data": {"data": "YWI="}}},
        {"recordId": "b", "data": {"file_data": {"url": "http://x?q", "sasToken": "s", "data": None}}},
        {"recordId": "c", "data": {"file_data": {}}},
        {"recordId": "d"},
        {"recordId": "e", "data": {"file_data": {"data": "YWI"}}},
        {"recordId": "f", "data": {"file_data": {"data": ""}}},
        {"recordId": "g", "data": {"file_data": {"data": "YWI=", "url": "http://y"}}},
    ]
    (tmp_path / "r.json").write_text(json.dumps({"values": records}, indent=1))
    routed = route_payloads(read_requests(spark, str(tmp_path)))
    missing = "file_data missing 'data' or 'url'"
    assert values(routed.orderBy("position"), "recordId", "payload", "source_url", "error") == [
        ("a", b"ab", None, None),
        ("b", None, "http://x?q&s", None),
        ("c", None, None, missing),
        ("d", None, None, missing),
        ("e", None, None, "Incorrect padding"),
        ("f", b"", None, "Empty PDF bytes passed to di_layout"),
        ("g", b"ab", None, None),
    ]
    request = routed.first()["request"]
    data = [((request, 0), json.dumps({"analyzeResult": markdown(section("é", "H"))})), ((request, 1), "{}")]
    data += [((request, 5), '{"analyzeResult": {"pages": [{'), (("another", 0), "{}")]
    parsed = parse_layouts(spark.createDataFrame(data, "k struct<request:string,position:int>, l string"), "k", "l")
    chunks = document_chunks(document_sections(parsed))
    out = response_envelopes(responses(routed, chunks)).first()["response"]
    assert "é" in out
    chunk = {
        "content": "H\né",
        "h1": "H",
        "h2": None,
        "h3": None,
        "sectionPath": "H",
        "sectionLevel": 1,
        "pageStart": None,
        "pageEnd": None,
    }
    found = json.loads(out)["values"]
    assert found[:2] == [
        {"recordId": "a", "data": {"chunks": [chunk]}},
        {"recordId": "b", "data": {"chunks": []}},
    ]
    assert found[2] == {"recordId": "c", "errors": [{"message": missing}]}
    assert [r["recordId"] for r in found] == list("abcdefg")
    assert found[6]["errors"] == [{"message": "no layout result"}]
