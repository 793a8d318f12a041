"""Queries over the document half: envelopes, sections, footers, headings, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.functions.geometry import centroid_y_of_json
from nestweave.functions.text import WHITESPACE, is_blank, section_level, section_path, signed_url
from nestweave.operators.chunks import (
    document_chunks,
    document_groups,
    document_texts,
    explode_chunks,
)
from nestweave.operators.headings import group_pages, h1_groups
from nestweave.operators.responses import response_envelopes, responses
from nestweave.operators.sections import document_sections, drop_footers, explode_sections
from nestweave.operators.stream import stream_chunks, stream_groups
from nestweave.plans.catalog import FILE_SHARDS, NO_KEY, query, shard_prefixes, sharded, table, texts
from nestweave.session import scratch_dir, spread, staged
from nestweave.sinks.tables import write_objects, write_responses
from nestweave.sources.documents import parse_layouts, read_layouts
from nestweave.sources.envelope import decode_payload, parse_requests, route_payloads

RECORDS_PER_REQUEST = 20
LINES_PER_PAGE = 10
# Small blocks in the queries, so that documents of ordinary size span several.
SMALL_BLOCK = 16
SMALL_RUN = 2

_SPACE = f"'{WHITESPACE}'"


# ---------------------------------------------------------------- requests


@query("""
SELECT page_id, CASE
  WHEN url LIKE '%spam%' OR url LIKE '%#%' THEN url
  WHEN url LIKE '%?%' THEN url || '&sig=' || page_id ELSE url || '?sig=' || page_id END AS signed
FROM pages
""")
def signed_urls(spark: SparkSession, folder: str) -> DataFrame:
    """URLs with a token, an empty token and none."""
    token = F.when(F.contains("url", F.lit("spam")), "").when(
        ~F.contains("url", F.lit("#")), F.concat(F.lit("sig="), "page_id")
    )
    return table(spark, folder, "pages").select("page_id", signed_url(F.col("url"), token).alias("signed"))


@query("SELECT doc_id, text AS decoded FROM documents")
def base64_decode(spark: SparkSession, folder: str) -> DataFrame:
    encoded = F.base64(F.encode("text", "utf-8"))
    decoded = F.decode(decode_payload(encoded), "utf-8")
    return texts(spark, folder).select("doc_id", decoded.alias("decoded"))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as request envelopes of at most ``RECORDS_PER_REQUEST`` records, as JSON text.

    Some carry their page inline, some broken or empty data, some a URL, some nothing.
    """
    url = F.col("url")
    inline = F.base64(F.encode("html", "utf-8"))
    data = (
        F.when(F.contains(url, F.lit("spam")), "")
        .when(F.contains(url, F.lit("/de/")), "abcde")
        .when(F.contains(url, F.lit("?")), inline)
    )
    record = F.struct(
        F.col("page_id").alias("position"),
        F.concat(F.lit("r"), "page_id").alias("recordId"),
        F.struct(
            F.struct(
                data.alias("data"),
                F.when(~F.contains(url, F.lit("/fr/")), url).alias("url"),
                F.lit("s=1").alias("sasToken"),
            ).alias("file_data")
        ).alias("data"),
    )
    return (
        table(spark, folder, "pages")
        .groupBy(F.floor(F.col("page_id") / RECORDS_PER_REQUEST).alias("request"))
        .agg(F.sort_array(F.collect_list(record)).alias("values"))
        .select("request", F.to_json(F.struct("values")).alias("envelope"))
    )


@query("""
SELECT page_id // 20 AS request, page_id % 20 AS position, 'r' || page_id AS "recordId"
FROM pages
""")
def envelope_explode(spark: SparkSession, folder: str) -> DataFrame:
    records = parse_requests(_requests(spark, folder), "request", "envelope")
    return records.select("request", F.col("position").cast("bigint"), "recordId")


@query("""
SELECT 'r' || page_id AS "recordId",
  CASE WHEN url LIKE '%spam%' THEN '' WHEN url LIKE '%/de/%' THEN NULL WHEN url LIKE '%?%' THEN html END AS payload,
  CASE WHEN url LIKE '%spam%' OR url LIKE '%/de/%' OR url LIKE '%?%' OR url LIKE '%/fr/%' THEN NULL
       ELSE url || '?s=1' END AS source_url,
  CASE WHEN url LIKE '%spam%' THEN 'Empty PDF bytes passed to di_layout'
       WHEN url LIKE '%/de/%' THEN 'Incorrect padding' WHEN url LIKE '%?%' THEN NULL
       WHEN url LIKE '%/fr/%' THEN 'file_data missing ''data'' or ''url''' END AS error
FROM pages
""")
def payload_route(spark: SparkSession, folder: str) -> DataFrame:
    routed = route_payloads(parse_requests(_requests(spark, folder), "request", "envelope"))
    return routed.select(
        "recordId", F.decode("payload", "utf-8").alias("payload"), "source_url", "error"
    )


# ---------------------------------------------------------------- layouts to sections


def _lines(text: str = "text") -> Column:
    return F.split(text, "\n")


def _polygon(y: Column) -> Column:
    point = F.struct(F.lit(0.5).alias("x"), y.alias("y"))
    return F.array(F.array(point))


def _page_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as layout JSON by pages: ten lines a page, short lines as headings."""

    def block(line: Column, i: Column) -> Column:
        return F.struct(
            F.when(F.length(line) < 40, "sectionHeading").otherwise("text").alias("category"),
            line.alias("content"),
            _polygon((i + 1) / 20).alias("boundingPolygons"),
        )

    def page(p: Column) -> Column:
        lines = F.slice("lines", p * LINES_PER_PAGE + 1, LINES_PER_PAGE)
        return F.struct((p + 1).alias("pageNumber"), F.transform(lines, block).alias("blocks"))

    last = F.floor((F.size("lines") - 1) / LINES_PER_PAGE).cast("int")
    pages = F.transform(F.sequence(F.lit(0), last), page)
    layout = F.struct(F.struct(pages.alias("pages")).alias("analyzeResult"))
    lines = texts(spark, folder).select("doc_id", _lines().alias("lines"))
    return lines.select("doc_id", F.to_json(layout).alias("layout"))


def _markdown_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as layout JSON by sections, with headings of three levels."""
    sections = f"""transform(split(text, '\\n'), (line, i) -> named_struct(
        'content', line, 'sections', named_struct({_HEADING_FIELDS}), {_PAGE_FIELD},
        'boundingPolygons', array(array(named_struct('x', 0.5D, 'y', i % 20 / 20)))))"""
    layout = f"""to_json(named_struct('analyzeResult',
        named_struct('markdown', named_struct('sections', {sections}))))"""
    return texts(spark, folder).select("doc_id", F.expr(layout).alias("layout"))


# Headings and page of line i + 1: three levels that come and go at different paces.
_HEADING_FIELDS = """
'h1', if((i + 1) % 7 IN (1, 4), concat('H1-', (i + 1) DIV 14), null),
'h2', if((i + 1) % 5 = 2, concat('H2-', (i + 1) % 3), null),
'h3', if((i + 1) % 4 = 3, concat('H3-', (i + 1) % 2), null)
"""
_PAGE_FIELD = f"'pageNumber', cast(i DIV {LINES_PER_PAGE} + 1 AS int)"


_ALL_LINES_SQL = """
all_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents)
"""

_HEADINGS_SQL = """
CASE WHEN n % 7 IN (1, 4) THEN 'H1-' || (n // 14) END AS h1,
CASE WHEN n % 5 = 2 THEN 'H2-' || (n % 3) END AS h2,
CASE WHEN n % 4 = 3 THEN 'H3-' || (n % 2) END AS h3,
(n - 1) // 10 + 1 AS page
"""


@query(f"""
WITH {_ALL_LINES_SQL}
SELECT doc_id AS doc, CAST(n - 1 AS BIGINT) AS seq, line AS content,
       CASE WHEN length(line) < 40 THEN line END AS h1, CAST((n - 1) // 10 + 1 AS BIGINT) AS page,
       ((n - 1) % 10 + 1) / 20 AS y
FROM all_lines
""")
def section_explode_pages(spark: SparkSession, folder: str) -> DataFrame:
    layouts = parse_layouts(_page_layouts(spark, folder), "doc_id", "layout")
    return explode_sections(document_sections(layouts)).select(
        "doc",
        "seq",
        "content",
        "h1",
        F.col("pageNumber").cast("bigint").alias("page"),
        centroid_y_of_json(F.col("boundingPolygons")).alias("y"),
    )


@query(f"""
WITH {_ALL_LINES_SQL}
SELECT doc_id AS doc, CAST(n - 1 AS BIGINT) AS seq, line AS content, h1, h2, h3,
       CAST(page AS BIGINT) AS page, ((n - 1) % 20) / 20 AS y
FROM (SELECT *, {_HEADINGS_SQL} FROM all_lines)
""")
def section_explode_markdown(spark: SparkSession, folder: str) -> DataFrame:
    layouts = parse_layouts(_markdown_layouts(spark, folder), "doc_id", "layout")
    return explode_sections(document_sections(layouts)).select(
        "doc",
        "seq",
        "content",
        "h1",
        "h2",
        "h3",
        F.col("pageNumber").cast("bigint").alias("page"),
        centroid_y_of_json(F.col("boundingPolygons")).alias("y"),
    )


@query(f"""
WITH {_ALL_LINES_SQL}
SELECT doc_id AS doc, CAST(n - 1 AS BIGINT) AS seq, line AS content, CAST((n - 1) // 10 + 1 AS BIGINT) AS page FROM all_lines
""")
def layout_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Layout results read from JSON files, one each, by the file's path."""
    path = scratch_dir(spark, "layouts")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(NO_KEY))
    layouts = _page_layouts(spark, folder).select(
        F.concat(sharded("doc_id", FILE_SHARDS), F.lit("doc_id="), key, F.lit(".json")).alias("path"),
        F.col("layout").alias("value"),
    )
    write_objects(layouts, path)
    prefixes = shard_prefixes(spark, path, FILE_SHARDS)
    sections = explode_sections(document_sections(read_layouts(spark, prefixes)))
    return sections.select(
        F.regexp_extract("doc", r"doc_id=([0-9]+)\.json$", 1).cast("bigint").alias("doc"),
        "seq",
        "content",
        F.col("pageNumber").cast("bigint").alias("page"),
    )


@query("""
SELECT l_orderkey, l_partkey, CASE l_returnflag WHEN 'N' THEN (l_discount + l_tax) / 2 ELSE 0.5 END AS y
FROM lineitem
""")
def polygon_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """Good polygons, a coordinate in quotes, and a point without one."""
    second = (
        F.when(F.col("l_returnflag") == "N", F.concat(F.lit('"y":'), "l_tax"))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit('"y":"'), "l_tax", F.lit('"')))
        .otherwise(F.lit('"x":1'))
    )
    polygons = F.concat(F.lit('[[{"x":0,"y":'), "l_discount", F.lit("},{"), second, F.lit('}],"junk"]'))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_discount", "l_tax", "l_returnflag"
    )
    return spread(lines).select(
        "l_orderkey", "l_partkey", centroid_y_of_json(polygons).alias("y")
    )


_FOOTER_PHRASE = "e the"


@query(f"""
WITH {_ALL_LINES_SQL},
content AS (
  SELECT doc_id AS doc, n, CASE WHEN n % 9 = 0 THEN ' ' || n || chr(9) ELSE line END AS content FROM all_lines)
SELECT doc, CAST(n - 1 AS BIGINT) AS seq, content FROM content
WHERE trim(content, {_SPACE}) <> ''
  AND NOT regexp_full_match(trim(content, {_SPACE}), '\\p{{Nd}}+')
  AND NOT contains(lower(content), '{_FOOTER_PHRASE}')
  AND (n % 20) / 20 BETWEEN 0.05 AND 0.85
""")
def footer_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Blank lines, page numbers, a phrase and the page margins go."""
    lines = texts(spark, folder).select(
        F.col("doc_id").alias("doc"), F.posexplode(_lines()).alias("i", "line")
    )
    n = F.col("i") + 1
    number = F.concat(F.lit(" "), n.cast("string"), F.lit("\t"))
    stream = lines.select(
        "doc",
        F.col("i").cast("bigint").alias("seq"),
        F.when(n % 9 == 0, number).otherwise(F.col("line")).alias("content"),
        F.to_json(_polygon((n % 20) / 20)).alias("boundingPolygons"),
    )
    return drop_footers(stream, phrase=_FOOTER_PHRASE).select("doc", "seq", "content")


# ---------------------------------------------------------------- heading groups


def _turn_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as a section stream: the first line of what a user says is the heading."""
    heading = F.when(F.col("role") == "user", F.substring_index("text", "\n", 1))
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc"),
        F.col("turn").alias("seq"),
        F.col("text").alias("content"),
        heading.alias("h1"),
        F.lit(None).cast("string").alias("h2"),
        F.lit(None).cast("string").alias("h3"),
        F.col("turn").cast("int").alias("pageNumber"),
    )


_TURN_GROUPS_SQL = """
WITH turns AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN nullif(split_part(text, chr(10), 1), '') END AS h FROM conversations),
carry AS (
  SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading,
         last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM turns),
islands AS (
  SELECT *, sum(CASE WHEN h IS NOT NULL AND h IS DISTINCT FROM before THEN 1 ELSE 0 END)
            OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM carry)
SELECT conv_id AS doc, CAST(g AS BIGINT) AS "group", heading, CAST(min(turn) AS BIGINT) AS "pageStart",
       CAST(max(turn) AS BIGINT) AS "pageEnd", CAST(count(*) AS BIGINT) AS "rows"
FROM islands GROUP BY conv_id, g, heading
"""


def _bigint_pages(groups: DataFrame) -> DataFrame:
    pages = {c: F.col(c).cast("bigint") for c in ("pageStart", "pageEnd")}
    return groups.withColumns(pages)


@query(_TURN_GROUPS_SQL)
def heading_groups(spark: SparkSession, folder: str) -> DataFrame:
    return _bigint_pages(group_pages(h1_groups(_turn_stream(spark, folder))))


@query(_TURN_GROUPS_SQL)
def heading_groups_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with conversations cut into blocks of three turns."""
    return _bigint_pages(group_pages(h1_groups(_turn_stream(spark, folder), block_rows=3)))


@query(_TURN_GROUPS_SQL)
def heading_groups_fold(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the general fold."""
    groups = stream_groups(_turn_stream(spark, folder))
    return _bigint_pages(groups.withColumnRenamed("h1", "heading").drop("h2", "h3"))


def _text_lines() -> Column:
    """The non-blank lines of a document."""
    return F.filter(_lines(), lambda line: ~is_blank(line))


def _line_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as section arrays with headings of three levels."""
    lines = texts(spark, folder).select("doc_id", _text_lines().alias("lines"))
    section = f"""named_struct('content', line, {_HEADING_FIELDS}, {_PAGE_FIELD},
                                'polygons', cast(null AS variant))"""
    return lines.select(
        F.col("doc_id").alias("doc"),
        F.expr(f"transform(lines, (line, i) -> {section})").alias("sections"),
    )


def _line_stream(spark: SparkSession, folder: str) -> DataFrame:
    return explode_sections(_line_sections(spark, folder))


_NO_FOOTERS_SQL = f"""
WHERE NOT regexp_full_match(trim(line, {_SPACE}), '\\p{{Nd}}+') AND NOT contains(lower(line), 'inspection report')
"""


def _fold_sql(condition: str = "") -> str:
    """The section fold by recursion over the usable lines, numbered ``m``."""
    return f"""
WITH RECURSIVE {_ALL_LINES_SQL},
kept AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS n
  FROM all_lines WHERE trim(line, {_SPACE}) <> ''),
src AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS m
  FROM (SELECT doc_id, n, line, {_HEADINGS_SQL} FROM kept {condition})),
fold AS (
  SELECT doc_id, m, h1 AS a1, h2 AS a2, h3 AS a3,
         h1 IS NOT NULL OR h2 IS NOT NULL OR h3 IS NOT NULL AS ch,
         CAST(h1 IS NOT NULL OR h2 IS NOT NULL OR h3 IS NOT NULL AS BIGINT) AS g
  FROM src WHERE m = 1
  UNION ALL
  SELECT doc_id, m,
         CASE WHEN ch THEN coalesce(h1, a1) ELSE a1 END,
         CASE WHEN NOT ch THEN a2 WHEN h1 IS NOT NULL OR h2 IS NOT NULL THEN h2 ELSE a2 END,
         CASE WHEN ch THEN h3 ELSE a3 END,
         ch, g + CAST(ch AS BIGINT)
  FROM (SELECT s.doc_id, s.m, s.h1, s.h2, s.h3, f.a1, f.a2, f.a3, f.g,
               (s.h1 IS NOT NULL AND s.h1 IS DISTINCT FROM f.a1)
               OR (s.h2 IS NOT NULL AND s.h2 IS DISTINCT FROM f.a2)
               OR (s.h3 IS NOT NULL AND s.h3 IS DISTINCT FROM f.a3) AS ch
        FROM fold f JOIN src s ON s.doc_id = f.doc_id AND s.m = f.m + 1) x),
grouped AS (
  SELECT f.doc_id, s.n, f.g, f.a1, f.a2, f.a3, s.page,
         CASE WHEN f.ch AND NOT starts_with(ltrim(s.line, {_SPACE}), coalesce(s.h3, s.h2, s.h1))
              THEN coalesce(s.h3, s.h2, s.h1) || chr(10) || s.line ELSE s.line END AS seg
  FROM fold f JOIN src s ON s.doc_id = f.doc_id AND s.m = f.m),
groups AS (
  SELECT doc_id, g, max(a1) AS h1, max(a2) AS h2, max(a3) AS h3, min(page) AS "pageStart",
         max(page) AS "pageEnd", count(*) AS "rows", string_agg(seg, chr(10) ORDER BY n) AS text
  FROM grouped GROUP BY doc_id, g)
"""


@query(_fold_sql() + """
SELECT doc_id AS doc, g AS "group", h1, h2, h3, CAST("pageStart" AS BIGINT) AS "pageStart",
       CAST("pageEnd" AS BIGINT) AS "pageEnd", "rows", text FROM groups
""")
def heading_fold(spark: SparkSession, folder: str) -> DataFrame:
    groups = document_groups(_line_sections(spark, folder))
    return _bigint_pages(groups.withColumn("text", F.array_join("texts", "\n"))).select(
        "doc", F.col("no").alias("group"), "h1", "h2", "h3", "pageStart", "pageEnd", "rows", "text"
    )


@query(_fold_sql() + """
SELECT doc_id AS doc, g AS "group", h1, h2, h3, CAST("pageStart" AS BIGINT) AS "pageStart",
       CAST("pageEnd" AS BIGINT) AS "pageEnd", "rows" FROM groups
""")
def heading_fold_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a row stream, documents cut into blocks."""
    stream = staged(_line_stream(spark, folder).drop("boundingPolygons"), "sections")
    return _bigint_pages(stream_groups(stream, SMALL_BLOCK, SMALL_RUN))


# ---------------------------------------------------------------- chunks


def _pack_sql(segments: str, max_length: int, overlap: int) -> str:
    """Packing of ``segments`` (key columns ``doc_id, g``; order ``k``; text ``seg``)."""
    return f"""
pack AS (
  SELECT doc_id, g, CAST(0 AS BIGINT) AS k, CAST('' AS VARCHAR) AS buf, CAST(NULL AS VARCHAR) AS done
  FROM {segments} WHERE k = 1
  UNION ALL
  SELECT p.doc_id, p.g, s.k,
         CASE WHEN length(p.buf) + length(s.seg) + 1 <= {max_length} THEN p.buf || s.seg || chr(10)
              ELSE right(p.buf, {overlap}) || s.seg || chr(10) END,
         CASE WHEN length(p.buf) + length(s.seg) + 1 > {max_length} THEN trim(p.buf, {_SPACE}) END
  FROM pack p JOIN {segments} s ON s.doc_id = p.doc_id AND s.g = p.g AND s.k = p.k + 1),
ends AS (SELECT doc_id, g, max(k) AS k FROM {segments} GROUP BY doc_id, g),
chunks AS (
  SELECT doc_id, g, k, done AS content FROM pack WHERE done IS NOT NULL
  UNION ALL
  SELECT p.doc_id, p.g, p.k + 1, trim(p.buf, {_SPACE}) FROM pack p JOIN ends e
    ON e.doc_id = p.doc_id AND e.g = p.g AND e.k = p.k
  WHERE trim(p.buf, {_SPACE}) <> '')
"""


_TEXT_CHUNKS_SQL = f"""
WITH RECURSIVE {_ALL_LINES_SQL},
segments AS (
  SELECT doc_id, 0 AS g, line AS seg, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k
  FROM all_lines WHERE trim(line, {_SPACE}) <> ''),
"""


@query(_TEXT_CHUNKS_SQL + _pack_sql("segments", 2000, 200) + """
SELECT doc_id AS doc, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS chunk, content FROM chunks
""")
def text_chunks(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(spark, folder).select(
        F.col("doc_id").alias("doc"), _text_lines().alias("texts")
    )
    return document_texts(documents).withColumn("chunk", F.col("chunk").cast("bigint"))


@query(_TEXT_CHUNKS_SQL + _pack_sql("segments", 300, 50) + """
SELECT doc_id AS doc, content FROM chunks
""")
def text_chunks_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """One heading-less group per document, packed across blocks, shorter chunks."""
    none = F.lit(None).cast("string")
    plain = _line_stream(spark, folder).drop("boundingPolygons")
    stream = staged(plain.withColumns({"h1": none, "h2": none, "h3": none}), "sections")
    chunks = stream_chunks(stream, 300, 50, block_rows=SMALL_BLOCK, blocks_per_run=SMALL_RUN)
    return chunks.select("doc", "content")


_DOC_CHUNKS_SQL = (
    _fold_sql(_NO_FOOTERS_SQL)
    + """,
segments AS (
  SELECT doc_id, g, seg, row_number() OVER (PARTITION BY doc_id, g ORDER BY n) AS k FROM grouped),
"""
    + _pack_sql("segments", 2000, 200)
    + """
SELECT c.doc_id AS doc, c.content, h1, h2, h3, concat_ws(' > ', h1, h2, h3) AS "sectionPath",
       CAST(CASE WHEN h3 IS NOT NULL THEN 3 WHEN h2 IS NOT NULL THEN 2 WHEN h1 IS NOT NULL THEN 1 ELSE 0 END
            AS BIGINT) AS "sectionLevel",
       CAST("pageStart" AS BIGINT) AS "pageStart", CAST("pageEnd" AS BIGINT) AS "pageEnd"
FROM chunks c JOIN groups USING (doc_id, g)
"""
)

_CHUNK_COLUMNS = ["doc", "content", "h1", "h2", "h3", "sectionPath", "sectionLevel", "pageStart", "pageEnd"]


def _chunk_rows(chunks: DataFrame) -> DataFrame:
    levels = chunks.withColumn("sectionLevel", F.col("sectionLevel").cast("bigint"))
    return _bigint_pages(levels).select(*_CHUNK_COLUMNS)


@query(_DOC_CHUNKS_SQL)
def doc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents to chunks, all in one projection."""
    return _chunk_rows(explode_chunks(document_chunks(_line_sections(spark, folder))))


@query(_DOC_CHUNKS_SQL)
def doc_chunks_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a row stream, documents cut into blocks."""
    stream = staged(drop_footers(_line_stream(spark, folder)), "sections")
    return _chunk_rows(stream_chunks(stream, block_rows=SMALL_BLOCK, blocks_per_run=SMALL_RUN))


_LAYOUT_GROUPS_SQL = f"""
WITH {_ALL_LINES_SQL},
usable AS (
  SELECT doc_id, n, line, CASE WHEN length(line) < 40 THEN line END AS h, (n - 1) // 10 + 1 AS page
  FROM all_lines
  WHERE trim(line, {_SPACE}) <> '' AND NOT regexp_full_match(trim(line, {_SPACE}), '\\p{{Nd}}+')
    AND NOT contains(lower(line), 'inspection report')),
carry AS (
  SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
         last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM usable),
islands AS (
  SELECT *, h IS NOT NULL AND h IS DISTINCT FROM before AS ch,
         sum(CASE WHEN h IS NOT NULL AND h IS DISTINCT FROM before THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY n) AS g FROM carry),
"""


def _layout_chunk_sql(tail: str) -> str:
    return (
        _LAYOUT_GROUPS_SQL.replace("WITH", "WITH RECURSIVE", 1)
        + f"""
segments AS (
  SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id, g ORDER BY n) AS k, heading, page,
         CASE WHEN ch AND NOT starts_with(ltrim(line, {_SPACE}), h) THEN h || chr(10) || line ELSE line END AS seg
  FROM islands),
groups AS (
  SELECT doc_id, g, max(heading) AS h1, min(page) AS "pageStart", max(page) AS "pageEnd"
  FROM segments GROUP BY doc_id, g),
"""
        + _pack_sql("segments", 2000, 200)
        + tail
    )


@query(_layout_chunk_sql("""
SELECT c.doc_id AS doc, c.content, h1, NULL AS h2, NULL AS h3, coalesce(h1, '') AS "sectionPath",
       CAST(CASE WHEN h1 IS NULL THEN 0 ELSE 1 END AS BIGINT) AS "sectionLevel",
       CAST("pageStart" AS BIGINT) AS "pageStart", CAST("pageEnd" AS BIGINT) AS "pageEnd"
FROM chunks c JOIN groups USING (doc_id, g)
"""))
def layout_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Layout JSON by pages, all the way: parse, sections, footers, headings, chunks."""
    layouts = parse_layouts(_page_layouts(spark, folder), "doc_id", "layout")
    return _chunk_rows(explode_chunks(document_chunks(document_sections(layouts))))


@query("""
SELECT doc_id, concat_ws(' > ', nullif(lang, 'en'), source, nullif(lang, 'fr')) AS path,
       CAST(CASE WHEN lang <> 'fr' THEN 3 ELSE 2 END AS BIGINT) AS level
FROM documents
""")
def section_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Headings that are empty do not count, nor do null ones."""
    h1 = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    h3 = F.nullif(F.col("lang"), F.lit("fr"))
    return table(spark, folder, "documents").select(
        "doc_id",
        section_path(h1, F.col("source"), h3).alias("path"),
        section_level(h1, F.col("source"), h3).cast("bigint").alias("level"),
    )


@query(_layout_chunk_sql("""
SELECT doc_id // 20 AS request, doc_id % 20 AS position, 'd' || (doc_id % 7) AS "recordId",
       CASE WHEN source IN ('src1', 'src2', 'src3') OR d.lang = 'de' THEN NULL
            ELSE (SELECT count(*) FROM chunks c WHERE c.doc_id = d.doc_id) END AS n_chunks,
       CASE WHEN source IN ('src1', 'src2', 'src3') OR d.lang = 'de' THEN NULL
            ELSE (SELECT max("pageEnd") FROM chunks c JOIN groups r USING (doc_id, g) WHERE c.doc_id = d.doc_id)
            END AS last_page,
       CASE WHEN source = 'src1' THEN 'file_data missing ''data'' or ''url'''
            WHEN d.lang = 'de' OR source = 'src3' THEN 'no layout result'
            WHEN source = 'src2' THEN 'layout result is not valid JSON' END AS message
FROM documents d
"""))
def response_records(spark: SparkSession, folder: str) -> DataFrame:
    """Response envelopes through their sink: chunks of good records, errors of others.

    Record ids repeat within and between requests; some layouts are cut off, some null, and some give their
    page numbers as text or with a fraction, which is no error.
    """
    documents = table(spark, folder, "documents")
    records = documents.select(
        F.floor(F.col("doc_id") / RECORDS_PER_REQUEST).alias("request"),
        (F.col("doc_id") % RECORDS_PER_REQUEST).alias("position"),
        F.concat(F.lit("d"), F.col("doc_id") % 7).alias("recordId"),
        F.lit(None).cast("string").alias("data"),
        F.when(F.col("source") != "src1", F.concat(F.lit("https://files.example.com/"), "doc_id")).alias("url"),
        F.lit(None).cast("string").alias("sasToken"),
    )
    analysed = documents.where("lang <> 'de'").select("doc_id", "source", "lang")
    layouts = _page_layouts(spark, folder).join(analysed, "doc_id")
    key = F.struct(
        F.floor(F.col("doc_id") / RECORDS_PER_REQUEST).alias("request"),
        (F.col("doc_id") % RECORDS_PER_REQUEST).alias("position"),
    )
    page = r'"pageNumber":([0-9]+)'
    whole = (
        F.when(F.col("source") == "src2", F.expr("left(layout, length(layout) - 3)"))
        .when(F.col("source") == "src3", F.lit(None))
        .when(F.col("lang") == "fr", F.regexp_replace("layout", page, '"pageNumber":"$1"'))
        .when(F.col("lang") == "es", F.regexp_replace("layout", page, '"pageNumber":$1.0'))
        .otherwise(F.col("layout"))
    )
    keyed = layouts.select(key.alias("key"), whole.alias("layout"))
    chunks = document_chunks(document_sections(parse_layouts(keyed, "key", "layout")))
    path = scratch_dir(spark, "responses")
    envelopes = response_envelopes(responses(route_payloads(records), chunks))
    with_request = envelopes.select(F.to_json(F.struct("request", "response")).alias("response"))
    write_responses(with_request, path)

    record = "struct<recordId:string,data:struct<chunks:array<struct<content:string,h1:string,pageEnd:bigint>>>,errors:array<struct<message:string>>>"
    values = F.from_json("value", f"values array<{record}>").getField("values")
    read = spark.read.schema("request long, response string").json(path)
    rows = read.withColumnRenamed("response", "value").select("request", F.posexplode(values).alias("position", "r"))
    return rows.select(
        "request",
        F.col("position").cast("bigint").alias("position"),
        "r.recordId",
        F.when(F.col("r.data").isNotNull(), F.size("r.data.chunks")).cast("bigint").alias("n_chunks"),
        F.array_max("r.data.chunks.pageEnd").alias("last_page"),
        F.get(F.col("r.errors.message"), F.lit(0)).alias("message"),
    )
