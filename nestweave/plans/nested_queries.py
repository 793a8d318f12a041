"""Queries over the nested-JSON half: worklists, flattening, tables, drift."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nestweave.entities import CONVERSATIONS, TICKETS
from nestweave.functions.naming import rename_columns, sanitise
from nestweave.functions.text import resource_url
from nestweave.operators.drift import (
    ddl_feed,
    new_columns,
    table_columns,
)
from nestweave.operators.flatten import expand_structs, flatten
from nestweave.operators.normalize import base_table, child_table, join_children, normalize
from nestweave.operators.worklist import enrich, failed, pending_ids, succeeded
from nestweave.plans.catalog import FILE_SHARDS, NO_KEY, query, shard_prefixes, sharded, table, texts
from nestweave.session import scratch_dir, spread, staged
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
    write_statements,
    write_tables,
)
from nestweave.sources.capture import unexpected
from nestweave.sources.documents import parsed_documents, raw_documents, read_documents, split_unreadable
from nestweave.sources.inference import learn
from nestweave.sources.registry import read_registry
from nestweave.sources.worklist import listed_ids, read_worklist
from nestweave.streaming.incremental import STATEMENTS, UNEXPECTED, UNREADABLE, run_incremental

TURNS_PER_PAGE = 64


# ---------------------------------------------------------------- worklist and landing


@query("""
SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def worklist_anti(spark: SparkSession, folder: str) -> DataFrame:
    wanted = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    landed = table(spark, folder, "labels").select(F.col("doc_id").alias("id"))
    return pending_ids(wanted, landed, CONVERSATIONS)


@query("""
SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = l_partkey)
""")
def worklist_anti_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that repeat on both sides."""
    wanted = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("id"))
    landed = table(spark, folder, "events").select(F.col("user_id").alias("id"))
    return pending_ids(wanted, landed, CONVERSATIONS)


@query("SELECT CAST(o_custkey AS VARCHAR) AS id FROM orders")
def worklist_refetch(spark: SparkSession, folder: str) -> DataFrame:
    """The entity that fetches every id again, repeated ones too."""
    wanted = table(spark, folder, "orders").select(F.col("o_custkey").alias("id"))
    landed = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return pending_ids(wanted, landed, TICKETS)


@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents")
def worklist_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Worklist files, some of which lack the id column."""
    path = scratch_dir(spark, "worklist")
    ids = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    ids.write.json(f"{path}/with_id")
    table(spark, folder, "labels").select("quality").write.json(f"{path}/without_id")
    return read_worklist(spark, f"{path}/*", CONVERSATIONS)


@query("""
SELECT doc_id AS id, 'https://api.example.com/conversations/' || doc_id || '?display_as=string' AS url
FROM documents
""")
def resource_urls(spark: SparkSession, folder: str) -> DataFrame:
    url = resource_url(
        "https://api.example.com/", CONVERSATIONS.name, F.col("doc_id"), CONVERSATIONS.query_option
    )
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), url.alias("url"))


def _fetch_part(spark: SparkSession, folder: str) -> DataFrame:
    def fetch(name: str) -> tuple[int, str | None]:
        if name.endswith("gizmo"):
            raise ValueError(name)
        return (404, None) if name.endswith("ring") else (200, name.upper())

    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), "p_name")
    return enrich(parts, fetch, CONVERSATIONS.parallelism, "p_name")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, upper(p_name) AS body FROM part
WHERE NOT (p_name LIKE '%ring' OR p_name LIKE '%gizmo')
""")
def enrich_stub(spark: SparkSession, folder: str) -> DataFrame:
    return succeeded(_fetch_part(spark, folder)).select("id", "body")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id,
       CAST(CASE WHEN p_name LIKE '%ring' THEN 404 END AS BIGINT) AS status,
       CASE WHEN p_name LIKE '%gizmo' THEN 'ValueError: ' || p_name END AS error
FROM part WHERE p_name LIKE '%ring' OR p_name LIKE '%gizmo'
""")
def enrich_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Refused and raising calls, with the reason; the others are not affected."""
    return failed(_fetch_part(spark, folder)).select("id", F.col("status").cast("bigint"), "error")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 8 < 3 THEN 'first' ELSE 'second' END AS body,
       CAST(1 AS BIGINT) AS times
FROM part
""")
def fetch_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A batch whose first attempt ends after some of its parts; the second fetches only the others."""
    root = scratch_dir(spark, "resumed")
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("id"))

    def fetch(said: str, fails: bool):
        def fetched(rows: DataFrame) -> DataFrame:
            if fails and rows.where("CAST(id AS BIGINT) % 8 >= 3").limit(1).count():
                raise InterruptedError
            return enrich(rows, lambda key: (200, said), CONVERSATIONS.parallelism)

        return fetched

    # parts by the remainder of the id, so that SQL can tell them
    by_remainder = (F.col("id").cast("bigint") % 8).cast("int")
    with suppress(InterruptedError):
        land_in_parts(parts, fetch("first", True), root, 1, 8, by_remainder)
    land_in_parts(parts, fetch("second", False), root, 1, 8, by_remainder)
    landing = read_landing(spark, root)
    return landing.groupBy("id").agg(F.max("body").alias("body"), F.count("*").alias("times"))


@query("SELECT DISTINCT CAST(conv_id AS VARCHAR) AS id FROM conversations")
def landed_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of landed objects from the paths below sixteen prefixes, listed by tasks."""
    path = scratch_dir(spark, "listing")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_KEY))
    turns = table(spark, folder, "conversations").select(
        F.concat(sharded("conv_id", 16), F.lit("object="), key, F.lit("/roles.txt")).alias("path"), F.col("role").alias("value")
    )
    write_objects(turns, path)
    return listed_ids(shard_prefixes(spark, path, 16), "/object=([^/]+)/")


def _order_status() -> Column:
    return F.when(F.col("o_orderstatus") == "P", 404).otherwise(200)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(404 AS BIGINT) AS status
FROM orders WHERE o_orderstatus = 'P'
""")
def status_split(spark: SparkSession, folder: str) -> DataFrame:
    fetched = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), _order_status().alias("status")
    )
    return failed(fetched).select("id", F.col("status").cast("bigint"))


def _landing(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed in two batches; urgent ones came twice."""
    root = scratch_dir(spark, "landing")
    orders = spread(table(spark, folder, "orders"))
    for batch in (1, 2):
        document = F.struct(
            F.col("o_orderkey").alias("id"),
            F.struct(F.lit(batch).alias("round"), F.col("o_totalprice").alias("total")).alias("state"),
        )
        asked = orders if batch == 1 else orders.where("o_orderpriority = '1-URGENT'")
        land(
            asked.select(
                F.col("o_orderkey").cast("string").alias("id"),
                _order_status().alias("status"),
                F.to_json(document).alias("body"),
            ),
            root,
            batch,
        )
    return read_landing(spark, root)


@query("""
SELECT o_orderkey AS __id__, o_totalprice AS __state_total__,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS BIGINT) AS __state_round__
FROM orders WHERE o_orderstatus <> 'P'
""")
def landing_latest(spark: SparkSession, folder: str) -> DataFrame:
    objects = latest_objects(_landing(spark, folder))
    schema = "id bigint, state struct<round:bigint,total:double>"
    return base_table(parse_objects(objects, schema))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(404 AS BIGINT) AS status, CAST(b AS BIGINT) AS batch
FROM orders, (VALUES (1), (2)) v(b)
WHERE o_orderstatus = 'P' AND (b = 1 OR o_orderpriority = '1-URGENT')
""")
def landing_errors(spark: SparkSession, folder: str) -> DataFrame:
    failures = landing_failures(_landing(spark, folder))
    return failures.select("id", F.col("status").cast("bigint"), F.col("batch").cast("bigint"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'P'")
def landing_pending(spark: SparkSession, folder: str) -> DataFrame:
    """What a second run still has to fetch: everything not landed with success."""
    wanted = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    return pending_ids(wanted, landed_ids(_landing(spark, folder)), CONVERSATIONS)


# ---------------------------------------------------------------- flatten and normalise


@query("""
SELECT c_custkey AS __id__, c_name AS __contact_fullname__, c_acctbal AS __contact_balance__,
       n_name AS __contact_place_nation__, r_name AS __contact_place_region_name__
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def flatten_struct(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    customers = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    place = F.struct(
        F.col("n_name").alias("nation"), F.struct(F.col("r_name").alias("name")).alias("region")
    )
    nested = customers.select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("full name"),
            F.col("c_acctbal").alias("balance"),
            place.alias("place"),
        ).alias("contact"),
    )
    return rename_columns(flatten(nested))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS __docid__, lang AS __where_lang__, source AS __where_source__,
       n_chars AS __where_nchars__
FROM documents
""")
def column_renames(spark: SparkSession, folder: str) -> DataFrame:
    """Odd characters go from column names; dots in field names stay and do no harm."""
    nested = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc - (id)/"),
        F.struct("lang", F.col("source").alias("source?"), F.col("n_chars").alias("n.chars")).alias(
            "where:"
        ),
    )
    return rename_columns(flatten(nested)).withColumnRenamed(
        "__where_n.chars__", "__where_nchars__"
    )


def _customer_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with an array of remarks: none, some, or null."""
    remark = lambda kind, amount: F.struct(F.lit(kind).alias("kind"), amount.alias("amount"))
    balance = F.col("c_acctbal")
    remarks = F.array(remark("debt", -balance), remark("balance", balance), remark("excess", balance - 5000))
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("who"),
        F.when(
            F.col("c_mktsegment") != "BUILDING", F.filter(remarks, lambda r: r["amount"] > 100)
        ).alias("remarks"),
    )


_REMARKS_SQL = """
WITH remarks AS (
  SELECT c_custkey, kind, amount FROM (
    SELECT c_custkey, 'debt' AS kind, -c_acctbal AS amount, c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, 'balance', c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, 'excess', c_acctbal - 5000, c_mktsegment FROM customer) r
  WHERE amount > 100 AND c_mktsegment <> 'BUILDING')
"""


@query(_REMARKS_SQL + """
SELECT c.c_custkey AS __id__, kind AS __remarks_kind__, amount AS __remarks_amount__
FROM customer c LEFT JOIN remarks r ON r.c_custkey = c.c_custkey
""")
def flatten_child_outer(spark: SparkSession, folder: str) -> DataFrame:
    return child_table(_customer_documents(spark, folder), "remarks")


@query(_REMARKS_SQL + """
SELECT c.c_custkey AS __id__, c_name AS __who_name__, c_mktsegment AS __who_segment__,
       kind AS __remarks_kind__, amount AS __remarks_amount__
FROM customer c LEFT JOIN remarks r ON r.c_custkey = c.c_custkey
""")
def child_join_back(spark: SparkSession, folder: str) -> DataFrame:
    documents = _customer_documents(spark, folder)
    return join_children(base_table(documents), child_table(documents, "remarks"))


@query(_REMARKS_SQL + """
SELECT c.c_custkey AS __id__, kind AS __remarks_kind__, amount AS __remarks_amount__
FROM customer c LEFT JOIN remarks r ON r.c_custkey = c.c_custkey
""")
def table_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """All tables written, a child table read back."""
    root = scratch_dir(spark, "tables")
    write_tables(normalize(_customer_documents(spark, folder), CONVERSATIONS), root)
    return spark.read.parquet(f"{root}/{CONVERSATIONS.child_table('remarks')}")


@query("""
SELECT l_orderkey AS __id__, CAST(l_linenumber AS BIGINT) AS __line__, l_partkey AS __item_l_partkey__,
       l_suppkey AS __item_l_suppkey__, l_quantity AS __item_amount_l_quantity__
FROM lineitem
""")
def base_table_sink(spark: SparkSession, folder: str) -> DataFrame:
    """All tables written, the base table read back."""
    root = scratch_dir(spark, "tables")
    write_tables(normalize(_lineitem_documents(spark, folder), CONVERSATIONS), root)
    base = spark.read.parquet(f"{root}/{CONVERSATIONS.base_table}")
    return base.withColumn("__line__", F.col("__line__").cast("bigint"))


def conversation_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as nested documents, a long one as several pages of turns.

    Turns are unique in a conversation, so a page gathers at most ``TURNS_PER_PAGE``.
    """
    turn = F.struct("turn", "role", F.struct("text").alias("body"))
    return (
        table(spark, folder, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / TURNS_PER_PAGE).alias("page"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(F.col("conv_id").alias("id"), F.struct("page").alias("meta"), "turns")
    )


@query("""
SELECT conv_id AS __id__, turn AS __turns_turn__, role AS __turns_role__, text AS __turns_body_text__
FROM conversations
""")
def normalize_turns(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize(conversation_documents(spark, folder), CONVERSATIONS)
    return tables[CONVERSATIONS.child_table("turns")]


def _lineitem_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A nested document per order line."""
    charge = lambda kind, rate: F.struct(F.lit(kind).alias("kind"), rate.alias("rate"))
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.struct("l_partkey", "l_suppkey", F.struct("l_quantity").alias("amount")).alias("item"),
        F.array(charge("discount", F.col("l_discount")), charge("tax", F.col("l_tax"))).alias("charges"),
        F.struct(F.array("l_returnflag", "l_linestatus").alias("flags")).alias("state"),
    )


@query("""
SELECT l_orderkey AS __id__, CAST(l_linenumber AS BIGINT) AS __line__, l_partkey AS __item_l_partkey__,
       l_suppkey AS __item_l_suppkey__, l_quantity AS __item_amount_l_quantity__
FROM lineitem
""")
def normalize_base(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize(_lineitem_documents(spark, folder), CONVERSATIONS)
    base = tables[CONVERSATIONS.base_table]
    return base.withColumn("__line__", F.col("__line__").cast("bigint"))


@query("""
SELECT l_orderkey AS __id__, unnest(['discount', 'tax']) AS __charges_kind__,
       unnest([l_discount, l_tax]) AS __charges_rate__
FROM lineitem
""")
def normalize_child(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize(_lineitem_documents(spark, folder), CONVERSATIONS)
    return tables[CONVERSATIONS.child_table("charges")]


@query("""
SELECT l_orderkey AS __id__, unnest([l_returnflag, l_linestatus]) AS __state_flags__ FROM lineitem
""")
def normalize_array_in_struct(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize(_lineitem_documents(spark, folder), TICKETS)
    return tables[TICKETS.child_table("state")]


@query("""
SELECT o_orderkey AS __id__, key AS __links_keys__, label AS __links_labels__
FROM (SELECT o_orderkey, unnest([o_orderkey, o_custkey]) AS key, o_orderstatus, o_orderpriority FROM orders) k,
     LATERAL (SELECT unnest([k.o_orderstatus, k.o_orderpriority, 'order']) AS label) l
""")
def flatten_sibling_cross(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrays below one field multiply; here two keys by three labels."""
    links = F.struct(
        F.array("o_orderkey", "o_custkey").alias("keys"),
        F.array("o_orderstatus", "o_orderpriority", F.lit("order")).alias("labels"),
    )
    documents = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), links.alias("links"))
    return child_table(documents, "links")


@query("""
SELECT a.l_orderkey AS id, a.l_linenumber::BIGINT AS lines, b.l_partkey AS parts
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey
""")
def flatten_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrays of one document multiplied, the first dealt out over tasks two elements at a time."""
    orders = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.collect_list(F.col("l_linenumber").cast("bigint")).alias("lines"), F.collect_list("l_partkey").alias("parts")
    )
    return flatten(orders, spread_rows=2)


@query("""
SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS item_l_partkey,
       l_suppkey AS item_l_suppkey, l_quantity AS item_amount_l_quantity, kind AS charges_kind,
       rate AS charges_rate, flag AS state_flags
FROM (SELECT *, unnest(['discount', 'tax']) AS kind, unnest([l_discount, l_tax]) AS rate FROM lineitem) c,
     LATERAL (SELECT unnest([c.l_returnflag, c.l_linestatus]) AS flag) f
""")
def flatten_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of the document at once, all arrays multiplied."""
    flat = flatten(_lineitem_documents(spark, folder))
    return flat.withColumn("line", F.col("line").cast("bigint"))


def _event_documents(spark: SparkSession, folder: str) -> DataFrame:
    props = F.map_filter(
        F.from_json("props", "map<string,bigint>"), lambda key, value: value >= 10
    )
    return table(spark, folder, "events").select(F.col("event_id").alias("id"), props.alias("props"))


_PROPS_SQL = """
SELECT event_id AS __id__, 'k' AS __props_key__, CAST(props ->> '$.k' AS BIGINT) AS __props_value__
FROM events WHERE CAST(props ->> '$.k' AS BIGINT) >= 10
"""


@query(_PROPS_SQL)
def flatten_map(spark: SparkSession, folder: str) -> DataFrame:
    """Map entries as key and value; an empty map drops its row."""
    return rename_columns(flatten(_event_documents(spark, folder)))


@query(_PROPS_SQL + """
UNION ALL
SELECT event_id, NULL, NULL FROM events WHERE CAST(props ->> '$.k' AS BIGINT) < 10
""")
def flatten_map_outer(spark: SparkSession, folder: str) -> DataFrame:
    return rename_columns(flatten(_event_documents(spark, folder), map_outer=True))


@query("""
SELECT id AS __id__, unnest(string_split(line, ' ')) AS __lines__
FROM (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line FROM documents) l
""")
def flatten_nested_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays of arrays: the words of all lines of all documents."""
    words = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    documents = texts(spark, folder).select(F.col("doc_id").alias("id"), words.alias("lines"))
    return child_table(documents, "lines")


@query("""
SELECT vec_id AS __id__, CAST(unnest(embedding) AS DOUBLE) AS __embedding__ FROM embeddings
""")
def flatten_vector(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    child = child_table(documents, "embedding")
    return child.withColumn("__embedding__", F.col("__embedding__").cast("double"))


@query("""
SELECT p_partkey AS id, p_name AS Whatisitxyz, p_type AS Whatisitxyz_2, p_size + 0.5 AS nested_ab,
       p_brand AS list_cd, repeat('n', 128) AS longname, p_retailprice AS "values"
FROM part
""")
def sanitize_names(spark: SparkSession, folder: str) -> DataFrame:
    """Field names cleaned at all levels, colliding ones told apart, long ones cut."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("What is it? (x/y).z!"),
        F.col("p_type").alias("What is it (x/y)z"),
        F.struct((F.col("p_size") + 0.5).alias("a: b")).alias("nested"),
        F.array(F.struct(F.col("p_brand").alias("c,d."))).alias("list"),
        F.create_map(F.lit("price"), F.struct(F.col("p_retailprice").alias("v!"))).alias("map"),
        F.lit("x").alias("n" * 130),
    )
    clean = sanitise(parts)
    return clean.select(
        "id",
        "Whatisitxyz",
        "Whatisitxyz_2",
        F.col("nested.ab").alias("nested_ab"),
        F.get(F.col("list.cd"), F.lit(0)).alias("list_cd"),
        F.lit(next(c for c in clean.columns if c.startswith("nnn"))).alias("longname"),
        F.col("map")["price"]["v"].alias("values"),
    )


@query("""
SELECT p_partkey AS id, p_name AS a_b, p_type AS a_b_2 FROM part
""")
def name_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Two fields that flatten to one name: ``a_b`` and ``a.b``."""
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("a_b"),
        F.struct(F.col("p_type").alias("b")).alias("a"),
    )
    return expand_structs(parts)


# ---------------------------------------------------------------- JSON files


def _event_json(spark: SparkSession, folder: str) -> str:
    path = scratch_dir(spark, "events")
    events = spread(table(spark, folder, "events"))
    events.select(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("user"), "value").alias("by"),
        F.from_json("props", "struct<k:bigint>").alias("props"),
        F.array("event_type", F.lit("event")).alias("tags"),
    ).write.json(path)
    return path


@query("""
SELECT event_id AS __id__, user_id AS __by_user__, value AS __by_value__,
       CAST(props ->> '$.k' AS BIGINT) AS __props_k__
FROM events
""")
def infer_json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files with their schema inferred from all of them."""
    documents = read_documents(spark, _event_json(spark, folder), multiline=False)
    return normalize(documents, CONVERSATIONS)[CONVERSATIONS.base_table]


@query("SELECT event_id AS __id__, unnest([event_type, 'event']) AS __tags__ FROM events")
def pinned_json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """The same files under a given schema: no inference pass, one field read."""
    schema = "id bigint, by struct<user:bigint,value:double>, props struct<k:bigint>, tags array<string>"
    documents = read_documents(spark, _event_json(spark, folder), schema, multiline=False)
    return normalize(documents, CONVERSATIONS)[CONVERSATIONS.child_table("tags")]


@query("SELECT page_id AS __id__, url AS __page_url__, html AS __page_html__ FROM pages")
def multiline_json(spark: SparkSession, folder: str) -> DataFrame:
    """One document per file, over several lines, as fetched objects are stored."""
    path = scratch_dir(spark, "pages")
    page = F.struct(F.col("page_id").alias("id"), F.struct("url", "html").alias("page"))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(NO_KEY))
    pages = table(spark, folder, "pages").select(
        F.concat(sharded("page_id", FILE_SHARDS), F.lit("file="), key, F.lit(".json")).alias("path"),
        F.to_json(page, {"pretty": "true"}).alias("value"),
    )
    write_objects(pages, path)
    prefixes = shard_prefixes(spark, path, FILE_SHARDS)
    documents = read_documents(spark, prefixes, "id bigint, page struct<url:string,html:string>")
    return base_table(documents)


@query("""
SELECT 'read' AS outcome, event_id AS id, NULL AS record FROM events WHERE event_type <> 'error'
UNION ALL
SELECT 'quarantined', NULL, '{"id": ' || event_id || ', ' || event_type FROM events WHERE event_type = 'error'
""")
def unreadable_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Records that are not JSON are set apart, the others are read."""
    path = scratch_dir(spark, "broken")
    broken = F.concat(F.lit('{"id": '), "event_id", F.lit(", "), "event_type")
    good = F.to_json(F.struct(F.col("event_id").alias("id")))
    spread(table(spark, folder, "events")).select(
        F.when(F.col("event_type") == "error", broken).otherwise(good).alias("value")
    ).write.text(path)
    schema = spark.createDataFrame([], "id bigint").schema
    readable, unreadable = split_unreadable(spark, path, schema, multiline=False)
    none = F.lit(None)
    return readable.select(
        F.lit("read").alias("outcome"), "id", none.cast("string").alias("record")
    ).unionByName(
        unreadable.select(
            F.lit("quarantined").alias("outcome"), none.cast("bigint").alias("id"), "record"
        )
    )


def _landed_in_rounds(spark: SparkSession, folder: str) -> str:
    """Conversation turns landed in three rounds, each normalised: what users say, then the rest.

    In the second round a turn's number is text in every fifth document, ids divisible by seven are
    numbers that name a field the schema lacks, and those divisible by eleven are cut off. The third round
    holds one document like those of the first.
    """
    base = scratch_dir(spark, "incremental")
    turn = F.struct("turn", "role", F.struct("text").alias("body"))
    turns = table(spark, folder, "conversations")
    schema = "id bigint, turns array<struct<turn:bigint,role:string,body:struct<text:string>>>"
    plain = F.to_json(F.struct(F.col("conv_id").alias("id"), F.array(turn).alias("turns")))
    odd_turn = F.struct(F.concat(F.lit("t"), "turn").alias("turn"), "role", F.struct("text").alias("body"))
    odd = F.to_json(F.struct(F.col("conv_id").alias("id"), F.array(odd_turn).alias("turns")))
    more = F.to_json(F.struct(F.col("conv_id").alias("id"), F.array(turn).alias("turns"), (F.col("turn") / 2).alias("new field")))
    cut = F.concat(F.lit('{"id": '), "conv_id")
    later = (
        F.when(F.col("conv_id") % 11 == 0, cut)
        .when(F.col("conv_id") % 7 == 0, more)
        .when(F.col("conv_id") % 5 == 0, odd)
        .otherwise(plain)
    )
    users = turns.where("role = 'user'")
    rounds = (users.select(plain.alias("value")), turns.where("role <> 'user'").select(later.alias("value")),
              users.orderBy("conv_id", "turn").limit(1).select(plain.alias("value")))
    for texts_of_round in rounds:
        texts_of_round.write.mode("append").text(f"{base}/raw")
        run_incremental(
            spark, f"{base}/raw", schema, CONVERSATIONS, f"{base}/tables", f"{base}/checkpoint", False
        )
    return f"{base}/tables"


@query("""
SELECT conv_id AS __id__, CASE WHEN role = 'user' OR conv_id % 5 <> 0 OR conv_id % 7 = 0 THEN turn END AS __turns_turn__,
       role AS __turns_role__, text AS __turns_body_text__,
       CAST(CASE WHEN role = 'user' THEN 0 ELSE 1 END AS BIGINT) AS batch
FROM conversations WHERE role = 'user' OR conv_id % 11 <> 0
UNION ALL
(SELECT conv_id, turn, role, text, 2 FROM conversations WHERE role = 'user' ORDER BY conv_id, turn LIMIT 1)
""")
def incremental_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Documents landing in three rounds, each handled once; a mistyped field costs no document."""
    root = _landed_in_rounds(spark, folder)
    out = spark.read.parquet(f"{root}/{CONVERSATIONS.child_table('turns')}")
    return out.withColumn("batch", F.col("batch").cast("bigint"))


@query("""
WITH later AS (
  SELECT bool_or(conv_id % 7 = 0) AS grown FROM conversations WHERE role <> 'user' AND conv_id % 11 <> 0)
SELECT 0::BIGINT AS batch, 'conversation_history_rest_of_fields' AS "table",
       'ALTER TABLE conversation_history_rest_of_fields ADD [__id__] NVARCHAR(MAX);' AS statement
UNION ALL
SELECT 0, 'conversation_history_turns',
       'ALTER TABLE conversation_history_turns ADD [__id__] NVARCHAR(MAX), [__turns_body_text__] NVARCHAR(MAX), '
       || '[__turns_role__] NVARCHAR(MAX), [__turns_turn__] NVARCHAR(MAX);'
UNION ALL
SELECT 1, 'conversation_history_rest_of_fields',
       'ALTER TABLE conversation_history_rest_of_fields ADD [__newfield__] FLOAT;' FROM later WHERE grown
UNION ALL
SELECT 1, 'conversation_history_contacts', 'SELECT TOP(1) * FROM [dbo].[conversation_history_contacts];'
FROM later WHERE NOT grown
UNION ALL
SELECT 2, 'conversation_history_contacts', 'SELECT TOP(1) * FROM [dbo].[conversation_history_contacts];'
""")
def incremental_statements(spark: SparkSession, folder: str) -> DataFrame:
    """What each round adds to the tables: all columns, then a new field, then nothing."""
    root = _landed_in_rounds(spark, folder)
    out = spark.read.parquet(f"{root}/{STATEMENTS}")
    return out.withColumn("batch", F.col("batch").cast("bigint"))


@query("""
SELECT kind, path, value, count(*) AS documents FROM (
  SELECT 'mistyped' AS kind, 'turns[].turn' AS path, '"t' || turn || '"' AS value FROM conversations
  WHERE role <> 'user' AND conv_id % 5 = 0 AND conv_id % 7 <> 0 AND conv_id % 11 <> 0
  UNION ALL
  SELECT 'unreadable', '', '{"id": ' || conv_id FROM conversations WHERE role <> 'user' AND conv_id % 11 = 0) x
GROUP BY ALL
""")
def unexpected_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values that the fields do not hold, and texts that are no JSON, counted over the rounds."""
    root = _landed_in_rounds(spark, folder)
    found = spark.read.parquet(f"{root}/{UNEXPECTED}").select("kind", "path", "value")
    broken = spark.read.parquet(f"{root}/{UNREADABLE}").select(
        F.lit("unreadable").alias("kind"), F.lit("").alias("path"), F.col("record").alias("value")
    )
    return found.unionByName(broken).groupBy("kind", "path", "value").agg(F.count("*").alias("documents"))


@query("""
SELECT event_id AS id, 'extra' AS path, 'unknown' AS kind, to_json(event_type) AS value FROM events
UNION ALL
SELECT event_id, 'by.flag', 'unknown', 'true' FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, 'tags[].b', 'unknown', CAST(user_id AS VARCHAR) FROM events
UNION ALL
SELECT event_id, 'by.user', 'mistyped', '"u' || user_id || '"' FROM events WHERE event_type = 'view'
""")
def unknown_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields outside a pinned schema, at all depths, and values that do not fit it."""
    path = scratch_dir(spark, "unknown")
    user = F.when(F.col("event_type") == "view", F.to_json(F.struct(F.concat(F.lit("u"), "user_id").alias("user"))))
    by = F.coalesce(
        user,
        F.when(F.col("event_type") == "error", F.to_json(F.struct(F.col("user_id").alias("user"), F.lit(True).alias("flag")))),
        F.to_json(F.struct(F.col("user_id").alias("user"))),
    )
    tags = F.to_json(F.array(F.struct(F.col("event_type").alias("a"), F.col("user_id").alias("b"))))
    spread(table(spark, folder, "events")).select(
        F.format_string('{"id":%d,"by":%s,"tags":%s,"extra":"%s"}', "event_id", by, tags, "event_type").alias("value")
    ).write.text(path)
    documents = staged(parsed_documents(raw_documents(spark.read, path, multiline=False)), "documents")
    pinned = StructType.fromDDL("id bigint, by struct<user:bigint>, tags array<struct<a:string>>")
    key = F.try_variant_get("document", "$.id", "bigint").alias("id")
    return unexpected(documents.select(key, "document"), pinned, ["id"])


# ---------------------------------------------------------------- schema drift


def _orders_json(spark: SparkSession, folder: str, later: bool) -> DataFrame:
    """Order documents as they came first, and as they came later with more fields.

    Schemas are inferred from all written documents, so they depend on the data: a field
    that no document has is not in them.
    """
    path = scratch_dir(spark, "orders")
    _write_orders(spark, folder, later, path)
    return read_documents(spark, path, multiline=False)


def _write_orders(spark: SparkSession, folder: str, later: bool, path: str) -> None:
    orders = spread(table(spark, folder, "orders"))
    fields = [
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("status"),
            (F.col("o_totalprice") if later else F.col("o_totalprice").cast("string")).alias("total"),
        ).alias("state"),
        F.array("o_orderpriority").alias("tags"),
    ]
    if later:
        urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") / 2)
        fields += [
            urgent.alias("rush fee"),
            F.array(F.struct(F.col("o_custkey").alias("key"), urgent.alias("fee"))).alias("parties"),
        ]
    orders.select(*fields).write.json(path)


def _columns_sql(base: str) -> str:
    """Columns of both loads, types taken from the JSON form of the data."""
    return f"""
    WITH first_load AS (
      SELECT to_json({{'id': o_orderkey, 'state_status': o_orderstatus,
                      'state_total': CAST(o_totalprice AS VARCHAR)}}) AS base,
             to_json({{'id': o_orderkey, 'tags': o_orderpriority}}) AS tags FROM orders),
    later_load AS (
      SELECT to_json({{'id': o_orderkey, 'state_status': o_orderstatus, 'state_total': o_totalprice,
                      'rushfee': CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 2 END}}) AS base,
             to_json({{'id': o_orderkey, 'tags': o_orderpriority}}) AS tags,
             to_json({{'id': o_orderkey, 'parties_key': o_custkey,
                      'parties_fee': CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 2 END}}) AS parties
      FROM orders),
    docs AS (
      SELECT 'first' AS load, 'rest_of_fields' AS t, base AS j FROM first_load
      UNION ALL SELECT 'first', 'tags', tags FROM first_load
      UNION ALL SELECT 'later', 'rest_of_fields', base FROM later_load
      UNION ALL SELECT 'later', 'tags', tags FROM later_load
      UNION ALL SELECT 'later', 'parties', parties FROM later_load),
    keys AS (SELECT load, t, j, unnest(json_keys(j)) AS k FROM docs),
    cols AS (
      SELECT DISTINCT load, '{base}' || t AS "table", '__' || k || '__' AS name,
             CASE WHEN t = 'rest_of_fields' AND json_type(j, '$.' || k) = 'DOUBLE'
                  THEN 'FLOAT' ELSE 'NVARCHAR(MAX)' END AS type
      FROM keys WHERE json_type(j, '$.' || k) <> 'NULL'),
    drift AS (
      SELECT l."table", l.name, l.type,
             CASE WHEN EXISTS (SELECT 1 FROM cols f WHERE f.load = 'first' AND f."table" = l."table"
                               AND f.name = l.name) THEN 'type_change' ELSE 'new' END AS kind
      FROM cols l
      WHERE l.load = 'later' AND NOT EXISTS (
        SELECT 1 FROM cols f WHERE f.load = 'first' AND f."table" = l."table"
        AND f.name = l.name AND f.type = l.type))
    """


def _first_registry(spark: SparkSession, folder: str, entity) -> tuple[str, DataFrame]:
    """The registry after the first load, written and read back."""
    root = scratch_dir(spark, "registry")
    tables = normalize(_orders_json(spark, folder, later=False), entity)
    empty = read_registry(spark, root)
    write_registry(empty, new_columns(table_columns(spark, tables, entity), empty), root)
    return root, read_registry(spark, root)


def _later_drift(spark: SparkSession, folder: str, registered: DataFrame, entity) -> DataFrame:
    tables = normalize(_orders_json(spark, folder, later=True), entity)
    return new_columns(table_columns(spark, tables, entity), registered)


@query(_columns_sql("conversation_history_") + """
SELECT "table", name, type FROM cols WHERE load = 'later'
""")
def sql_types(spark: SparkSession, folder: str) -> DataFrame:
    tables = normalize(_orders_json(spark, folder, later=True), CONVERSATIONS)
    return table_columns(spark, tables, CONVERSATIONS)


@query(_columns_sql("conversation_history_") + """
SELECT 'first' AS seen, name FROM cols WHERE load = 'first'
UNION SELECT 'both', name FROM cols
""")
def learned_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of schemas learned batch by batch: of the first load, then of both, each file read once."""
    base = scratch_dir(spark, "learned")
    names = []
    for seen, later in (("first", False), ("both", True)):
        _write_orders(spark, folder, later, f"{base}/raw/{seen}")
        schema = learn(spark, f"{base}/raw/*", f"{base}/store", f"{base}/checkpoint", multiline=False)
        tables = normalize(spark.createDataFrame([], schema), CONVERSATIONS)
        names += [(seen, c) for c in sorted({c for t in tables.values() for c in t.columns})]
    return spark.createDataFrame(names, "seen string, name string")


@query(_columns_sql("conversation_history_") + "SELECT * FROM drift")
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    _, registered = _first_registry(spark, folder, CONVERSATIONS)
    return _later_drift(spark, folder, registered, CONVERSATIONS)


@query(_columns_sql("conversation_history_") + """
SELECT "table", 'ALTER TABLE ' || "table" || ' ADD '
       || string_agg('[' || name || '] ' || type, ', ' ORDER BY name, type) || ';' AS statement
FROM drift GROUP BY "table"
""")
def drift_ddl(spark: SparkSession, folder: str) -> DataFrame:
    """ALTER statements through their sink."""
    _, registered = _first_registry(spark, folder, CONVERSATIONS)
    feed = ddl_feed(_later_drift(spark, folder, registered, CONVERSATIONS), CONVERSATIONS)
    path = scratch_dir(spark, "ddl")
    write_statements(feed, path)
    return spark.read.schema("table string, statement string").json(path)


@query(_columns_sql("intercom_tickets_") + """
SELECT "table", 'ALTER TABLE ' || "table" || ' ADD '
       || string_agg(name || ' ' || type, ', ' ORDER BY name, type) || ';' AS statement
FROM drift GROUP BY "table"
""")
def drift_ddl_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """The other entity: no brackets around names, no cleaning of nested names."""
    _, registered = _first_registry(spark, folder, TICKETS)
    return ddl_feed(_later_drift(spark, folder, registered, TICKETS), TICKETS)


@query(_columns_sql("conversation_history_") + """
SELECT "table", name, type FROM cols WHERE load = 'first'
UNION ALL SELECT "table", name, type FROM drift
""")
def registry_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The registry after both loads."""
    root, registered = _first_registry(spark, folder, CONVERSATIONS)
    write_registry(registered, _later_drift(spark, folder, registered, CONVERSATIONS), root)
    return read_registry(spark, root)


@query(_columns_sql("conversation_history_") + """
SELECT load, "table", statement FROM (
  SELECT 'later' AS load, "table", 'ALTER TABLE ' || "table" || ' ADD '
         || string_agg('[' || name || '] ' || type, ', ' ORDER BY name, type) || ';' AS statement
  FROM drift GROUP BY "table"
  UNION ALL
  SELECT load, 'conversation_history_contacts', 'SELECT TOP(1) * FROM [dbo].[conversation_history_contacts];'
  FROM (SELECT 'again' AS load, count(*) AS n FROM cols a WHERE a.load = 'first' AND NOT EXISTS (
          SELECT 1 FROM cols b WHERE b.load = 'first' AND a."table" = b."table" AND a.name = b.name AND a.type = b.type)
        UNION ALL SELECT 'later', count(*) FROM drift) x WHERE n = 0) y
""")
def noop_ddl(spark: SparkSession, folder: str) -> DataFrame:
    """The same load again, which gives one harmless statement, and the later one, which gives others."""
    _, registered = _first_registry(spark, folder, CONVERSATIONS)
    tables = normalize(_orders_json(spark, folder, later=False), CONVERSATIONS)
    drift = new_columns(table_columns(spark, tables, CONVERSATIONS), registered)
    again = ddl_feed(drift, CONVERSATIONS).select(F.lit("again").alias("load"), "*")
    later = ddl_feed(_later_drift(spark, folder, registered, CONVERSATIONS), CONVERSATIONS)
    return again.unionByName(later.select(F.lit("later").alias("load"), "*"))
