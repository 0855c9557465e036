"""Queries of the sources and sinks: files, pages, logs, setups, searches, each with equivalent SQL."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from graphloom.functions import text, types
from graphloom.operators import changes, history, links, matching, reading, shaping, vertices
from graphloom.plans import change_log, reports
from graphloom.plans.catalog import day, drained, query, t
from graphloom.registry import arguments, report_filters, sources
from graphloom.schema import Property, VertexEntry
from graphloom.session import new_folder
from graphloom.sources import readers
from graphloom.sources.typed_json import plain_json
from graphloom.streaming import flows

XSD = """<xs:schema><xs:complexType><xs:sequence><xs:element name="Table1"/></xs:sequence>
<xs:sequence><xs:element name="name" type="xs:string" minOccurs="0"/><xs:element name="size" type="xs:int"/><xs:element name="made" type="xs:dateTime"/></xs:sequence></xs:complexType></xs:schema>"""


@query("SELECT p_partkey, p_name AS name, CAST(p_size AS BIGINT) AS size, '2024-01-02 03:04:05' AS made FROM part")
def xml_header_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows typed by their document's header."""
    kinds = readers.xml_schema(XSD)
    made = F.concat(F.lit("<NewDataSet><Table1><name>"), "p_name", F.lit("</name><size>"), F.col("p_size").cast("string"), F.lit("</size><made>2024-01-02T03:04:05</made></Table1></NewDataSet>"))
    rows = readers.xml_rows(t(spark, d, "part").select("p_partkey", made.alias("xml")), "xml", kinds)
    return rows.select("p_partkey", "name", "size", F.date_format("made", "yyyy-MM-dd HH:mm:ss").alias("made"))


@query("SELECT min(o_orderkey) AS min, max(o_orderkey) AS max FROM orders")
def id_bounds(spark: SparkSession, d: str) -> DataFrame:
    """The probe of a remote source, by its registered name."""
    return sources.get("min_max")(t(spark, d, "orders"), "o_orderkey")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS moment, CAST(o_totalprice AS DOUBLE) AS total, nullif(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority || ', \"x\"' END, '') AS note FROM orders")
def csv_files(spark: SparkSession, d: str) -> DataFrame:
    """A CSV asset with a header, written by one job and read typed by another."""
    note = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat("o_orderpriority", F.lit(', "x"')))
    folder = new_folder(spark, "csv")
    rows = t(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("moment"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"), note.alias("note"))
    rows.write.csv(folder, header=True, escape='"')
    typed = readers.csv_rows(spark, folder, {"o_orderkey": "number", "moment": "datetime", "total": "number", "note": "string"})
    return typed.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), day("moment").alias("moment"), F.col("total").cast("double").alias("total"), "note")


@query("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def static_assets(spark: SparkSession, d: str) -> DataFrame:
    """Static JSON."""
    folder = new_folder(spark, "json")
    item = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))
    t(spark, d, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(item), ",\n"), F.lit("\n]")).alias("value")).write.partitionBy("n_regionkey").text(folder)
    return readers.static_json(spark, f"{folder}/*/*.txt").select("id", "name", "region")


@query("SELECT r_regionkey, base64(encode(r_name || chr(10))) AS content FROM region")
def static_images(spark: SparkSession, d: str) -> DataFrame:
    """Binary assets as base64."""
    folder = new_folder(spark, "images")
    t(spark, d, "region").select(F.col("r_name").alias("value"), "r_regionkey").write.partitionBy("r_regionkey").text(folder)
    found = readers.static_image(spark, f"{folder}/*/*.txt")
    return found.select(F.regexp_extract("path", r"r_regionkey=(\d+)", 1).cast(t(spark, d, "region").schema["r_regionkey"].dataType).alias("r_regionkey"), "content")


@query("SELECT min(page_id) AS min, max(page_id) AS max FROM pages WHERE page_id % 7 = 3")
def client_link_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Least and largest id in the links of pages."""
    made = F.when(F.col("page_id") % 7 == 3, F.concat("html", F.lit('<a href="/client?client_id='), F.col("page_id").cast("string"), F.lit('&x=1">c</a>'))).otherwise(F.col("html"))
    return readers.link_ids(t(spark, d, "pages").select(made.alias("html")), "html", r"client_id=(\d+)&")


def log_pages(spark: SparkSession, d: str) -> DataFrame:
    """A change-log page per order: a heading row, then a row per line item of it: moment, employee, entity, id of the change."""
    cell = lambda c: F.concat(F.lit("<td class='x'> "), c, F.lit(" </td>"))
    link = lambda name, c: F.concat(F.lit(f'<a href="/{name}?id='), c.cast("string"), F.lit('">'), c.cast("string"), F.lit("</a>"))
    row = F.concat(F.lit("<tr>"), cell(F.date_format("l_shipdate", "M/d/yyyy h:mm:ss a")), cell(link("employee", F.col("l_suppkey"))), cell(link("entity", F.col("l_partkey"))), cell(F.col("l_linenumber").cast("string")), F.lit("</tr>"))
    pages = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", row.alias("r")))), lambda x: x["r"]), "\n").alias("rows"))
    return pages.select(F.col("l_orderkey").alias("page_no"), F.concat(F.lit("<html><table><tr><th>When</th><th>Who</th><th>What</th><th>Change</th></tr>"), "rows", F.lit("</table></html>")).alias("html"))


@query("SELECT l_orderkey AS page_no, strftime(l_shipdate, '%Y-%m-%d') AS moment, CAST(l_suppkey AS BIGINT) AS emp_id, CAST(l_partkey AS BIGINT) AS entity_id, CAST(l_linenumber AS BIGINT) AS changelog_id FROM lineitem")
def change_log_pages(spark: SparkSession, d: str) -> DataFrame:
    """Who, what and which change at each moment, from the cells of change-log pages."""
    cells = readers.table_cells(log_pages(spark, d), "html", skip=1)
    at = lambda k: F.col("cells")[k]
    number = lambda k: at(k).try_cast("bigint")
    return cells.select("page_no", day(types.source_time(at(0))).alias("moment"), number(1).alias("emp_id"), number(2).alias("entity_id"), number(3).alias("changelog_id"))


@query("SELECT page_no FROM (SELECT l_orderkey AS page_no, count(*) AS n FROM lineitem GROUP BY 1) WHERE n + 1 <= 3")
def last_log_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of at most three rows, with the heading, end a paged scan."""
    counts = readers.table_cells(log_pages(spark, d), "html").groupBy("page_no").agg(F.count("*").alias("rows"))
    return counts.where("rows <= 3").select("page_no")


@query("SELECT p_partkey, 'p_name' AS id_name, 'old ' || p_brand AS old_value, p_name AS new_value FROM part UNION ALL SELECT p_partkey, 'p_size', '', CAST(p_size AS VARCHAR) FROM part")
def change_detail_pages(spark: SparkSession, d: str) -> DataFrame:
    """Rows after the fourth of change pages."""
    head = F.lit("<table>" + "<tr><td>heading</td><td>x</td><td>y</td></tr>" * 4)
    html = F.concat(head, F.lit("<TR><td>P_NAME</td><td>old "), "p_brand", F.lit("</td><td><b>"), "p_name", F.lit("</b></td></TR><tr><td>P_Size</td><td></td><td>"), F.col("p_size").cast("string"), F.lit("</td></tr><tr><td>short</td></tr></table>"))
    return readers.change_details(t(spark, d, "part").select("p_partkey", html.alias("html")), "html")


@query("SELECT event_id, 'goal ' || user_id AS goal, event_type AS intervention FROM events WHERE user_id % 2 = 0")
def encounter_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of interest of encounter pages, of those that hold every wanted text."""
    html = F.concat(F.lit("<div><b>Goal</b><span>goal "), F.col("user_id").cast("string"), F.lit("</span><b>Intervention</b><i>"), "event_type", F.lit("</i><b>Other</b><i>"), F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"), F.lit("</i></div>"))
    pages = t(spark, d, "events").select("event_id", html.alias("html"))
    kept = pages.where(shaping.contains_all(F.col("html"), ("Goal", "even")))
    pairs = kept.select("event_id", F.explode(text.label_values(F.col("html"))).alias("p")).where(F.col("p.label").isin("Goal", "Intervention"))
    return pairs.groupBy("event_id").agg(F.max(F.when(F.col("p.label") == "Goal", F.col("p.value"))).alias("goal"), F.max(F.when(F.col("p.label") == "Intervention", F.col("p.value"))).alias("intervention"))


@query("""
    SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \\t\\n\\f\\r\\v]+', ' ', 'g')) AS body FROM pages
""")
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of stored pages."""
    return t(spark, d, "pages").select("page_id", text.html_text(F.col("html")).alias("body"))


@query("SELECT n_nationkey, CAST(count(c_custkey) AS BIGINT) AS matches, CASE WHEN count(c_custkey) = 1 THEN min(c_custkey) END AS matched, CASE count(c_custkey) WHEN 0 THEN 'missing' WHEN 1 THEN 'unique' ELSE 'duplicate' END AS outcome FROM nation LEFT JOIN customer ON lower(c_name) = lower('CUSTOMER#' || lpad(CAST(n_nationkey * 7 AS VARCHAR), 9, '0')) GROUP BY 1")
def name_search(spark: SparkSession, d: str) -> DataFrame:
    """An id by a name, without case; a hit counts if there is one only."""
    asked = t(spark, d, "nation").select("n_nationkey", F.concat(F.lit("CUSTOMER#"), F.lpad((F.col("n_nationkey") * 7).cast("string"), 9, "0")).alias("asked"))
    people = t(spark, d, "customer").select("c_custkey", "c_name")
    return matching.matched_once(asked, people, F.lower("asked") == F.lower("c_name"), "n_nationkey", "c_custkey")


CLIENT = VertexEntry("Client", (Property("c_custkey", "Number", is_id=True), Property("c_name"), Property("c_mktsegment")), ("object_type", "c_custkey"), ("c_mktsegment",))


def clients(spark: SparkSession, d: str) -> DataFrame:
    return vertices.build(t(spark, d, "customer"), CLIENT)


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey <> 0")
def point_gets(spark: SparkSession, d: str) -> DataFrame:
    """Vertices by type and property, rebuilt to their columns."""
    found = reading.find(clients(spark, d), "Client", c_mktsegment="BUILDING", c_name=None)
    return reading.properties(found, ["c_custkey", "c_name", "c_mktsegment"]).groupBy("internal_id").pivot("name", ["c_custkey", "c_name", "c_mktsegment"]).agg(F.first("value")).where("c_custkey is not null").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))


@query("SELECT '#propagation#' || user_id || '#' || event_type AS stem, event_type AS category FROM events WHERE user_id < 20 GROUP BY ALL")
def prefix_scans(spark: SparkSession, d: str) -> DataFrame:
    """Keys that begin with a prefix, once each."""
    kind = F.when(F.col("user_id") < 20, "#propagation#").otherwise("#creep#")
    rows = t(spark, d, "events").select(F.concat(kind, F.col("user_id").cast("string"), F.lit("#"), "event_type").alias("stem"), F.col("event_type").alias("category"))
    return readers.by_prefix(rows, "stem", "#propagation#", "stem").select("stem", "category")


def change_types(spark: SparkSession, d: str) -> DataFrame:
    """The nations as actions of regions as categories."""
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("action"), F.col("n_nationkey").alias("action_id"), F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category"))


@query("""
    SELECT 'row' AS shape, n_regionkey AS category_id, CAST(n_nationkey AS VARCHAR) AS a, n_name AS b FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name LIKE 'A%'
    UNION ALL SELECT 'map', n_regionkey, CAST(count(*) AS VARCHAR), min(n_name) FROM nation GROUP BY 2
    UNION ALL SELECT 'list', n_regionkey, CAST(count(*) AS VARCHAR), min(r_name) FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 2
""")
def change_type_shapes(spark: SparkSession, d: str) -> DataFrame:
    """The change types as rows of some categories, as a map by category and as lists."""
    types_ = change_types(spark, d)
    rows = changes.type_index(types_, "A").select(F.lit("row").alias("shape"), "category_id", F.col("action_id").cast("string").alias("a"), F.col("action").alias("b"))
    maps = changes.by_category(types_).select(F.lit("map"), "category_id", F.size("actions").cast("string"), F.array_min(F.map_values("actions")))
    lists = changes.categories(types_).select(F.lit("list"), "category_id", F.size("action_ids").cast("string"), "category")
    return rows.union(maps).union(lists)


@query("SELECT event_id, CASE event_type WHEN 'signup' THEN 'client_id' WHEN 'view' THEN 'clientvisit_id' ELSE event_type || '_id' END AS id_name FROM events")
def setups(spark: SparkSession, d: str) -> DataFrame:
    """The configuration of what is asked for; what isn't set up would be an error."""
    configs = spark.createDataFrame([("signup", "client_id"), ("view", "clientvisit_id"), *((x, f"{x}_id") for x in ("click", "purchase", "error"))], "id_type string, setup string")
    asked = t(spark, d, "events").select("event_id", F.col("event_type").alias("id_type"))
    return changes.setup(configs, asked, "id_type").select("event_id", F.col("setup").alias("id_name"))


@query("SELECT 'page' AS how, o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 30 OFFSET 40) UNION ALL SELECT 'after', o_orderkey FROM (SELECT o_orderkey FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 30)")
def paged_reads(spark: SparkSession, d: str) -> DataFrame:
    """A page by position and the page after a key; limits are the feature."""
    rows = t(spark, d, "orders").select("o_orderkey")
    first = reading.page(rows, 40, 30, "o_orderkey").select(F.lit("page").alias("how"), "o_orderkey")
    return first.unionByName(reading.after(rows, 100, 30, "o_orderkey").select(F.lit("after").alias("how"), "o_orderkey"))


@query("SELECT identifier_stem, sid_value, event_name FROM (SELECT CAST(user_id AS VARCHAR) AS identifier_stem, CAST(event_id AS VARCHAR) AS sid_value, CASE WHEN event_type = 'signup' THEN 'INSERT' ELSE 'MODIFY' END AS event_name, value FROM events) WHERE value > 50")
def change_records(spark: SparkSession, d: str) -> DataFrame:
    """Change-stream records decoded from JSON texts."""
    image = F.struct(F.when(F.col("value") > 50, "graphing").otherwise("waiting").alias("disposition"), F.create_map(F.lit("a"), F.col("value") > 50).alias("progress"))
    record = F.struct(F.when(F.col("event_type") == "signup", "INSERT").otherwise("MODIFY").alias("event_name"), F.col("user_id").cast("string").alias("identifier_stem"), F.col("event_id").cast("string").alias("sid_value"), image.alias("new"))
    return flows.changes(t(spark, d, "events").select(F.to_json(record).alias("value"))).where("new.disposition = 'graphing'").select("identifier_stem", "sid_value", "event_name")


@F.pandas_udf(StringType())
def zipped(bodies: pd.Series) -> pd.Series:
    """What a log service sends: gzipped JSON."""
    return bodies.map(lambda x: None if x is None else gzip.compress(x.encode()).hex())


@query("""
    SELECT event_id AS record_id, CASE event_id % 4 WHEN 0 THEN 'dropped' WHEN 1 THEN 'failed' ELSE 'ok' END AS result, CASE WHEN event_id % 4 > 1 THEN 'm' || event_id || '-' || k END AS id, CASE WHEN event_id % 4 > 1 THEN event_type END AS message
    FROM events LEFT JOIN (VALUES (0), (1)) v(k) ON event_id % 4 > 1
""")
def log_records(spark: SparkSession, d: str) -> DataFrame:
    """base64 of gzipped JSON; control messages are dropped, what can't be read has failed."""
    event = lambda k: F.struct(F.concat(F.lit("m"), F.col("event_id").cast("string"), F.lit(f"-{k}")).alias("id"), F.lit(1).cast("bigint").alias("timestamp"), F.col("event_type").alias("message"))
    kind = F.when(F.col("event_id") % 4 == 0, "CONTROL_MESSAGE").otherwise("DATA_MESSAGE")
    body = F.to_json(F.struct(kind.alias("messageType"), F.lit("g").alias("logGroup"), F.array(event(0), event(1)).alias("logEvents")))
    data = F.when(F.col("event_id") % 4 == 1, "no base64!").otherwise(F.base64(F.unhex(zipped(body))))
    return readers.log_records(t(spark, d, "events").select(F.col("event_id").alias("record_id"), data.alias("data"))).select("record_id", "result", "id", "message")


@query("SELECT o_orderkey, o_custkey FROM orders")
def spilled_rows(spark: SparkSession, d: str) -> DataFrame:
    """Stored once, read back by the pointer."""
    return readers.unspill(spark, readers.spill(t(spark, d, "orders").select("o_orderkey", "o_custkey"), new_folder(spark, "spill")))


@query("SELECT DISTINCT user_id AS flow_id FROM events WHERE event_type = 'signup' AND value > 100")
def running_workers(spark: SparkSession, d: str) -> DataFrame:
    """Workers of a kind that are running."""
    rows = t(spark, d, "events").select(F.col("user_id").alias("flow_id"), F.col("event_type").alias("kind"), (F.col("value") > 100).alias("running"))
    return readers.search(rows, ["flow_id"], [("kind", "=", "signup"), ("running", "=", True)]).distinct()


@query("SELECT '3' AS identifier_stem, user_id AS id_value FROM (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last FROM events WHERE user_id % 5 = 3 GROUP BY 1) WHERE last <> 'error'")
def links_of_a_stem(spark: SparkSession, d: str) -> DataFrame:
    """What is linked under one stem now."""
    rows = t(spark, d, "events").select((F.col("user_id") % 5).cast("string").alias("identifier_stem"), F.col("user_id").alias("id_value"), F.struct("ts", "event_id").alias("ts"), (F.col("event_type") == "error").alias("is_unlink"))
    return links.of_stem(rows, "3").select("identifier_stem", "id_value")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-01-01'")
def dispatched_source(spark: SparkSession, d: str) -> DataFrame:
    """An extractor by name with literal, provided and computed arguments."""
    given = {"fields": ["o_orderkey", "o_totalprice"], "conditions": {"function": lambda status, **_: [("o_orderstatus", "=", status)]}, "date": "o_orderdate", "start": {"provided": "since"}, "end": {"provided": "until"}}
    return sources.get("search")(t(spark, d, "orders"), **arguments(given, {"status": "O", "since": "1996-01-01", "until": "1997-01-01"}))


@query("SELECT 'Payroll' AS title, 'by priority' AS sheet, 2 AS columns, o_orderpriority AS first_cell, CAST(count(*) AS VARCHAR) AS second_cell FROM orders GROUP BY ALL")
def report_sheets(spark: SparkSession, d: str) -> DataFrame:
    """A sheet of a report with its title and width, written and read back."""
    rows = t(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    folder = new_folder(spark, "sheets")
    path = readers.write_sheets({"by priority": rows}, folder, "Payroll")["by priority"]
    title = spark.read.csv(f"{path}_title", header=True, schema="title string, sheet string, columns int").select("title", "sheet")
    cells = spark.read.csv(path, header=True).toDF("first_cell", "second_cell")
    width = shaping.widest(cells.select(F.array("first_cell", "second_cell").alias("cells")), "cells")
    return cells.join(title, F.lit(True)).join(width, F.lit(True)).select("title", "sheet", "columns", "first_cell", "second_cell")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS name, r_name AS region FROM nation JOIN region ON r_regionkey = n_regionkey")
def typed_json(spark: SparkSession, d: str) -> DataFrame:
    """Store items and graph values made plain, an alternating list made a map, nested lists flat."""
    n = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    store = F.concat(F.lit('{"k": {"N": "'), F.col("n_nationkey").cast("string"), F.lit('"}, "name": {"S": "'), "n_name", F.lit('"}}'))
    graph = F.concat(F.lit('{"@type": "g:Map", "@value": ["region", "'), "r_name", F.lit('", "size", {"@type": "g:Int32", "@value": 1}]}'))
    rows = n.select(plain_json(store).alias("s"), plain_json(graph).alias("g"), readers.pair_map(F.flatten(F.array(F.array(F.lit("region"), "r_name"), F.array(F.lit("x"), F.lit("y"))))).alias("m"))
    kept = rows.where(F.get_json_object("g", "$.region") == F.col("m")["region"])
    return kept.select(F.get_json_object("s", "$.k").alias("k"), F.get_json_object("s", "$.name").alias("name"), F.get_json_object("g", "$.region").alias("region"))


@query("""
    SELECT p_partkey, p_brand AS cleaned, CASE WHEN p_size % 3 = 0 THEN 'unspecified' ELSE p_type END AS kind, p_size % 2 = 0 AS is_true, p_size % 5 <> 0 AS any_text, '06/06/2000' AS later, CASE WHEN p_partkey % 2 = 0 THEN '06/04/1990' ELSE '02/01/1999' END AS since FROM part
""")
def text_rules(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned texts, defaults, flags, a day from now and a filter's date."""
    flag = F.when(F.col("p_size") % 2 == 0, "True").otherwise("False")
    some = F.when(F.col("p_size") % 5 == 0, "").otherwise("False")
    since = F.when(F.col("p_partkey") % 2 == 1, F.lit("1999-02-01").cast("timestamp"))
    return t(spark, d, "part").select(
        "p_partkey",
        text.clean(F.concat(F.lit(" \r\n"), "p_brand", F.lit("\n "))).alias("cleaned"),
        text.unspecified(F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type"))).alias("kind"),
        types.is_true(flag).alias("is_true"),
        types.any_text(some).alias("any_text"),
        types.date_from("2000-06-01", 5).alias("later"),
        types.filter_date(since, "2000-06-01").alias("since"),
    )


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('click', 'view')) GROUP BY 1")
def stream_destinations(spark: SparkSession, d: str) -> DataFrame:
    """A stream's rows to a sink per destination; each keeps the first row of a key."""
    folder = new_folder(spark, "sinks")
    stream = spark.readStream.schema(t(spark, d, "events").schema).parquet(f"{d}/events.parque[t]").select("user_id", F.col("event_type").alias("destination"))
    sinks = {name: flows.first_wins_sink(f"{folder}/{name}", "user_id") for name in ("click", "view")}

    def write(batch: DataFrame, batch_id: int) -> None:
        flows.by_destination({name: lambda rows, put=put: put(rows, batch_id) for name, put in sinks.items()})(batch, batch_id)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    rows = [spark.read.parquet(f"{folder}/{name}").select("user_id") for name in sinks]
    return rows[0].unionByName(rows[1]).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def stream_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Log lines parsed in a stream."""
    stream = spark.readStream.schema(t(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")
    line = F.concat(F.lit("[INFO] 2024-01-01T00:00:00Z r1 {"), "event_type", F.lit("} done"))
    parsed = flows.log_lines(stream.select(line.alias("message"))).select(F.col("python.function_name").alias("event_type"))
    return drained(spark, parsed, "append").groupBy("event_type").agg(F.count("*").alias("events"))


WINDOW = {"date": "ts", "start": "2024-01-02", "end": "2024-01-20"}
#: The six searches of the productivity report and the four of payroll: source, fields, conditions.
SEARCHES = {
    "productivity.encounters": ("events", ["user_id", "value"], [("event_type", "=", "purchase")]),
    "productivity.unapproved": ("events", ["user_id", "value"], [("event_type", "=", "view")]),
    "productivity.tx_plans": ("events", ["user_id"], [("event_type", "=", "signup")]),
    "productivity.diagnostics": ("events", ["user_id"], [("event_type", "in", ["signup", "view"])]),
    "productivity.emp_data": ("events", ["user_id"], [("event_type", "!=", "error")]),
    "productivity.clients": ("events", ["user_id"], [("value", ">=", 10.0)]),
    "payroll.encounters": ("events", ["user_id", "value"], [("event_type", "=", "purchase"), ("value", ">", 20.0)]),
    "payroll.rates": ("events", ["user_id", "value"], [("event_type", "like", "cl%")]),
    "payroll.periods": ("events", ["user_id"], [("event_type", "=", "click")]),
    "payroll.unapproved": ("events", ["user_id"], [("event_type", "=", "error"), ("value", "<", 500.0)]),
}


@query("""
    WITH e AS (SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-20')
    SELECT 'productivity.encounters' AS search, count(*) AS found FROM e WHERE event_type = 'purchase' UNION ALL SELECT 'productivity.unapproved', count(*) FROM e WHERE event_type = 'view'
    UNION ALL SELECT 'productivity.tx_plans', count(*) FROM e WHERE event_type = 'signup' UNION ALL SELECT 'productivity.diagnostics', count(*) FROM e WHERE event_type IN ('signup', 'view')
    UNION ALL SELECT 'productivity.emp_data', count(*) FROM e WHERE event_type <> 'error' UNION ALL SELECT 'productivity.clients', count(*) FROM e WHERE value >= 10
    UNION ALL SELECT 'payroll.encounters', count(*) FROM e WHERE event_type = 'purchase' AND value > 20 UNION ALL SELECT 'payroll.rates', count(*) FROM e WHERE event_type LIKE 'cl%'
    UNION ALL SELECT 'payroll.periods', count(*) FROM e WHERE event_type = 'click' UNION ALL SELECT 'payroll.unapproved', count(*) FROM e WHERE event_type = 'error' AND value < 500
""")
def report_searches(spark: SparkSession, d: str) -> DataFrame:
    """The ten searches of the reports' source sets, each with its date window."""
    searches = {name: {"source": source, "fields": fields, "conditions": conditions, **WINDOW} for name, (source, fields, conditions) in SEARCHES.items()}
    found = change_log.query_sets({"events": t(spark, d, "events")}, searches)
    parts = [rows.agg(F.count("*").alias("found")).select(F.lit(name).alias("search"), "found") for name, rows in found.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 4 <> 0")
def complete_rows(spark: SparkSession, d: str) -> DataFrame:
    """rows that have all of three columns."""
    k = F.col("p_partkey")
    rows = t(spark, d, "part").select("p_partkey", F.when(k % 3 != 0, F.col("p_name")).alias("a"), F.when(k % 4 == 0, "").otherwise(F.col("p_brand")).alias("b"), F.col("p_size").alias("c"))
    return shaping.complete(rows, "a", "b", "c").select("p_partkey")


@query("SELECT s_suppkey AS csw_id, CAST(0 AS DOUBLE) + coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0) AS unapproved FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1")
def named_report_filter(spark: SparkSession, d: str) -> DataFrame:
    """A report filter by its registered name."""
    lines = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("emp_id"), F.col("l_quantity").alias("base_rate"), F.col("l_shipdate").alias("transfer_date"), F.lit("").alias("red_x"), "l_returnflag")
    people = t(spark, d, "supplier").select(F.col("s_suppkey").alias("emp_id"), F.col("s_name").alias("emp_name"))
    report = report_filters.get("team_productivity")(people, lines.where("l_returnflag <> 'N'"), lines.where("l_returnflag = 'N'"), "2000-06-01")
    return report.select("csw_id", F.col("unapproved").cast("double").alias("unapproved"))


@query("SELECT 'unassigned' AS page, count(*) AS rows FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'productivity', count(*) FROM supplier UNION ALL SELECT 'tx_plans', count(*) FROM customer UNION ALL SELECT 'diagnostics', count(*) FROM customer UNION ALL SELECT '30, 60, 90', count(*) FROM customer WHERE c_custkey % 3 <> 0")
def daily_bundle(spark: SparkSession, d: str) -> DataFrame:
    """A page per report of the day, those that the merged profile asks for."""
    schema = {"default": {"pages": ["unassigned", "productivity"], "title": {"text": "Daily"}}, "clinical": {"pages": ["tx_plans", "diagnostics", "30, 60, 90"], "title": {"size": 2}}}
    profile = reports.populate(schema, "clinical")
    people = t(spark, d, "supplier").select(F.col("s_suppkey").alias("emp_id"), F.col("s_name").alias("emp_name"))
    clients_ = t(spark, d, "customer").select(F.col("c_custkey").alias("client_id"))
    placed = clients_.where("client_id % 3 <> 0").select("client_id", F.lit("team").alias("team"), F.lit("csw").alias("csw_name"), F.lit(1).alias("emp_id"))
    work = t(spark, d, "orders").select(F.col("o_custkey").alias("client_id"), F.col("o_orderdate").alias("service_date"), F.lit(1).alias("emp_id"), F.lit(False).alias("non_billable"), F.col("o_orderdate").alias("transfer_date"), F.col("o_totalprice").alias("base_rate"), F.lit("").alias("red_x"))
    plans = clients_.select("client_id", F.lit("2000-01-01").cast("timestamp").alias("assessment_date"))
    pages = reports.daily(people, work, work, placed, clients_, plans, plans, "2000-06-01")
    whole = None
    for name in profile["pages"]:
        part = pages[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("page"), "rows")
        whole = part if whole is None else whole.unionByName(part)
    return whole


@query("SELECT 'w' || (user_id % 7) AS run_id, 100 - CAST(row_number() OVER (PARTITION BY user_id % 7 ORDER BY event_type = 'signup', event_id) AS INTEGER) AS from_end, event_id FROM events")
def decision_order(spark: SparkSession, d: str) -> DataFrame:
    """Decisions in order, those that close a run last."""
    rows = t(spark, d, "events").select(F.concat(F.lit("w"), (F.col("user_id") % 7).cast("string")).alias("run_id"), F.col("event_id").alias("sequence"), F.when(F.col("event_type") == "signup", "CompleteWorkflowExecution").otherwise("ScheduleActivityTask").alias("kind"))
    return history.completion_last(rows).select("run_id", (100 - F.col("place")).alias("from_end"), F.col("sequence").alias("event_id"))
