"""Queries of change logs by date and by what is known, link histories, older variants, chains and groups of operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import types
from graphloom.operators import attribution, changes, history, indexes, links, reading, vertices
from graphloom.plans import change_log
from graphloom.plans.catalog import query, t
from graphloom.plans.catalog_graph import CHANGE, ENTRY, EXTERNAL
from graphloom.plans.catalog_runs import FOLDED_SQL, log
from graphloom.plans.catalog_sources import SEARCHES, WINDOW
from graphloom.schema import Schema
from graphloom.session import new_folder
from graphloom.sources import typed_json
from graphloom.streaming import flows


def change_rows(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select("event_id", F.col("user_id").alias("id_value"), F.col("ts").cast("timestamp").alias("change_date"), F.col("event_type").alias("category"))


@query("""
    WITH known AS (SELECT user_id, max(ts) AS latest FROM events WHERE event_type = 'error' AND user_id % 3 <> 0 GROUP BY 1)
    SELECT event_id, e.user_id AS id_value FROM events e LEFT JOIN known k ON k.user_id = e.user_id WHERE event_type = 'click' AND (latest IS NULL OR ts >= latest)
""")
def driven_change_log(spark: SparkSession, d: str) -> DataFrame:
    """One category's changes of each driving id since what is known of it."""
    rows = change_rows(spark, d)
    return changes.since_known(rows, rows.where("category = 'error' and id_value % 3 <> 0"), "click").select("event_id", "id_value")


@query("""
    WITH day AS (SELECT date_trunc('hour', ts) AS moment, max_by(event_id, event_id) AS event_id FROM events WHERE event_type = 'view' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT epoch_us(moment) AS moment_us, event_id FROM day
""")
def global_change_log(spark: SparkSession, d: str) -> DataFrame:
    """A category's log of a date range by moment, the later row of a moment."""
    rows = change_rows(spark, d).where("category = 'view'").select(F.date_trunc("hour", "change_date").alias("change_date_utc"), "change_date", "event_id", F.col("event_id").alias("sequence"))
    return changes.daily_log(rows, "2024-01-05", "2024-01-15").select(F.unix_micros("change_date_utc").alias("moment_us"), "event_id")


@query("""
    WITH r AS (SELECT c_custkey AS id_value, c_custkey % 5 <> 0 AS known, c_custkey % 3 <> 0 AS linked, c_custkey % 2 = 0 AS remote FROM customer)
    SELECT id_value, 'new' AS outcome FROM r WHERE remote AND NOT known UNION ALL SELECT id_value, 'link' FROM r WHERE remote AND NOT (known AND linked) UNION ALL SELECT id_value, 'unlink' FROM r WHERE known AND linked AND NOT remote
""")
def older_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """New ids are linked in the same pass."""
    rows = t(spark, d, "customer").select(F.col("c_custkey").alias("id_value"))
    return links.reconcile_with_new(rows.where("id_value % 2 = 0"), rows.where("id_value % 5 <> 0").withColumn("is_linked", F.col("id_value") % 3 != 0))


RECORD_KIND = "CASE event_id % 5 WHEN 0 THEN 'Clients' WHEN 1 THEN 'Employees' WHEN 2 THEN 'unspecified' WHEN 3 THEN '' END"


@query(f"""
    WITH r AS (SELECT event_id, event_type, user_id % 7 AS client_id, event_id % 3 AS visit_id, event_id % 11 AS record_id, coalesce(nullif({RECORD_KIND}, ''), 'ChangeLog') AS kind FROM events)
    SELECT event_id, 'Clients' AS id_type, 'client_id' AS id_name, client_id AS id_value FROM r WHERE client_id <> 0
    UNION ALL SELECT event_id, 'ClientVisit', 'clientvisit_id', visit_id FROM r WHERE visit_id <> 0
    UNION ALL SELECT event_id, CASE WHEN kind = 'unspecified' THEN 'Static' ELSE kind END, CASE WHEN kind = 'unspecified' THEN event_type || '_id' ELSE 'changelog_id' END, record_id FROM r WHERE kind NOT IN ('Clients', 'ClientVisit')
""")
def older_changed_targets(spark: SparkSession, d: str) -> DataFrame:
    """Targets with zero guards and types by action for unspecified records."""
    rows = t(spark, d, "events").select("event_id", F.col("event_type").alias("action"), (F.col("user_id") % 7).alias("client_id"), (F.col("event_id") % 3).alias("clientvisit_id"), (F.col("event_id") % 11).alias("record_id"), F.expr(RECORD_KIND).alias("record_type"))
    static = {kind: ("Static", f"{kind}_id") for kind in ("view", "click", "purchase", "error", "signup")}
    return changes.changed_targets_before(rows, static, "ChangeLog", "changelog_id").select("event_id", "id_type", "id_name", "id_value")


@query("""
    SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 5 * 3600 AS as_written, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS as_utc FROM events
""")
def zone_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Times written with an offset, read as written and with the offset dropped."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00"))
    return t(spark, d, "events").select("event_id", F.unix_seconds(types.zone_corrected(text, False)).alias("as_written"), F.unix_seconds(types.zone_corrected(text, True)).alias("as_utc"))


@query("SELECT i AS id_value FROM range(1, 401) r(i) WHERE i <= (SELECT max(c_custkey) FROM customer) AND i % 4 <> 0")
def sampled_new_ids(spark: SparkSession, d: str) -> DataFrame:
    """One pass looks at the first 400 new ids; the cap is the feature."""
    remote = t(spark, d, "customer").agg(F.max("c_custkey").alias("max_id"))
    local = remote.select(F.lit(0).cast("bigint").alias("max_id"))
    working = t(spark, d, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("id_value"))
    return links.incremental(remote, local, working, sample=400)


@query("""
    WITH h AS (SELECT user_id AS id_value, ts, event_type = 'error' AS is_unlink FROM events WHERE event_type IN ('signup', 'error')),
    now AS (SELECT id_value, NOT arg_max(is_unlink, (ts, is_unlink)) AS is_linked FROM h GROUP BY 1),
    remote AS (SELECT DISTINCT user_id AS id_value FROM events WHERE user_id % 2 = 0 UNION SELECT DISTINCT user_id + 100000 FROM events WHERE user_id % 9 = 0)
    SELECT coalesce(r.id_value, n.id_value) AS id_value, CASE WHEN n.id_value IS NULL OR (r.id_value IS NOT NULL AND NOT is_linked) THEN true WHEN r.id_value IS NULL AND is_linked THEN false ELSE is_linked END AS is_linked
    FROM now n FULL JOIN remote r ON r.id_value = n.id_value
""")
def links_after_pass(spark: SparkSession, d: str) -> DataFrame:
    """A pass appends its link and unlink entries, and the current links follow from the whole history."""
    events = t(spark, d, "events")
    before = events.where(F.col("event_type").isin("signup", "error")).select(F.col("user_id").alias("id_value"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("is_unlink"))
    remote = events.where("user_id % 2 = 0").select(F.col("user_id").alias("id_value")).unionByName(events.where("user_id % 9 = 0").select((F.col("user_id") + 100000).alias("id_value")))
    added = links.link_entries(links.reconcile(remote, links.current(before, "id_value")), "2024-02-01")
    return links.current(before.unionByName(added), "id_value").select("id_value", "is_linked")


TYPES = [("p", 1), ("a", 2), ("div", 3), ("script", 4), ("footer", 5)]


@query(f"""
    WITH listed AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<([a-z0-9]+)', 1)) AS action FROM pages), types(action, action_id) AS (VALUES {', '.join(f"('{a}', {n})" for a, n in TYPES)})
    SELECT page_id, action, action_id FROM listed LEFT JOIN types USING (action)
""")
def page_actions(spark: SparkSession, d: str) -> DataFrame:
    """The actions that pages list with their stored types; those without a type come apart."""
    stored = spark.createDataFrame(TYPES, "action string, action_id int")
    known, unknown = changes.listed_actions(t(spark, d, "pages").select("page_id", "html"), "html", "<([a-z0-9]+)", stored)
    return known.select("page_id", "action", "action_id").unionByName(unknown.select("page_id", "action", F.lit(None).cast("int").alias("action_id")))


STEPS = ["a", "c", "d", "b"]


@query(f"""
    WITH {FOLDED_SQL},
    runs AS (SELECT DISTINCT run_id FROM log), plan AS (SELECT run_id, step, operation_id FROM runs, (VALUES {', '.join(f"({n}, '{x}')" for n, x in enumerate(STEPS))}) s(step, operation_id)),
    met AS (SELECT p.*, f.status FROM plan p LEFT JOIN folded f ON f.run_id = p.run_id AND f.operation_id = p.operation_id),
    first AS (SELECT run_id, min(step) AS step FROM met WHERE status IS DISTINCT FROM 'complete' GROUP BY 1)
    SELECT r.run_id, (SELECT count(*) FROM met m WHERE m.run_id = r.run_id AND m.status = 'complete') AS completed, m.operation_id, CASE WHEN m.run_id IS NULL THEN 'done' WHEN m.status IS NULL THEN 'start' WHEN m.status = 'failed' THEN 'retry' ELSE 'wait' END AS action
    FROM runs r LEFT JOIN first f ON f.run_id = r.run_id LEFT JOIN met m ON m.run_id = r.run_id AND m.step = f.step
""")
def chained_operations(spark: SparkSession, d: str) -> DataFrame:
    """Chains of four operations in every run, each after the one before."""
    events = log(spark, d)
    folded = attribution.operations(attribution.attempts(attribution.attributed(events)))
    plan = events.select("run_id").distinct().select("run_id", F.lit("chain").alias("chain_id"), F.posexplode(F.array(*map(F.lit, STEPS))).alias("step", "operation_id"))
    return attribution.chain_steps(plan, folded).select("run_id", "completed", "operation_id", "action")


@query(f"""
    WITH {FOLDED_SQL},
    plan AS (SELECT run_id, position, operation_id, CASE WHEN position % 3 = 0 THEN 'free' ELSE 'capped' END AS config FROM (SELECT DISTINCT run_id FROM log), (VALUES (0, 'a'), (1, 'b'), (2, 'c'), (3, 'd'), (4, 'e'), (5, 'f'), (6, 'g')) s(position, operation_id)),
    met AS (SELECT p.*, f.status FROM plan p LEFT JOIN folded f ON f.run_id = p.run_id AND f.operation_id = p.operation_id),
    turned AS (SELECT *, count(*) FILTER (WHERE status IN ('live', 'pending')) OVER (PARTITION BY run_id, config) AS live, count(*) FILTER (WHERE status IS NULL) OVER (PARTITION BY run_id, config ORDER BY position) AS turn FROM met)
    SELECT run_id, operation_id, CASE WHEN status IS NULL AND (config = 'free' OR live + turn <= 2) THEN 'start' WHEN status IS NULL THEN 'hold' WHEN status = 'failed' THEN 'retry' WHEN status = 'complete' THEN 'done' ELSE 'run' END AS action FROM turned
""")
def grouped_operations(spark: SparkSession, d: str) -> DataFrame:
    """Groups in parallel under a cap of two live operations."""
    events = log(spark, d)
    folded = attribution.operations(attribution.attempts(attribution.attributed(events)))
    plan = events.select("run_id").distinct().select("run_id", F.lit("group").alias("group_id"), F.posexplode(F.array(*map(F.lit, "abcdefg"))).alias("position", "operation_id"))
    plan = plan.withColumn("config", F.when(F.col("position") % 3 == 0, "free").otherwise("capped"))
    return attribution.group_starts(plan, folded, spark.createDataFrame([("capped", 2)], "config string, cap int")).select("run_id", "operation_id", "action")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def newest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The newest snapshot of a table."""
    return reading.newest(t(spark, d, "events"), "ts", "event_id").select("event_id", "user_id", "event_type")


@query("SELECT DISTINCT user_id AS operation_id, 'r0-' || user_id AS result FROM events WHERE event_type = 'purchase'")
def operation_results(spark: SparkSession, d: str) -> DataFrame:
    """The one distinct result of each operation's executions; two would be an error."""
    done = F.when(F.col("event_type") == "purchase", F.concat(F.lit("r0-"), F.col("user_id").cast("string")))
    return history.results(t(spark, d, "events").select(F.col("user_id").alias("operation_id"), done.alias("result")))


@query("SELECT epoch_us(date_trunc('hour', ts)) AS hour_us, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def stream_windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events of each hour in a stream with a watermark."""
    folder = new_folder(spark, "hours")
    stream = spark.readStream.schema(t(spark, d, "events").schema).parquet(f"{d}/events.parque[t]").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    flows.windowed_counts(stream, "ts", "event_type").writeStream.outputMode("complete").foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out")).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.unix_micros("window.start").alias("hour_us"), "event_type", "events")


MAPPINGS = {"default": {"Order": {"o_orderkey": {"name": "order_key"}, "o_orderpriority": {"name": "priority"}}}, "TPC": {"Order": {"o_orderkey": {"name": "id_value"}, "o_orderpriority": {"name": "rank"}}}}


@query("SELECT o_orderkey AS id_value, o_orderpriority AS rank, o_orderkey AS order_key, o_orderpriority AS priority FROM orders")
def chosen_mappings(spark: SparkSession, d: str) -> DataFrame:
    """A source's own mapping and, for another source, the default one."""
    rows = t(spark, d, "orders")
    own, other = (changes.mapped(rows, changes.choose_mapping(MAPPINGS, source, "Order")) for source in ("TPC", "elsewhere"))
    return own.join(other, F.col("id_value") == F.col("order_key"))


@query("SELECT n_regionkey AS ancestor, 1000 + n_nationkey AS descendant, 1 AS depth FROM nation UNION ALL SELECT 1000 + c_nationkey, 1000000 + c_custkey, 1 FROM customer UNION ALL SELECT n_regionkey, 1000000 + c_custkey, 2 FROM customer JOIN nation ON n_nationkey = c_nationkey")
def recursive_closure(spark: SparkSession, d: str) -> DataFrame:
    """The closure as one recursive query, for shallow hierarchies."""
    nations = t(spark, d, "nation").select(F.col("n_regionkey").cast("bigint").alias("parent"), (F.col("n_nationkey") + 1000).cast("bigint").alias("child"))
    people = t(spark, d, "customer").select((F.col("c_nationkey") + 1000).cast("bigint").alias("parent"), (F.col("c_custkey") + 1000000).alias("child"))
    nations.unionByName(people).createOrReplaceTempView("hierarchy_pairs")
    return reading.closure_sql(spark, "hierarchy_pairs", 4)


@query("""
    SELECT o_orderkey, '{"M":{"o_orderkey":{"N":"' || o_orderkey || '"},"o_orderpriority":' || CASE WHEN o_orderkey % 3 = 0 THEN '{"NULL":true}' ELSE '{"S":"' || o_orderpriority || '"}' END || ',"big":{"BOOL":' || (o_totalprice > 100000) || '},"keys":{"L":[{"N":"' || o_custkey || '"},{"N":"' || o_orderkey || '"}]}}}' AS typed,
           '{"big": ' || (o_totalprice > 100000) || ', "keys": [' || o_custkey || ', ' || o_orderkey || '], "o_orderkey": ' || o_orderkey || ', "o_orderpriority": ' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' AS plain
    FROM orders
""")
def typed_json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows to typed JSON and back to plain JSON."""
    value = F.struct("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), (F.col("o_totalprice") > 100000).alias("big"), F.array("o_custkey", "o_orderkey").alias("keys"))
    rows = t(spark, d, "orders").select("o_orderkey", value.alias("v"))
    typed = rows.select("o_orderkey", typed_json.encoded(F.col("v"), rows.schema["v"].dataType).alias("typed"))
    return typed.withColumn("plain", typed_json.plain_json("typed"))


REFERRED = '{"shared": {"key": {"name": "c_custkey", "kind": "Number", "is_id": true}, "all": [{"$ref": "#/shared/key"}, {"name": "c_name"}]}, "vertices": [{"name": "Customer", "properties": {"$ref": "#/shared/all"}, "id_key": ["object_type", "c_custkey"], "stem_key": ["c_name"], "indexes": [{"name": "names", "fields": ["c_name"]}]}], "edges": []}'


@query("SELECT CAST(c_custkey AS VARCHAR) AS id_value, c_name AS name, 'names' AS index FROM customer WHERE c_custkey <> 0")
def schema_with_references(spark: SparkSession, d: str) -> DataFrame:
    """A schema whose properties are references within its text, nested ones too."""
    schema = Schema.from_json(REFERRED)
    (index,) = indexes.declared(schema)
    found = vertices.build(t(spark, d, "customer"), schema.vertices["Customer"]).where("is_complete")
    return found.select(F.col("props")["c_custkey"].alias("id_value"), F.col("props")["c_name"].alias("name"), F.lit(index.name).alias("index"))


@query("""
    WITH e AS (SELECT * FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-20')
    SELECT 'productivity.encounters' AS search, user_id, value FROM e WHERE event_type = 'purchase' UNION ALL SELECT 'productivity.unapproved', user_id, value FROM e WHERE event_type = 'view'
    UNION ALL SELECT 'productivity.tx_plans', user_id, NULL FROM e WHERE event_type = 'signup' UNION ALL SELECT 'productivity.diagnostics', user_id, NULL FROM e WHERE event_type IN ('signup', 'view')
    UNION ALL SELECT 'productivity.emp_data', user_id, NULL FROM e WHERE event_type <> 'error' UNION ALL SELECT 'productivity.clients', user_id, NULL FROM e WHERE value >= 10
    UNION ALL SELECT 'payroll.encounters', user_id, value FROM e WHERE event_type = 'purchase' AND value > 20 UNION ALL SELECT 'payroll.rates', user_id, value FROM e WHERE event_type LIKE 'cl%'
    UNION ALL SELECT 'payroll.periods', user_id, NULL FROM e WHERE event_type = 'click' UNION ALL SELECT 'payroll.unapproved', user_id, NULL FROM e WHERE event_type = 'error' AND value < 500
""")
def report_search_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the ten searches of the reports' source sets."""
    searches = {name: {"source": source, "fields": fields, "conditions": conditions, **WINDOW} for name, (source, fields, conditions) in SEARCHES.items()}
    whole = None
    for name, rows in change_log.query_sets({"events": t(spark, d, "events")}, searches).items():
        part = rows.select(F.lit(name).alias("search"), "user_id", F.col("value") if "value" in rows.columns else F.lit(None).cast("double").alias("value"))
        whole = part if whole is None else whole.unionByName(part)
    return whole


@query("""
    WITH n AS (SELECT CAST(n_nationkey AS BIGINT) AS id_value, md5('TPCExternalId' || n_nationkey) AS e, md5('TPCChangeLogEntry' || n_nationkey) AS l, md5('TPCChange' || n_nationkey) AS c FROM nation WHERE n_nationkey <> 0)
    SELECT 'getExternalId' AS read, e AS internal_id, id_value FROM n WHERE id_value = 3
    UNION ALL SELECT 'listExternalIds', e, id_value FROM n
    UNION ALL SELECT 'getExternalIds', e, id_value FROM n WHERE id_value BETWEEN 5 AND 10
    UNION ALL SELECT 'pageExternalIds', e, id_value FROM (SELECT * FROM n ORDER BY id_value LIMIT 5 OFFSET 2)
    UNION ALL SELECT 'pageChangeLogEntries', l, id_value FROM (SELECT * FROM n ORDER BY id_value LIMIT 5 OFFSET 2)
    UNION ALL SELECT 'pageChangeDetails', c, id_value FROM (SELECT * FROM n ORDER BY id_value LIMIT 5 OFFSET 2)
    UNION ALL SELECT 'addExternalId', e, id_value FROM n UNION ALL SELECT 'addExternalId', l, id_value FROM n UNION ALL SELECT 'addExternalId', c, id_value FROM n UNION ALL SELECT 'addExternalId', md5('TPCOther' || id_value), id_value FROM n
    UNION ALL SELECT 'getExtIdMaxMin', 'max', max(id_value) FROM n UNION ALL SELECT 'getExtIdMaxMin', 'min', min(id_value) FROM n
""")
def named_read_rows(spark: SparkSession, d: str) -> DataFrame:
    """What reads and adds by name find among the nations, row by row."""
    kind = lambda name: t(spark, d, "nation").where("n_nationkey <> 0").select(F.lit("TPC").alias("id_source"), F.lit(name).alias("id_type"), F.lit("n_nationkey").alias("id_name"), F.col("n_nationkey").alias("id_value"))
    v = None
    for entry in (EXTERNAL, CHANGE, ENTRY):
        made = vertices.build(kind(entry.name), entry)
        v = made if v is None else v.unionByName(made)
    page = {"start": 2, "end": 7}
    one = v.where("object_type = 'ExternalId' and id_value = 3").first()["internal_id"]
    given = {"getExternalId": {"internal_id": one}, "listExternalIds": {}, "getExternalIds": {"low": 5, "high": 10}, "pageExternalIds": page, "pageChangeLogEntries": page, "pageChangeDetails": page, "addExternalId": {"new": vertices.build(kind("Other"), EXTERNAL)}}
    whole = None
    for name, arguments in given.items():
        part = reading.NAMED[name](v, v, **arguments).select(F.lit(name).alias("read"), "internal_id", F.col("id_value").cast("bigint").alias("id_value"))
        whole = part if whole is None else whole.unionByName(part)
    ends = reading.NAMED["getExtIdMaxMin"](v, v).select(F.explode(F.array(*(F.struct(F.lit(c).alias("internal_id"), F.col(c).cast("bigint").alias("id_value")) for c in ("max", "min")))).alias("x"))
    return whole.unionByName(ends.select(F.lit("getExtIdMaxMin").alias("read"), "x.*"))
