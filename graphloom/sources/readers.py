"""Sources and sinks over files: parameterised SQL sets, CSV, XML, JSON, HTML pages, log records, static assets, searches."""

from __future__ import annotations

import gzip
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from graphloom.functions.types import csv_value, xml_value
from graphloom.registry import sources


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@sources("sql_set")
def sql_set(spark: SparkSession, queries: dict[str, str], **identifiers: object) -> dict[str, DataFrame]:
    """One table per named query; identifiers are bound as parameters, never formatted into the text."""
    return {name: spark.sql(text, args={k: v for k, v in identifiers.items() if f":{k}" in text}) for name, text in queries.items()}


@sources("min_max")
def min_max(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def xml_schema(header: str) -> dict[str, str]:
    """Column types of an XSD header, in order: its last sequence's elements."""
    inner = header.rsplit("<xs:sequence>", 1)[-1]
    return {name: kind.removeprefix("xs:") for name, kind in re.findall(r'<xs:element name="([^"]+)" type="([^"]+)"', inner)}


@sources("xml")
def xml_rows(documents: DataFrame, column: str, kinds: dict[str, str], row_tag: str = "Table1") -> DataFrame:
    """Rows of XML texts: each row element becomes typed columns; absent text is ''."""
    schema = f"{row_tag} array<struct<{', '.join(f'`{k}`:string' for k in kinds)}>>"
    parsed = documents.withColumn("_rows", F.explode(F.from_xml(F.col(column), schema)[row_tag]))
    keep = [c for c in documents.columns if c != column]
    return parsed.select(*keep, *(xml_value(F.col(f"_rows.{k}"), kind).alias(k) for k, kind in kinds.items()))


@sources("csv")
def csv_rows(spark: SparkSession, path: str, kinds: dict[str, str]) -> DataFrame:
    """A CSV with a header, typed by column; a row with too many cells is an error."""
    text = spark.read.csv(path, header=True, mode="FAILFAST", schema=", ".join(f"`{c}` string" for c in kinds), enforceSchema=False, multiLine=True, escape='"')
    return text.select(*(csv_value(F.col(f"`{c}`"), kind).alias(c) for c, kind in kinds.items()))


def csv_texts(rows: DataFrame, column: str, kinds: dict[str, str]) -> DataFrame:
    """Typed columns of one CSV line per row."""
    parsed = rows.withColumn("_c", F.from_csv(F.col(column), ", ".join(f"`{c}` string" for c in kinds), {"mode": "PERMISSIVE"}))
    return parsed.select(*[c for c in rows.columns if c != column], *(csv_value(F.col(f"_c.`{c}`"), kind).alias(c) for c, kind in kinds.items()))


def keyed_last(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Per key its last row by file order."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def multimap(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Per key all its rows as an array ordered by `order`: for sources of bounded groups, such as reports by an id."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in rows.columns if c not in (key, order)]))).alias("rows"))


def flattened(keyed: DataFrame, key: str) -> DataFrame:
    return keyed.select(key, F.explode("rows").alias("_r")).select(key, "_r.*")


OPERATORS = {"=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "like": lambda c, v: c.like(v), "in": lambda c, v: c.isin(*v)}


@sources("search")
def search(rows: DataFrame, fields: list[str], conditions: list[tuple[str, str, object]], date: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """A projection of the rows that meet all conditions and lie in a date range: pushed into the scan."""
    on: Column = F.lit(True)
    for name, operator, value in conditions:
        on = on & OPERATORS[operator](F.col(name), value)
    for bound, operator in ((start, ">="), (end, "<=")):
        if date and bound:
            on = on & OPERATORS[operator](F.col(date), F.lit(bound).cast("timestamp"))
    return rows.where(on).select(*fields)


def by_prefix(rows: DataFrame, key: str, prefix: str, *distinct: str) -> DataFrame:
    """Rows whose sort key begins so, once per distinct key."""
    found = rows.where(F.col(key).startswith(prefix))
    return found.dropDuplicates(list(distinct)) if distinct else found


def link_ids(pages: DataFrame, html: str, pattern: str) -> DataFrame:
    """min and max of the numbers that a pattern finds in pages' links."""
    found = pages.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("id"))
    return found.select(F.col("id").try_cast("bigint").alias("id")).agg(F.min("id").alias("min"), F.max("id").alias("max"))


def table_cells(pages: DataFrame, html: str, skip: int = 0) -> DataFrame:
    """(…, row_no, cells) of the HTML table rows after the first `skip`."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    each = pages.select(*[c for c in pages.columns if c != html], F.posexplode(rows).alias("row_no", "_row")).where(F.col("row_no") >= skip)
    cells = F.transform(F.regexp_extract_all(F.col("_row"), F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(x, r"<[^>]*>", "")))
    return each.select(*[c for c in each.columns if c != "_row"], cells.alias("cells"))


def change_details(pages: DataFrame, html: str) -> DataFrame:
    """(id_name, old_value, new_value) of a change page's rows after the fourth."""
    rows = table_cells(pages, html, skip=4).where(F.size("cells") >= 3)
    return rows.select(*[c for c in rows.columns if c not in ("cells", "row_no")], F.lower(F.col("cells")[0]).alias("id_name"), F.col("cells")[1].alias("old_value"), F.col("cells")[2].alias("new_value"))


@F.pandas_udf(StringType())
def gunzipped(data: pd.Series) -> pd.Series:
    def one(x: bytes | None) -> str | None:
        try:
            return None if x is None else gzip.decompress(x).decode()
        except (OSError, EOFError, ValueError):
            return None

    return data.map(one)


def log_records(records: DataFrame) -> DataFrame:
    """Records (record_id, data base64 of gzipped JSON): result ok with a row per log event, dropped for control messages, failed for all else."""
    body = F.from_json(gunzipped(F.try_to_binary("data", F.lit("base64"))), "messageType string, logGroup string, logEvents array<struct<id:string,timestamp:bigint,message:string>>")
    parsed = records.withColumn("_b", body)
    kind = F.when(F.col("_b.messageType") == "CONTROL_MESSAGE", "dropped").when(F.col("_b.messageType") == "DATA_MESSAGE", "ok").otherwise("failed")
    rows = parsed.select("record_id", kind.alias("result"), F.col("_b.logGroup").alias("log_group"), F.explode_outer(F.when(kind == "ok", F.col("_b.logEvents"))).alias("_e"))
    return rows.select("record_id", "result", "log_group", "_e.id", "_e.timestamp", "_e.message")


def put_batches(data: DataFrame, order: str, size: str, by: str, most_bytes: int = 6_000_000, most_rows: int = 500, stretch: int = 100_000) -> DataFrame:
    """Rows with the number of the batch that takes them: running bytes and rows within each `by` shard, whichever fills first.

    The running sums are made in stretches of the order (numbers or times; other orders are one stretch), whose own sums are
    added up first, so a shard that holds most rows is many tasks.
    """
    value = F.coalesce(F.col(order).try_cast("double"), F.lit(0.0)) if data.schema[order].dataType.typeName() != "timestamp" else F.unix_micros(order).cast("double")
    low, high, rows = data.agg(F.min(value), F.max(value), F.count("*")).first()
    stretches = max(1, -(-rows // stretch))
    width = ((high - low) / stretches or 1.0) if rows else 1.0
    dealt = data.withColumn("_stretch", F.floor((value - F.lit(low or 0.0)) / F.lit(width)).cast("long"))
    before = Window.partitionBy(by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    sums = dealt.groupBy(by, "_stretch").agg(F.sum(size).alias("_b"), F.count("*").alias("_n")).select(by, "_stretch", zero("_b").alias("_bytes"), zero("_n").alias("_rows"))
    place = Window.partitionBy(by, "_stretch").orderBy(order)
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    own = dealt.withColumn("_sum", F.sum(size).over(upto) - F.col(size)).withColumn("_at", F.row_number().over(place) - 1)
    batch = F.greatest(F.floor((F.col("_sum") + F.col("_bytes")) / most_bytes), F.floor((F.col("_at") + F.col("_rows")) / most_rows)).cast("int")
    return own.join(sums.hint("shuffle_merge"), [by, "_stretch"]).withColumn("batch", batch).select(*data.columns, "batch")


def static_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def static_image(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.base64("content").alias("content"))


def latest_versions(entries: DataFrame, key: str = "entry_name", version: str = "version") -> DataFrame:
    """Per entry its newest version."""
    return keyed_last(entries, key, version)


def write_sheets(sheets: dict[str, DataFrame], folder: str, title: str = "") -> dict[str, str]:
    """A report as one folder of CSV files per sheet, written by the executors; the paths. With a title each sheet gets a folder beside it with the title and how many columns it spans."""
    paths = {}
    for name, rows in sheets.items():
        if title:
            spark = rows.sparkSession
            spark.createDataFrame([(title, name, len(rows.columns))], "title string, sheet string, columns int").write.mode("errorifexists").csv(f"{folder}/{re.sub(r'[^A-Za-z0-9]+', '_', name)}_title", header=True)
        paths[name] = f"{folder}/{re.sub(r'[^A-Za-z0-9]+', '_', name)}"
        text = rows.select(*(F.to_json(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f"`{f.name}`") for f in rows.schema))
        text.write.mode("errorifexists").csv(paths[name], header=True)
    return paths


def spill(rows: DataFrame, path: str) -> str:
    """Store once: a second write of the same path is an error; the pointer is the path."""
    rows.write.mode("errorifexists").parquet(path)
    return json.dumps({"pointer": path})


def unspill(spark: SparkSession, pointer: str) -> DataFrame:
    return spark.read.parquet(json.loads(pointer)["pointer"])


def typed_json(text: Column) -> Column:
    """A variant of typed JSON ({"S": ..}, {"N": ..}, {"BOOL": ..}); read members with variant_get."""
    return F.try_parse_json(text)


def pair_map(values: Column) -> Column:
    """A map of an alternating list: key, value, key, value."""
    return F.map_from_arrays(F.filter(values, lambda _, i: i % 2 == 0), F.filter(values, lambda _, i: i % 2 == 1))

