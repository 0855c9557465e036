import base64
import gzip
import json

from pyspark.sql import functions as F

from graphloom.plans import reports
from graphloom.sources import readers
from graphloom.streaming import flows


def test_csv_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,Rate,Check Date\n1,2.50,3/1/2019\n2,,"1/2/2019 3:04:05 PM"\n')
    rows = readers.csv_rows(spark, str(path), {"id": "number", "Rate": "number", "Check Date": "datetime"}).collect()
    assert [r["Rate"] is None for r in rows] == [False, True] and rows[1]["Check Date"].hour == 15


def test_xml_header():
    header = '<xs:sequence><xs:sequence><xs:element name="max" type="xs:short"/><xs:element name="when" type="xs:dateTime"/></xs:sequence></xs:sequence>'
    assert readers.xml_schema(header) == {"max": "short", "when": "dateTime"}


def test_change_page(spark):
    rows = "".join(f"<tr><td>A{i}</td><td>old {i}</td><td><b>new</b></td></tr>" for i in range(6))
    found = readers.change_details(spark.createDataFrame([(1, f"<table>{rows}</table>")], "page int, html string"), "html").collect()
    assert [tuple(r) for r in found] == [(1, "a4", "old 4", "new"), (1, "a5", "old 5", "new")]


def test_log_records(spark):
    def packed(x):
        return base64.b64encode(gzip.compress(json.dumps(x).encode())).decode()

    records = [("a", packed({"messageType": "DATA_MESSAGE", "logGroup": "g", "logEvents": [{"id": "1", "timestamp": 5, "message": "m"}, {"id": "2", "timestamp": 6, "message": "n"}]})), ("b", packed({"messageType": "CONTROL_MESSAGE"})), ("c", "!!"), ("d", None)]
    found = sorted((r["record_id"], r["result"], r["message"]) for r in readers.log_records(spark.createDataFrame(records, "record_id string, data string")).collect() if r["record_id"] != "d")
    assert [x[1] for x in found] == ["ok", "ok", "dropped", "failed"]


def test_spill_and_sheets(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a"])], "a int, b array<string>")
    pointer = readers.spill(rows, str(tmp_path / "x"))
    assert readers.unspill(spark, pointer).count() == 1
    paths = readers.write_sheets({"30, 60, 90": rows}, str(tmp_path / "book"))
    assert spark.read.csv(paths["30, 60, 90"], header=True).first()["b"] == '["a"]'


def test_small_readers(spark):
    rows = spark.createDataFrame([("p#1", 1), ("p#1", 2), ("q", 3)], "k string, n int")
    assert readers.by_prefix(rows, "k", "p#", "k").count() == 1 and readers.keyed_last(rows, "k", "n").count() == 2
    assert readers.min_max(rows, "n").first().asDict() == {"min": 1, "max": 3}
    assert rows.select(readers.pair_map(F.array(F.lit("a"), F.lit("b")))).first()[0] == {"a": "b"}
    assert readers.link_ids(spark.createDataFrame([("<a href='x?id=7'><a href='x?id=9'>",)], "html string"), "html", r"id=(\d+)").first().asDict() == {"min": 7, "max": 9}


def test_reports(spark):
    employees = spark.createDataFrame([(1, "One, Ann", "Boss X", "CSW"), (2, "Two, Bob", None, "CSW")], "emp_id long, emp_name string, supervisors string, profile_code string")
    teams = reports.clinical_teams(employees, "CSW", {}, [("Boss", "alpha")], "none")
    clients = spark.createDataFrame([(10, "A One (CSW)"), (11, "Z Nobody")], "client_id long, primary_staff string")
    placed, unplaced = reports.caseloads(clients, teams)
    assert [tuple(r) for r in placed.collect()] == [(10, "alpha", "One, Ann", 1)] and [r["client_id"] for r in unplaced.collect()] == [11]
    assert reports.incomplete(clients, placed, unplaced).count() == 0
    day = spark.createDataFrame([(1, "2020-01-02 00:59:00", "2020-01-03 00:00:00")], "i int, a string, b string")
    assert day.select(reports.hours_between(F.col("b"), F.col("a"))).first()[0] == 23
    assert reports.populate({"default": {"q": [1]}, "p": {"q": [2]}}, "p") == {"q": [1, 2]}


def test_first_wins_sink(spark, tmp_path):
    write = flows.first_wins_sink(str(tmp_path / "out"), "k")
    first, second = (spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]))
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "a"), (2, "b"), (3, "d")]


def test_first_wins_sink_reads_its_own_buckets(spark, tmp_path):
    write = flows.first_wins_sink(str(tmp_path / "out"), "k", order="at", buckets=8)
    table = lambda rows: spark.createDataFrame(rows, "k int, v string, at int")
    write(table([(k, "first", 2) for k in range(40)] + [(k, "earlier", 1) for k in range(20)]), 0)
    write(table([(3, "late", 0), (100, "new", 0)]), 1)
    found = {r["k"]: r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {k: "earlier" if k < 20 else "first" for k in range(40)} | {100: "new"}
    assert len(list((tmp_path / "out").glob("bucket=*/batch_id=1"))) == 1
    before = sorted(p.name for p in (tmp_path / "out").rglob("*.parquet"))
    write(table([(5, "again", 0)]), 2)
    assert sorted(p.name for p in (tmp_path / "out").rglob("*.parquet")) == before  # nothing new, nothing written


def test_windowed_counts(spark, tmp_path):
    rows = spark.sql("select timestamp '2020-01-01 00:10:00' as ts, 'x' as kind union all select timestamp '2020-01-01 00:20:00', 'x' union all select timestamp '2020-01-01 01:20:00', 'x'")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    found = []
    flows.windowed_counts(stream, "ts", "kind").writeStream.outputMode("complete").foreachBatch(lambda b, _: found.extend(r["events"] for r in b.collect())).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(found)[-2:] == [1, 2]


def test_destinations(spark):
    seen = {}
    write = flows.by_destination({"a": lambda b: seen.update(a=b.count()), "b": lambda b: seen.update(b=b.count())})
    write(spark.createDataFrame([("a",), ("a",), ("c",)], "destination string"), 0)
    assert seen == {"a": 2, "b": 0}
