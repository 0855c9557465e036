import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphloom.operators import reading, shaping
from graphloom.plans import change_log
from graphloom.schema import Schema, SchemaError, with_references
from graphloom.sources.typed_json import encoded, plain, plain_json


def test_typed_json(spark):
    item = {"id": {"S": "x"}, "n": {"N": "5"}, "f": {"N": "2.5"}, "ok": {"BOOL": True}, "no": {"NULL": True}, "m": {"M": {"a": {"L": [{"S": "q"}]}}}, "s": {"SS": ["a", "b"]}}
    assert plain(item) == {"id": "x", "n": 5, "f": 2.5, "ok": True, "no": None, "m": {"a": ["q"]}, "s": ["a", "b"]}
    graph = {"@type": "g:Map", "@value": ["k", {"@type": "g:List", "@value": [{"@type": "g:Int32", "@value": 3}]}]}
    assert plain(graph) == {"k": [3]} and plain({"_alg_class": "set", "value": [1]}) == [1]
    rows = spark.createDataFrame([(json.dumps(item),), ("no json",), (None,), ('{"@type": "g:Odd", "@value": 1}',)], "x string")
    found = [r[0] for r in rows.select(plain_json("x")).collect()]
    assert json.loads(found[0])["n"] == 5 and found[1:] == [None, None, None]


def test_shapes(spark):
    rows = spark.createDataFrame([({"a": "", "b": "x"}, {"a": "1"}, {"a": "2", "c": "3"})], "props map<string,string>, l map<string,string>, r map<string,string>")
    r = rows.select(shaping.clean_properties(F.col("props")).alias("c"), shaping.extraction_profile(F.col("l"), F.col("r")).alias("p")).first()
    assert r["c"] == {"a": None, "b": "x"} and r["p"] == {"a": "2", "c": "3"}
    many = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (1, "a", "z")], "k int, name string, value string")
    assert shaping.potentials(many, "k", "name", "value").first()["potentials"] == {"a": "z", "b": "y"}
    assert json.loads(shaping.shaped(many.limit(1), "k", "name").first()["object"]) == {"k": 1, "name": "a"}
    assert shaping.task_arguments(many, "name", "value").count() == 2
    with pytest.raises(PySparkException):
        shaping.one_of_each(many, "name", "value").collect()
    assert spark.range(1).select(shaping.branch_level(F.lit(125), F.lit(5))).first()[0] == 3


def test_merges(spark):
    rows = spark.createDataFrame([(1, "a", ["x"], 1), (1, None, ["y"], 2), (1, "b", None, 3), (2, None, None, 1)], "k int, s string, l array<string>, seq int")
    found = {r["k"]: (r["s"], r["l"]) for r in shaping.merge_enrichments(rows, "k", ("s",), ("l",), "seq").collect()}
    assert found == {1: ("b", ["x", "y"]), 2: (None, [])}
    both = shaping.merge_histories([rows.select("k", "s", "seq"), rows.select("k", F.lit("new").alias("s"), (F.col("seq") + 5).alias("seq"))], "seq", "k")
    assert {r["s"] for r in both.collect()} == {"new"}


def test_recipients(spark):
    people = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A")], "emp_id long, team string")
    above = reading.closure(spark.createDataFrame([(9, 1), (8, 9)], "parent long, child long"))
    assert {r[0] for r in shaping.recipients(people, "team", ["A"]).collect()} == {1, 3}
    assert {r[0] for r in shaping.recipients(people, "team", ["A"], above).collect()} == {1, 3, 8, 9}


def test_change_log_growth(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id_value long")
    known = spark.createDataFrame([(1, True), (2, False)], "id_value long, is_linked boolean")
    categories = spark.createDataFrame([("Clients",)], "category string")
    log = spark.createDataFrame([(2, "1/2/2019", "ADD", "Ann (7)"), (3, "1/3/2019", "ADD", ""), (1, "1/2/2019", "ADD", "Bob (8)"), (3, "1/3/2019", "DEL", "")], "id_value long, Date string, Action string, Consumer string")
    mapping = {"Date": {"name": "change_date_utc", "mutation": "convert_datetime_utc"}, "Action": {"name": "action"}, "Consumer": {"name": "client_id", "mutation": "get_client_id"}}
    types = spark.createDataFrame([("ADD", 1, "Clients"), ("DEL", 2, "Other")], "action string, action_id long, category string")
    moment = F.to_timestamp(F.lit("2019-01-02")).alias("change_date_utc")
    emp = spark.range(1).select(moment, F.lit(77).cast("bigint").alias("emp_id"))
    detail = spark.range(1).select(moment, F.lit(9).cast("bigint").alias("changelog_id"))
    more = spark.range(1).select(F.lit(9).cast("bigint").alias("changelog_id"), F.lit("").alias("clientvisit_id"), F.lit("5").alias("record_id"), F.lit("").alias("record_type"))
    grown = change_log.grow(ids(2, 3), known, categories, log, emp, detail, more, types, mapping, "2020-01-01")
    assert {tuple(r) for r in grown.outcomes.collect()} == {(1, "unlink"), (2, "link"), (3, "new")}
    assert sorted((r["id_value"], r["emp_id"]) for r in grown.changes.collect()) == [(2, 77), (3, 3)]
    targets = {(r["id_type"], r["client_id"]) for r in grown.targets.collect()}
    assert ("Clients", "7") in targets and grown.entries.where("is_unlink").count() == 1 and grown.propagated.count() == 2
    sets = change_log.query_sets({"log": log}, {"adds": {"source": "log", "fields": ["id_value"], "conditions": [("Action", "=", "ADD")]}})
    assert sets["adds"].count() == 3


def test_schema_references():
    text = '{"p": {"id": {"name": "k", "kind": "Number", "is_id": true}}, "vertices": [{"name": "A", "properties": [{"$ref": "#/p/id"}], "id_key": ["k"], "stem_key": []}], "edges": [{"label": "_e_", "indexes": [{"name": "i", "fields": ["src_id"], "unique": false}]}]}'
    found = Schema.from_json(text)
    assert found["A"].id_property.name == "k" and found["_e_"].indexes[0].unique is False
    assert with_references({"a~/b": [{"x": 1}], "r": {"$ref": "#/a~0~1b/0"}})["r"] == {"x": 1}
    for bad in ({"r": {"$ref": "#/none"}}, {"r": {"$ref": "#/r"}}, {"r": {"$ref": "other.json"}}, {"a": {"b": {"$ref": "#/a"}}}):
        with pytest.raises(SchemaError):
            with_references(bad)


def test_typed_json_encoding(spark):
    rows = spark.sql("select struct(1 as n, 1.50 as d, 'x' as s, true as b, null as z, array('a', null) as l, map('k', struct(2L as m)) as o) as v union all select null")
    made = rows.select(encoded(F.col("v"), rows.schema["v"].dataType).alias("t")).withColumn("p", plain_json("t")).collect()
    plain = [json.loads(r["p"]) for r in made]
    assert plain == [{"n": 1, "d": 1.5, "s": "x", "b": True, "z": None, "l": ["a", None], "o": {"k": {"m": 2}}}, None]
    assert json.loads(made[0]["t"])["M"]["l"] == {"L": [{"S": "a"}, {"NULL": True}]}
