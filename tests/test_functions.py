from pyspark.sql import functions as F

from graphloom.functions import ids, text, types


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_golden_ids(spark):
    """Recorded ids."""
    golden = {("MBI", "Employees", "3889"): "ff9ccecb77051747a9ff6cc4169de27d", ("MBI", "Change", "177", "1230"): "7b4043d1fe270c1ed1f032f8ec31e899", ("MBI", "ChangeLogEntry", "177"): "c5bf540a3fb43491ad13e446cb9c3757", ("MBI", "Employees", "3883"): "84a3b5c37a72a389a9c6bf401b5dd7b5", ("MBI", "ChangeLogEntry", "8813"): "190237dff8ed7eee76a1cdd467af5837", ("MBI", "Change", "8813", "1482"): "b89431ac59174cdc38f3ceee61a4cdc9"}
    for keys, expected in golden.items():
        assert one(spark, ids.internal_id(*map(F.lit, keys))) == expected
    assert one(spark, ids.secret_token(F.lit("7b4043d1fe270c1ed1f032f8ec31e899"), "String")) == "e7b0192b71294db66f1ac4e0a9b36bff"
    assert one(spark, ids.secret_token(F.lit("b89431ac59174cdc38f3ceee61a4cdc9"), "String")) == "4a7e6efa625a9e63eaa86396dfbde1b7"


def test_stems(spark):
    stem = ids.identifier_stem("TestVertex", {"property_1": F.lit(1), "property_2": F.lit("squids")}, {"property_2"})
    assert one(spark, stem) == '#vertex#TestVertex#{"property_1": 1, "property_2": "squids"}#'
    stub = ids.identifier_stem("TestVertex", {"a": F.lit(None).cast("string")})
    assert one(spark, stub) == '#vertex#TestVertex::stub#{"a": null}#'
    assert one(spark, ids.is_stub(stub)) and one(spark, ids.stem_type(stub)) == "TestVertex::stub"
    quoted = ids.identifier_stem("T", {"a": F.lit('x"y#\\')})
    assert one(spark, ids.stem_pairs(quoted)) == {"a": 'x"y#\\'}


def test_edge_ids_swap(spark):
    a, b, label = F.lit("a"), F.lit("b"), F.lit("_x_")
    assert one(spark, ids.edge_id(a, label, b, inbound=F.lit(True))) == one(spark, ids.edge_id(b, label, a))


def test_canonical_numbers(spark):
    for given, expected in (("1941.000000", "1941"), ("2.500000", "2.5"), ("100", "100"), ("0.000000", "0")):
        assert one(spark, types.canonical(F.lit(given))) == expected


def test_falsy_is_null(spark):
    assert one(spark, types.to_property(F.lit(0), "Number")) is None
    assert one(spark, types.to_property(F.lit(""), "String")) is None
    assert one(spark, types.to_property(F.lit("false"), "Boolean")) is False
    assert one(spark, types.to_property(F.lit("no number"), "Number")) is None


def test_split_entry(spark):
    cases = {"Name (123)": ("123", "Name"), "123 (Type)": ("123", "Type"), "Foo (Bar)": ("Bar", "Foo"), "77": ("77", None), "words": ("words", None), "": ("", None)}
    for given, expected in cases.items():
        assert tuple(one(spark, text.split_entry(F.lit(given)))) == expected, given


def test_names_and_money(spark):
    assert one(spark, text.person_name(F.lit("Ölund, Åsa B"))) == "Å Ölund"
    assert tuple(one(spark, text.split_name(F.lit("Last, First")))) == ("First", "Last")
    assert tuple(one(spark, text.split_name(F.lit("First Last")))) == ("First", "Last")
    assert tuple(one(spark, text.split_name(F.lit("only")))) == (None, None)
    assert float(one(spark, text.money(F.lit("$1,234.50")))) == 1234.5 and one(spark, text.money(F.lit("none"))) is None
    assert one(spark, text.staff_names(F.lit("A One (CSW), B Two"))) == ["A One", "B Two"]
    assert one(spark, text.clean(F.lit(" \r\n "))) is None


def test_dates(spark):
    assert one(spark, types.graph_time(types.source_time(F.lit("3/1/2019 1:02:03 PM")))) == "2019-03-01T13:02:03+0000"
    assert one(spark, types.graph_time(types.source_time(F.lit("3/1/2019")))) == "2019-03-01T00:00:00+0000"
    assert one(spark, types.source_time(F.lit("soon"))) is None
    assert one(spark, types.filter_date(F.lit(None).cast("timestamp"), "2020-01-01")) == "01/03/2010"


def test_links(spark):
    entry = one(spark, ids.link_entry(F.lit("2020-01-01").cast("timestamp"), F.lit(True)))
    assert entry == "1577836800!unlink"
    parsed = one(spark, ids.parse_link_entry(F.lit(entry)))
    assert parsed["is_unlink"] and parsed["ts"].year == 2020


def test_xml_values(spark):
    assert one(spark, types.xml_value(F.lit(None).cast("string"), "string")) == ""
    assert len(one(spark, types.xml_value(F.lit("x" * 50_000), "string"))) == 45_000
    assert one(spark, types.xml_value(F.lit("<b>hi</b>"), "string")) == "hi"
    assert one(spark, types.xml_value(F.lit("true"), "boolean")) is True
