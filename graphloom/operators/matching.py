"""Joins with a checked number of matches, ordered first matches and exploded name lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matched_once(left: DataFrame, right: DataFrame, on: Column, left_key: str, right_key: str) -> DataFrame:
    """left with matches (number of distinct right keys), matched (that key if there is exactly one) and outcome: unique, missing or duplicate. Use an equality in `on` where there is one, so that the join is no nested loop."""
    counted = left.join(right, on, "left").groupBy(left[left_key].alias(left_key)).agg(F.count_distinct(right[right_key]).alias("matches"), F.min(right[right_key]).alias("_one"))
    outcome = F.when(F.col("matches") == 1, "unique").when(F.col("matches") == 0, "missing").otherwise("duplicate")
    return counted.select(left_key, "matches", F.when(F.col("matches") == 1, F.col("_one")).alias("matched"), outcome.alias("outcome"))


def patient_match(records: DataFrame, clients: DataFrame, gram: int = 5, unnumbered: bool = False) -> DataFrame:
    """Records (record_id, medicaid, first_name, last_name) to clients (client_id, ...): with a medicaid number, the client's contains it and last or first name are equal without case; without one, both names are equal.
    unnumbered: clients without a number are found by both names too, whatever the record's number is.

    Clients are grouped by number and names first, and asked once for each number and names that records have. A number is looked up by equality on one of its
    pieces of `gram` characters, in its middle, beside the name, so a frequent name costs only the numbers that share the piece; the substring is tested then. Numbers
    shorter than a piece meet all numbers of their name. Clients with both names equal are met by the last name alone. Ids that come
    with several names or numbers are told apart from others with the same ones: their matches are counted as ids, once.
    """
    low = lambda c: F.lower(F.col(c))
    whole = lambda *c: F.to_json(F.array(*(F.coalesce(F.concat(F.lit("="), x), F.lit("")) for x in c)))
    r = _with_oddness(records.select("record_id", "medicaid", low("first_name").alias("rf"), low("last_name").alias("rl")), "record_id", whole("medicaid", "rf", "rl"))
    c = _with_oddness(clients.select("client_id", F.col("medicaid").alias("cm"), low("first_name").alias("cf"), low("last_name").alias("cl")).where("client_id is not null"), "client_id", whole("cm", "cf", "cl"))
    groups = c.groupBy("client_id", "_what", "_odd").agg(*(F.first(x).alias(x) for x in ("cm", "cf", "cl"))).groupBy("_what", F.when(F.col("_odd"), F.col("client_id")).alias("_client")).agg(*(F.first(x).alias(x) for x in ("cm", "cf", "cl")), F.count("*").alias("_n"), F.min("client_id").alias("_id"))
    key = lambda tag, piece, *names: F.struct(F.lit(tag).alias("tag"), piece.alias("piece"), whole(*names).alias("name"))
    none = F.lit("")
    pieces = F.array_distinct(F.concat(F.array(none), F.when(F.length("cm") >= gram, F.transform(F.sequence(F.lit(1), F.length("cm") - (gram - 1)), lambda i: F.col("cm").substr(i, F.lit(gram)))).otherwise(F.array().cast("array<string>"))))
    by_name = lambda tag, name: F.when(F.col("cm").isNotNull() & F.col(name).isNotNull(), F.transform(pieces, lambda p: key(tag, p, F.col(name))))
    bare = F.array(key("b", none, F.col("cf"), F.col("cl"))), F.array(key("b", none, F.col("cf"), F.col("cl")), key("n", none, F.col("cf"), F.col("cl")))
    both = F.when(F.col("cf").isNotNull() & F.col("cl").isNotNull(), F.when(F.col("cm").isNull(), bare[1]).otherwise(bare[0]))
    held = groups.withColumn("_k", F.explode(F.flatten(F.array_compact(F.array(by_name("l", "cl"), by_name("f", "cf"), both))))).select("*", "_k.*").drop("_k")

    numbered = F.coalesce(F.length("medicaid") > 0, F.lit(False))
    middle = F.floor((F.length("medicaid") - gram) / 2).cast("int") + 1
    piece = F.when(F.length("medicaid") >= gram, F.col("medicaid").substr(middle, F.lit(gram))).otherwise(none)
    wanted = F.when(numbered, F.array(key("l", piece, F.col("rl")), key("f", piece, F.col("rf")), *([key("n", none, F.col("rf"), F.col("rl"))] if unnumbered else []))).otherwise(F.array(key("b", none, F.col("rf"), F.col("rl"))))
    r = r.withColumn("_ask", F.when(F.col("_odd"), F.concat(F.lit("id"), F.col("record_id").cast("string"))).otherwise(F.col("_what")))
    asked = r.select("_ask", "medicaid", "rf", "rl").distinct().withColumn("_k", F.explode(wanted)).select("*", "_k.*").drop("_k")
    met = asked.join(held, ["tag", "piece", "name"]).where(F.col("tag").isin("b", "n") | F.col("cm").contains(F.col("medicaid"))).where((F.col("tag") != "f") | ~F.col("cl").eqNullSafe(F.col("rl")) | F.col("cl").isNull())
    pairs = met.groupBy("_ask", "_what", "_client").agg(F.min("_n").alias("_n"), F.min("_id").alias("_id"))
    each = pairs.groupBy("_ask", "_client").agg(F.sum("_n").alias("_n"), F.min("_id").alias("_id"))
    counted = each.groupBy("_ask").agg(F.sum(F.when(F.col("_client").isNull(), F.col("_n")).otherwise(1)).alias("matches"), F.min("_id").alias("_one"))
    found = r.select("record_id", "_ask").join(counted, "_ask", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    outcome = F.when(F.col("matches") == 1, "unique").when(F.col("matches") == 0, "missing").otherwise("duplicate")
    return found.select("record_id", "matches", F.when(F.col("matches") == 1, F.col("_one")).alias("client_id"), outcome.alias("outcome"))


def _with_oddness(rows: DataFrame, key: str, what: Column) -> DataFrame:
    """rows with `_what` and whether their key comes with several of it."""
    each = rows.withColumn("_what", what)
    ends = each.groupBy(F.col(key).alias("_key")).agg((F.min("_what") != F.max("_what")).alias("_odd"))
    return each.join(ends, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def team_of(key: Column, text: Column, manual: dict[str, str], first_level: list[tuple[str, str]], default: str) -> Column:
    """A team by hand, else that of the first supervisor whose name the text contains, else the default."""
    by_hand = F.lit(None).cast("string")
    for k, team in manual.items():
        by_hand = F.when(key == k, team).otherwise(by_hand)
    listed = F.lit(None).cast("string")
    for name, team in reversed(first_level):
        listed = F.when(text.contains(name), team).otherwise(listed)
    return F.coalesce(by_hand, listed, F.lit(default))


def by_names(rows: DataFrame, names: str, people: DataFrame, name: str, person: str) -> tuple[DataFrame, DataFrame]:
    """(rows exploded by their list of names with the person, rows' names that nobody has). Of people with one name the largest id counts."""
    one = people.groupBy(name).agg(F.max(person).alias(person))
    each = rows.withColumn(name, F.explode(names)).drop(names)
    return each.join(one, name), each.join(one, name, "left_anti")


def both_ways(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys of one side alone; empty if both have the same."""
    return left.select(key).distinct().join(right.select(key).distinct().withColumnRenamed(key, "_k"), F.col(key) == F.col("_k"), "full").where(f"`{key}` is null or _k is null").select(F.coalesce(key, "_k").alias(key), F.when(F.col("_k").isNull(), "left").otherwise("right").alias("side"))

