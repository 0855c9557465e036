"""URL filters by dated lists: an as-of join of captures with list entries.

A list is a table of dated entries (pattern, listed_at, action): from listed_at on, until the pattern's next entry, the
action holds for the pattern, which is a host or a parent domain ("example.org" covers "a.example.org"). Entries become
validity intervals [listed_at, next listed_at) by one window over the list; a pattern's last one stays open. A capture is judged by
the entries active at its fetch time; the entry of the longest matching pattern decides, whatever its action.

Captures are reduced to distinct (host, fetch time), so copies cost nothing; intervals are spread over the months of captures that they
cover and over `salts`, so the join is an equality join on (pattern, month, salt) with the interval as a residual, and neither a busy host nor a
listed domain above most hosts is one key. Everything is DataFrame functions.

Results: one row per capture, repeated ones too. A null, empty or malformed URL or a null time matches nothing and has a null action;
a URL of any length is read whole. Entries with a null pattern or time are ignored; several of one pattern and moment: the
alphabetically last action holds. A result column whose name captures has already gets an underscore. Times are timestamps; dates
count from their midnight. Empty captures give no rows, an empty list only null actions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import fresh


def host(url: Column) -> Column:
    """The lower-cased host: no user, port or final dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    bare = F.rtrim(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""), F.lit("."))
    return F.nullif(F.lower(bare), F.lit(""))


def suffixes(name: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, listed_at, until): entries as validity intervals; until is null for those still open."""
    clean = entries.select(F.rtrim(F.lower("pattern"), F.lit(".")).alias("pattern"), F.col("listed_at").cast("timestamp").alias("listed_at"), "action").where("pattern is not null and listed_at is not null")
    single = clean.groupBy("pattern", "listed_at").agg(F.max("action").alias("action"))
    return single.withColumn("until", F.lead("listed_at").over(Window.partitionBy("pattern").orderBy("listed_at")))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on", salts: int = 8) -> DataFrame:
    """captures with host, matched_pattern, listed_at and action (null: no active entry)."""
    own, moment, held = (fresh(captures, name) for name in ("_host", "_moment", "_best"))
    base = captures.withColumn(own, host(F.col(url))).withColumn(moment, F.col(fetched).cast("timestamp"))
    keys = base.select(F.col(own).alias("host"), F.col(moment).alias("_at")).where("host is not null and _at is not null").distinct()
    salted = keys.withColumn("_salt", F.pmod(F.xxhash64("host", "_at"), F.lit(salts)).cast("int"))
    probes = salted.withColumn("pattern", F.explode(suffixes(F.col("host")))).withColumn("_month", F.trunc("_at", "month"))
    time = F.col(fetched).cast("timestamp")
    first, last = captures.agg(F.min(time)).scalar(), captures.agg(F.max(time)).scalar()
    listed = intervals(entries).where(F.col("listed_at") <= last).where(F.col("until").isNull() | (F.col("until") > first))
    months = F.sequence(F.trunc(F.greatest("listed_at", first), "month"), F.trunc(F.least("until", last), "month"), F.expr("interval 1 month"))
    spread = listed.withColumn("_month", F.explode(months)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = probes.join(spread, ["pattern", "_month", "_salt"]).where("_at >= listed_at and (until is null or _at < until)")
    best = met.groupBy("host", "_at").agg(F.max_by(F.struct("pattern", "listed_at", "action"), F.length("pattern")).alias("_best"))
    judged = base.join(best.select(F.col("host").alias(own), F.col("_at").alias(moment), F.col("_best").alias(held)), [own, moment], "left")
    results = {"host": own, "matched_pattern": f"{held}.pattern", "listed_at": f"{held}.listed_at", "action": f"{held}.action"}
    return judged.select(*(f"`{c}`" for c in captures.columns), *(F.col(at).alias(fresh(captures, name)) for name, at in results.items()))
