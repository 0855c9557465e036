"""Text rules of the sources: names, entries, money, staff lists, log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_entry(text: Column) -> Column:
    """struct(entry_id, entry_text): 'Name (12)' and '12 (Type)' give (12, text); 'Foo (Bar)' gives ('Bar', 'Foo'); digits give (digits, null); other text (text, null)."""
    outer, inner = F.regexp_extract(text, r"^([^()]*?)\s*\(([^()]*)\)\s*$", 1), F.regexp_extract(text, r"^([^()]*?)\s*\(([^()]*)\)\s*$", 2)
    pair = F.regexp_like(text, F.lit(r"^[^()]*\([^()]*\)\s*$"))
    outer_number = F.regexp_like(outer, F.lit(r"^\d+$"))
    return F.struct(
        F.when(pair & outer_number, outer).when(pair, inner).otherwise(text).alias("entry_id"),
        F.when(pair & outer_number, inner).when(pair, outer).alias("entry_text"),
    )


def person_name(text: Column) -> Column:
    """'F Last' of 'Last, First ...' (Unicode letters)."""
    last, initial = (F.regexp_extract(text, r"(?U)(\w+),\s+(\w)", k) for k in (1, 2))
    return F.when(last != "", F.concat(initial, F.lit(" "), last))


def split_name(text: Column) -> Column:
    """struct(first_name, last_name) of 'Last, First' or 'First Last'; other forms are null."""
    comma, space = F.split(text, ", "), F.split(text, " ")
    good_comma, good_space = F.size(comma) == 2, (F.size(space) == 2) & ~text.contains(", ")
    return F.struct(F.when(good_comma, F.try_element_at(comma, F.lit(2))).when(good_space, F.try_element_at(space, F.lit(1))).alias("first_name"), F.when(good_comma, F.try_element_at(comma, F.lit(1))).when(good_space, F.try_element_at(space, F.lit(2))).alias("last_name"))


def staff_names(text: Column) -> Column:
    """The names of a list like 'A One (CSW), B Two', without the groups."""
    return F.transform(F.split(text, ", "), lambda x: F.trim(F.regexp_replace(x, r"\([^)]*\)", "")))


def money(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"[^\d.]", ""), F.lit("")).try_cast("decimal(18,2)")


def clean(text: Column) -> Column:
    """Without line ends and outer blanks; blank is null."""
    return F.nullif(F.trim(F.translate(text, "\r\n", "")), F.lit(""))


def unspecified(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unspecified"))


def unescape(text: Column) -> Column:
    """The five named HTML entities, &amp; last."""
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def html_text(html: Column) -> Column:
    """Text between tags, scripts and styles left out, white space joined."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescape(bare), r"\s+", " "))


def label_values(html: Column) -> Column:
    """array<struct<pos,label,value>>: each text of a page with the one after it."""
    texts = F.filter(F.transform(F.split(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", ""), r"<[^>]*>"), lambda x: F.trim(unescape(x))), lambda x: x != "")
    later = F.slice(F.concat(texts, F.array(F.lit(None).cast("string"))), F.lit(2), F.size(texts))
    return F.transform(F.arrays_zip(texts.alias("label"), later.alias("value")), lambda x, i: F.struct(i.alias("pos"), x["label"].alias("label"), x["value"].alias("value")))


def log_fields(line: Column) -> Column:
    """A function's log line: '[LEVEL] time request {function} message'."""
    pattern = r"^\[(\w+)\]\s+([^\s\x01]+)\s+([^\s\x01]+)\s+\{([^}\x01]*)\}\s+(.*)$"
    names = ("level", "logged_at", "request_id", "function_name", "message")
    parts = F.split(F.regexp_replace(line, pattern, "\x01$1\x01$2\x01$3\x01$4\x01$5"), "\x01", 6)  # all groups in one pass
    found = F.transform(F.filter(F.array(parts), lambda p: (F.size(p) == 6) & (p[0] == "")), lambda p: F.struct(*(F.nullif(p[k], F.lit("")).alias(n) for k, n in enumerate(names, 1))))
    none = F.struct(*(F.lit(None).cast("string").alias(n) for n in names))
    return F.coalesce(F.get(found, F.lit(0)), none)


def invocation_fields(line: Column) -> Column:
    """A platform line: 'REPORT RequestId: x Duration: 1.5 ms Billed Duration: 100 ms Memory Size: 128 MB Max Memory Used: 50 MB'."""
    number = lambda name, kind: F.nullif(F.regexp_extract(line, rf"(?:^|[\t ]){name}: ([\d.]+)", 1), F.lit("")).try_cast(kind)
    return F.struct(
        F.nullif(F.regexp_extract(line, r"^(START|END|REPORT)\b", 1), F.lit("")).alias("status"),
        F.nullif(F.regexp_extract(line, r"RequestId: (\S+)", 1), F.lit("")).alias("request_id"),
        number("Duration", "double").alias("duration_ms"),
        number("Billed Duration", "bigint").alias("billed_ms"),
        number("Memory Size", "bigint").alias("memory_mb"),
        number("Max Memory Used", "bigint").alias("used_mb"),
    )


def log_kind(line: Column) -> Column:
    """invocation wins over python; the rest is raw."""
    return F.when(F.regexp_like(line, F.lit(r"^(START|END|REPORT)\b.*RequestId: ")), "invocation").when(F.regexp_like(line, F.lit(r"^\[\w+\]\s+\S+\s+\S+\s+\{")), "python").otherwise("raw")
