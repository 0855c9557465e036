"""Token counts of a text's fields or sections, from one encoding of the whole text.

A whole text is encoded once; token character spans come from the tokens' bytes (a token that holds a part of a character
covers that character). Spans are joined to sections, given as disjoint character intervals, by two binary searches. A
token within one section counts there. A token that crosses boundaries goes by the rule:
  majority  to the section that holds most of its characters, the earlier one on a tie (default);
  first     to the section of its first character that lies in any section;
  split     to all of them, in shares of its characters in sections.
Tokens that touch no section are counted under section -1, in a row that exists only if there are any.

Results: null or empty text has no tokens; its only section (a line) is empty and counts 0. Without a sections column,
sections are lines, each with its line end. A null or empty array of sections leaves section -1 alone. Overlapping or
reversed sections raise ValueError. Repeated rows give repeated rows, an empty table none; a text of any length is encoded whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm.byte_bpe import encode_text, transducer
from graphloom.llm.common import slices


def spans(text: str, path: str, pattern: str) -> np.ndarray:
    """Rows [begin, end) of characters, one per token."""
    token = transducer(path).token
    lengths = np.array([len(token[x]) for x in encode_text(text, path, pattern)], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    data = text.encode("utf-8", "surrogatepass")
    if len(data) != len(text) and len(lengths):
        character = np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80) - 1
        begins, ends = character[begins], character[ends - 1] + 1
    return np.stack([begins, ends], 1)


def lines(text: str) -> list[tuple[int, int]]:
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    ends[-1] -= 1
    cuts = [0, *ends.tolist()]
    if len(cuts) > 2 and cuts[-1] == cuts[-2]:
        cuts.pop()
    return list(zip(cuts, cuts[1:], strict=False))


def attribute(tokens: np.ndarray, sections: list[tuple[int, int]], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, boundary-crossing tokens) by section, then those of no section."""
    count, crossing = np.zeros(len(sections) + 1), np.zeros(len(sections) + 1, np.int64)
    begin, end = (np.array([s[i] for s in sections], np.int64) for i in (0, 1))
    if (begin > end).any() or (begin[1:] < end[:-1]).any():
        raise ValueError("sections must be disjoint and ordered")
    if len(tokens) and len(sections):
        first = np.searchsorted(end, tokens[:, 0], "right")
        last = np.searchsorted(begin, tokens[:, 1], "left") - 1
        partly = (first <= last) & ((begin[np.minimum(first, len(sections) - 1)] > tokens[:, 0]) | (end[np.maximum(last, 0)] < tokens[:, 1]) | (first < last))
        whole = (first <= last) & ~partly
        count += np.bincount(first[whole], minlength=len(count))
        count[-1] += (first > last).sum()
        for k in np.flatnonzero(partly):
            among = np.arange(first[k], last[k] + 1)
            share = np.maximum(0, np.minimum(end[among], tokens[k, 1]) - np.maximum(begin[among], tokens[k, 0]))
            among, share = among[share > 0], share[share > 0]
            if not len(among):
                count[-1] += 1
                continue
            if rule == "split":
                count[among] += share / share.sum()
            else:
                count[among[0] if rule == "first" else among[np.argmax(share)]] += 1
            crossing[among] += 1
    else:
        count[-1] = len(tokens)
    return count, crossing


def section_counts(docs: DataFrame, path: str, pattern: str, rule: str = "majority", sections: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, section, start_char, end_char, n_tokens, n_crossing, doc_tokens). sections: a column array<struct<start,end>>; None: lines."""
    if rule not in ("majority", "first", "split"):
        raise ValueError(rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 2 << 20):
            keys, out = batch.column(key).to_pylist(), [[] for _ in range(7)]
            given = batch.column(sections).to_pylist() if sections else [None] * len(keys)
            for k, x, own in zip(keys, batch.column(text).to_pylist(), given, strict=True):
                tokens = spans(x or "", path, pattern)
                parts = [(s["start"], s["end"]) for s in own or ()] if sections else lines(x or "")
                count, crossing = attribute(tokens, parts, rule)
                rows = [(k, i, a, b, float(count[i]), int(crossing[i]), len(tokens)) for i, (a, b) in enumerate(parts)]
                if count[-1] or not parts:
                    rows.append((k, -1, None, None, float(count[-1]), 0, len(tokens)))
                for column, values in zip(out, zip(*rows, strict=True), strict=True):
                    column.extend(values)
            kinds = (batch.schema.field(key).type, pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=[key, "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"])

    narrow = docs.select(key, text, *([sections] if sections else []))
    return narrow.mapInArrow(run, f"{key} {narrow.schema[key].dataType.simpleString()}, section int, start_char long, end_char long, n_tokens double, n_crossing long, doc_tokens long")
