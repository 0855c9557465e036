"""Packing documents into sequences: shortest pack first over the histogram of lengths.

Every document becomes pieces of at most `size` tokens (only documents longer than that are cut, at multiples of size).
The histogram of piece lengths has at most `size` entries, whatever the corpus, so it alone goes to the driver. Lengths
are placed longest first; each goes to the pack that holds least and still has room, and what is updated are counts of
packing patterns, not packs. Then pieces get their places by joining on (length, rank): ranks are taken within (length,
salt) and shifted by the counts of the salts before, so no length, however common, meets in one task.

Results: null or empty text is one piece with the end id only. A null doc_id is packed and stays null. Repeated rows are packed as often as they occur. A very
long text is cut into as many pieces as it needs. An empty table gives no rows. Only the named columns are read. A sequence's end is padded to size, except where its length is a
power of two.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graphloom.llm.common import Kept, fresh, materialize, shuffle_partitions, slices, texts
from graphloom.llm.token_files import Added, byte_characters

#: Separators that str.split() takes for white space and the tokenizer doesn't.
ODD = re.compile("[\x1c-\x1f]")


#: Words of characters whose lower case and normal form are plain, and their pre-tokens once in lower case.
PLAIN = re.compile("[!-~¡¿«»À-ÖØ-öø-ÿ]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class WordEncoder:
    """The library's ids of a text, packed to four bytes; ids of words between white space are kept, as the tokenizer drops white space before it merges. Texts with added tokens go through the library whole."""

    def __init__(self, path: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.added = Added(self.library)
        self.model, self.kept, self.shown = self.library.model, Kept(most), byte_characters()

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def found(self, words: list[str]) -> Iterator[bytes]:
        """Plain words go to the library's model by pre-tokens, others through the whole library."""
        tokenize, shown = self.model.tokenize, self.shown
        for word in words:
            ids = [t.id for part in PARTS.findall(word.lower()) for t in tokenize(part.encode().decode("latin-1").translate(shown))] if PLAIN.fullmatch(word) else self.ids(word)
            yield struct.pack(f"<{len(ids)}I", *ids)

    def packed(self, text: str) -> bytes:
        if ODD.search(text) or self.added.within(text):
            return np.array(self.ids(text), "<u4").tobytes()
        words = text.split()
        return b"".join(map(self.kept.of(words, self.found).__getitem__, words))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(docs: DataFrame, path: str, size: int, end_id: int, with_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, end = word_encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, text):
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, x in zip(batch.column(key).to_pylist(), texts(batch, text), strict=True):
                ids = of.packed(x) + end
                for at in range(0, len(ids), 4 * size):
                    part = ids[at : at + 4 * size]
                    for column, value in zip(rows, (doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part if with_ids else None), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows[:5]), *([pa.array(rows[5], pa.binary())] if with_ids else [])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pack, how many packs) by shortest pack first, longest length first."""
    room: dict[int, list[list]] = {}  # space left -> [lengths, count]
    spaces: list[int] = []  # a heap of -space, perhaps of spaces that have gone

    def put(lengths: tuple[int, ...], count: int, left: int) -> None:
        if left not in room:
            room[left] = []
            heapq.heappush(spaces, -left)
        room[left].append([lengths, count])

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} tokens doesn't fit")
        while todo:
            while spaces and not room.get(-spaces[0]):
                room.pop(-heapq.heappop(spaces), None)
            if not spaces or -spaces[0] < length:
                put((length,), todo, size - length)
                break
            left = -spaces[0]
            lengths, count = room[left].pop()
            used = min(todo, count)
            if count > used:
                room[left].append([lengths, count - used])
            put((*lengths, length), used, left - length)
            todo -= used
    return sorted((tuple(lengths), count) for held in room.values() for lengths, count in held)


def places(found: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), ordered: the r-th piece of a length is in the row with the largest first rank up to r, in sequence first + (r - first rank)."""
    rows, taken, sequence = [], {}, 0
    for lengths, count in found:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, offset))
            taken[length] = rank + count
            offset += length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def assign(cut: DataFrame, size: int) -> DataFrame:
    """cut (doc_id, start, length, ...) with sequence_id and offset (an underscore more if it has them). cut is read several times: pass a written table."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    table = places(patterns(histogram, size))
    salts = max(16, shuffle_partitions(spark))
    salt, rank, shift = (fresh(cut, name) for name in ("_salt", "_rank", "_shift"))
    made = [fresh(cut, name) for name in ("sequence_id", "offset")]
    salted = cut.withColumn(salt, F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    shifts = salted.groupBy("length", salt).agg(F.count("*").alias(rank)).select("length", salt, F.coalesce(F.sum(rank).over(before), F.lit(0)).alias(shift))
    order = Window.partitionBy("length", salt).orderBy("doc_id", "start")
    ranked = salted.withColumn(rank, F.row_number().over(order)).join(shifts.hint("shuffle_merge"), ["length", salt]).withColumn(rank, F.col(rank) - 1 + F.col(shift))
    names = cut.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        wide = int(table[:, 1].max()) + 2
        marks = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length, at = (batch.column(c).to_numpy() for c in ("length", rank))
            row = table[np.searchsorted(marks, length * wide + np.minimum(at, wide - 1), "right") - 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(row[:, 2] + at - row[:, 1]), pa.array(row[:, 3])], names=[*names, *made])

    return ranked.select(*(f"`{c}`" for c in names), F.col(rank).cast("long").alias(rank)).mapInArrow(run, f"{kinds}, {made[0]} long, {made[1]} long")


def pack(docs: DataFrame, path: str, size: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of all docs with their sequences. path: a tokenizer file that every executor can read."""
    cut, _ = materialize(pieces(docs, path, size, end_id, with_ids), "pieces")
    return assign(cut, size)
