"""Product codes of vectors: integer codebooks fitted by rounds of nearest entries and floored means, then one byte for each part.

Components become floor(scale * x) once and are written; every round reads those integers. The codebooks (parts * entries * part
width integers, whatever the table's size) are broadcast; Arrow batches find all distances by norm expansion, |c|^2 - 2 x.c
with exact int64 matrix products, and the first argmin, so ties go to the lower index. Each task gives the sums and counts of
its entries, which a grouped shuffle merges; new entries are floor(sum / count), and entries without parts stay.

Results: rows with a null vector, or with null, NaN or infinite components, are dropped. Codebooks start with the parts of the `entries`
smallest ids (null ids last; of equal ids the smaller vector first), or of all rows if there are fewer. Rows with one id each have a code.
A vector of another length than that of the smallest id has null for code and error. A length that isn't a multiple of `parts` is
an error, and so is a component whose integer doesn't fit 64 bits. Integers too large for int64 products (from about 2^29) are computed as
Python integers. An empty table gives no rows and empty codebooks. Only id, label and vector are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import materialize
from graphloom.llm.ranks import attach


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; an error beyond 64 bits."""

    def one(x: Column) -> Column:
        wide = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(wide) < F.lit(2.0**63), F.floor(wide)).otherwise(F.raise_error(F.lit("a component is too large for 64-bit integers")).cast("long"))

    return F.transform(vector, one)


def finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf))), F.lit(False))


def table_of(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have vectors of that width, their integers)."""
    column = batch.column("v")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    fits = lengths == width
    if not fits.all():
        column = column.filter(pa.array(fits))
    return fits, column.flatten().to_numpy(zero_copy_only=False).reshape(int(fits.sum()), width)


def exact(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are if squared distances fit int64, else as Python integers."""
    most = max((int(max(a.max(), -int(a.min()))) for a in (x, books) if a.size), default=0)
    if 4 * most * most * max(1, books.shape[2]) < 1 << 63:
        return x, books
    return x.astype(object), books.astype(object)


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows (n, parts * width) and books (parts, entries, width): the entries' indexes (parts, n) and squared distances (parts, n)."""
    parts, _, width = books.shape
    x, books = exact(x, books)
    cut = np.ascontiguousarray(x.reshape(len(x), parts, width).transpose(1, 0, 2))
    beside = (books * books).sum(2)[:, None, :] - 2 * np.matmul(cut, books.transpose(0, 2, 1))
    best = beside.argmin(2)
    return best, np.take_along_axis(beside, best[:, :, None], 2)[:, :, 0] + (cut * cut).sum(2)


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """(parts, entries, width) from the rows with the smallest ids."""
    found = [r["v"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()]
    if not found:
        return np.zeros((parts, 0, 0), np.int64)
    length = len(found[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    x = np.array([v for v in found if len(v) == length], np.int64)
    return x.reshape(len(x), parts, length // parts).transpose(1, 0, 2).copy()


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books after one round over all rows."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums, counts = np.zeros(books.shape, object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            _, x = table_of(batch, parts * width)
            best, _ = nearest(x, books)
            chosen = (best[:, None, :] == np.arange(entries)[None, :, None]).astype(np.int64)
            values, _ = exact(x, books)
            small = values.dtype != object and len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
            cut = (values if small else x.astype(object)).reshape(len(x), parts, width).transpose(1, 0, 2)
            sums += np.matmul(chosen if small else chosen.astype(object), cut).astype(object)
            counts += chosen.sum(2)
        part, entry = np.nonzero(counts)
        columns = [np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), len(part)), np.repeat(counts[part, entry], width)]
        totals = pa.array([Decimal(int(s)) for s in sums[part, entry].ravel()], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), totals], names=["part", "entry", "place", "n", "total"])

    found = rows.select("v").mapInArrow(run, "part long, entry long, place long, n long, total decimal(38,0)")
    after = books.copy()
    for r in found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # as many as the books have integers
        after[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    shared.destroy()
    return after


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): code has a byte for each part, error is the sum of the squared distances."""
    parts, _, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, x = table_of(batch, parts * width)
            best, far = nearest(x, shared.value)
            at = np.cumsum(fits) - 1
            codes, errors = best.T.astype(np.uint8), far.sum(0)
            made = [codes[i].tobytes() if ok else None for i, ok in zip(at, fits, strict=True)]
            error = [int(errors[i]) if ok else None for i, ok in zip(at, fits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(made, pa.binary()), pa.array(error, pa.int64())], names=["id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"id long, label {label}, code binary, error long")


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every finite vector, written, and the codebooks (parts, entries, width). At most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("a code's byte tells at most 256 entries apart")
    v = F.col(vector)
    rows, _ = materialize(vectors.where(finite(v)).select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), integers(v, scale).alias("v")), "integers")
    books = first_books(rows, parts, entries)
    if not books.size:
        return rows.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), books
    for _ in range(rounds):
        books = improved(rows, books)
    return materialize(coded(rows, books), "codes")[0], books


def restored(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """codes with `v`, the integers that each code stands for; null without a code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if c is None else books[np.arange(len(books)), np.frombuffer(c, np.uint8)].ravel() for c in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.int64()))], names=[*batch.schema.names, "v"])

    return codes.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema) + ", v array<bigint>")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """codes, a written table, with `label_error`: the sum of the errors of all rows with an equal label, nulls together."""
    totals, _ = materialize(codes.groupBy("label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")), "labels")
    return attach(codes, totals, "label", codes.count())
