"""Removing passages that an earlier document has: sparse suffixes, sorted by bucket-pointer refinement.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id. Sorting every suffix
would shuffle many times the input, so suffixes are sampled by content: of the q-grams in a window of `length` bytes
the one with the smallest hash is the window's anchor, so equal windows have equal anchors at equal offsets, and about one
suffix in fifteen is kept, which loses no string. A run is a stretch of successive windows with the same anchor.

1. Pre-aggregation of exact copies: runs are bucketed by their anchor's q-gram, and a run equal to one in an earlier document
   (112 bits of hashes) is repeated as a whole. Each task first does this among its own texts and passes on only one
   document per run, so copies and frequent passages, however many, arrive as one entry per task. Buckets of a single run or
   document are settled, and so are runs that share their anchor with others, but nothing to the left or right of it: a window has 15
   bytes more on one side at least. What is left are runs that reach past a passage's border.
2. Refinement: these runs of the first documents send their bytes, bucketed by anchor. Initial buckets hold all positions with equal
   q-grams of 16 bytes. Each pass sorts positions by (own bucket, bucket at an offset as long as what is compared already),
   writes the finer buckets back over the old ones, and so the next pass, which reads them at its later offset, compares twice
   as much; positions alone in their bucket drop out. The last pass compares `length` bytes.
3. Repeated windows return to their documents as ranges and are cut out there.

Anchors that are frequent in the whole table (counted over all texts beforehand; a list of bounded size) would bring all their
borders into one task. Their runs are not bucketed by anchor but go straight to step 2, where each of their windows is bucketed by a hash of
its whole length, once per task and string, so that a bucket holds copies of a string only. The list changes the way, not the results.
The number of tasks follows the bytes of the texts. All passes are linear in the bytes.

Results: null or empty text has nothing to remove. Matches never cross documents. Rows with a null id are kept whole and
are no source. Repeated rows of an id count once and are treated alike; different texts of one id are judged each by
itself, and none of them is earlier than another. An empty table gives no rows. Other columns are not read; without_repeats()
keeps them. Kept bytes may split a character of more than one byte; text_of() drops such rests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import Frequent, bucket_ids, forget, fresh, materialize, partitions_for, slices

Q = 20
U = np.uint64
MULTIPLIERS = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
BLOCK, POSITION_BITS = 1 << 19, U(22)
#: A task refines its bucket in so many parts, one at a time, to hold few arrays at once.
PARTS = 16
MASK48 = U((1 << 48) - 1)
#: A run's hash has in its upper half what is beside its anchor, in 16 bits for either side, 0 where the run doesn't reach as far.
LEFT, RIGHT, SIDE = U(32), U(48), U((1 << 16) - 1)
#: Anchors with so many runs, and this share of all runs, are frequent; so there are at most FREQUENT of them.
OFTEN, FREQUENT = 2048, 1 << 13
#: Different texts of one id lie this far apart in their document's positions.
APART = 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x *= MULTIPLIERS[4]
    x ^= x >> U(29)
    x *= MULTIPLIERS[5]
    x ^= x >> U(32)
    return x


def words_at(data: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian numbers that start at each byte."""
    size = np.dtype(kind).itemsize
    return np.ndarray((len(data) - size + 1,), kind, data, strides=(1,))


def qgrams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q bytes at each position."""
    n = len(data) - Q + 1
    eight = np.ascontiguousarray(words_at(data, "<u8"))
    x = eight[:n] * MULTIPLIERS[0]
    x += eight[8 : 8 + n] * MULTIPLIERS[1]
    x += words_at(data, "<u4")[16 : 16 + n].astype(U) * MULTIPLIERS[2]
    return mixed(x)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        v = np.minimum(v[:-reach], v[reach:])
        reach *= 2
    return np.minimum(v[: len(v) - (width - reach)], v[width - reach :]) if width > reach else v


def anchors_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """The keys of runs_of()."""
    x = qgrams(data)
    anchor, first, _ = bounds_of(x, begins, ends, length)
    return mixed(x[anchor[first]]) & MASK48


def bounds_of(x: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor of each window, whether a run starts there, whether it ends there)."""
    v = x >> POSITION_BITS << POSITION_BITS
    v |= np.arange(len(v), dtype=U)
    anchor = (sliding_min(v, length - Q + 1) & ((U(1) << POSITION_BITS) - U(1))).astype(np.int32)
    valid = np.zeros(len(anchor), bool)
    for a, b in zip(begins.tolist(), (ends - length + 1).tolist(), strict=True):
        valid[a : max(a, b)] = True
    other = anchor[1:] != anchor[:-1]
    first = valid.copy()
    first[1:] &= other | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= other | ~valid[1:]
    return anchor, first, last


def runs_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(key, run hash, segment, first window, windows) of all runs in the segments [begin, end) of data, which has fewer than 2**POSITION_BITS bytes."""
    x = qgrams(data)
    anchor, first, last = bounds_of(x, begins, ends, length)
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    final = hi + length - Q
    whole = (final - lo).astype(U) * MULTIPLIERS[3]
    for k in range(-(-(2 * length - 2 * Q) // Q) + 1):
        at = x[np.minimum(lo + Q * k, final)]
        whole += (at ^ (at >> U(31))) * MULTIPLIERS[k % 6] * U(2 * k + 1)
    whole += x[final]
    segment = np.searchsorted(begins, lo, "right") - 1
    at, reach = anchor[lo], (length - Q + 1) // 2
    left, right = (np.where(inside, np.maximum(x[np.clip(side, 0, len(x) - 1)] & SIDE, U(1)), U(0)) for inside, side in ((at - lo >= reach, at - reach), (final - at >= reach, at + reach)))
    return mixed(x[at]) & MASK48, mixed(whole) >> LEFT | left << LEFT | right << RIGHT, segment, lo - begins[segment], hi - lo + 1


def class_of(key: np.ndarray, run: np.ndarray) -> np.ndarray:
    return key * MULTIPLIERS[0] ^ run * MULTIPLIERS[1]


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each value is in the ordered list."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def at_head(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each row, the value at its group's head."""
    return values[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(values) else values


def packed48(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together: the upper ones of small numbers compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


RUNS = "bucket int, key binary, run binary, doc binary, first binary, windows binary"
RUNS_NAMES = ["bucket", "key", "run", "doc", "first", "windows"]


def run_rows(batches: Iterator[pa.RecordBatch], ids: list[int], length: int, frequent: np.ndarray, most_bytes: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of RUNS: runs still open, by bucket, and those spread by their documents (no key): settled ones, and with a mark for a run open ones of frequent anchors."""

    def flush(held: list) -> pa.RecordBatch:
        key, run, doc, first, windows = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(class_of(key, run))
        new = heads(key[order], run[order])
        settled = np.empty(len(doc), bool)
        settled[order] = doc[order] > np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        state = np.where(settled, 1, np.where(among(key, frequent), 2, 0))
        rows: list[list] = [[] for _ in RUNS_NAMES]
        for part in range(3):
            pick = np.flatnonzero(state == part)
            bucket = ((mixed(doc[pick].astype(U)) if part else key[pick]) % U(len(ids))).astype(np.uint16 if len(ids) <= 1 << 16 else np.uint32)
            by = np.argsort(bucket, kind="stable")  # documents stay together as they came
            pick, bucket = pick[by], bucket[by]
            cuts = np.flatnonzero(heads(bucket))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True) if len(bucket) else ():
                own = pick[a:b]
                for column, value in zip(rows, (ids[int(bucket[a])], b"" if part else packed48(key[own]), (b"", b"", b"open")[part] if part else run[own].tobytes(), doc[own].tobytes(), planes(first[own].astype("<i8")), windows[own].astype("u1").tobytes()), strict=True):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])], names=RUNS_NAMES)

    held, size = [], 0
    for buffer, begins, ends, docs, starts in blocks(batches, length):
        key, run, segment, first, windows = runs_of(buffer, begins, ends, length)
        if len(key):
            held.append((key, run, docs[segment], first + starts[segment], windows))
        size += len(buffer)
        if size >= most_bytes and held:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """(bytes, segment begins, ends, doc ids, segment starts in their documents), each of about BLOCK bytes at most; long texts are cut with an overlap, so that every window lies in one segment."""

    def joined(parts: list) -> tuple:
        sizes = np.array([len(p[0]) for p in parts])
        ends = np.cumsum(sizes)
        buffer = np.frombuffer(b"".join(p[0] for p in parts) + bytes(length), np.uint8)
        return buffer, ends - sizes, ends, np.array([p[1] for p in parts], np.int64), np.array([p[2] for p in parts], np.int64)

    parts, size = [], 0
    for batch in slices(batches, "text"):
        for doc, text, base in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "base")), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            if doc is None or len(data) < length:
                continue
            for at in range(0, len(data) - length + 1, BLOCK):
                part = data[at : at + BLOCK + length - 1]
                if size + len(part) > BLOCK and parts:
                    yield joined(parts)
                    parts, size = [], 0
                parts.append((part, doc, base + at))
                size += len(part)
    if parts:
        yield joined(parts)


FOUND = "bucket int, open boolean, doc binary, first binary, windows binary"
FOUND_NAMES = ["bucket", "open", "doc", "first", "windows"]
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def found_rows(parts: Iterator[tuple[bool, Found]], ids: list[int], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of FOUND: (document, first window, windows) of runs, repeated or open, one row for each bucket of documents, so that their number doesn't follow the documents or the runs."""

    def flush(is_open: bool) -> pa.RecordBatch:
        doc, first, windows = (np.concatenate(c) for c in zip(*held[is_open], strict=True))
        held[is_open].clear()
        bucket = (mixed(doc.astype(U)) % U(len(ids))).astype(np.uint16 if len(ids) <= 1 << 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        doc, first, windows, bucket = doc[order], first[order].astype("<i8"), windows[order].astype("<i4"), bucket[order]
        cuts = np.flatnonzero(heads(bucket))
        spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(doc)], strict=True))
        columns = (pa.array([planes(c[a:b]) for a, b in spans], pa.binary()) for c in (doc, first, windows))
        return pa.RecordBatch.from_arrays([pa.array([ids[k] for k in bucket[cuts].tolist()], pa.int32()), pa.array([is_open] * len(spans)), *columns], names=FOUND_NAMES)

    held: tuple[list, list] = ([], [])
    size = [0, 0]
    for is_open, found in parts:
        if len(found[0]):
            held[is_open].append(found)
            size[is_open] += len(found[0])
        if size[is_open] >= most:
            yield flush(is_open)
            size[is_open] = 0
    for is_open in (False, True):
        if held[is_open]:
            yield flush(is_open)


def found_of(batches: Iterator[pa.RecordBatch]) -> Found | None:
    """All runs of a partition of FOUND rows, ordered by document and place."""
    rows = [(from_planes(d, "<i8"), from_planes(f, "<i8"), from_planes(w, "<i4")) for batch in batches for d, f, w in zip(*(batch.column(c).to_pylist() for c in FOUND_NAMES[2:]), strict=True)]
    if not rows:
        return None
    columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
    rows.clear()
    order = np.lexsort((columns[1], columns[0]))
    return tuple(c[order] for c in columns)


def open_rows(batches: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """(doc_id, first, windows): a row for each document with open runs."""
    if (found := found_of(batches)) is None:
        return
    doc, first, windows = found
    cuts = np.append(np.flatnonzero(heads(doc)), len(doc))
    for at in range(0, len(cuts) - 1, most):
        own = cuts[at : at + most + 1]
        offsets = pa.array((own - own[0]).astype(np.int32))
        lists = (pa.ListArray.from_arrays(offsets, pa.array(c[own[0] : own[-1]], t)) for c, t in ((first, pa.int64()), (windows, pa.int32())))
        yield pa.RecordBatch.from_arrays([pa.array(doc[own[:-1]], pa.int64()), *lists], names=["doc_id", "first", "windows"])


def span_rows(batches: Iterator[pa.RecordBatch], length: int, most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """(doc_id, spans): a row for each document with repeated windows; spans: where its maximal runs of repeated bytes begin, and after these their sizes."""
    if (found := found_of(batches)) is None:
        return
    doc, first, windows = found
    text = (np.cumsum(heads(doc, first >> APART)) - 1) << (APART + 1)
    begin = text + (first & ((1 << APART) - 1))
    reach = np.maximum.accumulate(begin + windows + length - 1)  # texts ascend, so nothing reaches from one into the next
    new = np.ones(len(doc), bool)
    new[1:] = begin[1:] > reach[:-1]
    new = np.flatnonzero(new)
    size = reach[np.append(new[1:], len(doc)) - 1] - begin[new]
    doc, first = doc[new], first[new]
    cuts = np.append(np.flatnonzero(heads(doc)), len(doc)).tolist()
    for at in range(0, len(cuts) - 1, most):
        own = cuts[at : at + most + 1]
        spans = [first[a:b].tobytes() + size[a:b].tobytes() for a, b in zip(own[:-1], own[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(doc[own[:-1]], pa.int64()), pa.array(spans, pa.binary())], names=["doc_id", "spans"])


def refine_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, Found]]:
    """For a partition of RUNS rows: repeated runs, and open ones, whose windows must be compared."""
    held, done = [], ([], [])
    for batch in batches:
        for _, key, run, doc, first, windows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = (np.frombuffer(doc, np.int64), from_planes(first, "<i8"), np.frombuffer(windows, np.uint8))
            if key:
                held.append((unpacked48(key), np.frombuffer(run, U), *row))
            else:
                done[bool(run)].append(row)
    for is_open in (False, True):
        if done[is_open]:
            yield is_open, tuple(np.concatenate(c) for c in zip(*done[is_open], strict=True))
            done[is_open].clear()
    if held:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        held.clear()
        part = (columns[0] >> U(40)).astype(np.uint8) % PARTS
        for k in range(PARTS):
            mine = part == k
            if mine.any():
                yield from refine_bucket(*(c[mine] for c in columns))


def refine_bucket(key: np.ndarray, run: np.ndarray, doc: np.ndarray, first: np.ndarray, windows: np.ndarray) -> Iterator[tuple[bool, Found]]:
    order = np.argsort(key)
    new = heads(key[order])
    starts = np.flatnonzero(new)
    low, high = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
    pick = order[(low < high)[np.cumsum(new) - 1]]
    if not len(pick):
        return
    key, run, doc, first, windows = (c[pick] for c in (key, run, doc, first, windows))
    order = np.lexsort((doc, run, key))
    key, run, doc, first, windows = (c[order] for c in (key, run, doc, first, windows))
    repeated = doc > at_head(doc, heads(key, run))
    open_ = ~repeated
    open_[open_] = beside(key[open_], run[open_])
    for mask, is_open in ((repeated, False), (open_, True)):
        yield is_open, (doc[mask], first[mask], windows[mask])


def beside(key: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Whether another run with the same anchor has the same beside it: windows hold an anchor and what is left or right of it, so runs without may not share one."""
    shared = np.zeros(len(key), bool)
    for side in (LEFT, RIGHT):
        code = run >> side & SIDE
        some = np.flatnonzero(code)
        place = key[some] << U(16) | code[some]
        order = np.argsort(place)
        if not len(order):
            continue
        new = heads(place[order])
        starts, other = np.flatnonzero(new), run[some[order]]
        shared[some[order]] |= (np.minimum.reduceat(other, starts) != np.maximum.reduceat(other, starts))[np.cumsum(new) - 1]
    return shared


BORDERS = "bucket int, part binary, doc binary, first binary, windows binary, bytes binary"
BORDERS_NAMES = ["bucket", "part", "doc", "first", "windows", "bytes"]


def border_rows(batches: Iterator[pa.RecordBatch], ids: list[int], length: int, frequent: np.ndarray, most_bytes: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of BORDERS for rows (doc_id, text, base, first, windows): the bytes of open runs, bucketed by their anchors; those of frequent
    anchors window by window, bucketed by the whole window, and windows that an earlier document of the task has without bytes."""

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        doc, first, windows = (np.array([p[k] for p in parts], np.int64) for k in range(3))
        sizes = windows + length - 1
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(p[3] for p in parts) + bytes(length), np.uint8)
        x = qgrams(data)
        v = x >> POSITION_BITS << POSITION_BITS
        v |= np.arange(len(v), dtype=U)
        anchor = (sliding_min(v, length - Q + 1)[starts] & ((U(1) << POSITION_BITS) - U(1))).astype(np.int64)  # all windows of a run have the same
        code = mixed(x[anchor])
        hot = among(code & MASK48, frequent)
        of = np.repeat(np.flatnonzero(hot), windows[hot])
        step = np.arange(len(of)) - np.repeat(np.cumsum(windows[hot]) - windows[hot], windows[hot])
        at = starts[of] + step
        whole = np.zeros(len(at), U)
        for k, offset in enumerate([*range(0, length - Q, Q), length - Q]):
            whole = mixed(whole + x[at + offset] * MULTIPLIERS[k % 6])
        order = np.lexsort((doc[of], whole))
        of, step, at, whole = of[order], step[order], at[order], whole[order]
        seen = doc[of] > at_head(doc[of], heads(whole))
        some, one = np.flatnonzero(~hot), np.ones(len(of), np.int64)
        tables = (  # code, doc, first, windows, where their bytes start, whether these go along
            (code[some], doc[some], first[some], windows[some], starts[some], True),
            (whole[~seen], doc[of][~seen], (first[of] + step)[~seen], one[~seen], at[~seen], True),
            (mixed(doc[of][seen].astype(U)), doc[of][seen], (first[of] + step)[seen], one[seen], at[seen], False),
        )
        rows: list[list] = [[] for _ in BORDERS_NAMES]
        for codes, docs, firsts, counts, where, with_bytes in tables:
            bucket, part = codes % U(len(ids)), (codes >> U(56)).astype(np.uint8) % PARTS
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(heads(bucket[order]))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True) if len(order) else ():
                own = order[a:b]
                long = counts[own] + length - 1
                inside = np.repeat(where[own] - np.cumsum(long) + long, long) + np.arange(long.sum()) if with_bytes else ()
                for column, value in zip(rows, (ids[int(bucket[own[0]])], part[own].tobytes(), docs[own].tobytes(), firsts[own].tobytes(), counts[own].astype(np.uint8).tobytes(), data[inside].tobytes() if with_bytes else b""), strict=True):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])], names=BORDERS_NAMES)

    parts, size = [], 0
    for batch in slices(batches, "text", 4 << 20):
        for doc, text, base, firsts, counts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "base", "first", "windows")), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            for first, n in zip(firsts, counts, strict=True):
                if first >> APART != base >> APART:
                    continue  # of another text with this id
                parts.append((doc, first, n, data[first - base : first - base + n + length - 1]))
                size += n + length - 1
                if size >= most_bytes:
                    yield flush(parts)
                    parts, size = [], 0
    if parts:
        yield flush(parts)


def refine_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[bool, Found]]:
    """For a partition of BORDERS rows: windows that an earlier document has, as ranges."""
    kinds = (np.uint8, np.int64, np.int64, np.uint8, np.uint8)
    held, done = [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            columns = [np.frombuffer(x, k) for x, k in zip(row[1:], kinds, strict=True)]
            if row[-1]:
                held.append(columns)
            else:
                done.append(columns[1:3])
    if done:
        doc, first = (np.concatenate(c) for c in zip(*done, strict=True))
        done.clear()
        yield False, ranges_of(doc, first)
    if not held:
        return
    part, doc, first, windows, data = (np.concatenate(c) for c in zip(*held, strict=True))
    held.clear()
    sizes = windows.astype(np.int64) + length - 1
    for k in range(PARTS):
        mine = part == k
        if mine.any():
            yield False, compare_windows(doc[mine], first[mine], windows[mine].astype(np.int64), data[np.repeat(mine, sizes)], length)


def ranges_of(doc: np.ndarray, position: np.ndarray) -> Found:
    """Single repeated windows as ranges of neighbours."""
    order = np.lexsort((position, doc))
    doc, position = doc[order], position[order]
    new = np.flatnonzero(heads(doc, position - np.arange(len(position))))
    return doc[new], position[new], np.diff(np.append(new, len(doc)))


def refined(data: np.ndarray, left: np.ndarray, length: int, settled: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, buckets) of all positions that share their `length` bytes with another one; left: bytes from each position to its run's end. settled: gets the number of windows settled by each pass."""
    eight = np.ascontiguousarray(words_at(np.append(data, np.zeros(16, np.uint8)), "<u8"))
    at = np.flatnonzero(left >= 16)
    keys = [eight[at + 8], eight[at]]
    code = mixed(keys[0] * MULTIPLIERS[0] + keys[1] * MULTIPLIERS[1])
    order = np.argsort(code)
    if (heads(code[order]) != heads(*(k[order] for k in keys))).any():  # two strings have one hash
        order = np.lexsort(keys)
    bucket, count, depth = np.zeros(len(data), np.int64), 0, 16
    while True:
        new, at = heads(*(k[order] for k in keys)), at[order]
        bucket[at] = np.cumsum(new) - 1 + count  # written back: the next pass reads these at its later offset
        count += len(at)
        alone = new.copy()
        alone[:-1] &= new[1:]
        if settled is not None:
            settled.append(int(np.count_nonzero(left[at[alone]] >= length)))
        at = at[~alone]
        if depth == length:
            return at, bucket[at]
        offset = min(depth, length - depth)
        depth += offset
        at = at[left[at] >= depth]
        keys = [bucket[at] << 32 | bucket[at + offset]]
        order = np.argsort(keys[0])


def compare_windows(doc: np.ndarray, first: np.ndarray, windows: np.ndarray, data: np.ndarray, length: int) -> Found:
    sizes = windows + length - 1
    ends = np.cumsum(sizes)
    at, bucket = refined(data, np.repeat(ends, sizes) - np.arange(len(data)), length)
    owner = np.searchsorted(ends, at, "right")
    order = np.lexsort((doc[owner], bucket))
    at, owner, bucket = at[order], owner[order], bucket[order]
    repeated = doc[owner] > at_head(doc[owner], heads(bucket))
    at, owner = at[repeated], owner[repeated]
    return ranges_of(doc[owner], first[owner] + at - (ends - sizes)[owner])


def cut_text(text: str | None, spans: bytes | None, base: int) -> tuple[int, list[int], list[int], bytes]:
    """(bytes, begins and ends of what goes, kept bytes) of a text, given the spans of its id."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not spans:
        return len(data), [], [], data
    first, size = np.frombuffer(spans, np.int64).reshape(2, -1)
    mine = first >> APART == base >> APART
    first = first[mine] - base
    begins, ends = first.tolist(), (first + size[mine]).tolist()
    return len(data), begins, ends, b"".join(data[a:b] for a, b in zip([0, *ends], [*begins, len(data)], strict=True))


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sizes, begins, ends, kept = zip(*(cut_text(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "base")), strict=True)), strict=True)
        offsets = pa.array(np.cumsum([0, *map(len, begins)]).astype(np.int32))
        both = (pa.array([x for c in column for x in c], pa.int64()) for column in (begins, ends))
        removed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(both), names=["start", "end"]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), removed, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])


def frequent_anchors(docs: DataFrame, length: int, least: int = 16) -> np.ndarray:
    """Anchors of so many runs that their borders are not to meet in one task, ordered; counted over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, total = Frequent(), 0
        for buffer, begins, ends, _, _ in blocks(batches, length):
            key = anchors_of(buffer, begins, ends, length)
            keys.add(key)
            total += len(key)
        values, counts = keys.found(least)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(values.astype(np.int64), -1)), pa.array(np.append(counts, total))], names=["key", "n"])

    sums, path = materialize(docs.mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "anchors")
    total = sums.where("key = -1").agg(F.sum("n")).first()[0] or 0
    found = sums.where("key >= 0").where(F.col("n") >= max(OFTEN, total // FREQUENT)).orderBy(F.desc("n"), "key").limit(FREQUENT).collect()
    forget(docs.sparkSession, path)
    return np.array(sorted(r["key"] for r in found), U)


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, spans): for each document with windows that an earlier one has, the bytes that they cover. docs: doc_id, text, base."""
    spark = docs.sparkSession
    tasks = partitions_for(docs, "text")
    ids, frequent = bucket_ids(spark, tasks), frequent_anchors(docs, length)
    runs = docs.mapInArrow(lambda b: run_rows(b, ids, length, frequent), RUNS).repartition(tasks, "bucket")
    found, runs_path = materialize(runs.mapInArrow(lambda b: found_rows(refine_runs(b), ids), FOUND), "runs")
    unsettled = found.where("open").repartition(tasks, "bucket").mapInArrow(open_rows, "doc_id long, first array<long>, windows array<int>")
    borders = docs.join(unsettled.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "base", "first", "windows").mapInArrow(lambda b: border_rows(b, ids, length, frequent), BORDERS)
    more, more_path = materialize(borders.repartition(tasks, "bucket").mapInArrow(lambda b: found_rows(refine_windows(b, length), ids), FOUND), "borders")
    every = found.where("not open").unionByName(more).repartition(tasks, "bucket").mapInArrow(lambda b: span_rows(b, length), "doc_id long, spans binary")
    spans, _ = materialize(every, "spans")
    forget(spark, runs_path, more_path)
    return spans


def based(docs: DataFrame, key: str, text: str, base: str) -> DataFrame:
    """docs with `base`, where the text's positions begin: 0, or a place by its hash for an id that has several texts."""
    place = F.xxhash64(F.col(text))
    several = docs.groupBy(F.col(key).alias(f"{base}_key")).agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high").select(f"{base}_key")
    several, path = materialize(several, "several")
    if several.isEmpty():
        forget(docs.sparkSession, path)
        return docs.withColumn(base, F.lit(0).cast("long"))
    marked = docs.join(several, docs[key] == several[f"{base}_key"], "left")
    at = F.shiftleft(F.pmod(place, F.lit((1 << 31) - 1)), APART)
    return marked.withColumn(base, F.when(F.col(f"{base}_key").isNotNull(), at).otherwise(F.lit(0).cast("long"))).drop(f"{base}_key")


def remove_repeats(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed array<struct<start,end>>, kept binary): each text with its repeated byte ranges and the rest."""
    if not 2 * Q <= length <= 200:
        raise ValueError("length must be 40 to 200")
    narrow = based(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", "base")
    both = narrow.join(repeated_spans(narrow, length).hint("shuffle_hash"), "doc_id", "left")
    return both.mapInArrow(cut_rows, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")


def text_of(kept: bytes) -> str:
    return kept.decode("utf-8", "ignore")


def cut_texts(batches: Iterator[pa.RecordBatch], names: list[str], held: str, base: str) -> Iterator[pa.RecordBatch]:
    """Rows as they came, texts cut, and n_chars, if there is one, counted anew for cut texts."""
    for batch in slices(batches, "text"):
        given, found, bases = (batch.column(c).to_pylist() for c in ("text", held, base))
        cut = [cut_text(x, f, b) if f else (0, [], [], b"") for x, f, b in zip(given, found, bases, strict=True)]
        touched = [bool(begins) for _, begins, _, _ in cut]
        texts = [text_of(kept) if t else x for x, t, (*_, kept) in zip(given, touched, cut, strict=True)]
        columns = {n: batch.column(n) for n in names}
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            counts = [len(x) if t else n for x, t, n in zip(texts, touched, columns["n_chars"].to_pylist(), strict=True)]
            columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
        yield pa.RecordBatch.from_pydict(columns)


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """docs (doc_id, text and any others) with repeated passages cut from their texts; rests of split characters go."""
    held, key, base = fresh(docs, "_found"), fresh(docs, "_key"), fresh(docs, "_base")
    placed = based(docs, "doc_id", "text", base)
    narrow = placed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(base).alias("base"))
    found = repeated_spans(narrow, length).select(F.col("doc_id").alias(key), F.col("spans").alias(held))
    both = placed.join(found.hint("shuffle_hash"), placed["doc_id"] == found[key], "left")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    names = docs.columns
    return both.drop(key).mapInArrow(lambda b: cut_texts(b, names, held, base), kinds)
