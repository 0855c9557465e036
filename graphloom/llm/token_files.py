"""Token ids in files of length-delimited binary records.

A shard holds one record per document in ascending doc_id order (null ids first, ties by the hash of their texts, then by text):
    uint64 length | uint32 masked crc of those 8 bytes | payload | uint32 masked crc of the payload
with all numbers little-endian and payload = int64 doc_id, then the ids in the shard's width (two bytes if the vocabulary
fits, else four). A shard's index file holds a header (magic, width, records) and per record: uint64 offset, int64
doc_id, uint8 whether doc_id is null, uint32 ids; a reader can shuffle records by reading the index alone.

Documents are range-partitioned by doc_id, so each task writes one shard and nothing passes through one task. A task
writes under a name of its own attempt; the manifest lists only shards of attempts that succeeded, so retries and lost
executors leave at most unlisted files of this run's names, which are removed; files of others in the folder stay, but for
manifest.json, which is replaced. The manifest has one row per shard.

Results: null or empty text gives a record with only the end id; repeated rows give repeated records, in any number of shards; an empty table
gives no shard. A text of any length is one record. Broken checksums raise ValueError. Only the named columns are read, so extra ones don't matter.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graphloom.llm.byte_bpe import splitter
from graphloom.llm.common import Kept, new_folder, slices, texts

MAGIC = b"GLTOKEN1"
HEAD, INDEX = struct.Struct("<QI"), np.dtype([("offset", "<u8"), ("doc_id", "<i8"), ("null", "u1"), ("ids", "<u4")])
MANIFEST = "shard int, path string, index string, width int, records long, tokens long"


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted, so that checksums of data that hold checksums stay useful."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def read_frame(stream) -> bytes | None:
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("record cut short")
    length, crc = HEAD.unpack(head)
    if masked(head[:8]) != crc:
        raise ValueError("a record's length has a wrong checksum")
    body = stream.read(length + 4)
    if len(body) < length + 4 or masked(body[:length]) != struct.unpack("<I", body[length:])[0]:
        raise ValueError("a record's payload has a wrong checksum")
    return body[:length]


def store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: its own if printable, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class Added:
    """Finds texts that may hold a token added to a vocabulary (special ones too), which the library takes out before anything else. Tokens that are matched in normalized text are looked for there."""

    def __init__(self, library: Tokenizer):
        tokens, self.normalizer = library.get_added_tokens_decoder().values(), library.normalizer
        self.plain = [t.content for t in tokens if not t.normalized]
        given = [t.content for t in tokens if t.normalized]
        self.normal = [self.normalizer.normalize_str(x) for x in given] if self.normalizer else given

    def within(self, text: str) -> bool:
        if any(x in text for x in self.plain):
            return True
        if not self.normal:
            return False
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        return any(x in normal for x in self.normal)


class PieceEncoder:
    """The library's ids of a text, pre-token by pre-token; those of a pre-token don't depend on its neighbours and are kept. Texts with added tokens go through the library whole."""

    def __init__(self, path: str, pattern: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = self.library = Tokenizer.from_file(path)
        self.added = Added(library)
        self.model, self.split, self.kept = library.model, splitter(pattern).findall, Kept(most)
        self.width = 2 if library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.shown, self.kind = byte_characters(), f"<{'H' if self.width == 2 else 'I'}"

    def found(self, pieces: list[str]) -> Iterator[bytes]:
        for piece in pieces:
            tokens = self.model.tokenize(piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.shown))
            yield struct.pack(f"<{len(tokens)}{self.kind[1]}", *[t.id for t in tokens])

    def packed(self, text: str) -> bytes:
        """The ids, packed to width."""
        if self.added.within(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, f"<u{self.width}").tobytes()
        pieces = self.split(text)
        return b"".join(map(self.kept.of(pieces, self.found).__getitem__, pieces))


@lru_cache(maxsize=2)
def piece_encoder(path: str, pattern: str) -> PieceEncoder:
    return PieceEncoder(path, pattern)


def write(docs: DataFrame, folder: str, path: str, pattern: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> list[dict]:
    """Write docs' ids to shards in folder; returns the manifest, ordered, one entry per shard that has records."""
    mark = f"shard-{uuid.uuid4().hex[:12]}-"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, task = piece_encoder(path, pattern), TaskContext.get()
        end = np.array([end_id], f"<u{of.width}").tobytes()
        files, base = store(folder)
        name = f"{base}/{mark}{task.partitionId():06d}-{task.taskAttemptId()}"
        index, records, out, tokens = [], None, None, 0
        for batch in slices(batches, text):
            if out is None:
                files.create_dir(base, recursive=True)
                out, records = files.open_output_stream(f"{name}.rec", buffer_size=1 << 20), 0
            framed = []
            for doc_id, x in zip(batch.column(key).to_pylist(), texts(batch, text), strict=True):
                ids = of.packed(x) + end
                record = frame(struct.pack("<q", doc_id or 0) + ids)
                index.append((records, doc_id or 0, doc_id is None, len(ids) // of.width))
                framed.append(record)
                records += len(record)
                tokens += len(ids) // of.width
            out.write(b"".join(framed))
        if out is not None:
            out.close()
            with files.open_output_stream(f"{name}.idx") as to:
                to.write(MAGIC + struct.pack("<IQ", of.width, len(index)) + np.array(index, INDEX).tobytes())
            listed = {"shard": [task.partitionId()], "path": [f"{name}.rec"], "index": [f"{name}.idx"], "width": [of.width], "records": [len(index)], "tokens": [tokens]}
            yield pa.RecordBatch.from_pydict(listed, pa.schema([("shard", pa.int32()), ("path", pa.string()), ("index", pa.string()), ("width", pa.int32()), ("records", pa.int64()), ("tokens", pa.int64())]))

    place = F.xxhash64(text)  # so that many rows of one id are many shards; short, as the driver samples what ranges are cut by
    ordered = docs.select(key, text).repartitionByRange(F.col(key), place).sortWithinPartitions(F.col(key), place, F.col(text))
    manifest = sorted((r.asDict() for r in ordered.mapInArrow(run, MANIFEST).collect()), key=lambda r: r["shard"])
    files, base = store(folder)
    listed = {p for r in manifest for p in (r["path"], r["index"])}
    for info in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        if info.base_name.startswith(mark) and info.path not in listed:
            files.delete_file(info.path)
    if manifest:
        with files.open_output_stream(f"{base}/manifest.json") as to:
            to.write(json.dumps(manifest).encode())
    return manifest


def read(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record, from the files; start: ids in all records before it."""
    shards, base = [], 0
    for r in manifest:
        shards.append((r["path"], r["index"], base))
        base += r["tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = store(folder)

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "start", "n_tokens", "ids"])

        for batch in batches:
            for path, index, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input_stream(index) as of:
                    if of.read(8) != MAGIC:
                        raise ValueError(f"{index} is no index")
                    width, _ = struct.unpack("<IQ", of.read(12))
                    entries = np.frombuffer(of.read(), INDEX)
                rows, held = [], 0
                with files.open_input_stream(path, buffer_size=1 << 20) as of:
                    for entry in entries:
                        payload = read_frame(of)
                        ids = np.frombuffer(payload, f"<u{width}", offset=8).astype("<u4").tobytes()
                        if len(ids) != 4 * entry["ids"]:
                            raise ValueError(f"{path} doesn't match its index")
                        rows.append((None if entry["null"] else struct.unpack("<q", payload[:8])[0], start, len(ids) // 4, ids))
                        start, held = start + len(ids) // 4, held + len(ids)
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    listed = spark.createDataFrame(shards, "path string, index string, start long").repartition(max(1, len(shards)))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, path: str, pattern: str, end_id: int = 0) -> DataFrame:
    """Write docs and read the files back; `ids` are little-endian unsigned 32-bit."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    return read(spark, folder, write(docs, folder, path, pattern, end_id))
