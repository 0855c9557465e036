"""Media columns: lossless 8-bit audio and its features.

store() keeps bytes as the samples of a mono 8-bit PCM WAV; features() reads the stored bytes back and computes a
polyphase resampling by up/down (windowed-sinc low pass, one filter branch per output phase), log-mel filterbanks over
overlapping Hann frames, cut into tensors of fixed shape (frames, mels) kept as an Arrow stream with a fixed-shape tensor
column and time spans, and segments of high energy by hysteresis (a segment begins at or above the upper threshold and
ends below the lower one; both are set against the median frame). summarized() reads the stored tensors and sums them up. kept() writes
the recordings as one table and the tensors with their segments as another, each read back before the next step.

Results: null or empty text is a payload of 64 zero bytes; silence has no segments; the last tensor is filled up with the
floor level. A text of any length is one recording. Equal bytes give equal results: each text is computed by itself, repeated rows
give repeated rows, null ids stay. An empty table gives no rows. Bytes that are no such WAV raise an error. store() reads only the named
columns; features() and summarized() keep all they are given, and a result column whose name is taken gets an underscore.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import fresh, materialize, slices

FLOOR = -10.0
SEGMENTS = "array<struct<start_s:double,end_s:double>>"


def padded(data: bytes, unit: int = 64) -> bytes:
    return data + bytes(-len(data) % unit if data else unit)


def to_wav(payload: bytes, rate: int) -> bytes:
    with wave.open(out := io.BytesIO(), "wb") as to:
        to.setnchannels(1)
        to.setsampwidth(1)
        to.setframerate(rate)
        to.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> tuple[bytes, int]:
    with wave.open(io.BytesIO(media), "rb") as of:
        return of.readframes(of.getnframes()), of.getframerate()


@lru_cache(maxsize=8)
def low_pass(up: int, down: int, half: int = 6) -> np.ndarray:
    """Row p: the taps that make outputs of phase p."""
    widest = max(up, down)
    n = np.arange(-half * widest, half * widest + 1)
    taps = np.sinc(n / widest) * np.hanning(len(n) + 2)[1:-1]
    taps = taps / taps.sum() * up
    taps = np.pad(taps, (0, -len(taps) % up))
    return np.ascontiguousarray(taps.reshape(-1, up).T[:, ::-1], np.float32)


def resample(x: np.ndarray, up: int, down: int, block: int = 1 << 15) -> np.ndarray:
    """Output m is at input time m * down / up; zeros outside."""
    bank = low_pass(up, down)
    width = bank.shape[1]
    delay = 6 * max(up, down)
    out = np.empty(-(-len(x) * up // down), np.float32)
    data = np.concatenate([np.zeros(width, np.float32), x.astype(np.float32), np.zeros(width + delay, np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(data, width)
    for phase in range(up):
        at = np.arange(phase, len(out), up)
        for k in range(0, len(at), block):
            t = at[k : k + block] * down + delay
            branch = int(t[0] % up) if len(t) else 0
            out[at[k : k + block]] = windows[t // up + 1] @ bank[branch]
    return out


@lru_cache(maxsize=8)
def mel_bank(rate: float, frame: int, mels: int) -> np.ndarray:
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, mels + 2) / 2595) - 1)
    at = np.fft.rfftfreq(frame, 1 / rate)[:, None]
    return np.maximum(0, np.minimum((at - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - at) / (edges[2:] - edges[1:-1])))


def log_mel(x: np.ndarray, rate: float, frame: int, hop: int, mels: int, block: int = 4096) -> np.ndarray:
    count = max(1, -(-(len(x) - frame) // hop) + 1)
    x = np.pad(x, (0, max(0, (count - 1) * hop + frame - len(x))))
    frames = np.lib.stride_tricks.sliding_window_view(x, frame)[::hop]
    window, bank, out = np.hanning(frame), mel_bank(rate, frame, mels), np.empty((count, mels), np.float32)
    for k in range(0, count, block):
        power = np.abs(np.fft.rfft(frames[k : k + block] * window)) ** 2
        out[k : k + block] = np.log10(np.maximum(power @ bank, 10**FLOOR))
    return out


def hysteresis(level: np.ndarray, high: float, low: float) -> list[tuple[int, int]]:
    """[begin, end) of frames: begun at >= high, ended at < low."""
    mark = np.where(level >= high, 1, np.where(level < low, 0, -1))
    known = np.maximum.accumulate(np.where(mark >= 0, np.arange(len(mark)), -1))
    on = np.where(known >= 0, mark[known], 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def tensors(values: np.ndarray, frames: int, hop_s: float, frame_s: float) -> bytes:
    """An Arrow stream of tensors (frames, mels) with their time spans; its schema says how many frames there are and how far apart."""
    count, mels = values.shape
    held = -(-count // frames)
    full = np.full((held * frames, mels), FLOOR, np.float32)
    full[:count] = values
    first = np.arange(held) * frames
    last = np.minimum(first + frames, count) - 1
    kind = pa.fixed_shape_tensor(pa.float32(), (frames, mels))
    column = pa.ExtensionArray.from_storage(kind, pa.FixedSizeListArray.from_arrays(full.reshape(-1), frames * mels))
    batch = pa.RecordBatch.from_arrays([column, pa.array(first * hop_s), pa.array(last * hop_s + frame_s)], names=["log_mel", "start_s", "end_s"])
    batch = batch.replace_schema_metadata({"frames": str(count), "hop_s": repr(hop_s)})
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as to:
        to.write_batch(batch)
    return out.getvalue()


def read_tensors(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def frames_of(data: bytes) -> tuple[np.ndarray, float]:
    """(log-mel values of all frames, seconds between frames) of stored tensors, without what fills up the last one."""
    table = read_tensors(data)
    column = table.column("log_mel").combine_chunks()
    values = column.storage.flatten().to_numpy().reshape(-1, column.type.shape[1])
    return values[: int(table.schema.metadata[b"frames"])], float(table.schema.metadata[b"hop_s"])


def summary(data: bytes, spans: list[dict]) -> str:
    """A text about stored tensors and segments; equal ones have equal texts."""
    values, hop_s = frames_of(data)
    level = 10 * values.mean(1, dtype=np.float64)
    frame_s = float(read_tensors(data).column("end_s")[0].as_py()) - (min(len(values), read_tensors(data).column("log_mel").type.shape[0]) - 1) * hop_s
    high = sum(round((s["end_s"] - s["start_s"] - frame_s) / hop_s) + 1 for s in spans)
    means = ",".join(f"{x:.2f}" for x in values.mean(0, dtype=np.float64))
    return f"frames={len(values)};segments={len(spans)};high={high};level_db={np.median(level):.2f};mel={means}"


def describe(payload: bytes, rate: int, up: int, down: int, frame: int, hop: int, mels: int, frames: int) -> tuple[bytes, list[dict]]:
    x = resample((np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128, up, down)
    new_rate = rate * up / down
    values = log_mel(x, new_rate, frame, hop, mels)
    level = 10 * values.mean(1, dtype=np.float64)
    middle = float(np.median(level))
    segments = hysteresis(level, middle + 1.0, middle - 0.5) if level.max() > 10 * FLOOR else []
    spans = [{"start_s": a * hop / new_rate, "end_s": ((b - 1) * hop + frame) / new_rate} for a, b in segments]
    return tensors(values, frames, hop / new_rate, frame / new_rate), spans


def store(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: int = 8000) -> DataFrame:
    """(key, n_bytes, media) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([len(x) for x in data], pa.int64()), pa.array([to_wav(padded(x), rate) for x in data], pa.binary())], names=[key, "n_bytes", "media"])

    narrow = docs.select(key, text)
    return narrow.mapInArrow(run, f"{key} {narrow.schema[key].dataType.simpleString()}, n_bytes long, media binary")


def features(stored: DataFrame, up: int = 2, down: int = 5, frame: int = 256, hop: int = 128, mels: int = 20, frames: int = 32) -> DataFrame:
    """stored with payload (read back), tensors and segments."""
    names, made = stored.columns, [fresh(stored, name) for name in ("payload", "tensors", "segments")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    spans = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            read = [from_wav(x) for x in batch.column("media").to_pylist()]
            found = [describe(x, rate, up, down, frame, hop, mels, frames) for x, rate in read]
            columns = [pa.array([x for x, _ in read], pa.binary()), pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], spans)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, *made])

    return stored.mapInArrow(run, f"{kinds}, {made[0]} binary, {made[1]} binary, {made[2]} {SEGMENTS}")


def summarized(described: DataFrame, tensor: str = "tensors", segments: str = "segments") -> DataFrame:
    """described with feature, a text made from its tensors and segments."""
    name = fresh(described, "feature")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in described.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, tensor):
            found = [summary(data, spans) for data, spans in zip(batch.column(tensor).to_pylist(), batch.column(segments).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, name])

    return described.mapInArrow(run, f"{kinds}, {name} string")


#: How both tables are written: their rows are large, so row groups are small.
WRITTEN = {"compression": "zstd", "parquet.block.size": 16 << 20}


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, tensors, segments, feature) of every text: its recording is written and read back, then its tensors and segments are, and the feature is made from these."""
    media, _ = materialize(store(docs, key, text), "media", **WRITTEN)
    found = features(media)
    shown = found.select(key, "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "tensors", "segments")
    return summarized(materialize(shown, "tensors", **WRITTEN)[0])
