"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Encoding. Merge ranks are compiled into a trie of token bytes. The (nondeterministic) transducer reads one byte at a
time; a configuration is (last finished token, trie node of the token being read, tokens not emitted yet). A token may
follow another only if the two, merged by rank, stay apart; a sequence all of whose neighbours stay apart is exactly the
result of the merges, so one configuration at most stands at a token's end after each byte. Sets of configurations are
determinised when first met (subset construction with delayed output): what all configurations agree on is emitted, the
rest waits, at most until the longest token has passed. Configurations that allow the same tokens are one, and those that allow none are dropped.
States and transitions are kept between texts in a bounded table (beyond it, sets are followed without being kept), like
the results for whole pre-tokens.

Decoding. Token bytes run through an incremental UTF-8 machine whose transitions by token are also filled in on demand:
complete characters leave at once, an unfinished tail (three bytes at most) is the machine's state.

Results: null text is empty text and has no ids; ids outside the vocabulary raise ValueError; null ids decode as empty;
a malformed tail or sequence keeps its bytes in `decoded` and becomes U+FFFD in decoded text. Repeated rows give
repeated rows, an empty table none. A text of any length is encoded whole. Only the named columns are read, so extra columns don't matter.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from graphloom.llm.common import Kept, fresh, slices, texts


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


#: Nodes with so many tokens below tell configurations apart by what they allow; an item that allows nothing is dropped.
FEW, DEAD = 12, -2


class Transducer:
    """Byte-level BPE of one pre-token at a time."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = 80_000, most_pieces: int = 300_000, most_pairs: int = 120_000):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.most_states, self.most_pairs = most_states, most_pairs
        self.child: dict[int, int] = {}  # node << 8 | byte -> node; 0 is the root
        self.ends: list[int] = [-1]  # the token that ends at a node
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.child.get(node << 8 | byte) or self._grow(node, byte)
            self.ends[node] = rank
        self.steps: list[list[int]] = [[] for _ in self.ends]
        for key, node in self.child.items():
            self.steps[key >> 8].append(node)
        self.below = [0] * len(self.ends)  # how many tokens go on from a node
        for token in ranks:
            node = 0
            for byte in token[:-1]:
                node = self.child[node << 8 | byte]
                self.below[node] += 1
        self.same: dict[int, int] = {}  # last << 32 | node -> a token that stands for last there
        self.stands_for: dict[tuple[int, tuple[int, ...]], int] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.apart: dict[int, bool] = {}  # left << 32 | right
        self.kept = Kept(most_pieces)
        start = ((-1, 0, ()),)
        self.states, self.members, self.moves = {start: 0}, [start], {}

    def _grow(self, node: int, byte: int) -> int:
        self.ends.append(-1)
        self.child[node << 8 | byte] = len(self.ends) - 1
        return len(self.ends) - 1

    def merged(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """The merges by rank themselves, those below a rank; for single tokens only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if self.ranks.get(parts[best] + parts[best + 1], below) >= below:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[x] for x in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes the token; None for a byte, or if the merges never make it."""
        if token not in self.halves:
            data = self.token[token]
            last = self.merged(data, token) if len(data) > 1 else []
            self.halves[token] = (last[0], last[1]) if len(last) == 2 and self.merged(data) == [token] else None
        return self.halves[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether right may follow left; left -1 asks whether the merges can make right at all.

        The merges of both sides are undone, the latest first; at each moment the tokens that face each other must not
        have been the next to merge.
        """
        if len(self.token[right]) > 1 and self.parts(right) is None:
            return False
        if left < 0:
            return True
        key = left << 32 | right
        found = self.apart.get(key)
        if found is not None:
            return found
        if len(self.apart) >= self.most_pairs:
            self.apart.clear()
        ranks, token, a, b, limit, found = self.ranks, self.token, left, right, 1 << 60, True
        while True:
            if ranks.get(token[a] + token[b], limit) < limit:
                found = False
                break
            split_a, split_b = self.parts(a), self.parts(b)
            if split_a and (not split_b or a > b):
                limit, a = a, split_a[1]
            elif split_b:
                limit, b = b + 1, split_b[0]
            else:
                break
        self.apart[key] = found
        return found

    def _below(self, node: int) -> list[int]:
        """The tokens that go on from a node."""
        found, todo = [], [node]
        while todo:
            at = todo.pop()
            for step in self.steps[at]:
                todo.append(step)
                if self.ends[step] >= 0:
                    found.append(self.ends[step])
        return found

    def _alike(self, last: int, node: int) -> int:
        """A token that allows the same tokens below node as last does; DEAD if none is allowed. Below busy nodes, last itself."""
        if len(self.same) >= self.most_pairs:
            self.same.clear()
            self.stands_for.clear()
        found = last
        if self.below[node] <= FEW:
            allowed = tuple(t for t in self._below(node) if self.stay_apart(last, t))
            found = self.stands_for.setdefault((node, allowed), last) if allowed else DEAD
        self.same[last << 32 | node] = found
        return found

    def _step(self, members: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """The configurations after a byte, and what all of them agree to emit."""
        reached, child, ends, alike = [], self.child, self.ends, self.same
        for last, node, waiting in members:
            step = child.get(node << 8 | byte)
            if step is None:
                continue
            held = alike.get(last << 32 | step)
            if held is None:
                held = self._alike(last, step)
            if held != DEAD:
                reached.append((held, step, waiting))
            token = ends[step]
            if token >= 0 and self.stay_apart(last, token):
                reached.append((token, 0, (*waiting, token)))
        shared = reached[0][2]
        for _, _, waiting in reached:
            while waiting[: len(shared)] != shared:
                shared = shared[:-1]
            if not shared:
                break
        if shared:
            reached = [(last, node, waiting[len(shared) :]) for last, node, waiting in reached]
        reached.sort()
        return tuple(reached), shared

    @staticmethod
    def _rest(members: tuple) -> tuple[int, ...]:
        """What is left to emit at the end: the tokens of the configuration that stands at a token's end."""
        return next(waiting for _, node, waiting in members if node == 0)

    def transduce(self, data: bytes) -> list[int]:
        state, out, at, moves = 0, [], 0, self.moves
        while at < len(data):
            step = moves.get(state << 8 | data[at])
            if step is None:
                members, emitted = self._step(self.members[state], data[at])
                target = self.states.get(members)
                if target is None and len(self.members) < self.most_states:
                    target = self.states[members] = len(self.members)
                    self.members.append(members)
                if target is None:  # the table is full: go on without it until a known state
                    while target is None:
                        out += emitted
                        at += 1
                        if at == len(data):
                            out += self._rest(members)
                            return out
                        members, emitted = self._step(members, data[at])
                        target = self.states.get(members)
                    out += emitted
                    state, at = target, at + 1
                    continue
                step = moves[state << 8 | data[at]] = target, emitted
            state, emitted = step
            if emitted:
                out += emitted
            at += 1
        out += self._rest(self.members[state])
        return out

    def found(self, pieces: list[str]) -> Iterator[tuple[int, ...]]:
        for piece in pieces:
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            yield (whole,) if whole is not None else tuple(self.transduce(data))


class Utf8Machine:
    """Incremental UTF-8: the state is an unfinished character's bytes; moves by token are kept."""

    def __init__(self, token: dict[int, bytes]):
        self.token = token
        self.tails, self.numbers = [b""], {b"": 0}
        self.moves: dict[int, tuple[int, bytes]] = {}

    @staticmethod
    def cut(data: bytes) -> int:
        """Where an unfinished character at the end of data begins; len(data) if there is none."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 4 if 0xF0 <= byte <= 0xF4 else 3 if byte >= 0xE0 else 2 if byte >= 0xC2 else 1
            return len(data) - back if byte < 0xF5 and need > back else len(data)
        return len(data)

    def _move(self, state: int, token: int) -> tuple[int, bytes]:
        if token not in self.token:
            raise ValueError(f"id {token} is not in the vocabulary")
        data = self.tails[state] + self.token[token]
        at = self.cut(data)
        tail = data[at:]
        if tail not in self.numbers:
            self.numbers[tail] = len(self.tails)
            self.tails.append(tail)
        if len(self.moves) > 2_000_000:
            self.moves.clear()
        found = self.moves[state << 32 | token] = self.numbers[tail], data[:at]
        return found

    def chunks(self, ids) -> Iterator[bytes]:
        """Whole characters as soon as they are complete, then what is left."""
        state, moves = 0, self.moves
        for token in ids:
            step = moves.get(state << 32 | token)
            if step is None:
                step = self._move(state, token)
            state, chunk = step
            yield chunk
        if state:
            yield self.tails[state]


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    return Transducer(load_ranks(path))


@lru_cache(maxsize=4)
def machine(path: str) -> Utf8Machine:
    return Utf8Machine({rank: token for token, rank in load_ranks(path).items()})


LATIN = {rf"\{c}": "".join(x if x.isalnum() or ord(x) > 127 else f"\\x{ord(x):02x}" for x in map(chr, range(256)) if regex.match(rf"\{c}", x)) for c in ("p{L}", "p{N}", "s")}


def latin_pattern(pattern: str) -> str | None:
    """The same pattern for texts of the first 256 characters, without properties, for the faster re; None if it has others."""
    out, at, inside = "", 0, False
    while at < len(pattern):
        name = next((n for n in LATIN if pattern.startswith(n, at)), None)
        if name:
            out, at = out + (LATIN[name] if inside else f"[{LATIN[name]}]"), at + len(name)
        elif pattern.startswith(r"\S", at) and not inside:
            out, at = out + rf"[^{LATIN[r'\s']}]", at + 2
        elif pattern[at] == "\\":
            return None
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out, at = out + pattern[at], at + 1
    return out


@lru_cache(maxsize=8)
def matched(pattern: str) -> frozenset[str]:
    """The characters that the library's own tables match with a pattern of one character."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    library = tiktoken.Encoding("characters", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return frozenset(bytes(library.encode_ordinary(every)).decode())


def ranges(characters: frozenset[str]) -> str:
    """The characters as the inside of a set of a pattern."""
    codes = sorted(map(ord, characters))
    starts = [c for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    ends = [c for k, c in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True))


class Splitter:
    """findall() of a pattern with the library's tables of letters and digits, which may be of another Unicode version than the module's: by the fastest of three ways that give the same for a text."""

    def __init__(self, pattern: str):
        self.pattern, self.all = pattern, regex.compile(pattern).findall
        latin = latin_pattern(pattern)
        self.latin = re.compile(latin).findall if latin else None

    @cached_property
    def odd(self):
        """Searches for characters whose class differs between library and module."""
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        found = frozenset().union(*(matched(c) ^ frozenset(regex.findall(c, every)) for c in (r"\p{L}", r"\p{N}", r"\s")))
        return re.compile(f"[{ranges(found)}]").search if found else lambda text: None

    @cached_property
    def exact(self):
        """The pattern with the library's letters and digits spelt out; white space is the same in both."""
        out, at, inside = "", 0, False
        while at < len(self.pattern):
            name = next((c for c in (r"\p{L}", r"\p{N}") if self.pattern.startswith(c, at)), None)
            if name:
                spelt = ranges(matched(name))
                out, at = out + (spelt if inside else f"[{spelt}]"), at + len(name)
                continue
            step = 2 if self.pattern[at] == "\\" else 1
            inside = step == 1 and (self.pattern[at] == "[" or inside and self.pattern[at] != "]") or step == 2 and inside
            out, at = out + self.pattern[at : at + step], at + step
        return regex.compile(out).findall

    def findall(self, text: str) -> list[str]:
        if self.latin:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.exact(text) if self.odd(text) else self.all(text)
            return self.latin(text)
        return self.exact(text) if self.odd(text) else self.all(text)


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Splitter:
    return Splitter(pattern)


def encode_text(text: str, path: str, pattern: str) -> list[int]:
    of, pieces = transducer(path), splitter(pattern).findall(text)
    return list(chain.from_iterable(map(of.kept.of(pieces, of.found).__getitem__, pieces)))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every whole text. path: ranks file, readable on every executor; pattern: pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            ids = [encode_text(x, path, pattern) for x in texts(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    narrow = docs.select(key, text)
    return narrow.mapInArrow(run, f"{key} {narrow.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """encoded with `decoded` binary (an underscore more if it has that): the ids' bytes, through the UTF-8 machine."""
    kept, made = encoded.schema, fresh(encoded, "decoded")
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = machine(path)
        for batch in slices(batches, ids, 4 << 20):
            out = [b"".join(of.chunks(x or ())) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, made])

    return encoded.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in kept)}, {made} binary")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): encode() and decode() in one pass, so that a task needs one Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = machine(path)
        for batch in slices(batches, text, 4 << 20):
            ids = [encode_text(x, path, pattern) for x in texts(batch, text)]
            decoded = pa.array([b"".join(of.chunks(x)) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(ids, pa.list_(pa.int32())), decoded], names=[key, "ids", "decoded"])

    narrow = docs.select(key, text)
    return narrow.mapInArrow(run, f"{key} {narrow.schema[key].dataType.simpleString()}, ids array<int>, decoded binary")


def decode_text(ids, path: str) -> str:
    return b"".join(machine(path).chunks(ids)).decode("utf-8", "replace")
