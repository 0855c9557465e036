"""Chats as one token stream in which conversations that share their first turns share those tokens.

Template: a turn is an opening marker, its escaped text and a closing marker; roles without markers of their own are named in the turn. A
control string inside a text gets a backslash after its first character, one that has backslashes there gets one more, so no text
holds a marker and unescaping gives the text back. Markers are tokens of their own, after the vocabulary's; the loss mask covers
the tokens of assistants' texts, without markers.

Prefix tree, without a task that holds a tree or a conversation:

1. Turns are encoded once and written. Light rows (no text) are sorted by conversation and turn; a chained digest names each
   prefix, so equal prefixes are one node, whoever has them.
2. A node belongs to the smallest conversation through it. A conversation's own nodes are the end of its path, a run; those before belong
   to others and are given by the few depths at which the owner changes. Ordered by these (deeper branches first), runs are
   the tree in depth-first order, and running sums of their sizes are the places of all nodes in the stream.
3. A node's subtree ends where the last run through it ends. So a token may be attended from its own place up to there.
4. Tokens are joined to their nodes, once each, and dealt to shards of about `shard_tokens` consecutive tokens, sorted by place. Nodes that
   are open where a shard begins are repeated in it as context, so that every shard can be read alone. A pass with a stack of open nodes
   adds the ancestors' intervals. read_back() walks such a shard with a stack of digests.

Results: null text and null role are empty. Turns are ordered by turn (null first), then role and text: repeated rows are turns too. Rows
without conv_id are one conversation, whose id is null. Conversations equal to others, or beginnings of others, have no tokens of their own
but a member row that names their last node. An empty table gives empty tables. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.byte_bpe import load_ranks
from graphloom.llm.common import materialize, shuffle_partitions
from graphloom.llm.ranks import attach, placed, sums_before


@dataclass(frozen=True)
class Template:
    """Markers by role; named: before the role, between role and text, and after the text of any other role."""

    roles: tuple[tuple[str, str, str], ...] = (("system", "<<SYS>>", "<</SYS>>"), ("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"))
    named: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/TEXT]")
    trained: str = "assistant"

    @property
    def controls(self) -> tuple[str, ...]:
        return (*(marker for _, *pair in self.roles for marker in pair), *self.named)


TEMPLATE = Template()


class Codec:
    """Turns to token ids and back."""

    def __init__(self, template: Template, path: str, pattern: str):
        ranks = load_ranks(path)
        self.template, self.first = template, max(ranks.values(), default=-1) + 1
        self.library = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ids = {c: self.first + i for i, c in enumerate(template.controls)}
        self.marks = dict(map(reversed, self.ids.items()))
        self.pairs = {role: pair for role, *pair in template.roles}
        self.opens = {self.ids[pair[0]]: role for role, pair in self.pairs.items()}
        slashed = "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in template.controls)
        self.plain, self.slashed = re.compile(slashed), re.compile(slashed.replace(r"\\*", r"\\+"))

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.slashed.sub(lambda m: m[0][0] + m[0][2:], text)

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """(ids of the turn, where those of its text begin and end)."""
        pair, body = self.pairs.get(role), self.library.encode_ordinary(self.escape(text))
        if pair:
            head, tail = [self.ids[pair[0]]], self.ids[pair[1]]
        else:
            before, between, after = self.template.named
            head, tail = [self.ids[before], *self.library.encode_ordinary(self.escape(role)), self.ids[between]], self.ids[after]
        return [*head, *body, tail], len(head), len(head) + len(body)

    def decoded(self, ids: list[int]) -> str:
        return self.library.decode_bytes(ids).decode("utf-8")

    def formatted(self, ids: list[int]) -> str:
        """The turn as the template writes it."""
        out, since = [], 0
        for i, token in enumerate(ids):
            if token >= self.first:
                out += [self.decoded(ids[since:i]), self.marks[token]]
                since = i + 1
        return "".join([*out, self.decoded(ids[since:])])

    def parsed(self, formatted: str) -> tuple[str, str]:
        """(role, text) of a formatted turn."""
        for role, (start, end) in self.pairs.items():
            if formatted.startswith(start):
                return role, self.unescape(formatted[len(start) : -len(end)])
        before, between, after = self.template.named
        role, _, text = formatted[len(before) : -len(after)].partition(between)
        return self.unescape(role), self.unescape(text)


@lru_cache(maxsize=2)
def codec(template: Template, path: str, pattern: str) -> Codec:
    return Codec(template, path, pattern)


def arrow(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], names=list(schema))


LONG, INT, IDS = pa.int64(), pa.int32(), pa.list_(pa.int32())
ENCODED = {"row": LONG, "conv": LONG, "turn": LONG, "role": pa.string(), "ids": IDS, "loss_from": INT, "loss_to": INT, "n_tokens": INT, "digest": pa.binary()}
CHAINED = {"row": LONG, "conv": LONG, "depth": LONG, "prefix": pa.binary(), "position": LONG, "n_tokens": INT, "last": pa.bool_()}


def encoded(chats: DataFrame, template: Template, path: str, pattern: str) -> DataFrame:
    """A row for each turn with its ids and a digest of role and text; loss_from to loss_to are the trained tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(template, path, pattern)
        for batch in batches:
            rows = []
            for row, conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, start, end = of.encode(role, text)
                loss = (start, end) if role == template.trained else (0, 0)
                digest = hashlib.sha256(len(role).to_bytes(8, "big") + (role + text).encode()).digest()
                rows.append((row, conv, turn, role, ids, *loss, len(ids), digest[:16]))
            yield arrow(ENCODED, rows)

    numbered = chats.select(F.monotonically_increasing_id(), "conv", F.col("turn").cast("long"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return numbered.mapInArrow(run, "row long, conv long, turn long, role string, ids array<int>, loss_from int, loss_to int, n_tokens int, digest binary")


def chained(turns: DataFrame) -> DataFrame:
    """Light rows with depth, position and the digest of the prefix up to the turn; one row at a time, however long the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv, prefix, depth, position = None, None, b"", 0, 0
        for batch in batches:
            rows = []
            for row, of, digest, n in zip(*(batch.column(c).to_pylist() for c in ("row", "conv", "digest", "n_tokens")), strict=True):
                if of != conv:
                    conv, prefix, depth, position = of, b"", 0, 0
                if held:
                    rows.append((*held, held[1] != of))
                prefix = hashlib.sha256(prefix + digest).digest()[:16]
                held = (row, of, depth, prefix, position, n)
                depth, position = depth + 1, position + n
            yield arrow(CHAINED, rows)
        if held:
            yield arrow(CHAINED, [(*held, True)])

    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    light = turns.select("row", "conv", "turn", "role", "digest", "n_tokens").repartition("conv").sortWithinPartitions(*order)
    return light.mapInArrow(run, "row long, conv long, depth long, prefix binary, position long, n_tokens int, last boolean")


def owners(chain: DataFrame) -> DataFrame:
    """chain, a written table, with the smallest conversation through each prefix."""
    totals, _ = materialize(chain.groupBy("prefix").agg(F.count("*").alias("n"), F.min("conv").alias("owner")), "owners")
    return materialize(attach(chain, totals, "prefix", chain.count()), "paths")[0]


def runs(paths: DataFrame) -> DataFrame:
    """(conv, base, size, before): for each conversation with nodes of its own the place of their tokens in depth-first order, their number, and its tokens before them."""
    spans = paths.groupBy("conv", "owner").agg(F.min("depth").alias("depth"), F.sum("n_tokens").alias("size"), F.min("position").alias("before"))
    own = F.col("owner") == F.col("conv")
    bend = F.struct((-F.col("depth")).alias("up"), "owner")  # of two branches of one path the deeper comes first, of two at one depth the smaller owner
    found = spans.groupBy("conv").agg(F.sort_array(F.collect_list(bend), asc=False).alias("bends"), F.max(F.when(own, F.col("size"))).alias("size"), F.max(F.when(own, F.col("before"))).alias("before"))
    return materialize(sums_before(placed(found.where("size is not null"), "bends", tag="runs"), "size", "base").select("conv", "base", "size", "before"), "runs")[0]


def nodes(paths: DataFrame, places: DataFrame) -> DataFrame:
    """A row for each prefix: its turn's row, its first token's place, position and depth, and the end of its subtree."""
    own = F.col("owner") == F.col("conv")
    mine = lambda c: F.max(F.when(own, c))
    met = paths.join(places, "conv")
    return met.groupBy("prefix").agg(mine(F.col("base") + F.col("position") - F.col("before")).alias("start"), F.max(F.col("base") + F.col("size")).alias("until"), mine(F.col("row")).alias("row"), F.min("depth").alias("depth"), F.min("position").alias("position"), F.min("n_tokens").alias("n_tokens"))


@dataclass
class Tree:
    """stream: rows of shards, in order within each partition, see walk(). members: (conv_id, node), node being the start of the last turn."""

    stream: DataFrame
    members: DataFrame


@dataclass
class Open:
    """A node on the stack: seen are the intervals from the root up to its own end."""

    start: int
    end: int
    seen: list = field(default_factory=list)


STREAM = {"shard": LONG, "context": pa.bool_(), "start": LONG, "until": LONG, "position": LONG, "depth": LONG, "role": pa.string(), "ids": IDS, "loss_from": INT, "loss_to": INT, "ancestors": pa.list_(pa.struct([("start", LONG), ("end", LONG)]))}
STREAM_SQL = "shard long, context boolean, start long, until long, position long, depth long, role string, ids array<int>, loss_from int, loss_to int, ancestors array<struct<start: long, end: long>>"


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shards in order, with the intervals of the stream that the node's ancestors fill: its tokens attend to these and to those before them in the node.

    A token's position id is the row's position plus its place in ids; a token of an earlier node is attended to from its own place up to that node's `until`."""
    shard, stack = None, []
    for batch in batches:
        rows = []
        for of, context, start, until, position, depth, role, ids, loss_from, loss_to in zip(*(batch.column(c).to_pylist() for c in list(STREAM)[:-1]), strict=True):
            if of != shard:
                shard, stack = of, []
            del stack[depth:]
            if len(stack) != depth:
                raise ValueError(f"shard {of}: the node at {start} lacks its context")
            before = stack[-1].seen if stack else []
            end = start + len(ids)
            joined = before and before[-1][1] == start
            stack.append(Open(start, end, [*before[:-1], (before[-1][0], end)] if joined else [*before, (start, end)]))
            rows.append((of, context, start, until, position, depth, role, ids, loss_from, loss_to, [{"start": a, "end": b} for a, b in before]))
        yield arrow(STREAM, rows)


def merge(chats: DataFrame, path: str, pattern: str, template: Template = TEMPLATE, shard_tokens: int = 1 << 20, key: str = "conv_id") -> Tree:
    """The prefix tree of chats (conv_id, turn, role, text). path: ranks of a byte-level vocabulary, with the pattern of its pre-tokens."""
    bounds = chats.agg(F.max(key).alias("most"), F.min(key).alias("least")).first()
    most, least = (bounds["most"], bounds["least"]) if bounds["most"] is not None else (0, 0)
    free = most + 1 if most < (1 << 63) - 1 else least - 1  # stands for null
    turns, _ = materialize(encoded(chats.withColumn("conv", F.coalesce(F.col(key).cast("long"), F.lit(free).cast("long"))), template, path, pattern), "turns")
    paths = owners(materialize(chained(turns), "chain")[0])
    places = runs(paths)
    found, _ = materialize(nodes(paths, places), "nodes")
    shard = F.expr(f"start div {shard_tokens}")
    light = found.select("row", "start", "until", "position", "depth", "n_tokens")
    here = light.withColumn("shard", shard).withColumn("context", F.lit(False))
    later = light.withColumn("to", F.expr(f"(until - 1) div {shard_tokens}")).where(F.col("to") > shard)
    again = later.select(*light.columns, F.explode(F.sequence(shard + 1, "to")).alias("shard")).withColumn("context", F.lit(True))
    starts = here.groupBy("shard").agg(F.min("start").alias("first"))
    again = again.join(starts, "shard").where("until > first").drop("first")  # shards in which no node begins need no context
    placed_rows = here.unionByName(again).drop("n_tokens").join(turns.select("row", "role", "ids", "loss_from", "loss_to"), "row")
    total = found.agg(F.max("until")).first()[0] or 0
    tasks = max(shuffle_partitions(chats.sparkSession), -(-total // shard_tokens))
    stream = placed_rows.select(*list(STREAM)[:-1]).repartition(tasks, "shard").sortWithinPartitions("shard", "start").mapInArrow(walk, STREAM_SQL)
    ends = paths.where("last").select("conv", "prefix")
    counted, _ = materialize(ends.groupBy("prefix").agg(F.count("*").alias("n")).join(found.select("prefix", F.col("start").alias("node")), "prefix"), "ends")
    members = attach(ends, counted, "prefix", ends.count())
    return Tree(stream, members.select(F.when(F.col("conv") != free, F.col("conv")).alias(key), "node"))


READ = {"node": LONG, "n_turns": LONG, "turns_sha256": pa.string(), "loss_chars": LONG, "loss_sha256": pa.string(), "formatted_chars": LONG}


def read_back(stream: DataFrame, path: str, pattern: str, template: Template = TEMPLATE) -> DataFrame:
    """For each node of a stream (rows of a shard in one partition and in order) what the conversation up to it says, read from tokens and mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, shard, stack = codec(template, path, pattern), None, []
        for batch in batches:
            rows = []
            for at, context, start, depth, ids, low, high in zip(*(batch.column(c).to_pylist() for c in ("shard", "context", "start", "depth", "ids", "loss_from", "loss_to")), strict=True):
                if at != shard:
                    shard, stack = at, []
                del stack[depth:]
                turns, said, loss_chars, chars = stack[-1] if stack else (hashlib.sha256(), hashlib.sha256(), 0, 0)
                turns, said = turns.copy(), said.copy()
                formatted = of.formatted(ids)
                turns.update("{}\n{}\n".format(*of.parsed(formatted)).encode())
                loss = of.unescape(of.decoded(ids[low:high]))
                said.update(loss.encode())
                stack.append((turns, said, loss_chars + len(loss), chars + len(formatted)))
                if not context:
                    rows.append((start, depth + 1, turns.hexdigest(), stack[-1][2], said.hexdigest(), stack[-1][3]))
            yield arrow(READ, rows)

    return stream.mapInArrow(run, "node long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversations(tree: Tree, path: str, pattern: str, template: Template = TEMPLATE, key: str = "conv_id") -> DataFrame:
    """What every conversation of the tree says, read back; columns as in read_back(), without node."""
    members, _ = materialize(tree.members, "members")
    said = read_back(tree.stream, path, pattern, template)
    totals, _ = materialize(members.groupBy("node").agg(F.count("*").alias("n")).join(said, "node"), "said")
    return attach(members, totals, "node", members.count()).drop("node")
