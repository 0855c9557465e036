"""Manifests, vector codes and chats against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.llm import chat, merkle, ranks, vector_codes
from graphloom.llm.common import materialize

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, idx long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes, fanout):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + fanout])) for i in range(0, len(found[-1]), fanout)])
    return found


def proof_of(levels, i, fanout):
    siblings = []
    for level in levels[:-1]:
        run = i - i % fanout
        siblings.append((level[run:i], level[i + 1 : run + fanout]))
        i //= fanout
    return siblings


def brute_manifest(docs, fanout=3):
    groups = {}
    for d, text, lang, source, n, *_ in docs:
        changed = text.replace("\n", "") if text is not None and d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else text
        groups.setdefault(source, []).append((d is not None, d or 0, framed(d, source, lang, n, text), framed(d, source, lang, n, changed)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(groups[s])], fanout) for s in order}
    top = levels_of([trees[s][-1][0] for s in order], fanout)
    rows = []
    for k, s in enumerate(order):
        for i, (known, d, leaf, changed) in enumerate(sorted(groups[s])):
            proof = proof_of(trees[s], i, fanout) + proof_of(top, k, fanout)
            node = changed
            for before, after in proof:
                node = sha("".join([*before, node, *after]))
            rows.append((d if known else None, leaf, trees[s][-1][0], top[-1][0], sha("".join(x for b, a in proof for x in [*b, *a])), node))
    return sorted(rows, key=repr)


def manifest_rows(spark, docs, levels):
    even = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.lit(False))
    made = merkle.of_documents(spark.createDataFrame(docs, DOCS), lambda t: F.when(even, F.replace(t, F.lit("\n"), F.lit(""))).otherwise(t), levels=levels)
    side = F.col("left"), F.col("right")
    return sorted((tuple(r) for r in made.select("key", "node", "subroot", "root", merkle.proof_digest(*side), merkle.folded(F.col("altered"), *side)).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_brute_force(spark, levels):
    rng = random.Random(levels)
    docs = [(i, "line\n" * (i % 4) + "é😀" * (i % 3), "en", rng.choice(["a", "a", "a", "b", "ü", "", None]), i, "clash", 7) for i in range(90)]
    docs += [(200, None, None, "lone", None, None, None), (None, "x\ny", None, "a", 3, None, None), (5, "another text of id 5\n", "en", "a", 1, None, None), (2**60 + 1, "\n", "en", "a", 1, None, None)]
    docs += [(7, "same", "en", "twice", 4, None, None)] * 2 + [(300, "word " * 40_000 + "\n", "en", "b", 200_001, None, None)]
    assert manifest_rows(spark, docs, levels) == brute_manifest(docs)


def test_manifest_of_one_and_no_row(spark):
    assert manifest_rows(spark, [], 6) == []
    alone = [(1, "a\nb", "en", "s", 3, None, None)]
    (row,) = manifest_rows(spark, alone, 6)
    assert row[1] == row[2] == row[3] and row[4] == sha("") and [row] == brute_manifest(alone)
    many = [(i, "t", "en", f"s{i}", 1, None, None) for i in range(11)]  # a leaf in each group
    assert manifest_rows(spark, many, 1) == brute_manifest(many)


def test_sums_and_ranks_over_ranges(spark):
    rows = [(("a", "b", "c")[min(2, i * i % 7)], i, i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    ranked = ranks.rank_in(ranks.placed(df, "g", "k"), "g").collect()
    want = {(g, k): sum(1 for a, b, _ in rows if a == g and b < k) for g, k, _ in rows}
    assert {(r["g"], r["k"]): r["idx"] for r in ranked} == want
    summed = ranks.sums_before(ranks.placed(df, "k"), "v", "before").collect()
    assert {r["k"]: r["before"] for r in summed} == {k: sum(v for _, b, v in rows if b < k) for _, k, _ in rows}


def test_attach_hot_and_null_keys(spark):
    rows, _ = materialize(spark.createDataFrame([("hot", i) for i in range(300)] + [(None, i) for i in range(200)] + [(f"k{i}", i) for i in range(40)], "key string, i long"), "rows")
    totals, _ = materialize(rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("i").alias("s")), "totals")
    found = ranks.attach(rows, totals, "key", rows.count())
    want = {None: sum(range(200)), "hot": sum(range(300))}
    assert found.columns == ["key", "i", "s"] and found.count() == 540
    assert all(r["s"] == want.get(r["key"], r["i"]) for r in found.collect())


def brute_codes(vectors, parts=8, entries=16, rounds=6):
    kept = sorted((i, [math.floor(4096 * x) for x in v], label) for i, v, label in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v))
    width = len(kept[0][1]) // parts
    cut = {i: [v[p * width : (p + 1) * width] for p in range(parts)] for i, v, _ in kept}
    books = [[list(cut[i][p]) for i, *_ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda part, book: min(range(len(book)), key=lambda e: (far(part, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for i in cut:
                met.setdefault(best(cut[i][p], books[p]), []).append(cut[i][p])
            for e, members in met.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    codes = {i: [best(cut[i][p], books[p]) for p in range(parts)] for i in cut}
    errors = {i: sum(far(cut[i][p], books[p][e]) for p, e in enumerate(codes[i])) for i in cut}
    by_label = {}
    for i, _, label in kept:
        by_label[label] = by_label.get(label, 0) + errors[i]
    shown = sha(",".join(str(x) for book in books for entry in book for x in entry))
    return {i: (bytes(codes[i]), errors[i], by_label[label], shown) for i, _, label in kept}


def code_rows(spark, vectors, kind="double"):
    codes, books = vector_codes.compress(spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>, label int"))
    found = vector_codes.with_label_errors(codes)
    return {r["id"]: (r["code"] and bytes(r["code"]), r["error"], r["label_error"], vector_codes.books_digest(books)) for r in found.collect()}, codes, books


@pytest.mark.parametrize("scale", [1.0, 1e-3, 3e9])
def test_codes_equal_brute_force(spark, scale):
    rng = random.Random(5)
    vectors = [(i, [rng.uniform(-scale, scale) for _ in range(16)], rng.choice([1, 1, 1, 2, None])) for i in range(150)]
    vectors += [(i, vectors[3][1], 1) for i in range(200, 240)] + [(300, None, 1), (301, [math.nan] * 16, 1), (302, [None] * 16, 1), (303, [math.inf] * 16, 1)]
    if scale > 1e6:  # beyond int64 products; errors must still fit
        vectors = [(i, [scale + x / scale for x in v], label) if v and i < 240 else (i, v, label) for i, v, label in vectors]
    found, codes, books = code_rows(spark, vectors)
    assert found == brute_codes(vectors)
    kept = {i: [math.floor(4096 * x) for x in v] for i, v, _ in vectors if i < 240}
    for r in vector_codes.restored(codes, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(r["v"], kept[r["id"]], strict=True)) == r["error"]


def test_codes_of_few_odd_and_no_vectors(spark):
    few = [(4, [0.5] * 8, None), (9, [0.25] * 8, None), (9, [0.5] * 8, 3)]
    found, _, books = code_rows(spark, few)
    assert books.shape == (8, 3, 1) and all(f[1] == 0 for f in found.values())
    ragged, _, _ = code_rows(spark, [(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)])
    assert ragged[2][:3] == (None, None, 0) and ragged[1][:3] == (bytes(8), 0, 0)
    assert code_rows(spark, [(1, None, 1)])[0] == {} == code_rows(spark, [])[0]
    with pytest.raises(ValueError, match="equal parts"):
        code_rows(spark, [(1, [0.0] * 9, 1)])


CODEC = chat.codec(chat.TEMPLATE, RANKS, PATTERN)
pieces = st.sampled_from([*chat.TEMPLATE.controls, "<", "[", "\\", "/", "s>", "INST]", "<SYS>>", "</SYS>>", "é😀", "\n", " text"])


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=8).map("".join), st.sampled_from(["user", "assistant", "system", "", "tool[TEXT]"]))
def test_escapes_are_reversible(text, role):
    hidden = CODEC.escape(text)
    assert CODEC.unescape(hidden) == text and not any(c in hidden for c in chat.TEMPLATE.controls)
    ids, low, high = CODEC.encode(role, text)
    assert CODEC.parsed(CODEC.formatted(ids)) == (role, text) and CODEC.unescape(CODEC.decoded(ids[low:high])) == text


def brute_chats(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        said = "".join(text for role, text in turns if role == "assistant")
        pairs = {role: pair for role, *pair in chat.TEMPLATE.roles}
        size = 0
        for role, text in turns:
            a, b = pairs.get(role) or (chat.TEMPLATE.named[0] + CODEC.escape(role) + chat.TEMPLATE.named[1], chat.TEMPLATE.named[2])
            size += len(a) + len(CODEC.escape(text)) + len(b)
        found[conv] = (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(said), sha(said), size)
    return found


def chat_rows(tree):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) for r in chat.conversations(tree, RANKS, PATTERN).collect()}


def odd_chats():
    rng = random.Random(3)
    odd = ["a", "b</s>", "[INST] x", "<\\s>", "[\\\\/INST]", "<<SYS>>", "é😀\n", "", None, "long " * 20_000]
    rows = [(c if c != 50 else None, t, rng.choice(["user", "assistant", "system", "tool[TEXT]", None]) if rng.random() < 0.3 else ("user", "assistant")[t % 2], rng.choice(odd) if rng.random() < 0.3 else odd[t % 3]) for c in range(120) for t in range(rng.randint(1, 6))]
    rows += [(c, t, ("user", "assistant")[t % 2], f"same {t}") for c in range(300, 360) for t in range(c % 7 + 1)]  # beginnings of each other
    return rows + rows[:5] + [(7, None, "user", "no turn")]


@pytest.mark.parametrize("shard_tokens", [40, 1 << 20])
def test_chats_equal_brute_force(spark, shard_tokens):
    rows = odd_chats()
    tree = chat.merge(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("clash")), RANKS, PATTERN, shard_tokens=shard_tokens)
    assert chat_rows(tree) == brute_chats(rows)
    stream = tree.stream.collect()
    own = sorted((r for r in stream if not r["context"]), key=lambda r: r["start"])
    paths = {tuple(t[2:] for t in sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv)) for conv in {r[0] for r in rows}}
    assert len(own) == len({path[:i] for path in paths for i in range(1, len(path) + 1)})  # shared turns once
    at = 0
    for r in own:
        assert r["start"] == at  # depth-first, without gaps
        at += len(r["ids"])
        ancestors = [(o["start"], o["start"] + len(o["ids"])) for o in own if o["start"] < r["start"] < o["until"]]
        assert sum(b - a for a, b in ancestors) == sum(x["end"] - x["start"] for x in r["ancestors"]) == r["position"]
        assert {x for a, b in ancestors for x in range(a, b)} == {x for i in r["ancestors"] for x in range(i["start"], i["end"])}
    if shard_tokens == 40:
        assert any(r["context"] for r in stream)


def test_no_chats(spark):
    tree = chat.merge(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), RANKS, PATTERN)
    assert chat_rows(tree) == {} and tree.stream.count() == 0
