import random
import struct
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graphloom.llm import byte_bpe, common, packing, token_counts, token_files

LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(brute.RANKS), special_tokens={})
SAMPLES = ["a", "b", "ab", "the", "é", "日本", "😀", " ", "\n", "  ", "1", "23", "!", "..", "’s", "'s", "\x00", "zzzz", "in", "ing", "‍"]


def encode(text):
    return byte_bpe.encode_text(text, brute.RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert encode(text) == LIBRARY.encode_ordinary(text)
    assert byte_bpe.decode_text(encode(text), brute.RANKS) == text


def test_encoding_of_mixed_and_long_texts():
    draw = random.Random(1)
    for _ in range(2000):
        text = "".join(draw.choice(SAMPLES) for _ in range(draw.randint(0, 30)))
        assert encode(text) == LIBRARY.encode_ordinary(text)
    long = "ab" * 20000 + "z" * 9000
    assert encode(long) == LIBRARY.encode_ordinary(long)


CONTEXTS = ("a{c}b {c}{c} 1{c}  {c}'s", "{c}", " {c} ", "1{c}2", "!{c}?{c}")


def test_every_character_splits_as_in_the_libraries():
    """All code points whose class the module and the libraries see differently, and some of all others, in five contexts: pre-tokens, then ids."""
    pattern, split = public_tokenizers.PATTERN, byte_bpe.splitter(public_tokenizers.PATTERN)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert byte_bpe.matched(r"\s") == frozenset(regex.findall(r"\s", "".join(every)))
    library, piece = Tokenizer.from_file(brute.PIECES), token_files.piece_encoder(brute.PIECES, pattern)
    shown = token_files.byte_characters()
    draw = random.Random(3)
    odd = [c for c in every if split.odd(c)]
    for characters in (*(odd[k : k + 500] for k in range(0, len(odd), 500)), every[:0x700], every[0x1F000:0x1F200], *(draw.sample(every, 500) for _ in range(8))):
        text = "\n".join(x.replace("{c}", c) for c in characters for x in CONTEXTS)
        found = [x for x, _ in library.pre_tokenizer.pre_tokenize_str(text)]
        assert found == ["".join(shown[b] for b in p.encode()) for p in split.findall(text)]
        if draw.random() < 0.2:
            ids = LIBRARY.encode_ordinary(text)
            assert encode(text) == ids and np.frombuffer(piece.packed(text), f"<u{piece.width}").tolist() == ids


def test_small_tables_give_the_same():
    small = byte_bpe.Transducer(byte_bpe.load_ranks(brute.RANKS), most_states=50, most_pieces=8, most_pairs=40)
    for text in ("hellowonderfultransducers", "ththingerinoned", "äöüäöü", "xyzzyx" * 9):
        assert small.transduce(text.encode()) == LIBRARY.encode_ordinary(text)


def test_pairs_that_stay_apart():
    t = byte_bpe.transducer(brute.RANKS)
    draw, ids = random.Random(5), list(t.token)
    for _ in range(3000):
        a, b = draw.choice(ids), draw.choice(ids)
        if t.merged(t.token[a]) == [a]:
            assert t.stay_apart(a, b) == (t.merged(t.token[b]) == [b] and t.merged(t.token[a] + t.token[b]) == [a, b])


def test_streaming_decoder():
    machine = byte_bpe.machine(brute.RANKS)
    ids = encode("日本語😀é")
    chunks = list(machine.chunks(ids))
    assert b"".join(chunks).decode() == "日本語😀é" and all(c.decode() or True for c in chunks)
    half = [machine_id for machine_id, token in machine.token.items() if token == b"\xe6"]
    assert list(machine.chunks(half)) == [b"", b"\xe6"] and byte_bpe.decode_text(half, brute.RANKS) == "�"
    with pytest.raises(ValueError):
        list(machine.chunks([10**8]))


def test_encode_table(spark):
    docs = brute.frame(spark)
    out = byte_bpe.decode(byte_bpe.encode(docs, brute.RANKS, public_tokenizers.PATTERN), brute.RANKS).collect()
    given_ = {d: t or "" for d, t, _ in brute.ODD_DOCS}
    assert len(out) == len(given_)
    for r in out:
        assert r["ids"] == LIBRARY.encode_ordinary(given_[r["doc_id"]]) and bytes(r["decoded"]).decode() == given_[r["doc_id"]]
    assert byte_bpe.encode(docs.limit(0), brute.RANKS, public_tokenizers.PATTERN).count() == 0


def test_bounded_cache():
    kept, asked = common.Kept(6), []

    def find(keys):
        asked.extend(keys)
        return [k.upper() for k in keys]

    for word in "abcabcdefgabc":
        assert kept.of([word], find)[word] == word.upper()
    assert len(kept.young) + len(kept.old) <= 6 and asked.count("a") <= 2
    for word in "xyz":  # long keys fill a half sooner
        assert kept.of([word * 1000], find)[word * 1000] == word.upper() * 1000
    assert len(kept.young) == len(kept.old) == 1


@pytest.mark.parametrize("with_copies", [False, True])
def test_token_files(spark, tmp_path, with_copies):
    docs = brute.frame(spark, brute.ODD_DOCS + (brute.ODD_DOCS[:2] + [(None, "no id", "q")] if with_copies else []))
    library = Tokenizer.from_file(brute.PIECES)
    folder = str(tmp_path / "tokens")
    manifest = token_files.write(docs, folder, brute.PIECES, public_tokenizers.PATTERN)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"], bytes(r["ids"])) for r in token_files.read(spark, folder, manifest).collect()))
    expected, start = [], 0
    for doc, text in sorted(((d is not None, d or 0), t or "") for d, t in ((r["doc_id"], r["text"]) for r in docs.collect())):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        expected.append((*doc, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert rows == expected
    assert {p.name for p in (tmp_path / "tokens").iterdir()} == {r[k].rsplit("/", 1)[1] for r in manifest for k in ("path", "index")} | {"manifest.json"}


def test_added_tokens_in_texts(spark, tmp_path):
    docs = [(1, "a <|endoftext|> b"), (2, "x<|startoftext|>Y <|ENDOFTEXT|> <|endoftext|>"), (3, "plain <| text"), (4, "<|endoftext|>\x1c")]
    frame = brute.frame(spark, [(d, t, "s") for d, t in docs])
    ids = lambda path, text, end: [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, end]
    manifest = token_files.write(frame, str(tmp_path / "t"), brute.PIECES, public_tokenizers.PATTERN)
    rows = {r["doc_id"]: bytes(r["ids"]) for r in token_files.read(spark, str(tmp_path / "t"), manifest).collect()}
    assert rows == {d: np.array(ids(brute.PIECES, t, 0), "<u4").tobytes() for d, t in docs}
    assert np.frombuffer(rows[1], "<u4").tolist() == [64, 220, 50256, 275, 0]
    rows = {r["doc_id"]: bytes(r["ids"]) for r in packing.pack(frame, brute.WORDS, with_ids=True).collect()}
    assert rows == {d: np.array(ids(brute.WORDS, t, 2), "<u4").tobytes() for d, t in docs}
    assert np.frombuffer(rows[1], "<u4").tolist() == [320, 49407, 321, 2]


def test_token_files_of_nothing(spark, tmp_path):
    manifest = token_files.write(brute.frame(spark).limit(0), str(tmp_path / "none"), brute.PIECES, public_tokenizers.PATTERN)
    assert manifest == [] and token_files.read(spark, str(tmp_path / "none"), manifest).count() == 0


def test_broken_records_are_seen(tmp_path):
    good = token_files.frame(b"payload")
    for at in range(len(good)):
        path = tmp_path / "r"
        path.write_bytes(good[:at] + bytes([good[at] ^ 1]) + good[at + 1 :])
        with path.open("rb") as f, pytest.raises(ValueError):
            token_files.read_frame(f)
    assert struct.unpack("<Q", good[:8])[0] == 7


def test_packing(spark):
    library = Tokenizer.from_file(brute.WORDS)
    docs = brute.frame(spark, brute.ODD_DOCS + brute.ODD_DOCS[:2])
    rows = packing.pack(docs, brute.WORDS, with_ids=True).collect()
    ids = {d: library.encode(t or "", add_special_tokens=False).ids + [2] for d, t, _ in brute.ODD_DOCS}
    used, pieces = {}, []
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and bytes(r["ids"]) == np.array(part, "<u4").tobytes()
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.append((r["doc_id"], r["start"]))
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values())) + len(ids[1]) + len(ids[2])
    assert packing.pack(docs.limit(0), brute.WORDS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_patterns_place_every_length(histogram):
    found = packing.patterns(histogram, 64)
    placed = {}
    for lengths, count in found:
        assert sum(lengths) <= 64 and count > 0
        for n in lengths:
            placed[n] = placed.get(n, 0) + count
    assert placed == histogram
    table = packing.places(found)
    assert len(table) == sum(len(lengths) for lengths, _ in found)


def test_little_padding():
    histogram = {n: 1 + 3000 // n for n in range(1, 4097)}
    total = sum(n * c for n, c in histogram.items())
    assert sum(c for _, c in packing.patterns(histogram, 4096)) * 4096 < 1.01 * total + 4096


@pytest.mark.parametrize("rule", ["majority", "first", "split"])
def test_section_counts(spark, rule):
    docs = brute.frame(spark)
    rows = token_counts.section_counts(docs, brute.RANKS, public_tokenizers.PATTERN, rule).collect()
    for d, t, _ in brute.ODD_DOCS:
        text, own = t or "", sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["section"])
        assert abs(sum(r["n_tokens"] for r in own) - len(LIBRARY.encode_ordinary(text))) < 1e-9
        assert "".join(text[r["start_char"] : r["end_char"]] for r in own) == text
    tokens = token_counts.spans("ab\ncd ef", brute.RANKS, public_tokenizers.PATTERN)
    count, _ = token_counts.attribute(tokens, [(0, 3), (3, 8)], rule)
    assert count.sum() == len(tokens) and count[-1] == 0


def test_crossing_tokens_follow_the_rule():
    tokens = np.array([[0, 4], [4, 6], [8, 9]])
    sections = [(0, 1), (1, 5), (5, 6)]
    for rule, expected in (("majority", [0, 2, 0, 1]), ("first", [1, 1, 0, 1]), ("split", [0.25, 1.25, 0.5, 1])):
        count, crossing = token_counts.attribute(tokens, sections, rule)
        assert count.tolist() == expected and crossing.tolist() == [1, 2, 1, 0]
    with pytest.raises(ValueError):
        token_counts.attribute(tokens, [(0, 3), (2, 4)], "first")


def test_given_sections(spark):
    rows = spark.createDataFrame([(1, "name: Ann, age: 5", [(6, 9), (16, 17)]), (2, None, None)], "doc_id long, text string, parts array<struct<start:int,end:int>>")
    found = token_counts.section_counts(rows, brute.RANKS, public_tokenizers.PATTERN, "majority", "parts").collect()
    by = {(r["doc_id"], r["section"]): r["n_tokens"] for r in found}
    assert by[1, 0] >= 1 and by[1, 1] == 1 and sum(v for (d, _), v in by.items() if d == 1) == len(LIBRARY.encode_ordinary("name: Ann, age: 5")) and by[2, -1] == 0


def test_names_that_results_have(spark):
    encoded = byte_bpe.encode(brute.frame(spark), brute.RANKS, public_tokenizers.PATTERN)
    twice = byte_bpe.decode(byte_bpe.decode(encoded, brute.RANKS), brute.RANKS)
    assert twice.columns == ["doc_id", "ids", "decoded", "decoded_"] and twice.where("decoded = decoded_").count() == len(brute.ODD_DOCS)
    cut = packing.pieces(brute.frame(spark, [(None, "no id", "s"), *brute.ODD_DOCS]), brute.WORDS, 64, 2).withColumn("sequence_id", F.lit("mine")).withColumn("_salt", F.lit("x")).withColumn("_rank", F.lit("x")).withColumn("_shift", F.lit("x"))
    placed = packing.assign(cut, 64)
    assert placed.columns == [*cut.columns, "sequence_id_", "offset"]
    rows = placed.collect()
    assert len(rows) == cut.count() and {r["doc_id"] for r in rows} == {None, *(d for d, _, _ in brute.ODD_DOCS)} and {r["_salt"] for r in rows} == {"x"}


def test_files_of_others_stay(spark, tmp_path):
    folder = tmp_path / "shared"
    folder.mkdir()
    (folder / "keepme.txt").write_text("mine")
    docs = brute.frame(spark)
    first = token_files.write(docs, str(folder), brute.PIECES, public_tokenizers.PATTERN)
    again = token_files.write(docs, str(folder), brute.PIECES, public_tokenizers.PATTERN)
    assert (folder / "keepme.txt").read_text() == "mine"
    for manifest in (first, again):
        assert token_files.read(spark, str(folder), manifest).count() == len(brute.ODD_DOCS)


def test_very_long_texts(spark, tmp_path):
    long = ("Ein längerer Satz, with 12 words and more; " * 300_000)[:11_000_000]
    docs = brute.frame(spark, [(1, long, "s"), (2, "short", "s")])
    ids = {d: LIBRARY.encode_ordinary(t) for d, t in ((1, long), (2, "short"))}
    for r in byte_bpe.round_trip(docs, brute.RANKS, public_tokenizers.PATTERN).collect():
        assert r["ids"] == ids[r["doc_id"]] and bytes(r["decoded"]).decode() == {1: long, 2: "short"}[r["doc_id"]]
    manifest = token_files.write(docs, str(tmp_path / "long"), brute.PIECES, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["n_tokens"] for r in token_files.read(spark, str(tmp_path / "long"), manifest).select("doc_id", "n_tokens").collect()} == {d: len(x) + 1 for d, x in ids.items()}
    counts = token_counts.section_counts(docs, brute.RANKS, public_tokenizers.PATTERN).where("doc_id = 1").collect()
    assert [r["n_tokens"] for r in counts] == [len(ids[1])]
    whole = Tokenizer.from_file(brute.WORDS).encode(long, add_special_tokens=False).ids
    pieces = packing.pack(docs, brute.WORDS).where("doc_id = 1").collect()
    assert sum(r["length"] for r in pieces) == len(whole) + 1 and {r["doc_tokens"] for r in pieces} == {len(whole) + 1}
