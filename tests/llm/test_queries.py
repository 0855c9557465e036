"""Registered queries against SQL and contracts, and the pipeline against brute force."""

import hashlib
import io
import wave
import zlib
from pathlib import Path

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from graphloom.llm import byte_bpe, quality

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.iterdir():
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def entry():
    import __spark_entry__

    return __spark_entry__


@pytest.mark.parametrize("name", ["op2_ngram_join", "op4_topk", "op5_url_filters", "op8_suffix_dedup", "op11_merkle", "op12_vector_codes"])
def test_sql(spark, duck, name):
    found = entry().queries()[name](spark, str(DATA))
    sql = duck.sql(entry().oracle_sql()[name])
    columns = sorted(found.columns)
    names = list(sql.columns)
    assert columns == sorted(names)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in found.collect()) == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in sql.fetchall())


def test_op8(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rows = entry().queries()["op8_suffix_dedup"](spark, str(DATA)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == brute.repeats(docs)


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def rows_of(spark, name, columns):
    """The query's rows by document: every document once, with the contract's columns first."""
    rows = entry().queries()[name](spark, str(DATA))
    assert rows.columns[: len(columns.split())] == columns.split()
    return rows.collect()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op1_equals_the_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(brute.RANKS), special_tokens={})
    texts = documents(spark)
    rows = rows_of(spark, "op1_byte_bpe", "doc_id n_tokens ids_sha256 decoded_sha256")
    ids = {d: library.encode_ordinary(t) for d, t in texts.items()}
    assert len(rows) == len(texts) and {r["doc_id"]: tuple(r)[1:4] for r in rows} == {d: (len(x), sha(" ".join(map(str, x))), sha(texts[d])) for d, x in ids.items()}


def test_op3_equals_a_fit_without_spark(spark):
    texts = documents(spark)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in texts}
    known = sorted(d for d in labels if d in texts and not held[d])
    model = quality.fit(np.array([quality.features(texts[d]) for d in known]), np.array([labels[d] for d in known]))
    rows = {r["doc_id"]: r for r in rows_of(spark, "op3_quality", "doc_id held_out score predicted")}
    assert rows.keys() == texts.keys()
    for d, r in rows.items():
        score = float(model.score(np.array([quality.features(texts[d])]))[0])
        assert abs(r["score"] - score) < 1e-9 and r["held_out"] == held[d] and r["predicted"] == int(r["score"] >= 0.3) and 0 <= score <= 1
    out = [d for d in labels if d in texts and held[d]]
    assert sum(rows[d]["predicted"] == labels[d] for d in out) >= 0.9 * len(out)


def test_op6_equals_brute_force(spark):
    texts = documents(spark)
    found = {}
    for r in rows_of(spark, "op6_token_counts", "doc_id section start_char end_char n_tokens n_crossing doc_tokens"):
        found.setdefault(r["doc_id"], {})[r["section"]] = tuple(r)[2:]
    assert found == {d: brute.section_counts(t) for d, t in texts.items()}


def test_op7_stores_and_reads_back(spark):
    texts = documents(spark)
    rows = rows_of(spark, "op7_audio", "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature")
    assert {r["doc_id"] for r in rows} == texts.keys() and len(rows) == len(texts)
    same = {}
    for r in rows:
        data = texts[r["doc_id"]].encode()
        payload = data + bytes(-len(data) % 64 if data else 64)
        with wave.open(out := io.BytesIO(), "wb") as to:
            to.setparams((1, 1, 8000, 0, "NONE", ""))
            to.writeframes(payload)
        assert tuple(r)[1:7] == (len(data), len(payload), sha(payload), zlib.crc32(payload[-64:]), len(out.getvalue()), sha(out.getvalue()))
        assert same.setdefault(data, r["feature"]) == r["feature"]


def test_op9_equals_the_library(spark):
    library, texts = Tokenizer.from_file(brute.WORDS), documents(spark)
    ids = {d: library.encode(t, add_special_tokens=False).ids + [2] for d, t in texts.items()}
    rows = rows_of(spark, "op9_packing", "doc_id start length ids_crc32 doc_tokens sequence_id offset")
    pieces, sequences = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places, ends in ((pieces, {d: len(x) for d, x in ids.items()}), (sequences, None)):
        for k, parts in places.items():
            parts.sort()
            assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
            assert sum(n for _, n in parts) == ends[k] if ends else sum(n for _, n in parts) <= 4096
    assert pieces.keys() == texts.keys() and len(sequences) * 4096 <= 1.02 * sum(map(len, ids.values())) + 4096


def test_op10_equals_the_library(spark):
    library, texts = Tokenizer.from_file(brute.PIECES), documents(spark)
    start, expected = 0, {}
    for d in sorted(texts):
        ids = [*library.encode(texts[d], add_special_tokens=False).ids, 0]
        expected[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    rows = rows_of(spark, "op10_token_files", "doc_id start n_tokens ids_crc32")
    assert len(rows) == len(texts) and {r["doc_id"]: tuple(r)[1:4] for r in rows} == expected


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = corpus_pipeline.quality_classifier(spark, docs, str(DATA)).cache()
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    single = corpus_pipeline.near_duplicates(spark, kept, str(DATA)).cache()
    given = [(r["doc_id"], r["text"]) for r in kept.collect()]
    expected = {d for d, (_, c) in brute.jaccard_components(given, 5, 80).items() if d == c}
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == expected
    cut = corpus_pipeline.repeated_passages(spark, single, str(DATA)).cache()
    given = [(r["doc_id"], r["text"]) for r in single.collect()]
    removed = brute.repeats(given)
    assert cut.columns == docs.columns and {r["doc_id"] for r in cut.collect()} == expected
    for r in cut.collect():
        assert r["n_chars"] == len(r["text"])
        if removed[r["doc_id"]][1] == 0:
            assert r["text"] == dict(given)[r["doc_id"]]
    assert corpus_pipeline.run(spark, str(DATA)).select("doc_id").distinct().count() == len(expected)


def test_op13(spark):
    from test_manifest_codes_chat import brute_chats

    odd = "</s>[INST] ok [/INST]"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()]
    found = entry().queries()["op13_chat"](spark, str(DATA))
    assert found.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == brute_chats([*rows, (-7, 0, "user", odd), (-7, 1, "assistant", odd)])
