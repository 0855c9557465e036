import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import audio, components, ngram_join, quality, suffix_dedup, topk, url_filters

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "lam", "mu"]


def near_copies(seed, count=120):
    """Bases with edited copies, exact copies, short texts and a shared passage."""
    draw, docs = random.Random(seed), []
    passage = " ".join(draw.choices(WORDS, k=60))
    bases = [" ".join(draw.choices([w + str(i) for w in WORDS for i in range(30)], k=draw.choice([4, 30, 80, 200]))) for _ in range(12)]
    for d in range(count):
        text = draw.choice(bases)
        kind = draw.random()
        if kind < 0.5:
            words = text.split()
            for _ in range(draw.randint(0, 6)):
                words[draw.randrange(len(words))] = draw.choice(WORDS)
            text = " ".join(words)
        if kind > 0.8:
            text = f"{text} {passage}"
        docs.append((draw.randrange(10**6) * 1000 + d, text))
    return docs + [(d, t) for d, t, _ in brute.ODD_DOCS]


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (3, 50, 3)])
def test_join_equals_brute_force(spark, width, percent, seed, monkeypatch):
    if seed == 2:  # cut everything into small tiles
        monkeypatch.setattr(ngram_join, "LIST", 2)
        monkeypatch.setattr(ngram_join, "BLOCK", 4)
        monkeypatch.setattr(ngram_join, "ELEMENTS", 400)
    docs = near_copies(seed)
    rows = ngram_join.near_duplicates(brute.frame(spark, [(d, t, "s") for d, t in docs]), width, percent).collect()
    expected = brute.jaccard_components(docs, width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected and len(rows) == len(docs)


@pytest.mark.parametrize("small", [False, True])
def test_every_link_between_classes(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(ngram_join, "LIST", 2)
        monkeypatch.setattr(ngram_join, "BLOCK", 4)
        monkeypatch.setattr(ngram_join, "ELEMENTS", 400)
    group = " ".join(f"w{k}" for k in range(60))
    docs = near_copies(5) + [(k, f"{group} end{k // 2}") for k in range(100, 124)]
    classes = {}
    for d, t in docs:
        if sets := brute.shingle_set(t, 3):
            classes[sets] = min(d, classes.get(sets, d))
    names = sorted((d, x) for x, d in classes.items())
    expected = {(a, b) for k, (b, y) in enumerate(names) for a, x in names[:k] if 100 * len(x & y) >= 80 * len(x | y)}
    assert {(a, b) for a in range(100, 124, 2) for b in range(a + 2, 124, 2)} <= expected  # a group whose links a spanning tree lacks
    frame = brute.frame(spark, [(d, t, "s") for d, t in docs])
    found = [(r["a"], r["b"]) for r in ngram_join.similar_pairs(frame, 3, 80).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    counts = {r["class_id"]: r["n_links"] for r in ngram_join.link_counts(frame, 3, 80).collect()}
    assert counts == {d: sum(d in pair for pair in expected) for d, _ in names}


def test_join_of_nulls_repeats_and_nothing(spark):
    docs = brute.frame(spark, [(None, "a b c d e f", "s"), (1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, "A B  c d\te f", "s"), (3, None, "s")])
    rows = sorted((r["doc_id"], r["class_id"], r["component_id"]) for r in ngram_join.near_duplicates(docs, 3, 90).collect())
    assert rows == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 3, 3)]
    kept = ngram_join.keep_one(docs, 3, 90)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 1, 3]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_bitmaps_bound_overlaps():
    draw = np.random.default_rng(4)
    for _ in range(200):
        x, y = (np.unique(draw.integers(0, 400, draw.integers(1, 200)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in "ab")
        words = min(ngram_join.bits_of(len(x)), ngram_join.bits_of(len(y))) // 64
        a, b = (ngram_join.folded(ngram_join.bitmap(z, ngram_join.bits_of(len(z))), words) for z in (x, y))
        most = min(len(x) - np.bitwise_count(a & ~b).sum(), len(y) - np.bitwise_count(b & ~a).sum())
        assert len(np.intersect1d(x, y)) <= most


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (2000, 2001), (2001, 2002), (2002, 2000)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}, 2000: 2000, 2001: 2000, 2002: 2000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only_documents_that_may_link_get_arrays(spark, monkeypatch):
    draw = random.Random(21)
    words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(4000)]
    header = " ".join(f"h{k}" for k in range(212))  # more shared shingles than a text's prefix leaves out, too few for a link
    docs = [(k, f"{header} {' '.join(draw.choices(words, k=50))}") for k in range(300)]
    docs += [(1000 + k, text + " more") for k, text in docs[:20]]
    frame = brute.frame(spark, [(d, t, "s") for d, t in docs])
    sent, arrays = [], ngram_join.with_arrays

    def seen(narrow, reps, placed, width, order):
        sent.append(placed.select("doc_id").distinct().count())
        return arrays(narrow, reps, placed, width, order)

    monkeypatch.setattr(ngram_join, "with_arrays", seen)
    kept = ngram_join.keep_one(frame, 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300)) and kept.columns == frame.columns
    assert len(sent) == 2 and 40 <= sent[0] <= 100  # 320 texts are in one long list, 40 of them link


def repeated_docs(seed):
    draw = random.Random(seed)
    passages = ["".join(draw.choices("abcdefgh äö", k=draw.choice([49, 50, 51, 90, 200]))) for _ in range(8)]
    docs = []
    for d in range(60):
        parts = ["".join(draw.choices("abcdefghijklmnop ", k=draw.randint(0, 120))) for _ in range(3)]
        docs.append((draw.choice([-1, 1]) * draw.randrange(10**5) * 100 + d, draw.choice(passages).join(parts)))
    docs += [(10**8 + d, t) for d, t in docs[:6]] + [(-(10**8), "a" * 300), (10**9, "a" * 120), (10**9 + 1, "ab" * 200), (10**9 + 2, "ab" * 90), (10**9 + 3, "x" * 49)]
    return docs + [(2 * 10**9 + d, t) for d, t, _ in brute.ODD_DOCS]


@pytest.mark.parametrize("block", [None, 64])
def test_repeats_equal_brute_force(spark, block, monkeypatch):
    docs = repeated_docs(3)
    if block is None:
        rows = suffix_dedup.remove_repeats(brute.frame(spark, [(d, t, "s") for d, t in docs])).collect()
    else:  # many segments in one text
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        docs = docs[:25]
        rows = suffix_dedup.remove_repeats(brute.frame(spark, [(d, t, "s") for d, t in docs])).collect()
    expected = brute.repeats(docs)
    assert len(rows) == len(docs)
    for r in rows:
        kept = bytes(r["kept"])
        assert (r["n_bytes"], r["n_bytes"] - len(kept), len(r["removed"]), hashlib.sha256(kept).hexdigest()) == expected[r["doc_id"]], r["doc_id"]


def test_repeats_of_nulls_and_repeated_rows(spark):
    long = "".join(chr(97 + (i * i) % 23) for i in range(130))
    docs = brute.frame(spark, [(None, long, "s"), (5, long, "s"), (5, long, "s"), (9, long + "é" + long, "t"), (7, None, "s")])
    rows = sorted(((r["doc_id"] or -1), r["n_bytes"], len(r["kept"])) for r in suffix_dedup.remove_repeats(docs).collect())
    assert rows == [(-1, 130, 130), (5, 130, 130), (5, 130, 130), (7, 0, 0), (9, 262, 2)]
    cut = suffix_dedup.without_repeats(docs.withColumn("n_chars", F.char_length("text").cast("long")))
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    assert cut.columns == [*docs.columns, "n_chars"] and found[9] == ("é", 1) and found[7] == (None, None) and found[5] == (long, 130)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_quality_learns_and_holds(spark):
    draw = random.Random(2)
    good = [" ".join(draw.choices(WORDS, k=60)).capitalize() + "." for _ in range(150)]
    bad = ["!!! $$$ ".join(draw.choices(WORDS, k=40)).upper() for _ in range(60)]
    docs = brute.frame(spark, [(i, t, "s") for i, t in enumerate(good + bad)] + [(900, None, "s"), (901, "", "s"), (None, "x", "s")])
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(210)] + [(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels.where(~quality.held_out()))
    rows = docs.select("doc_id", quality.scorer(model).alias("s"), quality.held_out().alias("h")).collect()
    right = [(r["s"] >= quality.CUT) == (r["doc_id"] < 150) for r in rows if r["h"] and r["doc_id"] < 210]
    assert len(right) > 20 and np.mean(right) > 0.97 and all(0 <= r["s"] <= 1 for r in rows) and len(rows) == 213
    by = {r["doc_id"]: r["s"] for r in rows}
    assert by[900] == by[901] and [r["h"] for r in rows if r["doc_id"] is None] == [False]
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    only = quality.train(docs, labels.where("quality = 1"))
    assert {r["s"] for r in docs.select(quality.scorer(only).alias("s")).collect()} == {0.5}
    assert docs.limit(0).select(quality.scorer(model)).count() == 0


def test_pairs_order_strengths():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(300, 3))
    strength = x @ np.array([2.0, -1.0, 0.0])
    a, b = draw.integers(0, 300, 2000), draw.integers(0, 300, 2000)
    wins = draw.random(2000) < 1 / (1 + np.exp(strength[b] - strength[a]))
    w = quality.fit_pairs(x, np.where(wins, a, b), np.where(wins, b, a))
    assert abs(w[0] - 2) < 0.4 and abs(w[1] + 1) < 0.3 and abs(w[2]) < 0.2


def vectors(spark, seed=1, count=900):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] + 0.2 * draw.normal(size=8)).astype(float).tolist()) for i in draw.permutation(count)]
    rows += [(5000 + 20 * i, [1.0] * 8) for i in range(30)]
    odd = [(7000, None), (7020, [1.0, None] + [0.0] * 6), (7040, [float("nan")] * 8), (7060, [float("inf")] * 8), (7080, []), (None, [1.0] * 8), (7100, [1.0] * 3), (7120, [0.5] * 3), (20, rows[0][1]), (7140, [1e30] + [0.0] * 7), (7160, [3e7, -2e7] + [0.0] * 6)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash")).withColumn("score", F.lit(1))


@pytest.mark.parametrize(("leaf", "most_block", "count"), [(16, 32_768, 900), (4, 64, 900), (2, 200, 2400)])
def test_top_k_equals_brute_force(spark, leaf, most_block, count, monkeypatch):
    monkeypatch.setattr(topk, "LEAF", leaf)
    table = vectors(spark, count=count)
    found = {}
    for r in topk.top_k(table, F.col("vec_id") % 20 == 0, 20, most_block=most_block).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    clean = {}
    for r in table.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ints = [int(np.floor(64 * x)) for x in v]
            if sum(x * x for x in ints) < 2**63:
                clean[r["vec_id"]] = min(ints, clean.get(r["vec_id"], ints))
    expected = {}
    for q, v in clean.items():
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in clean.items() if i != q and len(w) == len(v))[:20]
            if best:
                expected[q] = [(k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert 7140 not in expected and 7160 in expected
    assert {q: sorted(rows) for q, rows in found.items()} == expected


def brute_top(q_ids, q, ids, c, k):
    rows = []
    for own, v in zip(q_ids.tolist(), q.tolist(), strict=True):
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in zip(ids.tolist(), c.tolist(), strict=True) if i != own)[:k]
        rows += [(own, i, -s) for s, i in best]
    return sorted(rows)


@pytest.mark.parametrize("kind", ["ties", "scattered", "clusters", "huge", "equal"])
def test_search_equals_brute_force(kind):
    draw = np.random.default_rng(8)
    for size in (1, 5, 40, 300):
        d = int(draw.integers(1, 6))
        c = {
            "ties": draw.integers(-3, 4, (size, d)),
            "scattered": draw.normal(size=(size, d)) * 50,
            "clusters": draw.normal(size=(5, d))[draw.integers(0, 5, size)] * 300 + draw.normal(size=(size, d)) * 5,
            "huge": draw.normal(size=(size, d)) * 2**28,
            "equal": np.full((size, d), 7),
        }[kind].astype(np.int64)
        ids = draw.permutation(3 * size)[:size]
        asks = draw.random(size) < 0.4
        asks[0] = True
        found = topk.Search(ids[asks], c[asks], ids, c, 7).run()
        assert sorted(map(tuple, found.tolist())) == brute_top(ids[asks], c[asks], ids, c, 7)


def test_dual_trees_prune_clustered_vectors():
    draw = np.random.default_rng(4)
    for d in (8, 64):
        x = draw.normal(size=(200, d))[draw.integers(0, 200, 12_000)] + draw.normal(size=(12_000, d)) * 0.03
        v = np.floor(64 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
        ids = np.arange(len(v))
        asks = ids % 20 == 0
        search = topk.Search(ids[asks], v[asks], ids, v, 20)
        found = search.run()
        assert search.scored < 0.1 * asks.sum() * len(v)
        few = np.flatnonzero(asks)[:15]
        assert sorted(r for r in map(tuple, found.tolist()) if r[0] <= few[-1]) == brute_top(few, v[few], ids, v, 20)


def test_pairs_of_blocks_are_dropped_before_they_are_shuffled(spark, monkeypatch):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(12, 16))[draw.integers(0, 12, 6000)] + draw.normal(size=(6000, 16)) * 0.01
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    written = {}

    def keep(df, tag, materialize=topk.materialize):
        written[tag] = materialize(df, tag)
        return written[tag]

    monkeypatch.setattr(topk, "materialize", keep)
    rows = topk.top_k(table, F.col("vec_id") % 20 == 0, 5, most_block=500).collect()
    assert len(rows) == 300 * 5
    worst = written["seeds"][0].where("rank = 5").agg(F.min("score")).first()[0]
    pairs = written["pairs"][0].collect()
    assert len(pairs) > 20 and sum(r["seeds"] or r["upper"] >= worst for r in pairs) < 0.5 * len(pairs)


def test_search_of_huge_integers():
    q = np.array([[2**30, -(2**30)]])
    c = np.array([[2**30, 1], [2**30, 2], [5, 5]])
    found = topk.Search(np.array([9]), q, np.array([1, 2, 3]), c, 2).run()
    assert sorted(found.tolist()) == [[9, 1, 2**60 - 2**30], [9, 2, 2**60 - 2**31]]


def test_top_k_of_nothing(spark):
    assert topk.top_k(vectors(spark).limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(vectors(spark), F.lit(False)).count() == 0


def test_cover_trees_cover_and_separate():
    draw = np.random.default_rng(3)
    for x in (draw.normal(size=(2000, 3)), draw.normal(size=(9, 4))[draw.integers(0, 9, 800)] + 0.01 * draw.normal(size=(800, 4)), np.zeros((50, 2))):
        tree = topk.cover_tree(x)
        assert sorted(tree.rows.tolist()) == list(range(len(x)))
        for node in range(len(tree.radius)):
            rows = tree.rows[tree.begin[node] : tree.end[node]]
            assert np.sqrt(((x[rows] - tree.centre[node]) ** 2).sum(1)).max() <= tree.radius[node] + 1e-12
            children = np.arange(tree.first[node], tree.last[node])
            if len(children):
                assert tree.radius[children].max() <= tree.radius[node] / 2
                assert sorted(np.concatenate([tree.rows[tree.begin[k] : tree.end[k]] for k in children]).tolist()) == sorted(rows.tolist())
                apart = np.sqrt(((tree.centre[children][:, None] - tree.centre[children]) ** 2).sum(2))
                assert apart[~np.eye(len(children), dtype=bool)].min(initial=np.inf) > tree.radius[node] / 2


def test_audio_table(spark):
    docs = brute.frame(spark, brute.ODD_DOCS + brute.ODD_DOCS[:1])
    rows = audio.summarized(audio.features(audio.store(docs))).collect()
    given = {d: t or "" for d, t, _ in brute.ODD_DOCS}
    assert len(rows) == 15
    by_text = {}
    for r in rows:
        data = given[r["doc_id"]].encode()
        payload = bytes(r["payload"])
        assert r["n_bytes"] == len(data) and payload == data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        table = audio.read_tensors(bytes(r["tensors"]))
        assert table.schema.field("log_mel").type.shape == [32, 20] and all(a < b for a, b in zip(table["start_s"].to_pylist(), table["end_s"].to_pylist(), strict=True))
        assert all(s["start_s"] < s["end_s"] for s in r["segments"])
        assert by_text.setdefault(data, (r["feature"], bytes(r["media"]), bytes(r["tensors"]))) == (r["feature"], bytes(r["media"]), bytes(r["tensors"]))
    assert audio.features(audio.store(docs.limit(0))).count() == 0 and audio.kept(docs.limit(0)).count() == 0


def plain_feature(text, rate=8000, up=2, down=5, frame=256, hop=128, mels=20):
    """The feature of a text by sums and loops: (frames, segments, high frames, median level, mean of each filter)."""
    data = (text or "").encode()
    data += bytes(-len(data) % 64 if data else 64)
    x = (np.frombuffer(data, np.uint8).astype(float) - 128) / 128
    half = 6 * max(up, down)
    lags = np.arange(-half, half + 1)
    taps = np.sinc(lags / max(up, down)) * np.hanning(len(lags) + 2)[1:-1]
    taps *= up / taps.sum()
    wide = np.zeros(len(x) * up)
    wide[::up] = x
    slow = np.array([sum(taps[k + half] * wide[m * down - k] for k in lags if 0 <= m * down - k < len(wide)) for m in range(-(-len(x) * up // down))])
    new_rate = rate * up / down
    count = max(1, -(-(len(slow) - frame) // hop) + 1)
    slow = np.concatenate([slow, np.zeros(max(0, (count - 1) * hop + frame - len(slow)))])
    waves = np.exp(-2j * np.pi * np.outer(np.arange(frame), np.arange(frame // 2 + 1)) / frame)
    points = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + new_rate / 2 / 700), mels + 2) / 2595) - 1)
    at = np.arange(frame // 2 + 1) * new_rate / frame
    values = np.empty((count, mels))
    for i in range(count):
        power = np.abs((slow[i * hop : i * hop + frame] * np.hanning(frame)) @ waves) ** 2
        for k in range(mels):
            low, middle, high = points[k : k + 3]
            weight = [max(0.0, min((f - low) / (middle - low), (high - f) / (high - middle))) for f in at]
            values[i, k] = np.log10(max(float(power @ weight), 1e-10))
    level = 10 * values.mean(1)
    median, on, segments, loud = np.median(level), False, 0, 0
    for v in level if level.max() > -100 + 1e-9 else []:
        if v >= median + 1 and not on:
            on, segments = True, segments + 1
        elif v < median - 0.5:
            on = False
        loud += on
    return count, segments, loud, median, values.mean(0)


def test_features_equal_sums_and_loops(spark):
    rng = random.Random(4)
    texts = [None, "", "short", "quiet " * 60 + "LOUD ÿÿÿ \x7f" * 40 + "quiet " * 90, "".join(chr(rng.randrange(32, 127)) for _ in range(1500)), "é日本😀" * 120 + " " * 900 + "zzzz" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in audio.kept(docs).collect():
        parts = dict(p.split("=") for p in r["feature"].split(";"))
        frames, segments, high, level, means = plain_feature(texts[r["doc_id"]])
        assert (int(parts["frames"]), int(parts["segments"]), int(parts["high"])) == (frames, segments, high), r["doc_id"]
        assert abs(float(parts["level_db"]) - level) < 0.02 and np.abs(np.array(parts["mel"].split(","), float) - means).max() < 0.02
        assert len(r["segments"]) == segments and audio.frames_of(bytes(r["tensors"]))[0].shape == (frames, 20)


def test_resampling_equals_the_direct_sum():
    x = np.random.default_rng(1).normal(size=301).astype(np.float32)
    for up, down in ((2, 5), (3, 4), (1, 2), (5, 2), (1, 1)):
        bank = audio.low_pass(up, down)
        taps = np.ascontiguousarray(bank[:, ::-1].T).reshape(-1)
        spread = np.zeros(len(x) * up)
        spread[::up] = x
        full = np.convolve(spread, taps)
        expected = full[6 * max(up, down) :: down][: -(-len(x) * up // down)]
        assert np.allclose(audio.resample(x, up, down, block=16)[: len(expected)], expected, atol=1e-4)


def test_tones_and_segments():
    t = np.arange(8000) / 3200
    values = audio.log_mel(np.sin(2 * np.pi * 400 * t).astype(np.float32), 3200, 256, 128, 20)
    bank = audio.mel_bank(3200, 256, 20)
    assert values.mean(0).argmax() == bank[np.fft.rfftfreq(256, 1 / 3200).tolist().index(400.0)].argmax()
    assert audio.hysteresis(np.array([0, 5, 3, 3, 1, 0, 3, 5, 5]), 4, 2) == [(1, 4), (7, 9)]


def test_url_filters_equal_brute_force(spark):
    draw = random.Random(6)
    hosts = ["a.example.org", "b.a.example.org", "example.org", "other.net", "www.other.net"]
    entries = [(draw.choice(["example.org", "a.example.org", "OTHER.net.", "net", None]), f"2024-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}", draw.choice(["allow", "block"])) for _ in range(25)] + [("example.org", None, "block")]
    captures = [(i, f"https://{draw.choice(hosts)}:443/p?q=http://x.y/", f"2024-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}") for i in range(120)]
    captures += captures[:3] + [(900, None, "2024-05-05"), (901, "no url", "2024-05-05"), (902, "http://example.org/", None), (903, "HTTP://user:pw@A.Example.org./x", "2024-12-30")]
    table = spark.createDataFrame(captures, "page_id long, url string, fetched_on string").withColumn("host_", F.lit(1))
    listed = spark.createDataFrame(entries, "pattern string, listed_at string, action string")
    rows = url_filters.judge(table, listed).collect()

    def expected(url, day):
        import re

        m = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", url or "")
        if not m or not day:
            return None
        host = re.sub(r":\d*$", "", re.sub(r"^.*@", "", m[1])).rstrip(".").lower()
        parts = host.split(".")
        for k in range(len(parts)):
            pattern = ".".join(parts[k:])
            active = sorted((d, a) for p, d, a in entries if p and d and p.lower().rstrip(".") == pattern and d <= day)
            if active:
                return pattern, active[-1][1]
        return None

    assert len(rows) == len(captures)
    for r in rows:
        found = (r["matched_pattern"], r["action"]) if r["action"] else None
        assert found == expected(r["url"], r["fetched_on"]), r
    assert url_filters.judge(table.limit(0), listed).count() == 0 and url_filters.judge(table, listed.limit(0)).where("action is not null").count() == 0
    clashing = table.selectExpr("*", "'mine' as host", "1 as _day", "2 as _best", "'x' as action", "3 as `a.b`")
    again = url_filters.judge(clashing, listed)
    assert again.columns == [*clashing.columns, "host__", "matched_pattern", "listed_at", "action_"]
    assert sorted((r["page_id"], str(r["action_"])) for r in again.collect()) == sorted((r["page_id"], str(r["action"])) for r in rows)


def test_audio_keeps_names_that_are_taken(spark):
    stored = audio.store(brute.frame(spark)).withColumn("payload", F.lit("mine")).withColumn("feature", F.lit(1))
    found = audio.summarized(audio.features(stored))
    assert found.columns == [*stored.columns, "payload_", "tensors", "segments", "feature_"] and {r["payload"] for r in found.collect()} == {"mine"}


def test_long_texts_of_media_and_quality(spark):
    long = "A sentence of some words, more or less. " * 280_000
    docs = brute.frame(spark, [(None, long, "s"), (2, long, "s"), (3, "short", "s")])
    sizes = audio.summarized(audio.features(audio.store(docs))).select("n_bytes", F.length("payload").alias("n"), "feature").collect()
    assert sorted((r["n_bytes"], r["n"]) for r in sizes) == sorted([(len(long), len(long) + -len(long) % 64)] * 2 + [(5, 64)]) and len({r["feature"] for r in sizes}) == 2
    model = quality.train(docs, spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, quality int"))
    scores = [r["s"] for r in docs.select(quality.scorer(model).alias("s"), F.length("text").alias("n")).orderBy("n").collect()]
    assert scores[1] == scores[2] and scores[0] < quality.CUT <= scores[1]


def test_a_labelled_id_of_many_rows_is_one(spark):
    docs = spark.range(4000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("text !!! "), (F.col("id") % 7).cast("string")).alias("text"))
    one = spark.createDataFrame([(0, "text !!! 0"), (1, "text !!! 0")], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert quality.train(docs, labels) == quality.train(one, labels)


def test_entries_hold_from_their_moment(spark):
    listed = spark.createDataFrame([("a.org", "2024-03-01 15:00:00", "block"), ("a.org", "2024-03-01 18:00:00", "allow"), ("org", "2190-01-01", "block")], "pattern string, listed_at string, action string")
    captures = spark.createDataFrame([(1, "http://a.org/", "2024-03-01 09:00:00"), (2, "http://a.org/", "2024-03-01 15:00:00"), (3, "http://x.a.org/" + "y" * 2_000_000, "2024-03-01 19:00:00"), (4, "http://b.org/", "2200-05-05")], "page_id long, url string, fetched_on string")
    assert {r["page_id"]: r["action"] for r in url_filters.judge(captures, listed).collect()} == {1: None, 2: "block", 3: "allow", 4: "block"}


def test_frequent_anchors_give_the_same_repeats(spark, monkeypatch):
    draw = random.Random(12)
    passage = "a header that nearly every document of this table has, with a border of its own text "
    docs = [(d, "".join(draw.choices("abcdefghijklmnop ", k=draw.randint(0, 60))) + passage + "".join(draw.choices("abcdefghijklmnop ", k=draw.randint(20, 80)))) for d in range(300)]
    docs += repeated_docs(4)[:40]
    frame = brute.frame(spark, [(d, t, "s") for d, t in docs])
    expected = brute.repeats(docs)
    for often in (2048, 5):
        monkeypatch.setattr(suffix_dedup, "OFTEN", often)
        anchors = suffix_dedup.frequent_anchors(suffix_dedup.based(frame.select("doc_id", "text"), "doc_id", "text", "base"), 50, least=2)
        assert (len(anchors) > 0) == (often == 5)
        monkeypatch.setattr(suffix_dedup, "frequent_anchors", lambda docs, length, found=anchors: found)
        rows = suffix_dedup.remove_repeats(frame).collect()
        monkeypatch.undo()
        assert {r["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows} == expected


def test_borders_of_a_frequent_anchor_spread_over_buckets():
    draw = random.Random(1)
    passage = "a passage of sixty bytes or so that is in every one of them "
    texts = [passage + "".join(draw.choices("abcdefghijklmnop ", k=60)) for _ in range(2000)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": texts, "base": [0] * 2000})
    data, begins, ends, docs, starts = next(suffix_dedup.blocks(iter([batch]), 50))
    keys = suffix_dedup.anchors_of(data, begins, ends, 50)
    hot = np.unique(keys)[np.unique(keys, return_counts=True)[1] >= 1000]
    key, run, segment, first, windows = suffix_dedup.runs_of(data, begins, ends, 50)
    of = {d: ([], []) for d in range(2000)}
    for k, s, f, w in zip(key.tolist(), segment.tolist(), first.tolist(), windows.tolist(), strict=True):
        if k in set(hot.tolist()):
            of[int(docs[s])][0].append(f)
            of[int(docs[s])][1].append(w)
    opened = batch.append_column("first", pa.array([of[d][0] for d in range(2000)], pa.list_(pa.int64()))).append_column("windows", pa.array([of[d][1] for d in range(2000)], pa.list_(pa.int32())))

    def largest(frequent):
        sizes = {}
        for out in suffix_dedup.border_rows(iter([opened]), list(range(32)), 50, frequent):
            for bucket, data in zip(out.column("bucket").to_pylist(), out.column("bytes").to_pylist(), strict=True):
                sizes[bucket] = sizes.get(bucket, 0) + len(data)
        return max(sizes.values()) / (sum(sizes.values()) / 32)

    assert largest(np.empty(0, np.uint64)) > 5 and largest(hot) < 1.5


def test_runs_that_share_an_anchor_alone_are_settled():
    import pyarrow as pa

    draw = random.Random(8)
    ids = list(range(4))

    def found(passage):
        texts = [("".join(draw.choices("abcdefghijklmnop ", k=90)) + passage + "".join(draw.choices("abcdefghijklmnop ", k=90))).encode() for _ in range(400)]
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": [t.decode() for t in texts], "base": [0] * 400})
        runs = pa.Table.from_batches(list(suffix_dedup.run_rows(iter([batch]), ids, 50, np.empty(0, np.uint64))))
        return [r for k in ids for r in pa.Table.from_batches(list(suffix_dedup.found_rows(suffix_dedup.refine_runs(iter(runs.filter(pa.array(x == k for x in runs["bucket"].to_pylist())).to_batches())), ids)), pa.schema([("bucket", pa.int32()), ("open", pa.bool_()), *((c, pa.binary()) for c in ("doc", "first", "windows"))])).to_pylist()]

    opened = lambda rows: sum(len(r["doc"]) // 8 for r in rows if r["open"])
    assert opened(found("a passage of 24 bytes, so")) == 0  # each text has the anchor, but no 35 bytes of another one
    long = found("a passage of sixty bytes or so that is in every one of them ")
    assert opened(long) > 0 and len(long) <= 2 * len(ids) ** 2  # as many rows as there are buckets, whatever the runs are


def test_refinement_writes_buckets_back():
    draw = np.random.default_rng(6)
    for length in (50, 64, 40, 130):
        parts = [draw.integers(97, 99, draw.integers(length, 260)).astype(np.uint8) for _ in range(60)]
        parts += [np.concatenate([draw.integers(97, 123, 9).astype(np.uint8), parts[k][:150]]) for k in range(30)]
        sizes = np.array([len(p) for p in parts])
        data, ends = np.concatenate(parts), np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(data))
        settled = []
        at, bucket = suffix_dedup.refined(data, left, length, settled)
        groups = {}
        for p in np.flatnonzero(left >= length).tolist():
            groups.setdefault(data[p : p + length].tobytes(), []).append(p)
        found = {}
        for p, b in zip(at.tolist(), bucket.tolist(), strict=True):
            found.setdefault(b, []).append(p)
        assert sorted(map(sorted, found.values())) == sorted(g for g in groups.values() if len(g) > 1)
        assert len(settled) == {40: 3, 50: 3, 64: 3, 130: 5}[length] and sum(settled) == sum(len(g) == 1 for g in groups.values())


def test_different_texts_of_one_id(spark):
    long = "".join(random.Random(5).choices("abcdefghijklmnop ", k=1300))
    other = "0123456789" * 7
    docs = brute.frame(spark, [(1, long[200:500], "s"), (5, long, "s"), (5, other + long[:260], "s"), (5, None, "s"), (7, other + long[1100:], "s")])
    rows = {(r["doc_id"], r["n_bytes"]): [(s["start"], s["end"]) for s in r["removed"]] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert rows[1, 300] == [] and rows[5, 0] == []
    alone = lambda text, before: brute.repeats([(k, t) for k, t in enumerate([*before, text])])[len(before)][1]
    for key, text, before in (((5, 1300), long, [long[200:500]]), ((5, 330), other + long[:260], [long[200:500]]), ((7, 270), other + long[1100:], [long[200:500], long, other + long[:260]])):
        assert sum(b - a for a, b in rows[key]) == alone(text, before)
    cut = {r["text"] for r in suffix_dedup.without_repeats(docs).collect()}
    assert len(cut) == 5 and None in cut and long[200:500] in cut


def by_rows(rows, width, percent):
    """Components of rows: with the rows of an id as one, and by texts alone."""
    sets = [(d, brute.shingle_set(t, width)) for d, t in rows]

    def smallest(same_id):
        root = list(range(len(sets)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, (d, a) in enumerate(sets):
            for j, (e, b) in enumerate(sets[:i]):
                if (a and b and 100 * len(a & b) >= percent * len(a | b)) or (same_id and d == e):
                    root[find(i)] = find(j)
        least = {}
        for i, (d, _) in enumerate(sets):
            least[find(i)] = min(least.get(find(i), d), d)
        return [least[find(i)] for i in range(len(sets))]

    return smallest(True), smallest(False)


LINKED, ALONE = " ".join(f"w{i}" for i in range(60)), " ".join(f"a{i}" for i in range(60))


@pytest.mark.parametrize("case", ["lost", "turned", "random"])
def test_ids_with_several_texts(spark, case):
    rows = [(1, LINKED), (4, ALONE), (4, LINKED + " end")]
    if case == "turned":
        rows = rows[::-1]
    elif case == "random":
        rng = random.Random(1)
        bases = [" ".join(f"b{k}x{i}" for i in range(50)) for k in range(6)]
        rows = [(rng.randint(0, 25), rng.choice(bases) + rng.choice(["", " e", " f g", " h"]) if rng.random() < 0.9 else rng.choice([None, "", "one two"])) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    of_ids, of_texts = by_rows(rows, 3, 90)
    found = ngram_join.near_duplicates(docs, 3, 90).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == sorted((d, c) for (d, _), c in zip(rows, of_ids, strict=True))
    kept = ngram_join.keep_one(docs, 3, 90).collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept))) == sorted(repr(r) for r, c in zip(rows, of_texts, strict=True) if c == r[0])


def test_components_by_rounds_and_by_one_task(spark):
    rng = random.Random(9)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 620)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    one, rounds = ({(r["node"], r["component"]) for r in components.components(df, few=few).collect()} for few in (1 << 18, 0))
    assert one == rounds and (619, 500) in one
