"""Brute-force versions that the operators are compared with."""

import hashlib
import re
from collections import defaultdict

import public_tokenizers
import tiktoken
import tiktoken.load

ODD_DOCS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 8, "x"),
    (2, "The quick brown fox jumps over the lazy dog. " * 8, "x"),
    (3, "the QUICK brown fox jumps over the lazy dog. " * 8, "y"),
    (4, None, None),
    (5, "", "z"),
    (6, "   \n\t ", "z"),
    (7, "two words", "z"),
    (8, "Two  Words", "z"),
    (9, "äöü ß 日本語 😀 é " * 12 + "\x1c\x1d", "w"),
    (10, "abc " * 9000, "w"),
    (11, "x" * 70000, "w"),
    (12, "Start " + "the quick brown fox jumps over the lazy dog. " * 3 + "unique end of this one here", "v"),
    (13, "line one\nline two\n\nline four\n", "v"),
    (14, "'s 't it's we'll 123,456.78 !!! \r\n end", "v"),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, width):
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def jaccard_components(docs, width, percent):
    sets = {d: shingle_set(t, width) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = defaultdict(list)
    for d in sorted(sets):
        common = defaultdict(int)
        for s in sets[d]:
            for o in seen[s]:
                common[o] += 1
            seen[s].append(d)
        for o, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[o]) - n):
                a, b = root(d), root(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def repeats(docs, length=50):
    first, found = {}, {}
    for d, t in sorted(docs):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first.setdefault(data[i : i + length], d) < d:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        found[d] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def section_counts(text):
    """Tokens of each line of a text, with its line end: by walking tokens' bytes and counting characters, ties to the earlier line."""
    library = tiktoken.Encoding("brute", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tiktoken.load.load_tiktoken_bpe(RANKS), special_tokens={})
    lines = text.split("\n")
    lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
    line_of = [k for k, x in enumerate(lines) for _ in x]
    char_of = [k for k, c in enumerate(text) for _ in c.encode()]
    ids, at = library.encode_ordinary(text), 0
    counts, crossing = [0.0] * len(lines), [0] * len(lines)
    for i in ids:
        size = len(library.decode_single_token_bytes(i))
        touched = [line_of[c] for c in dict.fromkeys(char_of[at : at + size])]
        own = sorted(set(touched), key=lambda k: (-touched.count(k), k))
        counts[own[0]] += 1
        for k in own if len(own) > 1 else ():
            crossing[k] += 1
        at += size
    ends = [sum(map(len, lines[: k + 1])) for k in range(len(lines))]
    return {k: (ends[k] - len(x), ends[k], counts[k], crossing[k], len(ids)) for k, x in enumerate(lines)}


def frame(spark, docs=ODD_DOCS):
    """A documents table with columns that clash with those the operators make."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(d, t, s) for d, t, s in docs], "doc_id long, text string, source string")
    return rows.select("*", F.lit("clash").alias("ids"), F.lit(1).alias("n"), F.lit(2).alias("length"), F.lit(3).alias("score"), F.lit(4).alias("tile"), F.lit("c").alias("found"))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
