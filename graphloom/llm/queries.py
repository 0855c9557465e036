"""The queries of this subpackage, each over whole tables, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import audio, byte_bpe, chat, merkle, ngram_join, packing, quality, suffix_dedup, token_counts, token_files, topk, url_filters, vector_codes
from graphloom.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.col("ids")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN).select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out()))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), quality.scorer(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def dated_list(pages: DataFrame) -> DataFrame:
    """A dated list for the pages' domains: each registered domain is blocked on a day of early 2024, allowed again 60 days later, and its blog hosts are blocked from May on."""
    hosts = pages.select(url_filters.host(F.col("url")).alias("host")).where("host is not null").distinct()
    parts = F.split("host", r"\.")
    domains = hosts.select(F.array_join(F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), 3), ".").alias("pattern")).distinct()
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.length("pattern") * 7 % 90).cast("int"))
    blocked = domains.select("pattern", day.alias("listed_at"), F.lit("block").alias("action"))
    allowed = domains.select("pattern", F.date_add(day, 60).alias("listed_at"), F.lit("allow").alias("action"))
    blogs = hosts.where(F.col("host").startswith("blog.")).select(F.col("host").alias("pattern"), F.lit("2024-05-01").cast("date").alias("listed_at"), F.lit("block").alias("action"))
    return blocked.unionByName(allowed).unionByName(blogs)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 180).cast("int")))
    judged = url_filters.judge(captures, dated_list(pages))
    text = lambda c: F.col(c).cast("date").cast("string").alias(c)
    return judged.select("page_id", "url", text("fetched_on"), "host", "matched_pattern", text("listed_at"), "action", F.coalesce(F.col("action") != "block", F.lit(True)).alias("kept"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op7_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audio.kept(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.lit(False))
    proven = merkle.of_documents(table(spark, sf_dir, "documents"), lambda text: F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text))
    found = proven.select(F.col("key").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", merkle.proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"), merkle.folded(F.col("altered"), F.col("left"), F.col("right")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    found = vector_codes.with_label_errors(codes)
    return found.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


def codes_sql(rounds: int) -> str:
    """Each round as its own tables: r<i> are the entries after i rounds, n<i> the nearest ones of each part."""

    def nearest(i: int) -> str:
        return f"""
        n{i} AS MATERIALIZED (
            SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
            FROM (SELECT p.vec_id, p.part, r.entry, coalesce(list_sum(list_transform(list_zip(p.v, r.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0)::BIGINT AS d FROM parts p JOIN r{i} r ON r.part = p.part)
            GROUP BY vec_id, part)"""

    def improved(i: int) -> str:
        return f"""
        r{i + 1} AS MATERIALIZED (
            SELECT r.part, r.entry, coalesce(m.v, r.v) AS v
            FROM r{i} r LEFT JOIN (
                SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY place) AS v
                FROM (SELECT n.part, n.entry, g.place, sum(p.v[g.place])::BIGINT AS s, count(*) AS c FROM n{i} n JOIN parts p ON p.vec_id = n.vec_id AND p.part = n.part, (SELECT unnest(range(1, width + 1)) AS place FROM shape) g GROUP BY 1, 2, 3)
                GROUP BY part, entry) m ON m.part = r.part AND m.entry = r.entry)"""

    steps = ",".join(f"{nearest(i)},{improved(i)}" for i in range(rounds))
    return f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        shape AS (SELECT max(len(v)) // 8 AS width FROM kept),
        parts AS MATERIALIZED (SELECT vec_id, part, v[part * width + 1 : (part + 1) * width] AS v FROM kept, shape, (SELECT unnest(range(8)) AS part)),
        r0 AS MATERIALIZED (
            SELECT part, entry, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept) USING (vec_id) WHERE entry < 16),{steps},{nearest(rounds)},
        codes AS (SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM n{rounds} GROUP BY vec_id),
        books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM r{rounds})
        SELECT c.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, b.h AS codebooks_sha256
        FROM codes c JOIN kept k USING (vec_id), books b
    """


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.conversations(chat.merge(chats, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_byte_bpe, op2_ngram_join, op3_quality, op4_topk, op5_url_filters, op6_token_counts, op7_audio, op8_suffix_dedup, op9_packing, op10_token_files, op11_merkle, op12_vector_codes, op13_chat)}
ORACLES: dict[str, str] = {
    "op4_topk": """
        WITH clean AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM clean q JOIN clean c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 20
    """,
    "op2_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[i : i + 2] END AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common >= 90 * (x.n + y.n - common)),
        reach(doc_id, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.node)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY 1) r ON r.doc_id = d.doc_id
    """,
    "op5_url_filters": r"""
        WITH captures AS (
            SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 180 AS INTEGER) AS day,
                   nullif(lower(rtrim(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '.')), '') AS host
            FROM pages),
        hosts AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL),
        domains AS (SELECT DISTINCT array_to_string(p[greatest(len(p) - 2, 1) : ], '.') AS pattern FROM (SELECT string_split(host, '.') AS p FROM hosts)),
        dated AS (SELECT pattern, DATE '2024-01-01' + CAST(length(pattern) * 7 % 90 AS INTEGER) AS day FROM domains),
        entries AS (
            SELECT pattern, day AS listed_at, 'block' AS action FROM dated
            UNION ALL SELECT pattern, day + 60, 'allow' FROM dated
            UNION ALL SELECT host, DATE '2024-05-01', 'block' FROM hosts WHERE host LIKE 'blog.%'),
        single AS (SELECT pattern, listed_at, max(action) AS action FROM entries GROUP BY 1, 2),
        met AS (
            SELECT c.page_id, e.*, row_number() OVER (PARTITION BY c.page_id ORDER BY length(e.pattern) DESC, e.listed_at DESC) AS r
            FROM captures c JOIN single e ON (c.host = e.pattern OR ends_with(c.host, '.' || e.pattern)) AND e.listed_at <= c.day)
        SELECT c.page_id, c.url, CAST(c.day AS VARCHAR) AS fetched_on, c.host, m.pattern AS matched_pattern, CAST(m.listed_at AS VARCHAR) AS listed_at, m.action, coalesce(m.action <> 'block', true) AS kept
        FROM captures c LEFT JOIN met m ON m.page_id = c.page_id AND m.r = 1
    """,
    "op8_suffix_dedup": """
        WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        sized AS (SELECT doc_id, h, len(h) // 2 AS n FROM bytes),
        places AS (SELECT doc_id, h, n, unnest(range(n)) AS p FROM sized),
        starts AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM places WHERE p <= n - 50),
        firsts AS (SELECT s, min(doc_id) AS first FROM starts GROUP BY s),
        later AS (SELECT doc_id, p FROM starts JOIN firsts USING (s) WHERE first < doc_id),
        marked AS (SELECT a.doc_id, a.p, substr(a.h, 2 * a.p + 1, 2) AS byte, l.p IS NOT NULL AS begins FROM places a LEFT JOIN later l ON l.doc_id = a.doc_id AND l.p = a.p),
        covered AS (SELECT doc_id, p, byte, bool_or(begins) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM marked),
        edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM covered),
        cut AS (
            SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
                   string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept
            FROM edges GROUP BY doc_id)
        SELECT s.doc_id, s.n AS n_bytes, coalesce(c.n_removed, 0) AS n_removed, coalesce(c.n_spans, 0) AS n_spans, sha256(unhex(coalesce(c.kept, ''))) AS kept_sha256
        FROM sized s LEFT JOIN cut c ON c.doc_id = s.doc_id
    """,
    "op11_merkle": r"""
        WITH RECURSIVE checked AS (
            SELECT *, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
                lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT) AS crc
            FROM documents),
        texts AS (SELECT *, CASE WHEN crc % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS altered FROM checked),  -- the final complement turns 1 into 0
        fields AS (
            SELECT doc_id, source, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text, altered], lambda v: CASE WHEN v IS NULL THEN '-' ELSE CAST(octet_length(encode(v)) AS VARCHAR) || ':' || v END) AS f FROM texts),
        leaves AS (
            SELECT doc_id, source, sha256(f[1] || f[2] || f[3] || f[4] || f[5]) AS leaf, sha256(f[1] || f[2] || f[3] || f[4] || f[6]) AS altered FROM fields),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
        tree AS (
            SELECT 0 AS level, source, idx, leaf AS h, n FROM ranked
            UNION ALL
            SELECT level + 1, source, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM tree WHERE n > 1 GROUP BY level, source, idx // 3),
        subroots AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM tree WHERE n = 1),
        top AS (
            SELECT 0 AS level, idx, h, n FROM subroots
            UNION ALL
            SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM top WHERE n > 1 GROUP BY level, idx // 3),
        beside AS (
            SELECT level, source, idx, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM tree WHERE n > 1 WINDOW r AS (PARTITION BY source, level, idx // 3 ORDER BY idx)),
        beside_top AS (
            SELECT level, idx, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM top WHERE n > 1 WINDOW r AS (PARTITION BY level, idx // 3 ORDER BY idx)),
        walk AS (
            SELECT idx AS place, source, 0 AS level, idx, altered AS h, '' AS proof FROM ranked
            UNION ALL
            SELECT place, w.source, w.level + 1, w.idx // 3, sha256(b.l || w.h || b.r), proof || b.l || b.r
            FROM walk w JOIN beside b ON b.source IS NOT DISTINCT FROM w.source AND b.level = w.level AND b.idx = w.idx),
        climbed AS (SELECT place, source, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM walk GROUP BY place, source),
        walk_top AS (
            SELECT c.place, c.source, 0 AS level, s.idx, c.h, c.proof FROM climbed c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
            UNION ALL
            SELECT place, source, w.level + 1, w.idx // 3, sha256(b.l || w.h || b.r), proof || b.l || b.r
            FROM walk_top w JOIN beside_top b ON b.level = w.level AND b.idx = w.idx),
        done AS (SELECT place, source, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM walk_top GROUP BY place, source)
        SELECT r.doc_id, r.leaf, s.h AS subroot, t.h AS root, sha256(d.proof) AS proof_sha256, d.h AS folded_root, d.h = t.h AS verified
        FROM ranked r JOIN done d ON d.place = r.idx AND d.source IS NOT DISTINCT FROM r.source
        JOIN subroots s ON s.source IS NOT DISTINCT FROM r.source JOIN (SELECT h FROM top WHERE n = 1) t ON true
    """,
    "op12_vector_codes": codes_sql(6),
}
