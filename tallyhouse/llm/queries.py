"""The queries of this subpackage over the driver's tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    bpe,
    decontaminate,
    fuzzy_lines,
    jaccard,
    licenses,
    mixing,
    repeats,
    spelling,
    token_files,
    topk,
    toxicity,
    warc,
    whitening,
)
from tallyhouse.llm.common import row_key, table

FOLDS = 5


def warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a capture, read the archives back, assemble the transactions."""
    path = warc.write_captures(table(spark, sf_dir, "pages"))
    captures = warc.transactions(warc.read_records(spark, path, payloads=False), payloads=False)
    number = lambda c: F.regexp_extract(c, r"page:(-?\d+)(?:;|$)", 1).try_cast("long")
    return captures.select(
        number("capture_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
        number("response.refers_to").alias("refers_to"), F.size("requests").alias("n_requests"),
        F.size("metadata").alias("n_metadata"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that repeat 13-word windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document covered by 400-byte strings that start anywhere else too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = repeats.repeated_spans(docs)
    light = docs.select("doc_id", *row_key("doc_id", "text"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("_whole"))
    out = light.join(spans, ["k1", "k2"], "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_spans"),
                      F.coalesce("kept_sha256", "_whole").alias("kept_sha256"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix the sources 3 : 1 : 2 (repeating) to 150 % of all words by the cube method."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    drawn = mixing.draws(docs, keep=("doc_id",))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias(
        "taken"), "copies")


def fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat or nearly repeat another line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzy_lines.drop_similar_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files of all documents and read starts, lengths and checksums back."""
    import public_tokenizers
    path = token_files.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    public_tokenizers.path("byte_bpe_50k.json"))
    rows = token_files.read_tokens(spark, path)
    return rows.select("doc_id", "start", "n_tokens", token_files.token_crc("tokens").alias("ids_crc32"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence family that each document names."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs, licenses.fit(docs))
    return found.select("doc_id", "family", "probability", F.size("licenses").cast("long").alias("n_findings"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four of five label folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=FOLDS)
    held = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    return toxicity.score_toxicity(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of each document: word 5-grams, similarity 0.8 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.linked(docs).select(F.col("key").alias("doc_id"), "class_id", "links", "n_grams")


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every 20th vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.integer_components("embedding").alias("v"))
    return topk.top_k(rows.where("vec_id % 20 = 0"), rows, k=20)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's token ids, and the text that they decode to."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.decode_tokens(bpe.encode_texts(table(spark, sf_dir, "documents"), path, keep=("doc_id",)), path)
    decimal = F.array_join(F.col("tokens").cast("array<string>"), ",")
    return rows.select("doc_id", "n_tokens", F.sha2(F.encode(decimal, "UTF-8"), 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least 6 letters and 5 occurrences, their forms and roots."""
    rows = spelling.spelling_forms(table(spark, sf_dir, "documents"), damage=199)
    return rows.select("word", "form", "root", "n", "n_near", "form_n")


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_warc_transactions": warc_transactions, "op2_decontamination": decontamination,
    "op3_repeated_bytes": repeated_bytes, "op4_source_mix": source_mix, "op5_fuzzy_line_dedup": fuzzy_line_dedup,
    "op6_token_output": token_output, "op7_license_scan": license_scan, "op8_toxicity_scores": toxicity_scores,
    "op9_jaccard_classes": jaccard_classes, "op10_exact_top_k": exact_top_k,
    "op11_bpe_round_trip": bpe_round_trip, "op12_spelling_variants": spelling_variants,
    "op13_embedding_whitening": embedding_whitening,
}

ORACLE = {
    "op1_warc_transactions": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        f AS (SELECT d, min(page_id) AS low FROM p WHERE n >= 100 GROUP BY d)
        SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
               CASE WHEN low <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN low <> page_id THEN low END AS refers_to,
               1::INTEGER AS n_requests, 1::INTEGER AS n_metadata
        FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100""",
    "op2_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        g AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
              FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
                    FROM b WHERE len(w) > 0)),
        s AS (SELECT DISTINCT size FROM g),
        x AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
              FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, s WHERE len(w) >= size)),
        h AS (SELECT x.doc_id, x.i, x.size, g.item_id FROM x JOIN g ON x.size = g.size AND x.gram = g.gram),
        c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h)
              GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS sha
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
        SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op10_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                     list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 20""",
}
