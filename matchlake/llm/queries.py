"""Registered queries of the training-data operators, and SQL for those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import (
    ads_search,
    angle_negatives,
    dart_minhash,
    html_crf,
    license_scan,
    line_runs,
    mixing,
    nn_descent,
    pair_bitmaps,
    simple8b,
    suffix_dedup,
    trie_bpe,
    zstd_langid,
)
from matchlake.llm.shared import Scratch, small_batches, table

END_ID = 2
#: Of so many rows one is a query or an anchor.
QUERY_STEP = 50


def op1_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "repeats")


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pages = table(spark, sf_dir, "pages")
    text = html_crf.main_text(F.col("html"), html_crf.trained())
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scanned = table(spark, sf_dir, "documents").select(
        "doc_id", license_scan.licences(F.col("text")).alias("s")
    )
    base = F.filter("s.hits", lambda h: h["base"])
    places = F.transform(base, lambda h: h["word"])

    def joined(hits):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    closest = F.array_max(F.transform("s.hits", lambda h: h["closeness"]))
    return scanned.select(
        "doc_id",
        F.col("s.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("s.hits")).alias("labels"),
        F.coalesce(closest, F.lit(0.0)).alias("score"),
        F.transform(
            "s.hits",
            lambda h: F.struct(*[h[c].alias(c) for c in ("label", "word", "words", "edits", "found")]),
        ).alias("spans"),
    )


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_search.search(table(spark, sf_dir, "embeddings"))


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.drop_repeated_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op8_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    folder = Scratch(spark, "token-ids").folder
    simple8b.write_ids(
        table(spark, sf_dir, "documents"),
        folder,
        public_tokenizers.path("word_bpe_49k.json"),
        END_ID,
    )
    return simple8b.read_ids(spark, folder, simple8b.crc32, "long").withColumnRenamed(
        "value", "ids_crc32"
    )


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Digests of the ids of whole texts, and of the texts the ids decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return (
        docs.select("doc_id", trie_bpe.token_ids_and_text(F.col("text"), path).alias("t"))
        .select("doc_id", "t.*")
        .select(
            "doc_id",
            F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
            F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        )
    )


def op10_zstd_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held = zstd_langid.held_out("doc_id")
    model = zstd_langid.train(docs.where(~held))
    answered = docs.select(
        "doc_id", held.alias("held_out"), zstd_langid.language("text", model).alias("a")
    )
    return answered.select(
        "doc_id",
        "held_out",
        F.col("a.lang").alias("lang_pred"),
        F.col("a.score").alias("score"),
        F.col("a.accepted").alias("accepted"),
    )


def op11_angle_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10)))
    return angle_negatives.hard_negatives(
        rows.withColumn("label", F.coalesce(moved, F.col("label"))),
        F.pmod("vec_id", F.lit(QUERY_STEP)) == 0,
    )


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pair_bitmaps.aligned(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.drop_repeated_bytes(docs).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_sainte_lague_mixing,
        op2_dart_minhash,
        op3_html_crf,
        op4_license_scan,
        op5_nn_descent,
        op6_adaptive_scan,
        op7_line_runs,
        op8_simple8b,
        op9_trie_bpe,
        op10_zstd_langid,
        op11_angle_negatives,
        op12_pair_bitmaps,
        op13_induced_suffixes,
    )
}

_LINE_KEYS = """
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
  )
),
repeated AS (
  SELECT line_key FROM keyed WHERE length(line_key) >= 1
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
)"""

ORACLES = {
    "op7_line_runs": f"""
WITH {_LINE_KEYS}
SELECT doc_id,
       count(*) AS n_lines,
       count(*) FILTER (r.line_key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (r.line_key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key
GROUP BY doc_id
""",
    "op11_angle_negatives": """
WITH part AS (
  SELECT row_number() OVER () AS uid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.uid AS a, a.vec_id AS anchor_id, r.uid, r.vec_id, a.label = r.label AS same,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM part a JOIN part r ON a.vec_id % 50 = 0 AND a.uid <> r.uid AND len(a.v) = len(r.v)
),
positive AS (
  SELECT a, anchor_id, uid, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.a, p.uid ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.a = p.a AND NOT s.same
WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
