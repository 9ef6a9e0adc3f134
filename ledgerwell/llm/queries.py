"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwell.llm import alignment, bpe, collocations, fingerprints, jaccard, language, mixing, packing, pii, quality, recount, toxicity, warc
from ledgerwell.llm.shared import crc32_of_id, documents, prepared

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), TOKENIZER).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = recount.edited_counts(documents(spark, sf_dir), TOKENIZER)
    digest = F.sha2(F.encode("text", "UTF-8"), 256).alias("edited_sha256")
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_encoded_anew", digest)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(documents(spark, sf_dir))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(documents(spark, sf_dir), width=3, parts=9, whole=10)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", taken)


def toxic_model(spark: SparkSession, sf_dir: str) -> tuple:
    """Learned from the labelled documents that are not held out."""
    labels = documents(spark, sf_dir, "labels").where(F.pmod(crc32_of_id(), F.lit(3)) != 1)
    return toxicity.learn(documents(spark, sf_dir), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir), toxic_model(spark, sf_dir))
    held_out = F.pmod(crc32_of_id(), F.lit(3)) == 1
    predicted = (F.col("_score") >= 0.7).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), F.col("_score").alias("score"), predicted.alias("predicted"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(documents(spark, sf_dir, "pages")).where("problem is null")
    return read.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = documents(spark, sf_dir, "labels").where("quality = 1")
    judged = quality.judge(documents(spark, sf_dir), trusted)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.pmod(crc32_of_id(), F.lit(4)) == 2
    predicted = language.predict(docs, language.profiles(docs.where(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), BYTE_BPE, PIECE_BPE)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), BYTE_BPE)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


_RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_fingerprints,
        op3_token_counts,
        op4_pii,
        op5_jaccard_join,
        op6_mixing,
        op7_toxicity,
        op8_warc,
        op9_quality,
        op10_language_id,
        op11_alignment,
        op12_bpe,
        op13_collocations,
    )
}


def _with_folder(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepared(spark), sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES = {name: _with_folder(query) for name, query in _RAW.items()}

# SQL for the queries that DuckDB can express whole.
ORACLE = {
    "op6_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS nth
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3.0, 1.0, 2.0][(nth % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM sources
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), goals AS (
    SELECT source, source_size, least(most, coalesce((SELECT level FROM levels WHERE level * weight <= most ORDER BY most / weight, nth LIMIT 1) * weight, most)) AS goal
    FROM levels
), ranked AS (
    SELECT s.doc_id, s.size, g.source_size, g.goal,
        CASE WHEN g.source_size > 0 THEN g.goal / g.source_size ELSE 0 END AS rate,
        (row_number() OVER (PARTITION BY s.source ORDER BY s.size, md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id) - 1)::DOUBLE AS rank,
        ('0x' || substr(md5('mix-1/' || coalesce(s.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, round(goal, 6) AS target,
    ((floor((rank + 1) * rate + start) - floor(rank * rate + start)) * size)::BIGINT AS taken
FROM ranked
""",
    "op8_warc": r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), k AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p
), r AS (
    SELECT *, strlen(html) >= 1000 AND page_id <> keeper AS again FROM k
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN keeper END AS refers_to
FROM r
""",
    "op13_collocations": r"""
WITH lowered AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered)
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), counts AS (
    SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
    FROM starts, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= 10
), parts AS (
    SELECT *, array_to_string(list_slice(ws, 1, cut), ' ') AS head, array_to_string(list_slice(ws, cut + 1, k), ' ') AS rest
    FROM candidates, (VALUES (1), (2)) AS places(cut) WHERE cut < k
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.f AS a, x.f AS l, y.f AS r, cut, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM parts c JOIN counts x ON x.lang || ':' || x.phrase = c.lang || ':' || c.head
        JOIN counts y ON y.lang || ':' || y.phrase = c.lang || ':' || c.rest
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
    SELECT lang, array_to_string(list_slice(ws, i, i + 1), ' ') AS phrase, max(f) AS most
    FROM candidates, (VALUES (1), (2)) AS places(i) WHERE k = 3 GROUP BY ALL
), kept AS (
    SELECT b.* FROM lowest b LEFT JOIN longer t ON t.lang = b.lang AND t.phrase = b.phrase
    WHERE NOT coalesce(100 * t.most >= 50 * b.a, false)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000
""",
}
