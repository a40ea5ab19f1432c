"""Registered queries of the training-data operators, with the SQL that checks those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, decontaminate, langid, licences, neighbours, quality, simhash, spelling, suffixes, urls, vafile, warc, whitening
from terrace.llm.common import fold, stage, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tokenizer() -> tuple[dict[bytes, int], str]:
    """Ranks and splitting pattern of the fixed public vocabulary."""
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@query()
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern), ranks))


@query()
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.train(docs.where(F.coalesce(fold("doc_id", 4) != 2, F.lit(True))))
    found = langid.predict(docs, prototypes)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


SQL_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@query(
    f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, list_slice(w, p0, p0 + 9) AS words FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p0 FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM iw),
dw AS (SELECT doc_id, p0, n, list_slice(w, p0, p0 + n - 1) AS words
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p0 FROM d JOIN sizes ON len(w) >= n)),
f AS (SELECT doc_id, p0, n, words FROM dw SEMI JOIN iw USING (words)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + n)) AS p FROM f) GROUP BY 1),
m AS (SELECT doc_id, list(item ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM f JOIN iw USING (words)) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)"""
)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model | None:
    """The production classifier: learns from ``documents`` and ``labels`` outside the held-out fold."""
    teaching = F.coalesce(fold("doc_id", 5) != 0, F.lit(True))
    return quality.train(table(spark, sf_dir, "documents").where(teaching), table(spark, sf_dir, "labels").where(teaching))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


@query()
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


@query(
    """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS refers_to FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN refers_to <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN refers_to <> page_id THEN refers_to END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = stage(warc.write(table(spark, sf_dir, "pages")), "warc")
    back = warc.read(archives)
    return back.select(
        F.col("record_key").cast("long").alias("page_id"), "payload_bytes", F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


@query()
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


@query()
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)


@query(
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
)
def op11_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vafile.search(vectors.where(F.col("vec_id") % 50 == 0), vectors)


@query()
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"))
    return licences.inherit(licences.scan(files), "doc_id")
