"""Benchmark decontamination: exact item-sized word windows found by a prefix-filtered set join.

Containment of a whole window needs every one of its words, so the necessary prefix of a window is one token: its rarest
word. A document word joins the windows whose prefix token it is; the token's place in the window fixes where the window
would start (positional bound), the words left in the document whether it fits (length bound), and only then are the words
compared. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import BROADCAST_BYTES, broadcast_if_small, measured, stage

WINDOW = 10
SEGMENT = 64
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, split at every ASCII character that is no digit or small letter. NULL has none."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item`` (the key as text, NULL as empty text) and ``words`` of every distinct window of each item."""
    listed = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return listed.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), window).alias("words")).distinct()


def segments(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Overlapping slices of each document's words: every window of the document lies whole in one slice."""
    step = SEGMENT - (window - 1)
    cut = docs.select(key, words(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(step))
    slices = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice("w", s + 1, SEGMENT).alias("words")))
    return cut.select(key, F.inline(slices))


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per distinct document key: n_words, n_hit, n_items, items_sha256, contaminated.

    NULL and empty texts have no words and no hits; an item without words has no window; an item of fewer words than a
    window is one window. Rows that repeat a document key are taken as more texts of one document (a NULL key is a key):
    words and hits add up, equal rows count once. The digest of no items is that of the empty string.
    """
    docs = docs.select(F.struct(F.col(key).alias("doc"), F.xxhash64(text).alias("part")).alias("id"), F.col(text).alias("text"))
    listed = stage(windows(items, item_key, item_text, window), "items")
    contents = listed.select("words").distinct().withColumn("window", F.xxhash64("words"))
    tokens = contents.select(F.explode("words").alias("token")).distinct()
    tokens = broadcast_if_small(tokens, measured(tokens), limit)

    # Rarity over the whole corpus, of the words that items use.
    seen = docs.select(F.explode(words(F.col("text"))).alias("token")).join(tokens, "token").groupBy("token").agg(F.count("*").alias("n"))
    ranked = contents.select("words", F.posexplode("words").alias("offset", "token")).join(seen, "token", "left")
    rarest = ranked.groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("least"))
    # A window with a word that no document has occurs nowhere.
    prefixes = stage(rarest.where("least.n > 0").select(F.col("least.token").alias("token"), F.col("least.offset").alias("offset"), F.size("words").alias("length"), F.col("words").alias("wanted")), "prefixes")
    size = measured(prefixes)
    prefixes = broadcast_if_small(prefixes, size, limit)

    cut = segments(docs, "id", "text", window)
    carried = ["words"] if size <= limit else []  # slices are not shuffled once per word: past the limit they are joined back
    spread = cut.select("id", "start", *carried, F.posexplode("words").alias("at", "token"))
    joined = spread.join(prefixes, "token").withColumn("from", F.col("at") - F.col("offset"))
    joined = joined if carried else joined.join(cut, ["id", "start"])
    fits = (F.col("from") >= 0) & (F.col("from") + F.col("length") <= F.size("words"))
    found = joined.where(fits).where(F.slice("words", F.col("from") + 1, F.col("length")) == F.col("wanted"))
    found = stage(found.select("id", (F.col("start") + F.col("from")).alias("from"), "length", "wanted"), "found")

    hits = found.select("id", F.explode(F.sequence("from", F.col("from") + F.col("length") - 1)).alias("at")).distinct()
    hits = hits.groupBy("id.doc").agg(F.count("*").alias("n_hit"))
    occurring = found.select("id.doc", "wanted").distinct().join(listed.withColumnRenamed("words", "wanted"), "wanted").select("doc", "item").distinct()
    matched = occurring.groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"))
    sizes = docs.groupBy("id").agg(F.max(F.size(words(F.col("text"))).cast("long")).alias("n"))
    counts = sizes.groupBy("id.doc").agg(F.sum("n").alias("n_words"))

    def same(right: str) -> Column:
        return counts["doc"].eqNullSafe(F.col(f"{right}.doc"))

    joined = counts.join(hits.alias("h"), same("h"), "left").join(matched.alias("m"), same("m"), "left")
    n_hit, names = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        counts["doc"].alias(key), "n_words", n_hit.cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
