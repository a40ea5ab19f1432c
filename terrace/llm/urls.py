"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the URLs that no rule fits."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage

SAMPLE = 20_000  # labelled URLs that the trees are fitted on
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789.-"
BUCKETS = 4096  # hash buckets of host suffixes (of two labels and of one) and of first path segments
FOLDS = 5  # of hosts: a labelled URL's suffix statistics leave out the labels of its own fold
FEATURES = [
    "suffix_blocked", "top_blocked", "head_blocked", "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "query_length",
    "parameters", "has_fragment", "secure", "longest_label", "suffix_count", "top_count", "head_count",
]


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://`` or for NULL."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_for(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule that fits, or NULL. A rule ``host/path`` fits its host and all subdomains, by path prefix."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _features(pages: DataFrame, url: str) -> DataFrame:
    """Lexical features of ``url`` (NULL: the empty text), next to ``host`` and ``path``."""
    whole = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.length(whole), F.lit(1))
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    size = F.greatest(F.length("host"), F.lit(1))
    counted = [F.length("host") - F.length(F.translate("host", c, "")) for c in ALPHABET]
    shares = F.transform(F.array(*counted, F.length(F.translate("host", ALPHABET, ""))), lambda c: c / size)
    parts = {"suffix": F.substring_index("host", ".", -2), "top": F.substring_index("host", ".", -1), "head": F.substring_index("path", "/", 2)}
    return pages.select(
        "*", F.length(whole).alias("length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.size(F.filter(F.split("path", "/"), lambda s: s != "")).alias("depth"), F.size(F.split("host", r"\.")).alias("labels"),
        (F.length(F.regexp_replace(whole, "[^0-9]", "")) / n).alias("digit_ratio"), F.length(F.regexp_replace("host", "[^-]", "")).alias("hyphens"),
        F.aggregate(shares, F.lit(0.0), lambda a, p: F.when(p > 0, a - p * F.log2(p)).otherwise(a)).alias("entropy"), F.length(query).alias("query_length"),
        F.size(F.filter(F.split(query, "&"), lambda s: s != "")).alias("parameters"), whole.contains("#").cast("int").alias("has_fragment"),
        whole.startswith("https:").cast("int").alias("secure"), F.array_max(F.transform(F.split("host", r"\."), F.length)).alias("longest_label"),
        *(F.pmod(F.xxhash64(part), F.lit(BUCKETS)).cast("int").alias(b) for b, part in parts.items()),
        F.pmod(F.xxhash64("host", F.lit(17)), F.lit(FOLDS)).cast("int").alias("fold"),
    )


def _labelled(pages: DataFrame, rules: list[tuple[str, str]], key: str, url: str) -> tuple[DataFrame, int, int]:
    """Rows with their features, rule and ``label`` (1 block, 0 allow, else NULL), and how many are labelled allow and block.

    A suffix statistic that held a URL's own label would tell the trees in training what no other URL can tell them. So the
    statistics of a labelled URL are those of the other folds of hosts, as if its own host had none. Both kinds of label weigh as
    much in total, so a suffix without labels stands at one half. How common a suffix is counts by powers of two, lest the number
    name the suffix.
    """
    named = pages.select(F.col(key).alias("k"), F.col(url).alias("url")).select("k", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    ruled = named.withColumn("rule", rule_for(rules, F.col("host"), F.col("path")))
    kind = F.lit(None).cast("double")
    for rule, verdict in dict(rules).items():
        kind = F.when(F.col("rule") == rule, F.lit(float(verdict == "block"))).otherwise(kind)
    rows = stage(_features(ruled, "url").withColumn("label", kind), "urls")
    allowed, blocked = rows.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    weigh = {"allow": 1 / max(allowed, 1), "block": 1 / max(blocked, 1)}
    known = F.col("label").isNotNull().cast("int")
    for name in ("suffix", "top", "head"):
        # At most BUCKETS x FOLDS rows, from counts combined before the shuffle.
        counts = rows.groupBy(name, "fold").agg(
            F.count("*").alias("n"), F.count_if(F.col("label") == 0).alias("a"), F.count_if(F.col("label") == 1).alias("b")
        )
        counts = stage(counts, "suffixes")
        total = counts.groupBy(name).agg(F.floor(F.log2(F.sum("n"))).cast("int").alias(f"{name}_count"), F.sum("a").alias("allow"), F.sum("b").alias("block"))
        rows = rows.join(F.broadcast(total), name).join(F.broadcast(counts.drop("n")), [name, "fold"])
        allow, block = ((F.col(c) - known * F.col(own)) * weigh[c] for c, own in (("allow", "a"), ("block", "b")))
        even = (weigh["allow"] + weigh["block"]) / 2
        rows = rows.withColumn(f"{name}_blocked", (block + even) / (block + allow + 2 * even)).drop("allow", "block", "a", "b")
    return rows, allowed, blocked


def judge(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` of every row, repeated rows and NULL keys included.

    ``rules`` are (``host/path``, ``allow`` or ``block``); the longest that fits gives the verdict. The URLs that a rule
    fits are the labelled ones: about ``sample`` of them, drawn by hash of the URL, train boosted trees that judge the
    others (score: probability of block where both kinds are as common; block above one half). Suffix statistics (how common the last
    two host labels are, the last, and the first path segment, and how the labelled URLs among them weigh) are counted over all rows in a fixed number of
    hash buckets. NULL URLs and URLs without ``://`` have an empty host and path. Where the labelled URLs are not of both
    kinds, all other URLs get the one label there is, or allow.
    """
    rows, allowed, blocked = _labelled(pages, rules, key, url)
    if allowed and blocked:
        scored = _fit(rows, sample, allowed, blocked).transform(rows).withColumn("score", vector_to_array("probability")[1])
    else:
        scored = rows.withColumn("score", F.lit(float(blocked > 0)))
    own = F.when(F.col("label") > 0, "block").when(F.col("label").isNotNull(), "allow")
    method = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return scored.select(F.col("k").alias(key), "host", "path", "rule", F.coalesce(own, method).alias("verdict"), "score")


def held_out_auc(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url", sample: int = SAMPLE) -> float | None:
    """Area under the curve over the labelled URLs of one fold of hosts, scored by trees fitted on the others.

    None where the fitted or the held-out labels are not of both kinds. The held-out URLs' statistics leave out their own fold.
    """
    rows, allowed, blocked = _labelled(pages, rules, key, url)
    labelled = rows.where("label IS NOT NULL")
    sides = {held: labelled.where("fold = 0" if held else "fold <> 0") for held in (True, False)}
    if any(side.select("label").distinct().count() < 2 for side in sides.values()):
        return None
    scored = _fit(sides[False], sample, allowed, blocked).transform(sides[True])
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(scored)


def _fit(rows: DataFrame, sample: int, allowed: int, blocked: int) -> PipelineModel:
    """Boosted trees on about ``sample`` labelled rows, both kinds of equal weight; equal URLs are drawn once."""
    share = min(1.0, sample / (allowed + blocked))
    unit = (F.xxhash64("url", F.lit(3)) / F.lit(float(1 << 63)) + 1) / 2
    drawn = rows.where(F.col("label").isNotNull() & (unit < share)).dropDuplicates(["url"]).select("label", *FEATURES)
    weight = F.when(F.col("label") > 0, (allowed + blocked) / (2 * blocked)).otherwise((allowed + blocked) / (2 * allowed))
    few = stage(drawn.withColumn("weight", weight).coalesce(4), "sample")
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=20, maxDepth=4, stepSize=0.3, seed=1, maxBins=64)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(few)
