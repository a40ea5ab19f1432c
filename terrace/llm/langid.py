"""Language identification with hyperdimensional profiles.

Letters have random bipolar vectors. An n-gram binds its letters' vectors, each rotated by its place; a document bundles
(adds) its n-gram vectors; a language prototype bundles the documents that carry its label. A text gets the language whose
prototype has the largest cosine with its bundle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import text_runs

DIMENSIONS = 1024
SEED = 20_011
GRAM_BLOCK = 8192
TABLE = 1 << 23  # numbers below this are counted in a table, others by sorting
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=65_536)
def _symbol(code: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(SEED + code))
    return (rng.integers(0, 2, DIMENSIONS, np.int8) * 2 - 1).astype(np.int8)


def _distinct(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, rising, and the place of each value among them, of whole numbers from 0 to ``below``.

    Numbers of few possible values are found by a table of these, without sorting.
    """
    if below > TABLE:
        return np.unique(values, return_inverse=True)
    there = np.zeros(below, bool)
    there[values] = True
    found = np.flatnonzero(there)
    place = np.empty(below, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[values]


def _counted(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, rising, and how often each occurs, of whole numbers from 0 to ``below``."""
    if below > TABLE:
        return np.unique(values, return_counts=True)
    counts = np.bincount(values, minlength=below)
    found = np.flatnonzero(counts)
    return found, counts[found]


class Grams:
    """Letter trigrams of some texts: lower-cased, every run of other characters one boundary symbol.

    ``doc``, ``gram``, ``count``: one entry per document and distinct trigram, in document order. ``first``, ``second``,
    ``third``: the symbols of each distinct trigram. ``groups`` may number the texts otherwise; ``doc`` is then that number,
    and texts of one number are counted together.
    """

    def __init__(self, texts: list[str | None], groups: np.ndarray | None = None):
        lowered = [f" {t.lower()} " if t else "" for t in texts]
        codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
        letter = _letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1] | (doc[1:] != doc[:-1])  # one boundary per run, and one where a text begins
        keep[0:1] = True
        codes, doc = np.where(letter, codes, 0)[keep], doc[keep]
        symbols, at = _distinct(codes, 0x110000)
        at = at.astype(np.int64)
        whole = (doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, bool)
        s = len(symbols)
        packed = ((at[:-2] * s + at[1:-1]) * s + at[2:])[whole] if len(doc) > 2 else np.zeros(0, np.int64)
        grams, which = _distinct(packed, s**3)
        owner, owners = (doc, len(texts)) if groups is None else (groups[doc], int(groups.max(initial=-1)) + 1)
        pair = owner[2:][whole] * max(len(grams), 1) + which if len(grams) else np.zeros(0, np.int64)
        pairs, self.count = _counted(pair, owners * max(len(grams), 1))
        self.doc, self.gram = np.divmod(pairs, max(len(grams), 1))
        self.first, self.second, self.third = (symbols[x] for x in (grams // (s * s), grams // s % s, grams % s)) if s else (grams,) * 3
        self.n = len(grams)
        self.has_letter = np.bincount(doc, codes > 0, len(texts)) > 0

    def vectors(self, start: int, stop: int) -> np.ndarray:
        """Bound vectors of the trigrams start..stop."""
        out = None
        for turn, codes in ((2, self.first), (1, self.second), (0, self.third)):
            values, at = np.unique(codes[start:stop], return_inverse=True)
            turned = np.stack([np.roll(_symbol(int(c)), turn) for c in values])[at]
            out = turned if out is None else out * turned
        return out.astype(np.float32)

    def bundles(self, owner: np.ndarray, owners: int) -> np.ndarray:
        """One bundle (float64, whole numbers) per owner; ``owner`` is given per entry, rising or -1 for none."""
        out = np.zeros((owners, DIMENSIONS))
        for start in range(0, self.n, GRAM_BLOCK):
            block = self.vectors(start, min(start + GRAM_BLOCK, self.n))
            inside = np.flatnonzero((self.gram >= start) & (self.gram < start + GRAM_BLOCK) & (owner >= 0))
            own = owner[inside]
            cuts = np.flatnonzero(np.diff(own)) + 1
            for part in np.split(inside, cuts) if len(inside) else ():
                weights = self.count[part]
                exact = np.float32 if weights.sum() < 1 << 24 else np.float64
                out[owner[part[0]]] += weights.astype(exact) @ block[self.gram[part] - start]
        return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype per label value; rows without a label teach nothing.

    Each task bundles its rows per label; the sums per label and dimension are combined by Spark. What is collected is one
    vector of ``DIMENSIONS`` numbers per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, texts in text_runs(batches, "t"):
            labels = part.column(1).to_pylist()
            names = sorted(set(labels))
            number = {x: i for i, x in enumerate(names)}
            grams = Grams(texts, np.array([number[x] for x in labels], np.int64))
            for name, bundle in zip(names, grams.bundles(grams.doc, len(names)), strict=True):
                sums[name] = sums.get(name, 0) + bundle
        for name, bundle in sums.items():
            place = pa.array(np.arange(DIMENSIONS, dtype=np.int32))
            yield pa.record_batch([pa.array([name] * DIMENSIONS), place, pa.array(bundle.astype(np.int64))], names=["lang", "place", "total"])

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
    summed = known.mapInArrow(run, "lang string, place int, total bigint").groupBy("lang", "place").agg(F.sum("total").alias("total"))
    prototypes: dict[str, np.ndarray] = {}
    for name, place, total in summed.collect():
        prototypes.setdefault(name, np.zeros(DIMENSIONS))[place] = total
    return prototypes


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (cosine, not below 0) of every row, repeated rows and NULL keys included.

    A text that is NULL or has no letter, and every text when nothing was learned, is ``und`` with score 0. Equal cosines
    go to the smaller language name.
    """
    names = sorted(prototypes)
    rows = np.stack([prototypes[n] for n in names]) if names else np.zeros((0, DIMENSIONS))
    rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
    shipped = docs.sparkSession.sparkContext.broadcast((names, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = shipped.value
        for part, texts in text_runs(batches, "t", 1 << 20):
            grams = Grams(texts)
            bundles = grams.bundles(grams.doc, len(texts))
            lengths = np.linalg.norm(bundles, axis=1)
            known = grams.has_letter & (lengths > 0) & bool(names)
            cosines = bundles @ rows.T / np.maximum(lengths, 1e-300)[:, None] if names else np.zeros((len(texts), 1))
            best = np.argmax(cosines, axis=1)
            score = np.where(known, np.clip(cosines[np.arange(len(texts)), best], 0, 1), 0.0)
            label = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.record_batch([part.column(0), pa.array(label, pa.string()), pa.array(score)], names=["k", "lang_pred", "score"])

    cols = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = cols.schema["k"].dataType.simpleString()
    return cols.mapInArrow(run, f"k {kind}, lang_pred string, score double").withColumnRenamed("k", key)
