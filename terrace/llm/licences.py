"""License scan: sparse TF-IDF cosine of notices and licence files to templates, then inheritance along directories.

Words are hashed to a fixed number of buckets, so that document frequencies, counted over every line of the corpus, have a
bounded size. Every line of a text is compared with the notices; the whole text is compared with the notices and with whole
licence texts, as a licence file. A file without a notice of its own gets the licence of the nearest directory above it that holds a licence file, found by joins on paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import salted_left_join, stage, text_runs, with_text_columns

BUCKETS = 1 << 17
LEAST = 0.6  # cosine from which a notice or a licence file counts
MEMO_ENTRIES = 1 << 18
WORD = re.compile(r"\w[\w.-]*\w|\w").findall

# Usual wordings of public licence notices and the openings of licence files.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}


def licence_texts() -> dict[str, list[str]]:
    """Whole licence texts by name. Those beside the licences of ``TEMPLATES`` keep a relative from passing for one of them."""
    return {p.stem: [p.read_text("utf-8")] for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}


class Units:
    """Term counts of texts by unit: each non-empty line, and the whole text where it has more than one."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def bucket(self, word: str) -> int:
        found = self.memo.get(word)
        if found is None:
            found = crc32(word.lower().encode("utf-8", "replace")) % BUCKETS
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[word] = found
        return found

    def lines(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Of each line's distinct buckets: line number, bucket, count; the text of each line."""
        known = self.bucket
        buckets, sizes, owner = [], [], []
        for i, text in enumerate(texts):
            for line in (text or "").splitlines():
                words = WORD(line)
                if words:
                    buckets.extend(map(known, words))
                    sizes.append(len(words))
                    owner.append(i)
        flat = np.repeat(np.arange(len(sizes)), sizes) * BUCKETS + np.array(buckets, np.int64)
        pairs, count = np.unique(flat, return_counts=True)
        line, bucket = np.divmod(pairs, BUCKETS)
        return line, bucket, count, np.array(owner, np.int64)


def frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many lines of the corpus each bucket occurs, and the number of lines: a fixed number of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, seen, lines = Units(), np.zeros(BUCKETS, np.int64), 0
        for _, texts in text_runs(batches, "t"):
            _, bucket, _, owner = units.lines(texts)
            seen += np.bincount(bucket, minlength=BUCKETS)
            lines += len(owner)
        used = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.append(used, -1)), pa.array(np.append(seen[used], lines))], names=["bucket", "n"])

    counted = docs.select(F.col(text).alias("t")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen, lines = np.zeros(BUCKETS, np.int64), 0
    for bucket, n in counted.collect():
        if bucket < 0:
            lines = n
        else:
            seen[bucket] = n
    return seen, lines


def weights(seen: np.ndarray, lines: int) -> np.ndarray:
    return np.log((1 + lines) / (1 + seen)) + 1


def _normal(line: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    value = count * idf[bucket]
    length = np.sqrt(np.bincount(line, value * value, n))
    return value / np.maximum(length[line], 1e-300)


def scan(
    docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, text: str = "text", least: float = LEAST, texts: dict[str, list[str]] | None = None
) -> DataFrame:
    """All columns of ``docs`` and ``_notice``, ``_notice_score`` (best line), ``_file``, ``_file_score`` (whole text).

    Lines are compared with ``templates``, whole texts with ``templates`` and ``texts`` (by default ``licence_texts()``). NULL, empty and wordless texts have no licence and score 0. Ties go to the smaller licence name. Columns of ``docs`` that have these names are replaced.
    """
    docs = docs.drop("_notice", "_notice_score", "_file", "_file_score")
    seen, lines = frequencies(docs, text)
    texts = licence_texts() if texts is None else texts
    shipped = docs.sparkSession.sparkContext.broadcast((sorted({*templates, *texts}), templates, texts, weights(seen, lines)))

    def start():
        names, notices, texts, idf = shipped.value
        units = Units()
        patterns = [(i, " ".join(t.split())) for known in (notices, texts) for i, n in enumerate(names) for t in known.get(n, [])]
        n_notices = sum(map(len, notices.values()))
        owner, patterns = [i for i, _ in patterns], [t for _, t in patterns]
        row, column, count, _ = units.lines(patterns)
        matrix = np.zeros((len(patterns), BUCKETS), np.float32)
        matrix[row, column] = _normal(row, column, count, idf, len(patterns))

        def best(line, bucket, count, n, matrix, used) -> tuple[np.ndarray, np.ndarray]:
            value = _normal(line, bucket, count, idf, n)
            inside = used[bucket]
            line, bucket, value = line[inside], bucket[inside], value[inside]
            score = np.zeros((len(names), n))
            for k in range(len(matrix)):
                np.maximum(score[owner[k]], np.bincount(line, value * matrix[k, bucket], n), out=score[owner[k]])
            return score.argmax(axis=0), score.max(axis=0, initial=0)

        by_line, by_text = ((m, m.any(axis=0)) for m in (matrix[:n_notices], matrix))

        def compute(texts: list) -> list[pa.Array]:
            line, bucket, count, of = units.lines(texts)
            which, score = best(line, bucket, count, len(of), *by_line)
            notice, notice_score = np.zeros(len(texts), int), np.zeros(len(texts))
            if len(of):
                order = np.lexsort((which, -score, of))
                texts_with, first = np.unique(of[order], return_index=True)
                notice[texts_with], notice_score[texts_with] = which[order][first], score[order][first]
            pairs, at = np.unique(of[line] * BUCKETS + bucket, return_inverse=True)
            whole, whole_bucket = np.divmod(pairs, BUCKETS)
            file, file_score = best(whole, whole_bucket, np.bincount(at, count, len(pairs)), len(texts), *by_text)
            name = lambda which, score: pa.array([names[w] if s >= least else None for w, s in zip(which, score, strict=True)], pa.string())
            return [name(notice, notice_score), pa.array(np.minimum(notice_score, 1.0)), name(file, file_score), pa.array(np.minimum(file_score, 1.0))]

        return compute

    return with_text_columns(docs, text, {"_notice": "string", "_notice_score": "double", "_file": "string", "_file_score": "double"}, start)


def inherit(scanned: DataFrame, key: str, path: str = "path") -> DataFrame:
    """``key``, ``path``, ``license``, ``score``, ``origin`` (notice, directory or NULL), ``directory`` of every row.

    ``scanned`` has ``_notice``, ``_notice_score``, ``_file`` and ``_file_score``. A licence file covers its directory and all
    below it, up to nearer ones; of several in one directory the highest score counts, then the smaller licence name. A NULL
    path inherits nothing; a path without a slash lies in the root, the empty directory, which covers all paths that don't begin
    with a slash (one that does lies below the directory ``/``). Directories are resolved once each, however many files they hold.
    """
    parent = F.when(F.col(path).contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.substring(path, 1, 0))
    files = stage(scanned.select(key, path, "_notice", "_notice_score", "_file", "_file_score", parent.alias("dir")), "scanned")
    found = files.where(F.col("_file").isNotNull() & F.col("dir").isNotNull())
    best = found.groupBy(F.col("dir").alias("directory")).agg(F.min(F.struct((-F.col("_file_score")).alias("less"), F.col("_file").alias("licence"))).alias("best"))
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, F.lit(1), n), "/").alias("directory")))
    root = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("directory")))
    dirs = files.select("dir").where("dir IS NOT NULL").distinct().select("dir", F.inline(F.concat(root, above)))
    nearest = salted_left_join(dirs, best, "directory", "dir").where("best IS NOT NULL").groupBy("dir").agg(F.max(F.struct("depth", "directory", "best")).alias("near"))
    covered = salted_left_join(files, nearest, "dir", key)
    own = F.col("_notice").isNotNull()
    from_dir = ~own & F.col("near").isNotNull()
    return covered.select(
        key, path, F.when(own, F.col("_notice")).otherwise(F.col("near.best.licence")).alias("license"),
        F.when(own, F.col("_notice_score")).otherwise(-F.col("near.best.less")).alias("score"),
        F.when(own, "notice").when(from_dir, "directory").alias("origin"), F.when(from_dir, F.col("near.directory")).alias("directory"),
    )
