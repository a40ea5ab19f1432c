"""Language profiles, quality, tokens, decontamination, licences: results, and the cases that inputs may hold."""

import hashlib
import random

import numpy as np
import pytest

from terrace.llm import bpe, decontaminate, langid, licences, quality
from terrace.llm.queries import ORACLES, QUERIES, tokenizer

from oracle import compare, connect

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "  \n "), (4, "x"), (5, "word " * 30_000), (5, "word " * 30_000), (6, "é\x00🙂 ﬁ"), (None, "the cat")]


def frame(spark, rows, shape="doc_id long, text string"):
    return spark.createDataFrame(rows, shape)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == []


def plain_merges(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            break
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_merges_equal_a_plain_loop():
    ranks, _ = tokenizer()
    rng = random.Random(1)
    for n in [1, 2, 3, 5, 8, 17, 64, 300]:
        for letters in (b"ab", b"the anio", bytes(range(256))):
            piece = bytes(rng.choice(letters) for _ in range(n))
            expected = [ranks[piece]] if piece in ranks else plain_merges(piece, ranks)
            assert bpe.merge(piece, ranks) == expected


def test_tokens_equal_the_library_and_decode_back(spark):
    import tiktoken

    ranks, pattern = tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(frame(spark, ODD))
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = bpe.digests(bpe.decode(bpe.encode(docs, ranks, pattern), ranks)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids := library.encode_ordinary(t)), sha(",".join(map(str, ids)).encode()), sha(t.encode())) for i, t in texts]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    carried = bpe.with_digests(docs, ranks, pattern)
    assert carried.columns == ["doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(str(tuple(r)) for r in carried.drop("text").collect()) == sorted(map(str, want))


def test_memo_generations_do_not_change_ids(monkeypatch):
    ranks, pattern = tokenizer()
    text = " ".join(f"wort{i % 37} zeile{i}" for i in range(500))
    whole = bpe.Encoder(ranks, pattern).encode(text)
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 5)
    assert np.array_equal(bpe.Encoder(ranks, pattern).encode(text), whole)


def test_language_bundles_equal_a_plain_sum():
    texts = ["The cat, the hat.", None, "", "ÉTÉ 12 été", "a" * 50]
    grams = langid.Grams(texts)
    bundles = grams.bundles(grams.doc, len(texts))
    for text, bundle in zip(texts, bundles):
        letters = []
        for c in f" {text.lower()} " if text else "":
            code = ord(c) if c.isalpha() else 0
            if code or not letters or letters[-1]:
                letters.append(code)
        total = np.zeros(langid.DIMENSIONS)
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            total += np.roll(langid._symbol(a), 2).astype(int) * np.roll(langid._symbol(b), 1) * langid._symbol(c)
        assert np.array_equal(total, bundle)


def test_language_trigrams_are_the_same_by_table_and_by_sorting(monkeypatch):
    texts = ["The cat, the hat.", None, "", "ÉTÉ 12 été", "\U0001d51e漢字 the cat"]
    fields = ("doc", "gram", "count", "first", "second", "third", "has_letter")
    groups = np.array([1, 0, 1, 0, 1])
    tabled, joined = langid.Grams(texts), langid.Grams(texts, groups)
    assert np.array_equal(joined.bundles(joined.doc, 2), [tabled.bundles(tabled.doc, 5)[groups == g].sum(axis=0) for g in (0, 1)])
    monkeypatch.setattr(langid, "TABLE", 0)
    for before, after in ((tabled, langid.Grams(texts)), (joined, langid.Grams(texts, groups))):
        assert all(np.array_equal(getattr(before, f), getattr(after, f)) for f in fields)


def test_language_trigrams_of_plain_texts_need_no_sorting(monkeypatch):
    monkeypatch.setattr(langid.np, "unique", None)
    assert langid.Grams(["the cat and the hat", "le chat"]).n == 19


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = QUERIES["op1_language"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 150 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97


def test_language_of_odd_texts(spark):
    docs = frame(spark, [(1, "le chat et la souris", "fr", "x"), (2, "the cat and the mouse", "en", "y"), (3, "ohne", None, "z")], "doc_id long, text string, lang string, score string")
    prototypes = langid.train(docs)
    assert sorted(prototypes) == ["en", "fr"]
    found = langid.predict(frame(spark, ODD), prototypes).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3}
    assert langid.predict(docs, prototypes).where("doc_id < 3").orderBy("doc_id").select("lang_pred").collect() == [("fr",), ("en",)]
    assert {r.lang_pred for r in langid.predict(docs, langid.train(docs.limit(0))).collect()} == {"und"}
    assert langid.predict(docs.limit(0), prototypes).count() == 0


def test_quality_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op9_quality"](spark, sf).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= quality.THRESHOLD for s in good]) > 0.98 and np.mean([s < quality.THRESHOLD for s in bad]) > 0.9


def test_quality_fit_makes_no_wide_copies():
    """The rounds hold a byte per measure of the rows, not their weights: the driver has no room for these."""
    import tracemalloc

    rng = np.random.default_rng(1)
    positive, unlabelled = rng.normal(size=(10_000, 150)) + 0.3, rng.normal(size=(10_000, 150))
    edges = quality.cut_points(np.vstack([positive, unlabelled]))
    tracemalloc.start()
    quality.fit(positive, unlabelled, 0.3, rounds=3, edges=edges)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000 * 150 * 8


def test_quality_of_odd_texts(spark):
    docs = frame(spark, ODD)
    nothing = quality.train(docs, frame(spark, [], "doc_id long, quality int"))
    assert nothing is None and {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    model = quality.train(docs, frame(spark, [(5, 1), (5, 1), (4, 1), (4, 0), (None, 1), (2, None)], "doc_id long, quality int"))
    found = quality.score(docs, model).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert model.prior == pytest.approx(2 / 4)
    assert quality.with_scores(docs, model).columns == ["doc_id", "text", "_score"]
    assert quality.score(docs.limit(0), model).count() == 0


def test_risk_stays_non_negative_and_ranks():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (400, 3)), rng.normal(-1, 1, (400, 3))
    model = quality.fit(good[:200], np.vstack([good[200:], bad]), 1 / 3)
    assert model.scores(good).mean() > 0.6 > 0.3 > model.scores(bad).mean()


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination_of_odd_texts(spark, limit):
    ten = "one two three four five six seven eight nine ten"
    items = frame(spark, [(1, ten + " eleven"), (2, ten), (3, "short item"), (4, ""), (5, None), (2, ten)], "item_id long, text string")
    rows = [*ODD, (10, f"x {ten.upper()}, eleven! {ten}"), (11, "A short-item"), (12, "short"), (13, f"{ten[:-3]} zehn"), (13, f"{ten[:-3]} zehn"), (14, ten), (14, "short item")]
    found = {r.doc_id: r for r in decontaminate.contamination(frame(spark, [(*r, 0) for r in rows], "doc_id long, text string, n_hit int"), items, limit=limit).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (found[10].n_words, found[10].n_hit, found[10].n_items, found[10].items_sha256) == (22, 21, 2, sha("1,2"))
    assert (found[11].n_hit, found[11].items_sha256, found[11].contaminated) == (2, sha("3"), True)
    assert (found[14].n_words, found[14].n_hit, found[14].n_items) == (12, 12, 3)
    for i in (1, 2, 3, 4, 5, 6, 12, 13, None):
        assert (found[i].n_hit, found[i].n_items, found[i].items_sha256, found[i].contaminated) == (0, 0, sha(""), False)
    assert (found[1].n_words, found[5].n_words, found[13].n_words) == (0, 30_000, 10)
    assert decontaminate.contamination(frame(spark, []), items).count() == 0
    assert decontaminate.contamination(frame(spark, rows), items.limit(0)).where("contaminated").count() == 0


def test_contamination_runs_no_python(spark):
    plan = QUERIES["op10_decontamination"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_notices_and_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/LICENSE", gpl), (3, "a/b/c/code.py", "nothing here"), (4, "a/x.py", "nothing here\nat all"),
        (5, "a/b/y.py", f"words of a long text that has no licence in it\n{mit}\nand so on"), (6, "z/y.py", "nothing"), (7, "top.py", "nothing"),
        (8, None, "nothing"), (9, "a/n", None), (9, "a/n", None), (None, "a/b/q", ""), (10, "ab/x", "nothing"),
    ]
    files = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, path string, text string, license string")
    found = {(r.doc_id, r.path): (r.license, r.origin, r.directory) for r in licences.inherit(licences.scan(files), "doc_id").collect()}
    assert found[3, "a/b/c/code.py"] == ("GPL-3.0", "directory", "a/b") and found[4, "a/x.py"] == ("MIT", "directory", "a")
    assert found[5, "a/b/y.py"] == ("MIT", "notice", None) and found[1, "a/LICENSE"][:2] == ("MIT", "notice")
    assert found[9, "a/n"] == ("MIT", "directory", "a") and found[None, "a/b/q"][0] == "GPL-3.0"
    assert all(found[k] == (None, None, None) for k in [(6, "z/y.py"), (7, "top.py"), (8, None), (10, "ab/x")])
    assert licences.inherit(licences.scan(files), "doc_id").count() == len(rows)
    assert licences.inherit(licences.scan(files.limit(0)), "doc_id").count() == 0


def test_the_root_covers_every_path(spark):
    mit = licences.licence_texts()["MIT"][0]
    rows = [(1, "LICENSE", mit), (2, "src/x.py", "nothing"), (3, "top.py", None), (4, "/abs/y.py", "nothing"), (5, "sub/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (6, "sub/z/q", "nothing"), (7, None, "nothing")]
    files = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, path string, text string, _notice string")
    found = {r.doc_id: (r.license, r.directory) for r in licences.inherit(licences.scan(files), "doc_id").collect()}
    assert found[2] == found[3] == found[4] == ("MIT", "") and found[6] == ("GPL-3.0", "sub") and found[7] == (None, None)


def test_whole_licence_files_cover_their_directories(spark):
    whole = {n: licences.licence_texts()[n][0] for n in ("Apache-2.0", "GPL-3.0", "BSD-3-Clause", "MPL-2.0", "MIT", "GPL-2.0", "LGPL-2.1", "CC-BY-4.0", "CC-BY-NC-4.0")}
    rows = []
    for i, (name, text) in enumerate(sorted(whole.items())):
        words = text.split()  # as other projects hold it: wrapped anew, under a copyright line, without the last words
        words = words[: len(words) * 9 // 10]
        lines = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        rows += [(10 * i, f"{name}/LICENSE", "\n".join(["Copyright (c) 2019 Someone Else", *lines])), (10 * i + 1, f"{name}/src/deep/x.py", "nothing here")]
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").limit(300).collect()]
    rows += [(1000 + i, f"prose/{i}", t) for i, t in enumerate(prose)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    scanned = licences.scan(files)
    found = {r.path: r for r in licences.inherit(scanned, "doc_id").collect()}
    for name in whole:
        r = found[f"{name}/src/deep/x.py"]
        assert (r.license, r.origin, r.directory) == (name, "directory", name)
    as_files = [{r.doc_id: r["_file"] for r in x.where("doc_id >= 1000").collect()} for x in (scanned, licences.scan(files, texts={}))]
    assert as_files[0] == as_files[1] and len(as_files[0]) == len(prose) > 100  # prose does not become a licence file


def test_every_notice_of_the_corpus_is_found(spark):
    wanted = {"MIT": "MIT License", "Apache-2.0": "Apache License", "GPL-3.0": "GNU General Public", "CC-BY-NC-4.0": "CC BY-NC"}
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op3_licences"](spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == len(docs)
    for i, text in docs.items():
        for name, mark in wanted.items():
            if mark in text:
                assert (found[i].license, found[i].origin) == (name, "notice")


def test_risk_gradient_equals_the_formula():
    """A few steps of the fit against steps along the numeric gradient of the unbiased risk, written out."""
    rng = np.random.default_rng(3)
    positive, unlabelled, prior, decay, rate = rng.normal(1, 1, (30, 2)), rng.normal(-0.2, 1, (50, 2)), 0.3, 2e-4, 0.03
    model = quality.fit(positive, unlabelled, prior, rounds=4, rate=rate, decay=decay)
    edges = np.quantile(np.vstack([positive, unlabelled]), np.linspace(0, 1, quality.BINS + 1)[1:-1], axis=0).T
    assert np.allclose(edges, model.edges)
    place = [np.stack([np.searchsorted(edges[j], x[:, j]) + j * quality.BINS for j in range(2)], 1) for x in (positive, unlabelled)]
    loss = lambda z: np.logaddexp(0, -z)  # noqa: E731  of calling a row with this logit good

    def risk(theta):
        gp, gu = (theta[p].sum(axis=1) + theta[-1] for p in place)
        negative = loss(-gu).mean() - prior * loss(-gp).mean()
        assert negative > 0
        return prior * loss(gp).mean() + negative + decay / 2 * (theta[:-1] ** 2).sum()

    theta, m, v = np.zeros(2 * quality.BINS + 1), 0, 0
    theta[-1] = np.log(prior / (1 - prior))
    for step in range(1, 5):
        grad = np.array([(risk(theta + e) - risk(theta - e)) / 2e-6 for e in np.eye(len(theta)) * 1e-6])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    used = np.unique(np.concatenate([p.ravel() for p in place]))
    assert np.allclose(model.weights.ravel()[used], theta[used], atol=1e-3) and model.bias == pytest.approx(theta[-1], abs=1e-4)


def test_loss_over_all_rows_equals_the_formula(spark):
    rng = np.random.default_rng(5)
    texts = [None, ""] + [" ".join(rng.choice(["alpha", "Beta.", "12", "x\n"], rng.integers(1, 60))) for _ in range(300)]
    measured = np.stack([quality.measures(t) for t in texts])
    edges = quality.cut_points(measured)
    w, bias = rng.normal(size=edges.shape[0] * quality.BINS), -0.4
    place = np.stack([np.searchsorted(edges[j], measured[:, j]) + j * quality.BINS for j in range(len(edges))], 1)
    g = w[place].sum(axis=1) + bias
    p = 1 / (1 + np.exp(-g))
    slope = sum(np.bincount(row, np.full(len(row), q), len(w)) for row, q in zip(place, p, strict=True)) / len(p)
    docs = frame(spark, list(enumerate(texts)))
    found = [quality.whole_loss(quality.binned(docs.repartition(parts), edges), len(edges))(w, bias) for parts in (1, 7)]
    assert np.isclose(found[0][0], np.logaddexp(0, g).mean(), atol=1e-5) and np.isclose(found[0][2], p.mean(), atol=1e-5)
    assert np.allclose(found[0][1], slope, atol=1e-5)
    assert found[0][0] == found[1][0] and (found[0][1] == found[1][1]).all() and found[0][2] == found[1][2]


def test_the_fit_follows_the_risk_over_all_rows():
    """The drawn rows are unlike the whole: only the passes over all rows bring the whole risk down."""
    rng = np.random.default_rng(6)
    positive, everything, prior = rng.normal(1, 1, (300, 3)), np.vstack([rng.normal(1, 1, (1200, 3)), rng.normal(-1, 1, (2800, 3))]), 0.3
    drawn = np.vstack([everything[:250], everything[-150:]])
    edges = quality.cut_points(np.vstack([positive, drawn]))
    place = quality.bins(edges, everything) + np.arange(3) * quality.BINS

    def whole(w, bias):
        g = w[place].sum(axis=1) + bias
        p = 1 / (1 + np.exp(-g))
        return np.logaddexp(0, g).mean(), np.bincount(place.ravel(), np.repeat(p, 3), len(w)) / len(p), p.mean()

    def risk(model):
        gp, gu = model.logits(positive), model.logits(everything)
        return prior * np.logaddexp(0, -gp).mean() + max(0, np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean())

    best = risk(quality.fit(positive, everything, prior, edges=edges))
    assert abs(risk(quality.fit(positive, drawn, prior, edges=edges, whole=whole)) - best) < 0.2 * (risk(quality.fit(positive, drawn, prior, edges=edges)) - best)


def test_language_scores_equal_plain_cosines(spark):
    """Prototypes summed and cosines taken trigram by trigram, over a few documents in two languages."""
    rows = [(1, "le chat dort ici", "fr"), (2, "the cat sleeps", "en"), (3, "un chien noir!", "fr"), (4, "a black dog", "en"), (5, "der Hund", None), (6, "chat cat", None)]

    def plain(text):
        letters, total = [], np.zeros(langid.DIMENSIONS)
        for c in f" {text.lower()} ":
            code = ord(c) if c.isalpha() else 0
            if code or not letters or letters[-1]:
                letters.append(code)
        for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
            total += np.roll(langid._symbol(a), 2).astype(int) * np.roll(langid._symbol(b), 1) * langid._symbol(c)
        return total

    sums = {lang: sum(plain(t) for _, t, k in rows if k == lang) for lang in ("en", "fr")}
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, langid.train(docs)).collect()}
    for i, text, _ in rows:
        own = plain(text)
        cosine = {k: own @ s / np.linalg.norm(own) / np.linalg.norm(s) for k, s in sums.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert found[i] == (best, pytest.approx(max(cosine[best], 0.0), abs=1e-9))


def test_licence_scores_equal_plain_cosines(spark):
    """TF-IDF cosines word by word: of each line with each notice, and of the whole text with notices and texts."""
    from collections import Counter
    from math import log, sqrt
    from zlib import crc32

    notices, texts = {"A": ["released under the alpha licence", "alpha alpha licence"], "B": ["beta terms apply"]}, {"C": ["gamma terms apply here to all of the text"]}
    rows = [(1, "Released under the ALPHA licence\nnothing else"), (2, "beta terms apply\nalpha licence alpha"), (3, "gamma terms apply\nhere to all of the text"), (4, None), (5, "nothing " * 400), (6, "")]
    docs = frame(spark, rows)
    vector = lambda line: Counter(crc32(w.lower().encode()) % licences.BUCKETS for w in licences.WORD(line))
    lines = {i: [x for x in (t or "").splitlines() if licences.WORD(x)] for i, t in rows}
    seen, total = Counter(), sum(map(len, lines.values()))
    for own in lines.values():
        for line in own:
            seen.update(set(vector(line)))
    idf = lambda b: log((1 + total) / (1 + seen[b])) + 1

    def cosine(a, b):
        a, b = ({k: n * idf(k) for k, n in vector(x).items()} for x in (a, b))
        return sum(a[k] * b.get(k, 0) for k in a) / sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    def first(found):
        """The highest score; of equal ones the smaller name."""
        return min(found, key=lambda x: (-round(x[0], 6), x[1]), default=(0.0, None))

    for r in licences.scan(docs, notices, texts=texts).collect():
        best = first((cosine(x, t), n) for x in lines[r.doc_id] for n, ts in notices.items() for t in ts)
        assert r["_notice_score"] == pytest.approx(min(best[0], 1), abs=1e-5) and r["_notice"] == (best[1] if best[0] >= licences.LEAST else None)
        whole = " ".join(lines[r.doc_id])
        file = first((cosine(whole, t), n) for d in (notices, texts) for n, ts in d.items() for t in ts) if whole else (0.0, None)
        assert r["_file_score"] == pytest.approx(min(file[0], 1), abs=1e-5) and r["_file"] == (file[1] if file[0] >= licences.LEAST else None)
