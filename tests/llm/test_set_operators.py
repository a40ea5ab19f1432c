"""Near-duplicates, repeated strings, nearest neighbours, components and the pipeline, against brute force."""

import hashlib
import random
import tracemalloc
from itertools import combinations

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from terrace.llm import neighbours, simhash, suffixes
from terrace.llm.components import components
from terrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\x0b"), (4, "x"), (5, "Wort und Ton " * 3_000), (5, "Wort und Ton " * 3_000), (6, "é\x00🙂 ﬁ b"), (None, "x")]


def documents(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, fp int")


def plain_fingerprint(text, width):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def classes(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 60)] + [(5, 5)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    found = components(spark.createDataFrame([*edges, (None, 1), (1, None)], "a long, b long")).collect()
    assert {r.node: r.root for r in found} == classes(edges, nodes) and len(found) == len(nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("per_key", [2048, 4])
def test_links_lose_no_near_pair(spark, monkeypatch, per_key):
    monkeypatch.setattr(simhash, "SLICE", 1 << 12)  # several slices per key
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for p in list(prints):
        for k in (1, 3, 4, 5):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), k)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = components(simhash.links(frame, len(prints), per_key=per_key)).collect()
    near = [(signed(a), signed(b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    expected = classes(near, {x for e in near for x in e})
    assert {r.node: r.root for r in found} == expected


def _bounded(monkeypatch, most):
    """Let every shuffle key fail that has more than ``most`` words."""
    collide_of = simhash._collide

    def bounded(keyed, radius):
        inner, mask = collide_of(keyed, radius), sum(1 << b for b in keyed)
        words = [len(simhash.flips(radius - u, [b for b in range(64) if b not in keyed])) for u in range(radius + 1)]

        def collide(key, rows):
            total = sum(words[((fp ^ key[0].as_py()) & mask).bit_count()] for fp in rows.column("fp").to_pylist())
            assert total <= most, total
            return inner(key, rows)

        return collide

    monkeypatch.setattr(simhash, "_collide", bounded)


@pytest.mark.parametrize("per_task", [20_000, 2081])
def test_heavy_keys_are_dealt_without_losing_a_pair(spark, monkeypatch, per_task):
    _bounded(monkeypatch, per_task)
    rng = random.Random(6)
    centre, prints = rng.getrandbits(64) >> 1, set()
    while len(prints) < 250:  # the centre is left out: near prints must find each other
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(2, 8))))
    prints |= {rng.getrandbits(63) for _ in range(50)}
    found = components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), len(prints), per_task=per_task)).collect()
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert {r.node: r.root for r in found} == classes(near, {x for e in near for x in e})


def test_a_hundred_thousand_prints_around_one_centre(spark, monkeypatch):
    _bounded(monkeypatch, simhash.PER_TASK)
    rng = random.Random(8)
    centre = rng.getrandbits(63)
    prints = {centre ^ int(m) for m in simhash.flips(3, list(range(63)))}  # all within 3 bits, and many at 4: all are near the centre
    while len(prints) < 100_000:
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(63), 4)))
    frame = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(8)
    found = components(simhash.links(frame, len(prints)))
    assert tuple(found.selectExpr("count(*)", "count(DISTINCT node)", "count(DISTINCT root)", "min(root)").first()) == (100_000, 100_000, 1, min(prints))


def test_near_duplicates_equal_all_pairs(spark):
    rows = [*ODD] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = [plain_fingerprint(t, 4) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    group = classes(edges, range(len(rows)))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[group[i]] = min(k, least.get(group[i], k))
    want = sorted(str((k, f"{prints[i]:016x}", least[group[i]])) for i, (k, _) in enumerate(rows))
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == want
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_one_document_of_each_group_stays(spark):
    base = " ".join(f"wort{i}" for i in range(300))
    rows = [(1, base), (2, base), (3, base.replace("wort7 ", "anders ")), (4, "something else entirely, and long enough"), (4, "something else entirely, and long enough"), (5, None), (6, "")]
    kept = simhash.without_near_duplicates(documents(spark, rows), ((5, 42), (2, 42)))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 4, 5]


def plain_removal(rows, length):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            gone[s : s + length] |= window in seen
            seen.add(window)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[key] = (len(raw), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def repeating(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé \n") for _ in range(n)) for n in (120, 180, 400, 99, 100)]
    rows = []
    for i in range(60):
        own = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 200))) for _ in range(3)]
        rows.append((i * 3 % 61, own[0] + rng.choice(shared)[rng.randrange(0, 20) :] + own[1] + rng.choice(shared) + own[2]))
    return rows + [(70, "ab" * 400), (71, "ab" * 90 + "c"), (72, "a" * 700), (73, None), (74, ""), (75, "kurz"), (76, rows[0][1]), (None, rows[1][1]), (77, "é" * 300)]


@pytest.mark.parametrize(("bucket", "split"), [(suffixes.BUCKET, suffixes.SPLIT), (3, 2)])
def test_removal_equals_brute_force(spark, bucket, split):
    rows = repeating(1)
    found = suffixes.remove_repeats(documents(spark, rows).repartition(5), bucket=bucket, split=split).collect()
    got = {r.doc_id: (r._n_bytes, r._n_removed, r._n_spans, hashlib.sha256(r._kept).hexdigest()) for r in found}
    assert got == plain_removal(rows, 100) and len(found) == len(rows)


def test_repeated_rows_share_their_result(spark):
    rows = [(1, "a b c " * 40), (1, "a b c " * 40), (2, "x" + "a b c " * 40), (2, "a b c " * 40)]
    found = sorted((r.doc_id, r._n_bytes, r._n_removed) for r in suffixes.remove_repeats(documents(spark, rows)).collect())
    assert found[0] == found[1] and found[0][2] > 0
    assert [r[2] for r in found if r[0] == 2] == [240, 240]
    assert suffixes.remove_repeats(documents(spark, [])).count() == 0


def test_characters_that_lost_bytes_go_whole_without_a_second_python_pass(spark):
    rng = random.Random(6)
    whole = "".join(map(chr, [0, 36, 0x7F, 0x80, 0x7FF, 0x800, 0xD7FF, 0xE000, 0xFFFD, 0xFFFF, 0x10000, 0x3FFFF, 0x40000, 0x10FFFF])).encode() * 4
    cut = [bytes(b for b in whole if rng.random() < p) for p in (0.5, 0.8, 0.95) for _ in range(60)]
    noise = [bytes(rng.choice(b"a\x80\x90\x9f\xa0\xbf\xc0\xc1\xc2\xdf\xe0\xe1\xed\xef\xf0\xf1\xf4\xf5\xff") for _ in range(40)) for _ in range(200)]
    rows = [b"", whole, whole * 20_000, (b"\x9f" + whole) * 20_000, *cut, *noise]
    removed = spark.createDataFrame([(i, bytearray(b), "old") for i, b in enumerate(rows)], "doc_id long, _kept binary, _kept_text string")
    found = suffixes.kept_text(removed).select("doc_id", "_kept_text").collect()
    assert {r.doc_id: r._kept_text for r in found} == {i: b.decode("utf-8", "ignore") for i, b in enumerate(rows)}
    cut = corpus_pipeline.remove_repeated_strings(spark, documents(spark, repeating(1)), SF)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_columns_equal_sorted_windows():
    rng = random.Random(2)
    core = bytes(rng.randrange(97, 100) for _ in range(160))
    texts = [core[i : i + 130] if i % 2 else bytes(rng.randrange(97, 100) for _ in range(20)) + core[30:140] for i in range(12)]
    anchors = np.array([t.index(core[60:84]) for t in texts])
    removed, kept, begin = suffixes.column_wise(texts, anchors, np.arange(len(texts)))
    seen = set()
    for i, t in enumerate(texts):
        for s in range(len(t) - 99):
            at = s + begin[i]
            if 0 <= at < removed.shape[1]:
                assert removed[i, at] == (t[s : s + 100] in seen) and kept[i, at] == (t[s : s + 100] not in seen)
        seen |= {t[s : s + 100] for s in range(len(t) - 99)}


def test_a_large_bucket_is_laid_out_in_slices():
    rng = np.random.default_rng(3)
    n, core = 16_384, bytes(rng.integers(97, 100, 160).astype(np.uint8))
    texts = [bytes(rng.integers(97, 123, 2).astype(np.uint8)) * (i % 9) + core + b"z" * (i % 5) for i in range(n)]
    anchors = np.array([2 * (i % 9) + 60 for i in range(n)])
    own = np.full(n, suffixes.gram_hashes(np.frombuffer(core[60:84], np.uint8))[0])
    tracemalloc.start()
    try:
        assert (suffixes.anchors_of(texts, own) == anchors).all()
        removed, kept, _ = suffixes.column_wise(texts, anchors, np.arange(n))
        assert tracemalloc.get_traced_memory()[1] < 32e6
    finally:
        tracemalloc.stop()
    assert kept[:, 30].sum() == 1 and kept[0, 30] and removed[1:, 30].all()


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")


def exact(queries, rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    good = {(i, v.tobytes()): (i, v) for i, v in good}.values()
    out = set()
    for q, v in good:
        if q in queries:
            best = sorted((-float(v @ x), i) for i, x in good if i != q and len(x) == len(v))[:k]
            out |= {(q, n + 1, i) for n, (_, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("block, group", [(neighbours.BLOCK_BYTES, neighbours.GROUP_BYTES), (200, 1 << 40), (200, 1), (1 << 30, 64 * 5 * 8 * 2)])
def test_few_vectors_are_searched_exactly(spark, monkeypatch, block, group):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", block)
    monkeypatch.setattr(neighbours, "GROUP_BYTES", group)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(300, None), (301, [0.0] * 5), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 5)]
    rows += [(305, [1.0, 2.0]), (306, [2.0, 1.0]), (None, [1.0] * 5), (5, rows[5][1]), (307, [])]
    table = vectors(spark, rows)
    asked = table.where("vec_id % 20 = 0 OR vec_id = 305")
    found = neighbours.nearest(asked, table, k=20, shard=12).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == exact({r[0] for r in rows if r[0] is not None and (r[0] % 20 == 0 or r[0] == 305)}, rows, 20)
    by_id = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v}
    assert all(abs(r.score - by_id[r.query_id] @ by_id[r.vec_id]) < 1e-12 for r in found)
    assert neighbours.nearest(asked.limit(0), table).count() == 0 and neighbours.nearest(asked, table.limit(0)).count() == 0


def test_recall_over_the_registered_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {(q, i) for q, _, i in exact({i for i, _ in rows if i % 20 == 0}, rows, 20)}
    got = {(r.query_id, r.vec_id) for r in QUERIES["op4_nearest"](spark, sf).collect()}
    assert len(got & want) / len(want) > 0.9


def test_pipeline_equals_its_steps(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs = source
    for name, apply in corpus_pipeline.STAGES:
        after = apply(spark, docs, SF)
        rows = {r.doc_id: r for r in after.collect()}
        before = {r.doc_id: r for r in docs.collect()}
        assert set(rows) <= set(before)
        if name != "byte-level BPE":
            assert after.columns == docs.columns
        if name == "suffix-array dedup":
            plain = plain_removal([(i, r.text) for i, r in before.items()], 100)
            assert all((len(r.text.encode()) == plain[i][0] - plain[i][1] or plain[i][1]) and (plain[i][1] or r.text == before[i].text) for i, r in rows.items())
            assert all(r.n_chars == (len(r.text) if plain[i][1] else before[i].n_chars) for i, r in rows.items())
        docs = spark.createDataFrame(after.collect(), after.schema)
    assert {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


def test_stages_take_odd_documents(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], shape)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, odd, SF).count() <= len(ODD)
        assert apply(spark, odd.limit(0), SF).count() == 0


def test_documents_that_share_or_lack_a_key_are_told_apart(spark):
    """A clean text stays when another text of its key, or another text without a key, is contaminated or a near copy."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first().text
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    clean = ["ein ruhiger Text ohne fremde Stellen " * 3, "un autre texte tranquille et sans passage " * 3]
    rows = [(k, t, None, None, None) for k, own in ((None, clean[0]), (7, clean[1])) for t in (own, f"before {item} after")]
    kept = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(rows, shape), SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("None", clean[0]), ("7", clean[1])])
    base = " ".join(f"wort{i}" for i in range(300))
    other = " ".join(f"mot{i}" for i in range(300))
    rows = [(k, t, None, None, None) for k, t in ((None, base), (None, other), (7, base + " ende"), (7, "etwas ganz anderes steht hier"), (8, other + " fin"))]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, shape), SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("None", base), ("None", other), ("7", "etwas ganz anderes steht hier")])


INTERNAL = ["_ids", "_decoded", "n_tokens", "ids_sha256", "_score", "_doc", "_part", "_spans", "_n_bytes", "_n_removed", "_kept", "_kept_text", "k", "t", "h", "fp", "fp0", "document", "chosen_key", "least", "words", "start", "at", "_salt", "node", "root"]


def test_stages_keep_columns_named_like_their_own(spark):
    shape = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    docs = spark.createDataFrame([(i, f"ein kurzer Text Nummer {i} mit Wörtern {i * i}" * 4, *INTERNAL) for i in range(4)], shape)
    for name, apply in corpus_pipeline.STAGES:
        found = apply(spark, docs, SF)
        want = [c for c in docs.columns if name != "byte-level BPE" or c not in ("n_tokens", "ids_sha256")]
        assert found.columns[: len(want)] == want and len(set(found.columns)) == len(found.columns)
        own = [c for c in INTERNAL if c in want and not (name == "suffix-array dedup" and c in ("_n_bytes", "_n_removed", "_kept", "_kept_text"))]
        assert all(r[c] == c for r in found.collect() for c in own), name
    again = corpus_pipeline.encode_bytes(spark, corpus_pipeline.encode_bytes(spark, docs, SF), SF)
    assert again.count() == 4 and again.columns.count("n_tokens") == 1


def test_near_copies_of_the_corpus_are_found(spark):
    """Brute force over five-word shingles: at least 85 % of the pairs at 0.8 or more are linked directly by one of the pipeline's fingerprints."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect() if r.text]
    words = {i: t.lower().split() for i, t in rows}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} for i, w in words.items()}
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    shared = {}
    for h in holders.values():
        if 1 < len(h) <= 40:
            for a, b in combinations(sorted(h), 2):
                shared[a, b] = shared.get((a, b), 0) + 1
    near = [(a, b) for (a, b), n in shared.items() if n >= 0.5 * min(len(sets[a]), len(sets[b])) and 0.8 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 1]
    text, prints = dict(rows), {}
    for i in {x for p in near for x in p}:
        prints[i] = [simhash.fingerprint(text[i], *s) for s in corpus_pipeline.SHINGLES]
    linked = sum(any((x ^ y).bit_count() <= 4 for x, y in zip(prints[a], prints[b], strict=True)) for a, b in near)
    assert len(near) > 100 and linked / len(near) > 0.85


def test_a_pipeline_run_leaves_its_result_only(spark, monkeypatch, tmp_path):
    from terrace.llm import common

    monkeypatch.setattr(common, "workspace", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["pipeline-4"]
