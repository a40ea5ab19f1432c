"""URL rules and trees, WARC archives."""

import hashlib
import random
import tracemalloc

import pytest

from terrace.llm import urls, warc
from terrace.llm.queries import QUERIES, RULES

SF = "/root/testdata/sf0.01"
URLS = [
    "http://a.com/", "http://a.com", "https://x.EXAMPLE.com/en/1", "https://www.example.com/en/1?q=/fr/", "http://m.www.example.com/en/", "http://notexample.com/en/",
    "http://a.net/es/2#x", "http://net/fr/", "http://a.net/de/", "http://a.net?x=/es/", "nothing", "", None, "://", "http://", "a://b://c.com/x", "http://u:p@h.com:80/x",
    "http://a.com\n/en/", "HTTP://É.COM/é", "http://a.org/" + "x/" * 20_000, "http://" + "a" * 50_000 + ".com/",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[cut:]
    end = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def ruled(host, path):
    fits = []
    for rule, _ in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([*enumerate(URLS), (None, URLS[0]), (0, URLS[0])], "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS label")
    found = urls.judge(pages, RULES).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        url = URLS[r.page_id or 0]
        host, path = split(url)
        rule = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and 0 <= r.score <= 1
        if rule:
            assert r.verdict == dict(RULES)[rule]


def test_one_label_or_none_or_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.com/")], "page_id long, url string")
    assert {r.verdict for r in urls.judge(pages, [("com/", "block")]).collect()} == {"block"}
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_the_registered_query_keeps_the_rules(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op2_url_filter"](spark, SF).collect()
    assert sorted(r.page_id for r in found) == sorted(pages)
    for r in found:
        host, path = split(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, ruled(host, path))
        assert r.rule is None or r.verdict == dict(RULES)[r.rule]


def test_trees_learn_a_lexical_rule(spark):
    rows = [(i, f"http://{'ok' if i % 2 else 'bad'}{i}.x/{'a' * (i % 7)}{'/1234567890?p=1&q=2' if i % 2 == 0 else ''}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = [(f"{'ok' if i % 2 else 'bad'}{i}.x/", "allow" if i % 2 else "block") for i in range(200)]
    judged = urls.judge(pages, rules).where("rule IS NULL").collect()
    assert len(judged) == 200 and sum((r.verdict == "allow") == (r.page_id % 2 == 1) for r in judged) > 190


def test_labels_of_held_out_hosts_are_told_apart(spark):
    """Trees fitted on other hosts rank the labelled URLs of held-out hosts, and judge the URLs without a rule both ways."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    assert urls.held_out_auc(pages, RULES) > 0.9
    judged = urls.judge(pages, RULES).where("rule IS NULL").groupBy("verdict").count().collect()
    assert {r.verdict for r in judged} == {"allow", "block"}
    assert urls.held_out_auc(pages.limit(0), RULES) is None


def test_a_label_does_not_reach_its_own_statistics(spark):
    """Turning the label of one host's URLs leaves their own suffix statistics as they are, but moves those of other hosts."""
    hosts = [f"h{i}.one.org" for i in range(12)]
    pages = spark.createDataFrame([(i, f"http://{h}/a") for i, h in enumerate(hosts)], "page_id long, url string")

    def shares(turned):
        rules = [(f"{h}/", "block" if (i % 2 == 0) != (i in turned) else "allow") for i, h in enumerate(hosts)]
        rows, _, _ = urls._labelled(pages, rules, "page_id", "url")
        return {r.k: (r.fold, round(r.suffix_blocked, 9), round(r.head_blocked, 9)) for r in rows.collect()}

    before = shares(())
    same = next(i for i in range(12) for j in range(12) if i < j and before[i][0] == before[j][0] and i % 2 != j % 2)
    pair = next(j for j in range(12) if j > same and before[j][0] == before[same][0] and j % 2 != same % 2)
    after = shares((same, pair))  # as many of both kinds as before
    assert after == before


PAGES = [
    (3, "http://a/", "x" * 100), (1, "http://b/", "x" * 100), (2, "http://c/", "x" * 99), (4, "http://d/", "x" * 99), (5, None, None), (6, "http://e/\r\nX: y", ""),
    (7, "http://f/", "é" * 200_000), (8, "http://g/", "é" * 200_000), (9, "http://h/", "\r\n\r\nWARC/1.1\r\n" * 20), (1, "http://b/", "x" * 100), (None, "http://i/", "x" * 100),
    (None, None, "y" * 200), (10, "http://j/", "<p>\x00</p>"),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "own") for p in PAGES], "page_id long, url string, html string, content string")
    archives = warc.write(pages)
    back = warc.read(archives).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = []
    for i, _, html in PAGES:
        size = len((html or "").encode())
        same = [k for k, _, h in PAGES if h == html and k is not None]
        first = min(same, default=None) if size >= 100 else None
        revisit = first is not None and first != i
        want.append((None if i is None else str(i), size, sha(html), "revisit" if revisit else "response", str(first) if revisit else None))
    assert sorted(map(str, want)) == sorted(str((r.record_key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in back)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in back if r.record_type == "response")
    assert sum(r.records for r in archives.select("records").collect()) == len(PAGES)
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_archive_files_start_with_their_dictionary():
    import struct

    import zstandard

    records = [warc.record(str(i), f"http://a/{i}", warc.DATE, f"<html>page {i} of the same shape, {i * i}</html>".encode() * 3, 1, "d", None) for i in range(500)]
    content = warc.pack(records, "a.warc.zst")
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D and zstandard.ZstdCompressionDict(content[8 : 8 + size]).dict_id() > 0
    found = list(warc.unpack(content))
    assert len(found) == 501 and found[0][0]["warc-type"] == "warcinfo" and found[7][0]["record-key"] == "6"
    assert len(content) < sum(len(zstandard.compress(r)) for r in records)


def test_an_archive_is_read_where_it_lies():
    """Unpacking many archives holds a record at a time, whatever their number and size."""
    noise = random.Random(1).randbytes
    files = [warc.pack([warc.record(str(i), None, warc.DATE, noise(20_000), 1, "d", None) for i in range(200)], "a") for _ in range(4)]
    assert all(len(f) > 3_900_000 for f in files)
    tracemalloc.start()
    read = sum(1 for f in files * 5 for _ in warc.unpack(memoryview(f)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert read == 20 * 201 and peak < 1_000_000


def test_many_archives_in_one_file(spark, monkeypatch, tmp_path):
    """A task that writes and reads forty archives: none of them exceeds its bound, all records come back."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 20)
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat(sha2(string(id), 512), 800) || sha2(string(id + 1), 512) AS html").coalesce(1)
    archives = warc.write(pages)
    archives.coalesce(1).write.parquet(str(tmp_path / "archives"))
    stored = spark.read.parquet(str(tmp_path / "archives"))
    assert stored.count() >= 35 and stored.selectExpr("max(records) AS n").first().n <= 12
    assert warc.read(stored).selectExpr("count(DISTINCT record_key) AS n", "sum(payload_bytes) AS b").first() == (400, 400 * 128 * 801)


@pytest.mark.parametrize("n", [1, 2])
def test_too_few_records_to_train_on(n):
    records = [warc.record("1", None, warc.DATE, b"x", 1, "d", None)] * n
    assert len(list(warc.unpack(warc.pack(records, "a")))) == n + 1
