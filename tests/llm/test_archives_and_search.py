"""WARC archives, the Merkle manifest and lexical search against plain versions of themselves."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.llm import lexical, merkle, warc

PAGE_SCHEMA = "page_id long, url string, html string, size int, key string, first long, value string, archive string"
LONG_PAGE = "<html>" + "é" * 300_000 + "</html>"


def page(page_id, url, html):
    return (page_id, url, html, 1, "k", 2, "v", "a")


@pytest.fixture(scope="module")
def pages(spark):
    same = "<p>" + "x" * 200 + "</p>"
    rows = [
        page(5, "http://a/5", same), page(3, "http://a/3", same), page(3, "http://a/3", same), page(None, None, same),
        page(7, "http://a/7\r\nX-Evil: 1", "<p>short</p>"), page(8, "http://a/8", "<p>short</p>"), page(9, "u", None),
        page(10, "u", ""), page(11, "http://a/é", LONG_PAGE), page(12, "http://b", LONG_PAGE),
        page(None, "n1", "y" * 150), page(None, "n2", "y" * 150), page(13, "h", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20),
        page(14, "edge", "z" * 99), page(15, "edge", "z" * 99), page(16, "edge", "w" * 100), page(17, "edge", "w" * 100),
    ]
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def expected_pages(rows):
    firsts = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            firsts[body] = min(firsts.get(body, r.page_id), r.page_id)
    out = []
    for r in rows:
        body = (r.html or "").encode()
        first = firsts.get(body)
        revisit = first is not None and r.page_id != first
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return Counter(out)


def test_pages_come_back_from_the_archives(pages):
    rows = pages.collect()
    got = warc.archived(pages, warc.Settings(records=3, span=1 << 16), payloads=True).collect()
    key = lambda r: (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
    assert Counter(map(key, got)) == expected_pages(rows) and all(r.intact for r in got)
    bodies = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    assert all(hashlib.sha256(b).hexdigest() == d for d, b in bodies.items())
    assert {(r.html or "").encode() for r in rows} == set(bodies.values())
    urls = {r.page_id: r.url for r in got}
    assert urls[11] == "http://a/é" and "\n" not in urls[7] and urls[None] in (None, "n1", "n2")


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], PAGE_SCHEMA)).collect() == []


def test_archives_are_plain_records_and_the_index_points_at_them(spark, pages, tmp_path):
    folder = str(tmp_path / "archives")
    warc.write_archives(pages, folder, warc.Settings(records=2))
    index = warc.indexed(spark, folder).collect()
    assert len(index) == pages.count()
    for name in os.listdir(folder):
        if name.endswith(".txt"):
            data = open(f"{folder}/{name}", "rb").read()
            own = sorted((r for r in index if r.archive.endswith(name)), key=lambda r: r.offset)
            assert 0 < len(own) <= 2 and sum(r.length for r in own) == len(data)
            for r in own:
                record = data[r.offset : r.offset + r.length]
                assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
    chosen = warc.indexed(spark, folder).filter(F.col("url") == "http://b")
    assert [r.id for r in warc.read_records(chosen).collect()] == ["12"]


def test_reads_are_coalesced_by_gap_and_span():
    places = [(0, 10), (10, 10), (25, 5), (200, 50), (250, 500), (750, 5)]
    assert list(warc.spans(places, 10, 300)) == [(0, 0, 30), (3, 200, 50), (4, 250, 500), (5, 750, 5)]
    assert list(warc.spans(places, 1000, 10_000)) == [(0, 0, 755)]
    assert list(warc.spans([], 1, 1)) == []


def test_headers_longer_than_the_window_are_found(tmp_path):
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: " + b"u" * 500 + b"\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    path = tmp_path / "x.txt"
    path.write_bytes(head * 4)
    with warc._opened(str(path)) as file:
        assert [(o, n) for o, n, _ in warc.headers(file, 4 * len(head), window=64)] == [(k * len(head), len(head)) for k in range(4)]


# --- Merkle manifest --------------------------------------------------------------------------


def hex_of(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def level_up(nodes):
    return [hex_of(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]


def path_of(nodes, at):
    """[(siblings left, siblings right)] per level, and the root."""
    steps = []
    while len(nodes) > 1:
        run = nodes[at // 2 * 2 : at // 2 * 2 + 2]
        steps.append((run[: at % 2], run[at % 2 + 1 :]))
        nodes, at = level_up(nodes), at // 2
    return steps, nodes[0]


def plain_leaf(r, add=0):
    values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + add, r.text)
    return hex_of(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    by_lang, out = {}, []
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    for group in by_lang.values():
        group.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, plain_leaf(r)))
    leaves = {v: [plain_leaf(r) for r in g] for v, g in by_lang.items()}
    subroots = [path_of(leaves[v], 0)[1] for v in langs]
    for k, v in enumerate(langs):
        for at, r in enumerate(by_lang[v]):
            steps = path_of(leaves[v], at)[0] + path_of(subroots, k)[0]
            root = path_of(subroots, k)[1]
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            node = plain_leaf(r, 1 if tampered else 0)
            for left, right in steps:
                node = hex_of(*left, node, *right)
            proof = hex_of(*(s for left, right in steps for s in (*left, *right)))
            out.append((r.doc_id, plain_leaf(r), subroots[k], root, proof, node, node == root))
    return Counter(out)


def manifest_rows(df, height):
    found = merkle.manifest(df, height).collect()
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found)


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_manifest_equals_a_plain_one(spark, height):
    rng = np.random.default_rng(3)
    langs = [None, "", "de", "en", "en", "en", "zü", "z"]
    data = [(k, f"text {k}" if k % 9 else None, langs[rng.integers(8)], None if k % 5 == 0 else "s", None if k % 11 == 0 else k) for k in range(61)]
    data.append((1000, "alone", "alone", "s", 5))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    want = plain_manifest(df.collect())
    assert manifest_rows(df, height) == want and any(not k[-1] for k in want) and any(k[-1] for k in want)


def test_manifest_of_odd_rows(odd_docs):
    assert manifest_rows(odd_docs, 1) == plain_manifest(odd_docs.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 11, 16, 21, 32])
def test_positions_are_where_a_log_has_its_nodes(n):
    nodes = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
    for top in {merkle.levels(n, True), 6}:
        log = merkle.build(nodes, top)
        row = nodes
        for level in range(top + 1):
            assert [log[merkle.position(level, k, n)] for k in range(len(row))] == row
            row = [merkle.h(*row[k : k + 2]) for k in range(0, len(row), 2)]
        assert len(log) == merkle.subtree_size(n, top)
        for k in range(n):
            assert merkle.folded(nodes[k], merkle.entries(log, k, n, top)) == log[-1]
            assert n == 1 or merkle.folded(nodes[k - 1], merkle.entries(log, k, n, top)) != log[-1]


# --- lexical search ---------------------------------------------------------------------------


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, top=20):
    tfs = [(r.doc_id, Counter(words_of(r.text))) for r in docs]
    tfs = [(d, c) for d, c in tfs if c]
    n_docs, n_terms = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item in items:
        scores = []
        for d, c in tfs:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in words_of(item.text) if t in c
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        scores.sort()
        out += [(item.item_id, k + 1, d, -s) for k, (s, _, _, d) in enumerate(scores[:top])]
    return Counter(out)


def found_rows(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


ITEMS = "item_id long, text string, score long, place int, terms string"


def test_search_equals_a_plain_one(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["Alpha", "beta", "GAMMA", "δέλτα", "x1", "ÉÀ", "rare", "común", "a", "b"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 9), p=None)) for _ in range(300)] + ["alpha,beta;x1 alpha"] * 60
    texts += ["", None, "!!! ...", "no match here " * 2000, "alpha" * 3, "alpha beta", "rare_rare"]
    docs = [(k * 7 % 1000, t, 1, "t", 2, 3) for k, t in enumerate(texts)] + [(None, "alpha beta", 1, "t", 2, 3)] * 3 + [(5, "alpha", 1, "t", 2, 3)] * 30
    df = spark.createDataFrame(docs, "doc_id long, text string, n long, terms string, score long, m int").repartition(6)
    items = [(k, " ".join(rng.choice(vocabulary, 4)), 0, 0, "") for k in range(12)]
    items += [(3, "alpha alpha ALPHA"), (3, "alpha alpha ALPHA"), (50, None), (51, "unseen words"), (None, "beta rare")]
    item_df = spark.createDataFrame([(*i[:2], 0, 0, "") for i in items], ITEMS)
    want = plain_search(df.collect(), item_df.collect())
    assert found_rows(lexical.search(df, item_df)) == want
    small = lexical.Settings(block=40, together=7)
    assert found_rows(lexical.search(df, item_df, small)) == want


def test_search_without_items_or_documents(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "fox dog", 0, 0, "")], ITEMS)
    assert lexical.search(odd_docs, none).collect() == []
    assert lexical.search(no_docs, some).collect() == []
    assert found_rows(lexical.search(odd_docs, some)) == plain_search(odd_docs.collect(), some.collect())


def test_scores_are_exact_where_doubles_are_not():
    weights = np.array([[5_000_000_007], [4_999_999_993]], np.int64)
    rows = [(75, [0, 1], [9_999_999, 3]), (80, [1], [1])]
    want = [
        sum(int(weights[t, 0]) * (1_000_000_000 * n // (1000 * n + 12 * m)) for t, n in zip(ts, ns, strict=True)) for m, ts, ns in rows
    ]
    assert lexical.scored(weights, rows)[:, 0].tolist() == want


def test_equal_scores_go_to_the_smallest_ids():
    best = lexical.Best(1, 3)
    best.add(np.array([[5], [5], [7], [0]]), [[9, 20], [4, 5, 30], [None], [1]])
    best.add(np.array([[5], [5]]), [[3], [6]])
    assert [(-s, k) for s, k in best.rows[0]] == [(7, (True, 0)), (5, (False, 3)), (5, (False, 4))]
