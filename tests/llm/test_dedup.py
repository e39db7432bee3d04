import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbflow.llm import exact_dedup, heavy, line_dedup, near_dedup
from curbflow.llm.components import components


def test_misra_gries_error_bound():
    rng = random.Random(3)
    values = [rng.choice(["hot"] * 5 + [f"v{k}" for k in range(200)]) for _ in range(5_000)]
    summary = heavy.MisraGries(8)
    for k in range(0, len(values), 100):
        summary.add(pa.array([v.encode() for v in values[k : k + 100]], pa.binary()))
    counts = Counter(values)
    assert summary.rows == 5_000 and len(summary.counts) <= 8 and summary.error <= 5_000 / 9 + 1
    for v, n in counts.items():
        assert 0 <= n - summary.counts.get(v.encode(), 0) <= summary.error


@pytest.mark.parametrize("share,counters", [(0.2, 20), (1 / 4096, 16384)])
def test_exact_groups(spark, make_docs, share, counters):
    texts = ["hot"] * 60 + [f"t{k % 30}" for k in range(70)] + [None, ""]
    docs = make_docs(*texts)
    got = {r.doc_id: r for r in exact_dedup.verdicts(docs, share=share, counters=counters).collect()}
    groups: dict[str, list[int]] = {}
    for k, t in enumerate(texts):
        groups.setdefault(t or "", []).append(k)
    for k, t in enumerate(texts):
        own = groups[t or ""]
        digest = hashlib.sha256((t or "").encode()).hexdigest()
        assert tuple(got[k]) == (k, max(own), len(own), k == max(own), digest)
    kept = exact_dedup.without_copies(docs, share=share, counters=counters)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(map(max, groups.values()))


def test_repeated_rows_leave_one(odd_docs):
    kept = [r for r in exact_dedup.verdicts(odd_docs).collect() if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept)
    assert exact_dedup.without_copies(odd_docs).count() == len(kept)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert len(set(zip(got.values(), map(root, got), strict=True))) == len(set(got.values())) == len(set(map(root, got)))


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute_force(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [(len(s), root(k)) for k, s in enumerate(sets)]


def cluster(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("width,percent,block", [(3, 85, 512), (5, 80, 7)])
def test_near_groups_equal_brute_force(make_docs, width, percent, block):
    """Clusters whose copies link in chains, lists shorter and longer than a block, a passage all documents share."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(60)]
    texts = []
    for size, copies, edits in ((150, 60, 14), (150, 12, 10), (40, 15, 4), (30, 9, 3), (6, 6, 2)):
        texts += cluster(rng, [word() for _ in range(size)], copies, edits)
    texts += [" ".join(passage + [word() for _ in range(rng.randrange(20, 60))]) for _ in range(60)]
    texts += ["", None, "One", "one", "one two", "One TWO", " \n", "one two three"]
    rng.shuffle(texts)
    settings = near_dedup.Settings(width, percent, block=block)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.grouped(make_docs(*texts), settings).collect()}
    assert got == {k: (n, c, k == c) for k, (n, c) in enumerate(brute_force(texts, width, percent))}


def test_signature_settings():
    s = near_dedup.CONTRACT
    assert s.prefix == s.coordinates - s.least_matches + 1 and 0.4 < s.least_matches / s.coordinates < s.percent / 100


def test_near_copies_leave_one_of_each_group(make_docs):
    base = [f"w{k}" for k in range(80)]
    docs = make_docs(" ".join(base), " ".join([*base[:-1], "other"]), "something else entirely")
    kept = near_dedup.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_null_ids_are_null(make_docs):
    docs = make_docs("a b c d", "e f g h").withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.component_id for r in near_dedup.grouped(docs).collect()] == [None, None]


def remaining_lines(texts):
    """Line deduplication by its definition."""
    where, cut = {}, []
    for k, t in enumerate(texts):
        lines = (t or "").split("\n")
        own = [n for n, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        cut.append((lines, own))
        for i in range(len(own) - 2):
            where.setdefault(tuple(lines[own[i + j]] for j in range(3)), []).append((k, i))
    later, kept = set(), set()
    for places in where.values():
        if len(places) > 1:
            kept |= {(places[0][0], places[0][1] + j) for j in range(3)}
            later |= {(k, i + j) for k, i in places[1:] for j in range(3)}
    gone = {(k, cut[k][1][i]) for k, i in later - kept}
    texts = ["\n".join(x for n, x in enumerate(lines) if (k, n) not in gone) for k, (lines, _) in enumerate(cut)]
    return texts, [sum(g[0] == k for g in gone) for k in range(len(cut))]


@pytest.mark.parametrize("share", [0.05, 1 / 4096])
def test_lines_equal_brute_force(make_docs, monkeypatch, share):
    monkeypatch.setattr(heavy.winners, "__defaults__", (share, round(4 / share)))
    rng = random.Random(9)
    texts = []
    for _ in range(120):
        lines = [rng.choice(["common a", "common b", "common c", "", " \t", *(f"l{n}" for n in range(6))]) for _ in range(rng.randrange(14))]
        texts.append("\n".join([*lines, *(["hot 1", "hot 2", "hot 3", "hot 4"] if rng.random() < 0.4 else [])]))
    texts += ["", None, "x\nx\nx\nx\nx", "one\ntwo"]
    docs = make_docs(*texts)
    got = line_dedup.deduplicated(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = {r.doc_id: r for r in got.collect()}
    want, gone = remaining_lines(texts)
    assert sum(gone) > 100
    for k, t in enumerate(texts):
        assert (rows[k].text or "") == want[k] and (rows[k].text is None) == (t is None)
        assert rows[k].n_removed == gone[k]


def lines_between_marks(texts, protect):
    """Line deduplication with marks around each text, by its definition."""
    where, cut = {}, []
    for k, t in enumerate(texts):
        lines = (t or "").split("\n")
        own = [n for n, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        cut.append((lines, own))
        padded = [None, *(lines[n] for n in own), None]
        for i in range(len(own)):
            where.setdefault(tuple(padded[i : i + 3]), []).append((k, i - 1))
    places = [(p, n) for found in where.values() if len(found) > 1 for n, p in enumerate(found)]
    later, first = ({(k, i + j) for (k, i), n in places if (n > 0) == side for j in range(3)} for side in (True, False))
    gone = {(k, cut[k][1][i]) for k, i in (later - first if protect else later) if 0 <= i < len(cut[k][1])}
    return ["\n".join(x for n, x in enumerate(lines) if (k, n) not in gone) for k, (lines, _) in enumerate(cut)]


def line_texts():
    rng = random.Random(12)
    texts = ["only line", "two\nlines", "only line", "two\nlines\n", "", None, "x\nx\nx\nx\nx", " \n"]
    for k in range(60):
        lines = [rng.choice(["common a", "common b", "", *(f"l{n}" for n in range(6))]) for _ in range(rng.randrange(9))]
        texts.append("\n".join([*lines, f"own {k}", *(["tail 1", "tail 2"] if rng.random() < 0.4 else [])]))
    return texts


def test_short_texts_and_edges_have_windows(make_docs):
    texts = line_texts()
    rows = {r.doc_id: r for r in line_dedup.deduplicated(make_docs(*texts), edges=True).collect()}
    want = lines_between_marks(texts, protect=True)
    assert [rows[k].text or "" for k in range(len(texts))] == want
    assert want[2] == want[3].strip() == "" and rows[2].n_removed == 1 and rows[3].n_removed == 2
    assert sum("tail 1" in x for x in want) == 1 < sum("tail 1" in (t or "") for t in texts)


def test_later_copies_go_even_where_a_window_across_the_border_is_first(make_docs):
    passage = [f"passage {k}" for k in range(3)]
    host = ["a 1", "a 2", *passage, "a 3", "a 4"]
    texts = ["\n".join(["z 1", *passage, "z 2"]), "\n".join(host), "\n".join(host), *line_texts()]
    rows = {r.doc_id: r for r in line_dedup.deduplicated(make_docs(*texts), edges=True, protect=False).collect()}
    want = lines_between_marks(texts, protect=False)
    assert [rows[k].text or "" for k in range(len(texts))] == want
    assert want[1].split("\n") == ["a 1", "a 2", "a 3", "a 4"] and want[2] == ""
    worded = lambda ts: {x for t in ts for x in (t or "").split("\n") if x.strip()}
    assert worded(want) == worded(texts)
