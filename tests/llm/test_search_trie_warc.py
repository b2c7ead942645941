"""Operators 11 to 13 against brute-force versions, on rows of the tables and on awkward rows; empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import best_position, conversation_trie, warc
from sluice.llm.common import scratch
from tests.conftest import SF_SMALL
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.awkward(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet")).cache()


# -- ranked search

def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(rows, items, k):
    """{item: [(score, doc_id), ...]} by the definition, every document scored."""
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    n_docs, length = sum(n > 0 for _, _, n in own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = {}
    for item, ts in asked.items():
        scores = []
        for i, c, n in own:
            m = 50 + 50 * n * n_docs // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out[item] = [(-s, None if none else i) for s, none, i in sorted(scores)[:k]]
    return {i: v for i, v in out.items() if v}


def found_by(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["rank"])):
        out[r["item_id"]].append((r["score"], r["doc_id"]))
        assert r["rank"] == len(out[r["item_id"]]) and 0 < r["n_read"] <= r["n_postings"]
    return dict(out)


def items_of(spark):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    odd = [(None, "a b c one two"), (10**6, None), (10**6 + 1, ""), (10**6 + 2, " .,! "), (10**6 + 3, "one"), (10**6 + 3, "TWO x"), (10**6 + 4, "zzzzunheardof"),
           (10**6 + 5, "é à ü ñ 123 ①"), (10**6 + 6, "a a a a")]
    return items.unionByName(spark.createDataFrame(odd, "item_id long, text string")).withColumns({"rank": F.lit(1), "doc_id": F.lit(1), "query": F.lit("x")})


@pytest.mark.parametrize("k,blocks,shard", [(50, 4 << 20, 4_000_000), (3, 4 << 20, 500), (1, 2000, 2000)])
def test_search_is_the_brute_force_ranking(spark, docs, k, blocks, shard):
    items = items_of(spark)
    got = found_by(best_position.search(docs, items, k=k, block_bytes=blocks, shard_postings=shard))
    assert got == ranked(cases.pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()], k)


def test_search_of_empty_tables(spark, docs):
    items = items_of(spark)
    assert best_position.search(docs.where("false"), items).count() == 0
    assert best_position.search(docs, items.where("false")).count() == 0


def test_reading_stops_at_best_positions():
    rng = np.random.default_rng(3)
    n_docs, n_terms = 4000, 12
    held = rng.random((n_docs, n_terms)) < 0.6
    impact = np.where(held, rng.integers(1, 400, (n_docs, n_terms)), 0)
    impact[:20] = 5000 + rng.integers(0, 3, (20, n_terms))  # few documents lead every list, with ties
    held[:20] = True
    d, t = np.nonzero(held)
    shard = best_position.Shard(np.arange(n_docs), held.sum(axis=1), t, impact[d, t], n_terms)
    for query in (np.arange(12), np.array([0]), np.array([3, 7])):
        total = impact[:, query].sum(axis=1)
        want = sorted((-s, i) for i, s in enumerate(total.tolist()) if s > 0)[:10]
        docs, scores, n_read, n_all = shard.top(query, 10)
        assert [(-s, i) for i, s in zip(docs.tolist(), scores.tolist(), strict=True)] == want
        assert n_read < n_all / 10  # the bounds end it long before the lists do


def test_equal_scores_are_read_on(spark):
    docs = spark.createDataFrame([(900 - i, "alpha beta") for i in range(300)] + [(2000 + i, "gamma delta") for i in range(300)], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert [d for _, d in found_by(best_position.search(docs, items, k=50))[1]] == list(range(601, 651))


# -- conversations

def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    return out


def nodes(convs):
    """Counter of the rows of the trie, by the definition."""
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for v in members:
        if v:
            children[v[:-1]] += 1
    for v, m in members.items():
        cost = (len(m) - 1) * len(v[-1][1].decode()) if v else 0
        for d in range(len(v) + 1):
            saved[v[:d]] += cost
            leaves[v[:d]] += not children[v]
    ends = lambda v, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(v)).encode()).hexdigest()
    return Counter((min(m), len(v), min(members[v[:-1]]) if v else None, len(m), children[v], leaves[v], saved[v], ends(v, m)) for v, m in members.items())


def trie(turns):
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt(conversation_trie.numbered_turns(turns), shared, F.col("conv_id") - F.col("conv_id") % 100, 5))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def odd_turns(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", F.col("turn").cast("long"), "role", "text")
    odd = [(None, 1, "user", "nobody's"), (300, None, "user", "first"), (300, 2, None, None), (300, 2, "user", "tie b"), (300, 2, "user", "tie a"), (300, 2, "user", "tie a"),
           (301, 1, "", ""), (302, 0, "user", "w" * 100_000), (303, 5, "user", "é①"), (399, 1, "user", "é①"), (-5, 1, "a", "b"), (-100, 3, "a", "c"), (-101, 1, "a", "b"), (10**15 + 7, 1, "x", "y")]
    same = [(c, t, "user" if t % 2 else "bot", f"turn {t}") for c in range(500, 560) for t in range(7)] + [(c, t, "user" if t % 2 else "bot", f"turn {t}") for c in range(560, 580) for t in range(6, 0, -1)]
    long = [(700, t, "user", f"long {t % 3}") for t in range(900)] + [(701, t, "user", f"long {t % 3}") for t in range(900)]
    extra = spark.createDataFrame(odd + same + long, "conv_id long, turn long, role string, text string")
    return table.unionByName(extra).withColumns({c: F.lit(7) for c in ("depth", "no", "k1", "size", "place", "part", "leaf")})


@pytest.mark.parametrize("block", [4096, 7])
def test_trie_is_the_brute_force_trie(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    turns = odd_turns(spark)
    got = trie(turns)
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == nodes(rebuilt(rows))


def test_trie_turns_and_empty_table(spark):
    turns = odd_turns(spark)
    told = conversation_trie.node_turns(trie(turns), turns).collect()
    convs = rebuilt([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    for r in told:
        want = convs[r["conv_id"]][r["depth"] - 1] if r["depth"] else (None, None)
        assert (r["role"], r["text"]) == tuple(x if x is None else x.decode() for x in want)
    assert trie(turns.where("false")).count() == 0


# -- archives

def odd_pages(spark):
    long = "long " * 30
    rows = [(1, "http://a/", long), (2, "http://b/", long), (2, "http://b/", long), (1, "http://a/ again", long), (None, None, long), (3, "http://c/\r\nWARC-Type: x", "short"),
            (4, "http://d/é", "short"), (5, None, None), (6, "", ""), (7, "http://e/", "x" * 99), (8, "http://e/", "x" * 99), (9, "http://f/", "y" * 100), (10, "http://f/", "y" * 100),
            (11, "http://g/", "é" * 50), (12, "http://g/", "é" * 50), (13, "http://h/", "\r\n\r\nWARC/1.1\r\n\r\n" * 9), (14, "http://i/", "w" * 3_000_000), (None, "http://j/", "z" * 200), (None, "http://k/", "z" * 200)]
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select((F.col("page_id") + 1000).alias("page_id"), "url", "html")
    return pages.unionByName(spark.createDataFrame(rows, "page_id long, url string, html string")).withColumns({c: F.lit(3) for c in ("first", "n", "offset", "payload", "refers_to")})


def archived(rows):
    own = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in own:
        if i is not None and len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    out = Counter()
    for i, b in own:
        again = b in first and (i is None or i > first[b])
        out[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None] += 1
    return out


FIELDS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("archive_bytes,broadcast", [(256 << 20, 16 << 20), (20_000, 0)])
def test_archives_round_trip(spark, archive_bytes, broadcast):
    pages = odd_pages(spark)
    path = scratch(spark, "warc-test")
    index = warc.write_warc(pages, path, archive_bytes=archive_bytes, broadcast_bytes=broadcast)
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    want = archived(rows)
    assert Counter(tuple(r) for r in index.select(*FIELDS).collect()) == want
    got = warc.read_warc(index, path, gap=100, range_bytes=10_000, task_bytes=100_000).collect()
    assert Counter(tuple(r[c] for c in FIELDS) for r in got) == want
    held = Counter((i, (h or "").encode()) for i, _, h in rows)
    responses = Counter((r["page_id"], bytes(r["payload"])) for r in got if r["record_type"] == "response")
    assert not responses - held and all(r["payload"] is None for r in got if r["record_type"] == "revisit")
    files = index.select("archive").distinct().count()
    assert files > 5 if archive_bytes < 256 << 20 else files <= 32


def test_selected_records_are_read_by_ranges(spark):
    pages = odd_pages(spark)
    path = scratch(spark, "warc-test")
    index = warc.write_warc(pages, path, archive_bytes=50_000)
    some = index.where("page_id % 7 = 3 or record_type = 'revisit'")
    for gap in (0, 1 << 20):
        got = warc.read_warc(some, path, gap=gap)
        assert Counter(tuple(r) for r in got.select(*FIELDS).collect()) == Counter(tuple(r) for r in some.select(*FIELDS).collect())
    full = warc.read_warc(warc.with_referred(index.where("record_type = 'revisit'"), index), path).collect()
    whole = {(r["page_id"], r["payload_digest"]) for r in full if r["record_type"] == "response"}
    assert all((r["refers_to"], r["payload_digest"]) in whole for r in full if r["record_type"] == "revisit")
    assert {"\r" in (r["url"] or "") for r in full} == {False}


def test_archives_are_warc_files(spark):
    import gzip
    import os
    path = scratch(spark, "warc-test")
    index = warc.write_warc(odd_pages(spark), path)
    folder = os.path.join(path.removeprefix("file://"), "archives")
    n = 0
    for name in os.listdir(folder):
        data = gzip.open(os.path.join(folder, name)).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", head)[1])
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[size:size + 4] == b"\r\n\r\n"
            data = rest[size + 4:]
            n += b"WARC-Type: warcinfo" not in head
    assert n == index.count()


def test_spoiled_record_is_an_error():
    raw = warc.record(1, "http://a/", b"payload", hashlib.sha256(b"payload").hexdigest(), 7, None, "1970-01-01T00:00:00Z")
    assert warc.parsed(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
    with pytest.raises(ValueError):
        warc.parsed(raw[:-5])


def test_archives_of_an_empty_table(spark):
    path = scratch(spark, "warc-test")
    index = warc.write_warc(odd_pages(spark).where("false"), path)
    assert index.count() == 0 and warc.read_warc(index, path).count() == 0
