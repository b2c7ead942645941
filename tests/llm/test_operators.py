"""Each operator against a brute-force version, on rows of the tables and on awkward rows; empty tables."""

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import (
    automaton_dedup,
    bitplane,
    curriculum,
    hyper_shuffle,
    nra_topk,
    pigeonhole_join,
    pii_spans,
    site_lines,
    string_tiling,
    toxicity_grammar,
)
from sluice.llm.common import scratch, words_of, written
from sluice.llm.components import components
from sluice.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm import cases


@pytest.fixture(scope="module")
def docs(spark):
    return cases.awkward(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet")).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return cases.pairs(docs)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


# -- helpers

@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nabABé\x1c.", max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_are_cut_at_ascii_space_only(texts):
    w = words_of(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        own = [w.data[s:e].tobytes().decode() for s, e in zip(w.start[w.ptr[i]:w.ptr[i + 1]], w.end[w.ptr[i]:w.ptr[i + 1]], strict=True)]
        assert own == cases.WORD.findall(t or "")
    flat = [x for t in texts for x in cases.WORD.findall(t or "")]
    assert len(set(w.hashes.tolist())) == len(set(flat))


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 10), (12, 12), (20, 4), (None, 5), (7, 20), (30, 31), (32, 31)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 20: 1, 7: 1, 10: 10, 11: 10, 30: 30, 31: 30, 32: 30}
    chain = spark.range(200).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    assert {r["root"] for r in components(chain, "x", "y").collect()} == {0}


# -- 1

def test_grammar_composes():
    model = toxicity_grammar.Model({"idiot": 4.0, "lowei*": 2.0, "kill": 1.0})
    one = lambda t: sum(model.clauses(t))
    assert one("an idiot here") == 4.0
    assert one("you idiot") == 5.0  # targeted
    assert one("not an idiot") == pytest.approx(1.2)
    assert one("not one of these odd idiot") == 4.0  # out of the negation's reach
    assert one("he said an idiot") == pytest.approx(4.0 * 0.5 * 1.25)
    assert one("he said. an idiot") == 4.0  # another clause
    assert one("loweisch") == 2.0
    assert model.clauses("clean words only. nothing") == []
    assert len(model.clauses("idiot. idiot")) == 2
    machine = toxicity_grammar.GRAMMAR
    assert all((s, k) in machine.step for s in machine.states() for k in toxicity_grammar.KINDS)


def _clauses(model, text):
    """Clause weights by the rules, without a machine."""
    g, out = toxicity_grammar, []
    for clause in re.split(r"[.!?;:\n]", text):
        words = g.WORDS.findall(clause)
        sums = {"insult": 0.0, "threat": 0.0}
        for i, word in enumerate(words):
            if w := model.weigh(word):
                marks = [x for x in words[:i] if not model.weigh(x)]
                near = [x for x in words[max(0, i - 3):i] if not model.weigh(x)]
                w *= 0.3 if set(near) & set(g.NEGATIONS) else 1.0
                w *= 0.5 if set(marks) & set(g.REPORTS) else 1.0
                sums["threat" if word in g.THREATS else "insult"] += w
        person = any(not model.weigh(x) and x in g.TARGETS for x in words)
        total = sums["insult"] * (1.25 if person else 1.0) + sums["threat"] * (1.25 if person else 0.0)
        out += [total] if total else []
    return out


@given(st.lists(st.sampled_from("you he not never says kill stab idiot idiots lowest lowering a the cat . ! kind , him".split()), max_size=30).map(" ".join))
@settings(max_examples=300, deadline=None)
def test_clauses_are_those_of_the_rules(text):
    model = toxicity_grammar.Model({"idiot": 4.0, "lowe*": 2.0, "kill": 1.0, "stab": 1.0})
    assert model.clauses(text) == pytest.approx(_clauses(model, text))


def test_a_threat_needs_a_target():
    model = toxicity_grammar.Model(dict.fromkeys(toxicity_grammar.THREATS, 1.0))
    assert model.clauses("the disease can kill bacteria") == [] and model.clauses("kill the process") == []
    assert model.clauses("they will kill you") and model.clauses("kill him")


def test_toxicity_learns_and_generalises(spark):
    rng = np.random.default_rng(0)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    data = []
    for i in range(1200):
        words = rng.choice(vocabulary, 40).tolist()
        toxic = i % 8 == 0
        if toxic:
            words[int(rng.integers(40))] = "zorgl" + str(rng.choice(["a", "en", "isch", "ung"]))
        data.append((i, " ".join(words), int(toxic)))
    labelled = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity_grammar.learn(labelled.drop("toxic"), labelled.select("doc_id", "toxic").where("doc_id < 900"))
    got = {r["doc_id"]: r["score"] for r in toxicity_grammar.score(labelled, model).collect()}
    assert all((got[i] >= 0.3) == bool(y) for i, _, y in data if i >= 900)


def test_toxicity_awkward(spark, docs, none):
    model = toxicity_grammar.learn(docs, spark.createDataFrame([(0, None), (1, 0), (1, 0), (None, 1)], "doc_id long, toxic int"))
    assert set(model.entries) == set(toxicity_grammar.THREATS)
    out = toxicity_grammar.score(docs, model)
    assert out.count() == docs.count() and out.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    assert toxicity_grammar.score(none, model).count() == 0


# -- 2

def _best(vectors, k):
    out = []
    for q, a in vectors.items():
        if q % 3 == 0:
            score = sorted((-int(np.dot(a, b)), i) for i, b in vectors.items() if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 16])
def test_top_k(spark, block):
    rng = np.random.default_rng(1)
    vectors = {i: rng.integers(-4, 5, 6).tolist() for i in range(120)}  # many ties
    vectors |= {200: [1, 2], 201: [3, 4], 207: [], 300: [2**40] * 6, 303: [2**31, -5, 0, 0, 0, 1]}
    vectors = {i: v for i, v in vectors.items() if i != 300}
    data = [*vectors.items(), (0, vectors[0]), (500, None), (None, [1] * 6)]
    df = spark.createDataFrame(data, "vec_id long, v array<long>").withColumn("id", F.lit(1))
    got = nra_topk.nra_top_k(df, "vec_id", F.col("v"), F.col("vec_id") % 3 == 0, 5, candidate_block=block, query_block=block)
    assert sorted(tuple(r) for r in got.drop("n_read", "n_resolved").collect()) == _best(vectors, 5)
    assert nra_topk.nra_top_k(df.where("false"), "vec_id", F.col("v"), F.col("vec_id") % 3 == 0).count() == 0


def test_top_k_drops_only_outsiders():
    rng = np.random.default_rng(2)
    c = rng.normal(0, 60, (3000, 16)).astype(np.int64)
    c[:40] = c[0] + rng.integers(-3, 4, (40, 16))
    q = c[:8]
    ids = np.arange(3000)
    i, j, s, read, resolved = nra_topk.top_k_block(q, ids[:8], c, ids, 5)
    assert (read < c.size).all() and (resolved < 100).all()  # outsiders were dropped before the lists ended
    for x in range(8):
        score = c @ q[x]
        want = sorted((-int(score[y]), y) for y in range(3000) if y != x)[:5]
        assert [(-int(b), int(a)) for a, b in zip(j[i == x], s[i == x], strict=True)] == want


@given(st.integers(1, 60), st.integers(0, 6), st.integers(1, 4), st.integers(0, 2**31), st.sampled_from([1, 3, 300]))
@settings(max_examples=60, deadline=None)
def test_top_k_of_random_vectors(n, dim, k, seed, most):
    rng = np.random.default_rng(seed)
    c, ids = rng.integers(-most, most + 1, (n, dim)), rng.permutation(3 * n)[:n]
    i, j, s, _, _ = nra_topk.top_k_block(c[:5], ids[:5], c, ids, k)
    for x in range(min(5, n)):
        score = c @ c[x]
        want = sorted((-int(score[y]), int(ids[y])) for y in range(n) if y != x)[:k]
        assert [(-int(b), int(ids[a])) for a, b in zip(j[i == x], s[i == x], strict=True)] == want


def test_reading_stops_early_where_few_components_carry_the_product():
    rng = np.random.default_rng(5)
    c = (rng.normal(0, 240, (6000, 64)) * np.exp(-np.arange(64) / 3)).astype(np.int64)
    _, _, _, read, resolved = nra_topk.top_k_block(c[:20], np.arange(20), c, np.arange(6000), 5)
    assert read.max() < 0.15 * c.size and resolved.max() <= 20


def test_components_of_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.5]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, None), (6, [])], "i long, e array<float>")
    assert [r[0] for r in df.select(nra_topk.floor_256(F.col("e"))).collect()] == [[128, -128], None, None, None, None, []]


# -- 3

def test_inverse_demand_inverts(spark):
    knots = ((0.0, 0.5), (0.4, 2.0), (1.0, 0.25))
    out = spark.range(101).select((F.col("id") / 100).alias("share")).withColumn("t", curriculum.inverse_demand(F.col("share"), knots)).collect()
    grid = np.linspace(0, 1, 200_001)
    w = np.interp(grid, *zip(*knots, strict=True))
    area = np.concatenate(([0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(grid))))
    for r in out:
        assert np.interp(r["t"], grid, area / area[-1]) == pytest.approx(r["share"], abs=1e-4)


def _targets(size, most=3.0):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(size.values())
    while True:
        level = (total - sum(most * size[s] for s in full)) / max(1, sum(weight[s] for s in size if s not in full))
        new = {s for s in size if s not in full and most * size[s] <= level * weight[s]}
        if not new:
            return {s: most * size[s] if s in full else weight[s] * level for s in size}
        full |= new


def test_curriculum(spark, docs, none):
    got = curriculum.curriculum(docs).collect()
    size = defaultdict(int)
    for r in docs.select("source", "text").collect():
        size[r["source"]] += len(cases.WORD.findall(r["text"] or ""))
    want = _targets(size)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert len(r["times"]) <= 3 and list(r["times"]) == sorted(r["times"]) and all(0 <= t <= 1 for t in r["times"])
        taken[r["source"]] += r["size"] * len(r["times"])
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in size)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(cases.WORD.findall(t or ""))) for i, t in cases.pairs(docs))
    first = [r["times"][0] for r in got if r["times"]]
    assert first == sorted(first)
    assert sorted(map(tuple, curriculum.curriculum(docs).select("doc_id", "n", "size", F.size("times")).na.fill(-1).collect())) == sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n"], r["size"], len(r["times"])) for r in got)
    order = [r["time"] for r in curriculum.training_order(curriculum.curriculum(docs)).collect()]
    assert order == sorted(order) and len(order) == sum(len(r["times"]) for r in got)
    assert curriculum.curriculum(none).count() == 0


# -- 4

def test_tiles_find_reordered_passages():
    item = np.arange(1, 31, dtype=np.uint64)
    doc = np.concatenate([[900], item[20:30], [901, 902], item[:12], [903], item[12:20], [904]]).astype(np.uint64)
    assert sorted(string_tiling.tiles(doc, item, 5)) == [(1, 20, 10), (13, 0, 12), (26, 12, 8)]
    assert string_tiling.tiles(doc[:5], item, 5) == []


def _tiles_brute(doc, item, least):
    """Greedy string tiling, the plain way."""
    out, free_d, free_i = [], [True] * len(doc), [True] * len(item)
    while True:
        best = []
        for j, i in itertools.product(range(len(item)), range(len(doc))):
            n = 0
            while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_d[i + n] and free_i[j + n]:
                n += 1
            if n >= least:
                best.append((-n, j, i))
        if not best:
            return sum(n for _, _, n in out)
        longest = min(best)[0]
        for n, j, i in sorted(b for b in best if b[0] == longest):
            n = -n
            if all(free_d[i:i + n]) and all(free_i[j:j + n]):
                out.append((i, j, n))
                free_d[i:i + n] = [False] * n
                free_i[j:j + n] = [False] * n


@given(st.lists(st.integers(1, 4), max_size=40), st.lists(st.integers(1, 4), max_size=25))
@settings(max_examples=80, deadline=None)
def test_tiles_cover_as_much_as_the_plain_way(doc, item):
    got = string_tiling.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
    for i, j, n in got:
        assert doc[i:i + n] == item[j:j + n] and n >= 3
    for of in (0, 1):
        used = [x for t in got for x in range(t[of], t[of] + t[2])]
        assert len(used) == len(set(used))
    assert sum(t[2] for t in got) == _tiles_brute(doc, item, 3)


def test_decontaminate(spark, docs, none):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "xq zq")], "item_id long, text string"))
    item = bench.where("item_id = 3").first()["text"]
    words = item.split()
    half = len(words) // 2
    mixed = " ".join(["noise"] * 9 + words[half:] + ["other"] * 4 + words[:half] + ["end"] * 5).upper()
    odd = spark.createDataFrame([(7001, mixed), (7002, " ".join(words[:4]) + " nothing else"), (7003, "see xq, zq."), (7004, None)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd)
    got = {(r["doc_id"], r["item_id"]): r for r in string_tiling.decontaminate(both, bench).collect()}
    assert (7001, 3) in got and (7003, 902) in got and not {7002, 7004} & {d for d, _ in got}
    split = {k for k in string_tiling.decontaminate(both, bench, most_words=200).select("doc_id", "item_id").collect()}
    assert {tuple(k) for k in split} == set(got)
    assert string_tiling.decontaminate(none, bench).count() == 0
    assert string_tiling.decontaminate(docs, bench.where("false")).count() == 0


# -- 5

@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["byte", "bit"]))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids, planes):
    a = np.array(ids, dtype="<u4")
    assert bitplane.from_planes(bitplane.to_planes(a, planes), len(a), planes).tolist() == ids
    assert bitplane.unpack(*bitplane.pack(a, planes, 3), planes).tolist() == ids


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files(spark, docs, rows, none, planes, monkeypatch):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    path = scratch(spark, "test-tokens")
    bitplane.write_tokens(docs, path, tokenizer_path(), planes=planes)
    want, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes()
        want.append((i, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = bitplane.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids")).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    index = bitplane.read_index(spark, path).orderBy("start").collect()
    assert sum(r["n_ids"] for r in index) == at and index[0]["start"] == 0
    bitplane.write_tokens(none, path + "-none", tokenizer_path(), planes=planes)
    assert bitplane.read_tokens(spark, path + "-none").count() == 0


# -- 6

def test_communication_matrix_is_exact_and_hypergeometric():
    counts = np.array([7, 0, 13, 40])
    m = hyper_shuffle.communication_matrix(counts, 8, 1)
    assert m.sum(axis=1).tolist() == counts.tolist() and sorted(m.sum(axis=0)) == [7] * 4 + [8] * 4
    first = np.array([hyper_shuffle.communication_matrix(np.array([30, 70]), 4, s)[0, 0] for s in range(3000)])
    assert first.mean() == pytest.approx(7.5, abs=0.15) and first.var() == pytest.approx(25 * 0.3 * 0.7 * 75 / 99, rel=0.1)
    big = hyper_shuffle.communication_matrix(np.array([10**6, 3 * 10**9]), 8, 3)
    assert big.sum(axis=1).tolist() == [10**6, 3 * 10**9] and np.ptp(big.sum(axis=0)) <= 1
    assert np.abs(big[0] - 125_000).max() < 6 * (10**6 / 8) ** 0.5


def test_shuffle(spark, docs, none):
    out = hyper_shuffle.hyper_shuffle(docs.repartition(5), F.octet_length(F.coalesce("text", F.lit(""))) + 1, F.crc32(F.coalesce("text", F.lit("")).cast("binary")), bucket_rows=16).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter((r["doc_id"], r["size"], r["checksum"]) for r in out) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in cases.pairs(docs))
    assert hyper_shuffle.hyper_shuffle(none, F.lit(1), F.lit(1)).count() == 0


# -- 7

@pytest.mark.parametrize(("n", "p", "block", "most"), [(3, 90, 128, 1 << 25), (5, 80, 128, 1 << 25), (2, 60, 4, 0)])
def test_jaccard_join(spark, docs, rows, none, n, p, block, most):
    got = pigeonhole_join.jaccard_join(docs, n=n, p=p, block=block, block_elements=1 << 20, broadcast_bytes=most)
    assert Counter(map(tuple, got.select("doc_id", "n_shingles", "n_links", "component_id").collect())) == cases.jaccard(rows, n, p)
    assert pigeonhole_join.jaccard_join(none).count() == 0


def _passages(rng, texts):
    """(doc_id, text): texts of own words with one or two of three common passages, families of near copies of 2, 5, 12
    and 40 members, one of them all with a passage, and short texts."""
    words = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    common = [words(25) for _ in range(3)]

    def text():
        out = words(rng.integers(60, 200))
        for k in rng.choice(3, rng.integers(1, 3), replace=False):
            out += common[k]
        return out
    out = [text() for _ in range(texts)]
    for size in (2, 5, 12, 40):
        base = text() if size == 12 else words(100)
        for _ in range(size):
            own = list(base)
            for at in rng.integers(0, len(own), rng.integers(0, 4)):
                own[at] = words(1)[0]
            out.append(own)
    out += [words(n)[:n - 1] + ["end"] for n in rng.integers(1, 12, 60)]
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize(("n", "p", "few"), [(5, 80, 8), (1, 60, 8), (3, 90, 2), (2, 70, 2)])
def test_jaccard_join_of_texts_with_common_passages(spark, monkeypatch, n, p, few):
    monkeypatch.setattr(pigeonhole_join, "FEW", few)
    rows = _passages(np.random.default_rng(n), 250)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = pigeonhole_join.jaccard_join(docs, n=n, p=p, block=16)
    assert Counter(map(tuple, got.select("doc_id", "n_shingles", "n_links", "component_id").collect())) == cases.jaccard(rows, n, p)


def test_common_passages_do_not_join_texts(spark, monkeypatch):
    tables = {}
    kept = pigeonhole_join.written
    monkeypatch.setattr(pigeonhole_join, "written", lambda df, name: tables.setdefault(name, kept(df, name)))
    rows = _passages(np.random.default_rng(5), 1500)
    pigeonhole_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), n=5, p=80, block=16)
    assert max(r["count"] for r in tables["members"].groupBy("root").count().collect()) < 200
    assert tables["placed"].agg(F.sum(F.size("tasks"))).first()[0] < 2000


def test_written_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {x for i in range(found.size()) if (x := found.apply(i).getName()).startswith("shuffle_")}
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(conf)
    df = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count()
    out = written(df, "test")
    assert not files() - before and spark.conf.get(conf) == was
    assert out.count() == written(df, "test").count() == df.count() == 5000  # the frame is still good


@given(st.integers(9, 400), st.sampled_from([60, 80, 90]), st.integers(0, 2**32))
@settings(max_examples=150, deadline=None)
def test_similar_sets_share_a_signature(size, p, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
    b = a.copy()
    while True:  # the least similar set that still counts, by random changes
        c = b.copy()
        if rng.random() < 0.5:
            c = np.delete(c, rng.integers(len(c)))
        else:
            c = np.unique(np.append(c, rng.integers(0, 2**63, dtype=np.uint64)))
        common = len(np.intersect1d(a, c))
        if common * 100 < p * (len(a) + len(c) - common):
            break
        b = c
    if len(b) != len(a) or (a != b).any():
        assert np.intersect1d(pigeonhole_join.signatures(a, p), pigeonhole_join.signatures(b, p)).size
        (one, need), (two, other) = pigeonhole_join.indexed(a, p), pigeonhole_join.indexed(b, p)
        assert len(np.intersect1d(one, two)) >= max(need, other)


# -- 8

def test_spans(spark, docs, rows, none):
    out = pii_spans.pii_spans(docs)
    assert out.columns == [*docs.columns, "pii"]
    got = Counter((r["doc_id"], tuple((s["start"], s["rank"], s["end"], s["kind"]) for s in r["pii"] if s["rank"] < 4)) for r in out.select("doc_id", "pii").collect())
    assert got == Counter((i, tuple(cases.base_spans(t or ""))) for i, t in rows)
    assert pii_spans.pii_spans(none).count() == 0


@given(st.lists(st.text(alphabet="aB0159.-@+ (_é\x01\x02\n", max_size=40), min_size=1, max_size=60))
@settings(max_examples=8, deadline=None)
def test_spans_of_random_texts(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in pii_spans.pii_spans(df).collect():
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["pii"] if s["rank"] < 4] == cases.base_spans(texts[r["doc_id"]])


@pytest.mark.parametrize("unit,kind", [("a@b.com ", "email"), ("10.0.0.1 ", "ip"), ("4111111111111111 ;", "card")])
def test_spans_of_a_text_of_many(spark, unit, kind):
    """Time in proportion to the matches: with work for each pair of them these sizes would take minutes."""
    for n in (20_000, 80_000):
        got = pii_spans.pii_spans(spark.createDataFrame([(unit * n,)], "text string")).first()["pii"]
        assert [(s["start"], s["kind"]) for s in got] == [(i * len(unit), kind) for i in range(n)]


def test_checks_and_context(spark):
    texts = ["my iban is GB82 WEST 1234 5698 7654 32 ok", "GB83 WEST 1234 5698 7654 32", "credit card 4111111111111111", "order 4111111111111111", "4111111111111112"]
    got = [r["pii"] for r in pii_spans.pii_spans(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert [[s["kind"] for s in x] for x in got] == [["iban"], [], ["card"], ["card"], []]
    assert got[0][0]["score"] == 1.0 and got[2][0]["score"] > 0.8 > got[3][0]["score"]


# -- 9

@pytest.mark.parametrize(("length", "most"), [(35, 256), (35, 2), (8, 256)])
def test_substring_dedup(spark, docs, rows, none, length, most):
    got = automaton_dedup.substring_dedup(docs, length=length, k=min(8, length), most_pieces=most, digest=True).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == cases.repeats(rows, length)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)
    if most == 2:
        assert automaton_dedup.substring_dedup(none).count() == 0


@given(st.lists(st.lists(st.integers(0, 2), max_size=30), min_size=1, max_size=5), st.integers(1, 6))
@settings(max_examples=100, deadline=None)
def test_automaton_counts_places(texts, length):
    automaton = automaton_dedup.SuffixAutomaton()
    for t in texts:
        automaton.add(t, 1)
    automaton.finish()
    places = Counter(tuple(t[k:k + length]) for t in texts for k in range(len(t) - length + 1))
    for t in texts:
        assert automaton.repeats(t, length) == [places[tuple(t[k:k + length])] > 1 for k in range(len(t) - length + 1)]


@given(st.integers(35, 200), st.integers(1, 6), st.integers(0, 2**32))
@settings(max_examples=100, deadline=None)
def test_pieces_part_the_windows_and_follow_their_words(n, alphabet, seed):
    words = np.random.default_rng(seed).integers(1, alphabet + 1, n).astype(np.uint64)
    m, start, count = automaton_dedup.pieces_of(words, 35, 8)
    assert start.tolist() == [0, *np.cumsum(count)[:-1]] and count.sum() == n - 34 and count.max() <= 28
    of = np.repeat(np.arange(len(m)), count)
    seen = {}
    for i in range(n - 34):
        w = tuple(words[i:i + 35].tolist())
        assert seen.setdefault(w, m[of[i]]) == m[of[i]]  # equal windows, equal minimizers
        if w in (tuple(words[j:j + 35].tolist()) for j in range(i)):
            assert all(of[j] != of[i] for j in range(i) if tuple(words[j:j + 35].tolist()) == w)


# -- 10

def test_site_lines(spark):
    pages = [(i, "a.com", ["menu", f"text {i}", "menu"]) for i in range(10)] + [(20 + i, "b.com", ["menu", None, ""]) for i in range(3)]
    pages += [(30, None, ["menu"]), (31, "a.com", None), (32, "a.com", [])] + [(40, "c.com", ["x"])] * 6
    df = spark.createDataFrame(pages, "page_id long, host string, lines array<string>").withColumns({"kept": F.lit(1), "h": F.lit(2), "n": F.lit(3)})
    got = {r["page_id"]: (r["kept"], r["n_dropped"]) for r in site_lines.drop_site_boilerplate(df, "host", "lines").collect()}
    assert got[3] == (["text 3"], 2) and got[21] == (["menu", None, ""], 0) and got[30] == (["menu"], 0)
    assert got[31] == ([], 0) and got[32] == ([], 0) and got[40] == ([], 1)
    assert site_lines.drop_site_boilerplate(df, "host", "lines").count() == len(pages)
    assert site_lines.drop_site_boilerplate(df.where("false"), "host", "lines").count() == 0
    html = spark.createDataFrame([("<p>a <b>b</b></p><script>x</script><br/>c<!-- d --> <DIV>e</DIV>",), (None,), ("",)], "html string")
    assert [r[0] for r in html.select(site_lines.html_lines(F.col("html"))).collect()] == [["a b", "c", "e"], [], []]


# -- 5, once more: the encoder is the tokenizer

@given(st.lists(st.text(alphabet="aAbBzéÉñß'’.,;:!?-—12①ΣςİḰ \x1c\x85\t\n<|>_sSlL中👍", max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_encoder_gives_the_ids_of_whole_texts(texts):
    made = _ENCODER.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in made] == [_ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_text_of_many_words_does_not_fill_the_memory_of_words():
    coder = bitplane.WordEncoder(tokenizer_path())
    coder.known = bitplane._Known(coder.one, 100)
    text = " ".join(f"zq{i}x" for i in range(1000)).encode()
    got = coder.encode([text, text])
    assert got[0] == got[1] == b"".join(coder.one(w) for w in text.split())
    assert len(coder.known) <= 101 and len(coder.known.old) <= 101


def test_token_writers_get_small_batches(spark):
    """Rows a batch while token files are written, and the session's own number after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), bitplane._batches_of(spark, 7):
        sizes = spark.range(100, numPartitions=1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
        assert max(r["n"] for r in sizes.collect()) == 7
        1 / 0
    assert spark.conf.get(name) == before


_ENCODER = bitplane.WordEncoder(tokenizer_path())


def test_special_tokens_in_any_case():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|endoftext|>", "X<|endoftext|>Y. Z<|STARTOFTEXT|>, <|StartOfText|>", "A <| B |> <|<|ENDOFTEXT|>|> END.", "", None,
             "<|", "É<|Endoftext|>É <|startoftext|>", "plain Words <|x"]
    got = [np.frombuffer(b, "<u4").tolist() for b in bitplane.WordEncoder(tokenizer_path()).encode([None if t is None else t.encode() for t in texts])]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got[0] != got[2] and 49407 not in got[1] and got[2] == [49407]


def _copied(spark, copies, toxic):
    """Labelled texts of both kinds; a third of the rows is one text with rare words, of the given label."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    data = []
    for i in range(600):
        words = rng.choice(vocabulary, 30).tolist()
        if i % 4 == 0:
            words[int(rng.integers(30))] = "zorglisch"
        data.append((i, " ".join(words), int(i % 4 == 0)))
    hot = " ".join(rng.choice(vocabulary, 28)) + (" qqrare" if toxic else " zorglisch qqrare")
    data += [(1000 + i, hot, toxic) for i in range(copies)]
    labelled = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    return toxicity_grammar.learn(labelled.drop("toxic"), labelled.select("doc_id", "toxic"))


@pytest.mark.parametrize("toxic", [0, 1])
def test_toxicity_counts_copies_once(spark, toxic):
    learned, plain = _copied(spark, 300, toxic).entries, _copied(spark, 1, toxic).entries
    assert learned == plain and "zorglisch" in learned and "qqrare" not in learned


@pytest.mark.parametrize("unit", ["<!-- ", "<script>", "<script ", "<style>x", "<", "<div "])
def test_lines_of_a_page_of_open_tags(spark, unit):
    """Time in proportion to the page: with a search from every start these sizes would take minutes."""
    pages = spark.createDataFrame([(unit * n + end,) for n in (20_000, 160_000) for end in ("", "</script>", "-->", "\u0001\u0002")], "html string")
    assert pages.select(F.size(site_lines.html_lines(F.col("html"))).alias("n")).where("n <= 1").count() == 8


@given(st.lists(st.lists(st.sampled_from(["<!-- ", "-->", "<script>", "<script ", "</script>", "<style>", "</STYLE>", ">", "<", "a b", "\n", "\x01", "\x02", "\x01!--", "<p>", "<!-->", "é", "<br/>"]), max_size=20), min_size=1, max_size=40))
@settings(max_examples=10, deadline=None)
def test_lines_are_those_of_the_plain_patterns(spark, pages):
    import re
    texts = ["".join(p) for p in pages]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, html string")
    few, site_lines.FEW_OPENERS = site_lines.FEW_OPENERS, -1  # all by the way for many openers
    try:
        marked = site_lines.html_lines(F.col("html"))
    finally:
        site_lines.FEW_OPENERS = few
    for r in df.select("i", site_lines.html_lines(F.col("html")).alias("lines"), marked.alias("marked")).collect():
        assert r["marked"] == r["lines"]
        shown = re.sub(f"(?is){site_lines.HIDDEN}", " ", texts[r["i"]])
        bare = re.sub("<[^>]*>", "", re.sub(f"(?i){site_lines.BREAKS}", "\n", shown))
        assert r["lines"] == [x.strip(" ") for x in bare.split("\n") if x.strip(" ")]
