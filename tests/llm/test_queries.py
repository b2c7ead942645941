"""Registered queries against DuckDB, and the pipeline against a plain version of its stages."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import curriculum, oracle, queries, string_tiling
from sluice.llm.common import words_of
from tests.conftest import SF_SMALL
from tests.llm import cases
from tools.oracle_check import TABLES, rows_of


def test_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(oracle.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.queries()[name](spark, SF_SMALL)
    res = con.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, res.fetchall())


def test_toxicity_query(spark):
    out = queries.op1_toxicity_grammar(spark, SF_SMALL).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert len(out) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    # toxicity: what its score rejects
    score = {r["doc_id"]: r["score"] for r in queries.op1_toxicity_grammar(spark, SF_SMALL).collect()}
    clean = corpus_pipeline.toxicity(spark, docs, SF_SMALL).cache()
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in score.items() if s < 0.3}
    # near duplicates: the smallest id of each group
    one = corpus_pipeline.near_duplicates(spark, clean, SF_SMALL).cache()
    want = {r[0] for r in cases.jaccard(cases.pairs(clean), 5, 80) if r[1] == 0 or r[0] == r[3]}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(want) and one.columns == docs.columns
    # decontamination: every pair by the plain tiling
    items = [(r["item_id"], r["t"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").withColumn("t", string_tiling.bare(F.col("text"))).collect()]
    texts = [(r["doc_id"], r["t"]) for r in one.withColumn("t", string_tiling.bare(F.col("text"))).collect()]
    import pyarrow as pa
    hashes = lambda t: words_of(pa.array([t])).hashes
    items = [hashes(t) for _, t in items]
    leaked = set()
    for i, t in texts:
        doc = hashes(t)
        for w in items:
            if np.isin(w, doc).sum() * 2 >= len(w) and sum(x[2] for x in string_tiling.tiles(doc, w, min(5, len(w)))) * 2 >= len(w):
                leaked.add(i)
    left = corpus_pipeline.decontamination(spark, one, SF_SMALL).cache()
    assert {r["doc_id"] for r in left.collect()} == want - leaked and left.columns == docs.columns
    # mixing: copies as the mix says
    mixed = corpus_pipeline.mixing(spark, left, SF_SMALL).cache()
    assert mixed.columns == docs.columns
    taken, size, source = Counter(), defaultdict(int), {}
    for r in left.collect():
        size[r["source"]] += len(cases.WORD.findall(r["text"]))
        source[r["doc_id"]] = r["source"]
    for r in mixed.collect():
        taken[r["source"]] += len(cases.WORD.findall(r["text"]))
    assert abs(sum(taken.values()) / sum(size.values()) - 1) < 0.1
    assert max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3
    # token files
    from tokenizers import Tokenizer
    tokenizer, want, at = Tokenizer.from_file(queries.tokenizer_path()), [], 0
    for i, t in sorted(cases.pairs(mixed)):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        want.append((i, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = corpus_pipeline.token_files(spark, mixed, SF_SMALL).orderBy("start").collect()
    assert [tuple(r) for r in got] == want


def test_pipeline_keeps_odd_rows(spark):
    docs = cases.awkward(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 60).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).cache()
    assert docs.count() > 0


def _odd_ids(spark, rows):
    """Documents of (doc_id, text, source)."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))


def _texts(n, words, start=0):
    return [" ".join(f"w{start + i}x{k}" for k in range(words)) for i in range(n)]


def test_near_duplicates_tell_rows_of_one_id_apart(spark):
    a, b, c, d = _texts(4, 60)
    near = lambda t: t + " more"
    rows = [(None, ""), (None, ""), (None, a), (None, near(a)), (None, b), (1, near(b)), (5, c), (5, near(c)), (5, d), (3, near(d)), (None, near(d)), (5, "single"), (5, "single")]
    got = corpus_pipeline.near_duplicates(spark, _odd_ids(spark, [(*r, "s") for r in rows]), SF_SMALL)
    got = Counter((r["doc_id"], r["text"]) for r in got.collect())
    for group in ([(None, a), (None, near(a))], [(5, c), (5, near(c))]):
        assert sum(got.pop(r, 0) for r in group) == 1
    assert got == Counter({(None, ""): 2, (1, near(b)): 1, (3, near(d)): 1, (5, "single"): 1})


def test_near_duplicates_deals_texts_out_once(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.near_duplicates(spark, _odd_ids(spark, [(i, t, "s") for i, t in enumerate(_texts(9, 20))]), SF_SMALL)
        plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
        assert out.count() == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len([x for x in plan if "Exchange hashpartitioning" in x]) == 2  # the documents, and the rows kept


def test_decontamination_tells_rows_of_one_id_apart(spark):
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first()["text"]
    a, b = _texts(2, 60)
    rows = [(None, item), (None, a), (None, None), (None, a), (7, b), (7, item), (7, a), (8, item)]
    got = corpus_pipeline.decontamination(spark, _odd_ids(spark, [(*r, "s") for r in rows]), SF_SMALL)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(None, a), (None, None), (None, a), (7, b), (7, a)])


def test_mixing_tells_rows_of_one_id_apart(spark):
    # equal sizes; heavy sources repeat, light ones lose rows
    rows = [(None, t, "abc"[i % 3]) for i, t in enumerate(_texts(90, 10))] + [(4, t, "abc"[i % 3]) for i, t in enumerate(_texts(90, 10, 100))]
    rows += [(None, "the same words " * 3, "c")] * 30
    docs = _odd_ids(spark, rows).cache()
    mix = curriculum.curriculum(docs).collect()
    want = Counter()
    for r in mix:
        want[r["doc_id"], r["source"], r["size"]] += len(r["times"])
    assert len({len(r["times"]) for r in mix}) > 1
    out = corpus_pipeline.mixing(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    out = out.collect()
    got = Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in out)
    assert got == Counter({k: n for k, n in want.items() if n})
    each, there = Counter((r["doc_id"], r["source"], r["text"]) for r in out), Counter(rows_ := [(i, s, t) for i, t, s in rows])
    assert set(each) <= set(rows_) and all(n <= 3 * there[k] for k, n in each.items())


def test_pipeline_trains_in_the_order_of_the_schedule(spark, monkeypatch):
    stages = dict(corpus_pipeline.STAGES)
    docs = _odd_ids(spark, [(i, t, "abc"[i % 3]) for i, t in enumerate(_texts(60, 10))]).cache()

    def trained():
        mixed = stages["mixing"](spark, docs, SF_SMALL).cache()
        want = [r["doc_id"] for r in mixed.orderBy("time", "doc_id").collect()]
        got = [r["doc_id"] for r in stages["token_files"](spark, mixed, SF_SMALL).orderBy("start").collect()]
        assert got == want and len(set(got)) < len(got)
        assert Counter(got) == Counter(r["doc_id"] for r in curriculum.training_order(curriculum.curriculum(docs)).collect())
        return got
    one = trained()
    assert one != sorted(one)
    monkeypatch.setattr(curriculum, "SCHEDULES", {w: ((0.0, 2.0 if w == 3 else 0.1), (1.0, 0.1 if w == 3 else 2.0)) for w in (1, 2, 3)})
    assert trained() != one
