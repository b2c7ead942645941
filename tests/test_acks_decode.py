"""T1-T3 acknowledgements and the decode split P7-P9."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import acks, decode
from sluice.operators.envelope import ENVELOPE_COLUMNS, make_envelope, with_default_stream


def brute_prune(first, n, log, behind):
    pending = set(range(first, n))
    out = []
    for seq, o in log:
        before = min(pending) if pending else None
        if pending and before < o - behind:
            pending = {p for p in pending if p >= o}
            act = "clear"
        else:
            pending.discard(o)
            act = "remove"
        out.append((seq, o, act, before, min(pending) if pending else None))
    return out


def prune_logs(rnd, partitions, most):
    """{partition: (first, next, [(seq, offset), ...])}: late, missing, repeated and unknown acks."""
    out = {}
    for part in range(partitions):
        first = rnd.choice([0, 5])
        n = first + rnd.randint(1, most)
        lag = rnd.choice([1, 5, 30, 200])
        offs = sorted(range(first, n), key=lambda x: x + rnd.random() * lag)
        share = rnd.choice([0.6, 0.95, 1])
        offs = [o for o in offs if rnd.random() < share]
        for _ in range(rnd.randint(0, 25)):
            offs.insert(rnd.randint(0, len(offs)), rnd.choice([rnd.randint(first, n - 1), n + rnd.randint(0, 40), rnd.randint(-3, first)]))
        out[part] = (first, n, list(enumerate(offs)))
    return out


def prune_frames(spark, logs):
    em = spark.createDataFrame([(p, o) for p, (a, b, _) in logs.items() for o in range(a, b)], "partition int, offset long")
    log = spark.createDataFrame([(p, o, s) for p, (_, _, log) in logs.items() for s, o in log], "partition int, offset long, ack_seq long")
    return em, log


def brute_of(logs, behind):
    return {(p, *r) for p, (a, b, log) in logs.items() for r in brute_prune(a, b, log, behind)}


def decided(df):
    return {tuple(r) for r in df.select("partition", "ack_seq", "offset", "action", "min_pending_before", "min_pending_after").collect()}


def test_pending_prune_matches_brute_force(spark):
    logs = prune_logs(random.Random(5), 40, 120)
    em, log = prune_frames(spark, logs)
    want = brute_of(logs, 3)
    got = acks.pending_prune(log, em, 3).checkpoint()
    assert decided(got) == want and got.count() == len(want) and sum(r[3] == "clear" for r in want) > 100


def test_pending_prune_over_many_blocks(spark):
    logs = {p: v for p, v in prune_logs(random.Random(8), 12, 150).items() if len(v[2]) > 60}
    em, log = prune_frames(spark, logs)
    assert decided(acks.pending_prune(log, em, 2, block_size=48)) == brute_of(logs, 2)


def test_prune_steps_are_one_ledger(spark):
    logs = prune_logs(random.Random(11), 40, 120)
    em, log = prune_frames(spark, logs)
    bounds = em.groupBy("partition").agg(F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset"))
    low = removed = None
    steps = set()
    for a, b in ((-1, 20), (20, 10**6)):
        part = log.where((F.col("ack_seq") > a) & (F.col("ack_seq") <= b))
        rows, low, removed = acks.prune_step(part, bounds, low, removed, 3)
        removed = removed.checkpoint()
        steps |= decided(rows)
    assert steps == brute_of(logs, 3)


def test_prune_groups_stay_small(spark, monkeypatch):
    """One partition and one offset hold most rows; no group of the search sees more than two blocks of them."""
    from sluice.operators import nearest
    seen = spark.sparkContext.accumulator(0)
    n, size = 1500, 64
    points = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("p"), F.when(F.col("id") == 3, 10**6).otherwise(F.col("id") % 7).alias("v"))
    queries = spark.range(n).select(F.lit(1).alias("k"), "id", F.lit(n).cast("long").alias("at"), F.lit(50).alias("least"))
    inner = nearest._in_block

    def counted(p, q):
        if p.num_rows > size or q.num_rows > 3 * size:
            seen.add(1)
        return inner(p, q)

    monkeypatch.setattr(nearest, "_in_block", counted)
    got = nearest.nearest(points, queries, "k", "p", "v", "at", "least", "found", block_size=size).collect()
    assert len(got) == n and {r["found"] for r in got} == {3} and seen.value == 0


def test_search_shuffles_points_and_queries_once(spark):
    """To their groups; the number of groups of a block goes to the tasks, whatever the tables' sizes."""
    from sluice.operators.nearest import nearest
    points = spark.range(200).select((F.col("id") % 2).alias("k"), F.col("id").alias("p"), (F.col("id") % 7).alias("v"))
    queries = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"), F.lit(5).alias("least"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        found = nearest(points, queries, "k", "p", "v", "at", "least", "found")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "CoGroup" in plan
        for r in found.collect():
            assert r["found"] == max((p for p in range(min(r["at"], 200)) if p % 2 == r["k"] and p % 7 >= 5), default=None)
    finally:
        spark.conf.set(name, before)


def test_prune_of_offsets_acked_again_and_again(spark):
    """An ack that clears spares its own offset until it is acked again: the second, of two acks or of more."""
    logs = {p: (0, 30, list(enumerate([9, 20, *again, 28, 29, 27, 20, 21]))) for p, again in
            enumerate([[], [20], [20, 20], [9, 20, 9, 20, 9], [22, 9, 9, 20, 20, 24, 24, 24]])}
    em, log = prune_frames(spark, logs)
    for behind in (3, 7):
        assert decided(acks.pending_prune(log, em, behind)) == brute_of(logs, behind)


def test_nearest_both_ways(spark):
    rnd = random.Random(2)
    pts = [(k, p, rnd.randint(0, 20)) for k in (0, 7) for p in rnd.sample(range(-30, 300), 100)]
    qs = [(i, rnd.choice([0, 7, 8, None]), rnd.choice([rnd.randint(-40, 310), None]), rnd.randint(0, 22)) for i in range(300)]
    points = spark.createDataFrame(pts, "k int, p long, v long")
    queries = spark.createDataFrame(qs, "id int, k int, at long, least long")
    from sluice.operators.nearest import nearest
    for ahead in (False, True):
        got = {r["id"]: r["found"] for r in nearest(points, queries, "k", "p", "v", "at", "least", "found", ahead=ahead, block_size=40).collect()}
        for i, k, at, least in qs:
            good = [p for kk, p, v in pts if kk == k and at is not None and v >= least and (p > at if ahead else p < at)]
            assert got[i] == ((min(good) if ahead else max(good)) if good else None)


def test_pending_and_unknown(spark):
    em = spark.createDataFrame([(0, o) for o in range(5)], "partition int, offset long")
    ak = spark.createDataFrame([(0, 1, 1), (0, 3, 2), (0, 9, 3)], "partition int, offset long, ack_seq long")
    assert sorted(r.offset for r in acks.ack_pending(em, ak).collect()) == [0, 2, 4]
    assert [r.offset for r in acks.ack_unknown(em, ak).collect()] == [9]


def test_fail_disposition(spark):
    df = spark.createDataFrame([("amqp", True), ("amqp", False), ("kestrel", False), ("jms", True),
                                ("mqtt", False), ("kafka", False)], "protocol string, requeue boolean")
    got = [r.d for r in df.select(acks.fail_disposition(F.col("protocol"), F.col("requeue")).alias("d")).collect()]
    assert got == ["requeue", "dead_letter", "abort", "drop", "drop", "replay"]


def test_decode_split_partitions_input(spark):
    raw = spark.createDataFrame(
        [("o", 0, i, v, p) for i, (v, p) in enumerate([
            (b'{"k": 1}', "kafka"), (b"not json", "amqp"), (b"", "mqtt"), (None, "jms"),
            (b'{"x": 2}', "kestrel"), (b'{"k": "a"}', "kafka")])],
        "origin string, partition int, offset long, value binary, protocol string")
    env = with_default_stream(make_envelope(raw))
    assert env.columns == ENVELOPE_COLUMNS and env.first().stream == "default"
    d = decode.decode(env, T.StructType([T.StructField("k", T.LongType())]))
    good = decode.good(d).collect()
    dead = {r.offset: (r.dead_reason, r.disposition) for r in decode.dead_letters(d).collect()}
    assert [r.k for r in good] == [1]
    assert dead == {1: ("undecodable", "reject_no_requeue"), 2: ("empty", "report_and_drop"),
                    3: ("empty", "drop"), 4: ("empty_tuple", "drop"), 5: ("undecodable", "report_and_drop")}
    assert len(good) + len(dead) == raw.count()


def test_arrow_decoder_contains_failures(spark):
    bodies = [b"1704067200000\r\nabc", b"12\r\n\xff\x00\r\nx", b"no time\r\nx", b"\xff\r\nx", b"", None, b"nothing", b"7\r\n"] * 40
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, value binary").withColumn("decoded", F.lit(1)).drop("decoded").repartition(3)
    d = decode.decode_arrow(df, decode.BINARY_PAYLOAD, decode.timestamp_body_decoder)
    want = [((1704067200000, b"abc"), None), ((12, b"\xff\x00\r\nx"), None), (None, "undecodable"), (None, "undecodable"),
            (None, "empty"), (None, "empty"), (None, "undecodable"), ((7, b""), None)]
    for r in d.collect():
        assert ((r.decoded.sent_ms, bytes(r.decoded.body)) if r.decoded else None, r.dead_reason) == want[r.id % 8]
    assert decode.decode_arrow(df.where("false"), decode.BINARY_PAYLOAD, decode.timestamp_body_decoder).count() == 0


def test_observe_counts_and_payload_decoder(spark):
    raw = spark.createDataFrame(
        [("q", 0, i, v) for i, v in enumerate([b"1704067200000\r\n" + b"0" * 1000, b"12\r\n", b"nope", b"", None])],
        "origin string, partition int, offset long, value binary")
    d = decode.decode(make_envelope(raw), decode.TIMESTAMP_PAYLOAD, decoder=decode.timestamp_payload_decoder())
    d, obs = decode.observe_counts(d)
    rows = {r.offset: (r.decoded.sent_ms if r.decoded else None, r.dead_reason) for r in d.collect()}
    assert rows[0] == (1704067200000, None) and rows[1] == (12, None)
    assert rows[2][1] == "undecodable" and rows[3][1] == "empty" and rows[4][1] == "empty"
    assert obs.get == {"messages": 5, "dead": 3, "good": 2}
    assert decode.good(d).where("offset = 0").first().filler_len == 1000


def test_commit_trigger():
    from sluice.streaming.pipelines import commit_trigger
    assert commit_trigger() == {"processingTime": "2 seconds"}


def test_pending_prune_unbounded_equals_fold(spark):
    rnd = random.Random(7)
    n = 300
    rows = []
    for part in range(3):
        offs = list(range(n))
        rnd.shuffle(offs)
        log = offs[:200] + [rnd.randint(0, n - 1) for _ in range(30)] + [n + 3]
        seqs = [rnd.randint(0, 150) for _ in log]           # ties in ack_seq on purpose
        rows += [(part, o, s) for o, s in zip(log, seqs)]
    emitted = spark.createDataFrame([(p, o) for p in range(3) for o in range(n)], "partition int, offset long")
    ack_df = spark.createDataFrame(rows, "partition int, offset long, ack_seq long")
    key = lambda df: sorted(tuple(r) for r in df.select("partition", "ack_seq", "offset", "action",
                                                        "min_pending_before", "min_pending_after").collect())
    fold = acks.pending_prune(ack_df, emitted, 10 ** 15)
    par = acks.pending_prune(ack_df, emitted, None)
    assert key(par) == key(fold)
