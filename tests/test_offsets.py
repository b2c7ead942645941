"""D1 start offsets, D2 fetch slice, D3 reset, A3-A5 commit accounting, T4."""


from sluice.operators import offsets

POS = "partition_id long, earliest long, current long, saved long, saved_topology string"


def plan(spark, rows, **kw):
    df = spark.createDataFrame(rows, POS)
    return {r.partition_id: (r.branch, r.reset, r.start_offset)
            for r in offsets.start_offset_plan(df, "A", **kw).collect()}


def test_start_offset_branches(spark):
    rows = [
        (1, 5, 5000, None, None),      # no saved
        (2, 5, 5000, 0, "A"),          # saved 0 -> counts as none (reset)
        (3, 5, 5000, -5, "A"),         # saved -5 -> reset
        (4, 5, 5000, 4500, "B"),       # other topology, no force -> saved
        (5, 5, 5000, 4000, "A"),       # behind by exactly max -> kept
        (6, 5, 5000, 3999, "A"),       # behind by max + 1 -> reset
        (7, 5, 5000, 6000, "A"),       # saved past current -> kept (negative lag)
    ]
    got = plan(spark, rows, max_offset_behind=1000)
    assert got[1] == ("none_saved", False, 5000)
    assert got[2] == ("saved", True, 5000)
    assert got[3] == ("saved", True, 5000)
    assert got[4] == ("saved", False, 4500)
    assert got[5] == ("saved", False, 4000)
    assert got[6] == ("saved", True, 5000)
    assert got[7] == ("saved", False, 6000)


def test_start_offset_forced_and_zero_valid(spark):
    rows = [(4, 5, 5000, 4500, "B"), (8, 5, 5000, 4500, "A"), (9, 0, 5000, 0, "A")]
    got = plan(spark, rows, force_from_start=True, max_offset_behind=1000)
    assert got[4] == ("topology_changed", False, 5)   # from the start offset
    assert got[8] == ("saved", False, 4500)           # same topology keeps its offset
    zero = plan(spark, [(9, 0, 5000, 0, "A")], zero_is_valid=True)
    assert zero[9] == ("saved", False, 0)


def test_fetch_slice_edges(spark):
    msgs = spark.createDataFrame(
        [(0, 10, b"x" * 50), (0, 11, b"y"),                      # first row larger than limit
         (1, 3, b"aa"), (1, 7, b"bbb"), (1, 9, b"ccccc"), (1, 12, b"d")],  # gaps; 2+3+5 = 10 = limit
        "partition int, offset long, value binary")
    starts = spark.createDataFrame([(0, 10), (1, 0)], "partition int, start_offset long")
    got = sorted((r.partition, r.offset) for r in offsets.fetch_slice(msgs, starts, 10, block_size=2).collect())
    assert got == [(0, 10), (1, 3), (1, 7), (1, 9)]


def test_range_reset(spark):
    req = spark.createDataFrame([(1, 4, 5, 50), (2, 51, 5, 50), (3, 50, 5, 50)],
                                "partition_id long, requested long, earliest long, latest long")
    got = {r.partition_id: (r.fetch_status, r.fetch_offset) for r in offsets.range_reset(req).collect()}
    assert got == {1: ("reset", 5), 2: ("reset", 5), 3: ("ok", 50)}
    off = {r.partition_id: r.fetch_status for r in offsets.range_reset(req, False).collect()}
    assert off[1] == "error"


def test_commit_point_and_admission(spark):
    emitted = spark.createDataFrame([(0, o) for o in range(10)] + [(1, o) for o in range(5)],
                                    "partition int, offset long")
    acks = spark.createDataFrame([(0, o, o) for o in (0, 1, 2, 4, 4, 99)] + [(1, o, o) for o in range(5)],
                                 "partition int, offset long, ack_seq long")
    cp = {r.partition: r.commit_offset for r in offsets.commit_point(emitted, acks).collect()}
    assert cp == {0: 3, 1: 5}
    fails = spark.createDataFrame([(0, 7, 1), (0, 6, 2), (0, 5, 3)], "partition int, offset long, fail_seq long")
    adm = {r.offset: r.admitted for r in offsets.fail_admission(fails, emitted, 4).collect()}
    assert adm == {7: True, 6: True, 5: False}   # next = 10; bound 10 - 4 = 6 kept exactly
    cnt = {r.partition: (r.acked, r.failed, r.error) for r in offsets.ack_counters(emitted, acks, fails, 4).collect()}
    assert cnt[0] == (4, 2, False)


def test_commit_changes_and_replay(spark):
    pts = spark.createDataFrame([(0, 3), (1, 5), (2, 8)], "partition int, commit_offset long")
    saved = spark.createDataFrame([(0, 3), (1, 4)], "partition int, saved_offset long")
    ch = sorted(r.partition for r in offsets.commit_changes(pts, saved).collect())
    assert ch == [1, 2]
    msgs = spark.createDataFrame([(0, o, f"m{o}") for o in range(6)], "partition int, offset long, message_id string")
    fails = spark.createDataFrame([(0, 4, 1), (0, 2, 2), (0, 2, 3)], "partition int, offset long, fail_seq long")
    rp = sorted((r.offset, r.replay_from) for r in offsets.replay_failed(msgs, fails).collect())
    assert rp == [(2, 2), (4, 2)]


def test_starting_offsets_option(spark):
    p = spark.createDataFrame([(0, 5), (1, 7)], "partition_id long, start_offset long")
    assert offsets.starting_offsets_option(p, "t") == '{"t":{"0":5,"1":7}}'
