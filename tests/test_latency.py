"""A1 running latency: edge rows and a brute-force fold of the reference loop."""

import random

from sluice.operators.latency import running_latency


def fold(rows, warmup=5000):
    """The reference loop, per task, rows in seq order."""
    out = []
    by_task = {}
    for task, seq, arrival, val in sorted(rows, key=lambda r: (r[0], r[1])):
        by_task.setdefault(task, []).append((seq, arrival, val))
    for task, rs in by_task.items():
        first = rs[0][1]
        mean, count = 0.0, 0
        for seq, arrival, val in rs:
            if arrival - first > warmup:
                count += 1
                if val < 0:
                    mean, count = 0.0, 0
                else:
                    mean += (val - mean) / count
                    out.append((task, seq, round(mean, 6)))
    return sorted(out)


def run(spark, rows, block=3):
    df = spark.createDataFrame(rows, "task int, seq long, arrival_ms long, val long")
    got = running_latency(df, block_size=block).collect()
    return sorted((r.task, r.seq, round(r.mean_latency, 6)) for r in got)


def test_edge_rows(spark):
    rows = [
        (0, 0, 1000, 7),        # first row: starts the warm-up
        (0, 1, 3000, -1),       # negative inside warm-up: ignored
        (0, 2, 6000, 9),        # exactly 5000 after: excluded
        (0, 3, 6001, -1),       # first counted row is negative: reset, no emit
        (0, 4, 6002, 10),
        (0, 5, 6003, 20),
        (0, 6, 6004, -3),       # two negatives in a row
        (0, 7, 6005, -4),
        (0, 8, 6006, 4),
        (1, 0, 0, 5),           # one row only: inside warm-up, nothing
    ]
    want = fold(rows)
    assert want == [(0, 4, 10.0), (0, 5, 15.0), (0, 8, 4.0)]
    assert run(spark, rows) == want


def test_random_against_fold(spark):
    rnd = random.Random(5)
    rows = []
    for task in range(3):
        t = rnd.randint(0, 100)
        for seq in range(150):
            t += rnd.randint(1, 100)
            rows.append((task, seq * 3 + task, t, -1 if rnd.random() < 0.05 else rnd.randint(0, 500)))
    assert run(spark, rows, block=8) == fold(rows)
