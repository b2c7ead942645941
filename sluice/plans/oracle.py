"""DuckDB twins of the fixtures (same formulas as ``sluice.sources.fixtures``).

Used only to check results: each query's oracle SQL is ``WITH <fixtures>
SELECT ...`` over the driver's pre-registered table views.
"""

from __future__ import annotations

FIXTURE_SQL: dict[str, str] = {
    "messages": """
  SELECT event_id,
         event_type AS origin,
         (['kafka','amqp','jms','mqtt','kestrel'])[CAST(event_id % 5 AS INTEGER) + 1] AS protocol,
         CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'raw' END AS stream,
         CAST(user_id AS VARCHAR) AS key_text,
         CASE WHEN event_id % 13 = 0 THEN 'not json'
              WHEN event_id % 17 = 0 THEN '' ELSE props END AS value_text,
         epoch_us(ts) // 1000 AS sent_ms,
         CAST(event_id % 4 AS INTEGER) AS "partition",
         event_id // 4 AS "offset",
         event_type || ':' || CAST(event_id % 4 AS VARCHAR) || ':' || CAST(event_id // 4 AS VARCHAR) AS message_id,
         ts, value AS num_value, user_id
  FROM events""",
    "destinations": """
  SELECT 'd' || CAST(n_nationkey AS VARCHAR) AS name,
         r_name AS site, n_name AS sensor,
         CASE WHEN n_nationkey % 11 = 5 THEN NULL ELSE CAST(n_nationkey AS VARCHAR) END AS sensor_id,
         n_nationkey % 2 = 0 AS grouped,
         'readings' AS p_topic,
         CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE 'q' END AS p_queue_name,
         'jq' AS p_queue,
         'rk' || CAST(n_nationkey % 3 AS VARCHAR) AS p_routing_key,
         'ex' || CAST(n_regionkey AS VARCHAR) AS p_exchange
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "paths": """
  SELECT 'p' || CAST(i AS VARCHAR) AS path, 'd' || CAST(i AS VARCHAR) AS destination
  FROM range(28) t(i)""",
    "registry_changes": """
  SELECT event_id AS seq,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'add_destination'
              WHEN event_type = 'error' THEN 'remove_destination'
              WHEN event_type = 'view' THEN 'add_path'
              WHEN event_type = 'click' THEN 'remove_path' END AS op,
         'd' || CAST(user_id % 25 AS VARCHAR) AS name,
         'p' || CAST(user_id % 30 AS VARCHAR) AS path
  FROM events""",
    "positions": """
  SELECT p_partkey AS partition_id,
         CAST(p_size AS BIGINT) AS earliest,
         CAST(p_size AS BIGINT) * 100 AS "current",
         CASE WHEN p_partkey % 5 = 0 THEN NULL
              WHEN p_partkey % 7 = 0 THEN 0
              WHEN p_partkey % 11 = 0 THEN CAST(p_size AS BIGINT) * 100 + 10
              ELSE p_partkey % 4000 END AS saved,
         CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS saved_topology
  FROM part""",
    "acked_events": """
  SELECT event_id,
         (event_id % 4 = 3 OR event_id < 500 + 100 * (event_id % 4) OR event_id % 3 <> 0) AS acked
  FROM events""",
    "emitted": """
  SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset" FROM events""",
    "ack_log": """
  SELECT CAST(ack_id % 4 AS INTEGER) AS "partition", ack_id // 4 AS "offset", ack_seq FROM (
    SELECT event_id AS ack_id, event_id - event_id % 8 + 7 - event_id % 8 AS ack_seq
    FROM acked_events WHERE acked
    UNION ALL
    SELECT event_id + 1000000, event_id - event_id % 8 + 7 - event_id % 8
    FROM events WHERE event_id % 100 = 0)""",
    "lagging_ack_log": """
  SELECT CAST(event_id % 4 AS INTEGER) AS "partition", "offset", ack_seq FROM (
    SELECT event_id, event_id // 4 AS "offset", event_id + event_id * 13 % 97 AS ack_seq FROM events WHERE event_id % 37 <> 5
    UNION ALL SELECT event_id, event_id // 4, event_id + 200 FROM events WHERE event_id % 53 = 7
    UNION ALL SELECT event_id, event_id // 4 + 60, event_id FROM events WHERE event_id % 211 = 3)""",
    "fail_log": """
  SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset", event_id AS fail_seq
  FROM acked_events WHERE NOT acked AND event_id % 21 = 0""",
    "replay_fails": """
  SELECT DISTINCT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset", CAST(step AS INTEGER) AS step FROM (
    SELECT event_id, (event_id // 250) % 3 AS step FROM acked_events WHERE NOT acked AND event_id % 21 = 0
    UNION ALL SELECT event_id, (event_id // 250) % 3 + 1 FROM acked_events WHERE NOT acked AND event_id % 42 = 0 AND (event_id // 250) % 3 < 2)""",
    "latencies": """
  SELECT CAST(user_id % 2 AS INTEGER) AS task, event_id AS seq, event_id * 10 AS arrival_ms,
         CASE WHEN event_id % 97 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(floor(value) AS BIGINT) END AS val
  FROM events""",
    "queue_items": """
  SELECT o_orderpriority AS queue, o_orderkey AS seq,
         o_orderstatus || ':' || CAST(o_custkey AS VARCHAR) AS value,
         o_orderdate AS put_at,
         CASE WHEN o_custkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(86400000 AS BIGINT) * 400 END AS expiration_ms,
         CASE o_orderstatus WHEN 'O' THEN 'waiting' WHEN 'P' THEN 'open' ELSE 'confirmed' END AS state,
         o_orderdate + INTERVAL 1 DAY AS opened_at,
         CASE WHEN o_custkey % 4 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(86400000 AS BIGINT) * 30 END AS auto_abort_ms,
         o_totalprice AS price
  FROM orders""",
    "queue_state": """
  SELECT * FROM queue_items WHERE put_at <= TIMESTAMP '1998-01-01 00:00:00'""",
    "next_put": """
  SELECT queue, seq, value, expiration_ms FROM queue_items
  WHERE put_at > TIMESTAMP '1998-01-01 00:00:00'""",
    "queue_limits": """
  SELECT queue,
         CAST(250 + 15 * CAST(substr(queue, 1, 1) AS INTEGER) AS BIGINT) AS capacity,
         (['NOT_CONFIGURED','QUIESCENT','READ_ONLY','UP'])[CAST(substr(queue, 1, 1) AS INTEGER) % 4 + 1] AS status
  FROM (SELECT DISTINCT o_orderpriority AS queue FROM orders)""",
}

# Fixtures that other fixtures read (emitted in this order).
_DEPENDS = {
    "ack_log": ["acked_events"],
    "fail_log": ["acked_events"],
    "replay_fails": ["acked_events"],
    "queue_state": ["queue_items"],
    "next_put": ["queue_items"],
}

OBSERVED_MS = "epoch_ms(TIMESTAMP '1998-01-01 00:00:00')"


def fixtures_prefix(names: list[str]) -> str:
    """``WITH`` and the named fixtures (and what they depend on) as CTEs;
    further CTEs can follow after a comma, then the final SELECT."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in order)
    return f"WITH {ctes}"


def with_fixtures(names: list[str], body: str) -> str:
    """``WITH`` the named fixtures, then ``body`` (a SELECT, or more CTEs
    starting with a comma and then a SELECT)."""
    return f"{fixtures_prefix(names)}\n{body.strip()}"
