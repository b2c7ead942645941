"""Conversation prefix trie by whole-sequence collapse (operator 12).

1. Turns are numbered within their conversation, and every prefix of a conversation gets a 128-bit key: the
   exclusive or of the hashes of (place, role, text) of its turns.  A running exclusive or is associative, so a
   conversation of any length is scanned in blocks; no conversation is a task of its own.
2. Conversations that are equal as a whole collapse into one weighted sequence, whose representative is the
   smallest id; the list of those that end there is hashed from sorted chunks.
3. A sequence that is a proper prefix of another goes by anti-join against the prefixes; what is left are the leaves.
4. The prefixes of the weighted sequences are summed by key into nodes: members, least member, leaves.
5. What a subtree saves is summed along the leaves only.  Each node belongs to the least leaf below it, so a leaf owns
   a suffix of its path.  A leaf gives to each node of its path the sum of what it owns from there on; as every node of
   a subtree is owned by one leaf of that subtree, the sum over the leaves is the subtree's, and no row meets all its
   ancestors.

All joins but one are on keys that are unique on a side and read from written tables; the one to the parent is hot
where a node has many children, which AQE splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import written

KEY = ["depth", "k1", "k2"]
#: Turns of a conversation in one block of a scan.
BLOCK = 4096
_NO_END = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, no, h1, h2, chars) of every turn: its place from 1, the hashes of role and text, the text's code points.

    Turns are in the order of ``turn``, null first, those of one turn by role and text; null role or text is empty.
    Rows without a conversation id take no part.  Repeated rows are turns of their own."""
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
    order = ["conv_id", "turn", "role", "text", "place"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
                       F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role").alias("h2"), F.char_length("text").cast("long").alias("chars"))
    rows = written(rows, "turns")  # a part is a block of about equally many rows, in order
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    sums = sums.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("place"))
    return rows.withColumn("nth", nth).join(sums, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("nth")).alias("no"), "h1", "h2", "chars")


def rebuilt(numbered: DataFrame, shared: Column, base: Column, most_shared: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: (conversations, steps).

    ``shared`` and ``base`` are functions of ``conv_id``: a conversation begins with the first ``shared`` turns of
    conversation ``base`` (all if that has fewer, none if it does not exist), at most ``most_shared``, and goes on with
    its own turns after its first ``shared``.  ``numbered`` is as ``numbered_turns`` gives it, read more than once.
    Conversations are (conv_id, size), steps (conv_id, size, depth, h1, h2, chars)."""
    convs = numbered.groupBy("conv_id").agg(F.max("no").alias("n"))
    convs = written(convs.withColumns({"h": shared.cast("long"), "base": base}), "conversations")
    of = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(of, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = written(convs.select("conv_id", "h", "base", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "rebuilt")
    heads = numbered.where(F.col("no") <= most_shared).withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "size", "depth", "h1", "h2", "chars"]
    first = convs.join(heads, "base").where("no <= taken").withColumn("depth", F.col("no")).select(*columns)
    own = numbered.join(convs, "conv_id").where("no > h").withColumn("depth", F.expr("no - h + taken")).select(*columns)
    return convs.select("conv_id", "size"), first.unionByName(own)


def _running(rows: DataFrame, key: str, values: dict[str, Column], kind, none: Column, down: bool = False) -> DataFrame:
    """``rows`` with the running aggregate of each value along ``depth`` within ``key``, in blocks of ``BLOCK``.
    ``kind`` is an aggregate that also combines its own results; the result of two parts is ``none`` for no rows."""
    rows = written(rows, "scan").withColumn("blk", F.floor(F.col("depth") / BLOCK))
    sums = rows.groupBy(key, "blk").agg(*[kind(v).alias(f"s_{c}") for c, v in values.items()])
    order = F.desc if down else F.asc
    earlier = Window.partitionBy(key).orderBy(order("blk")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "blk", *[F.coalesce(kind(f"s_{c}").over(earlier), none).alias(f"s_{c}") for c in values])
    upto = Window.partitionBy(key, "blk").orderBy(order("depth")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({f"r_{c}": kind(v).over(upto) for c, v in values.items()}).join(sums, [key, "blk"])
    join = (lambda a, b: a.bitwiseXOR(b)) if kind is F.bit_xor else (lambda a, b: a + b)
    return out.withColumns({c: join(F.col(f"r_{c}"), F.col(f"s_{c}")) for c in values}).drop("blk", *[f"{p}_{c}" for p in "rs" for c in values])


def prefix_trie(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations: one for each different sequence of first turns.

    ``convs`` has (conv_id, size) and ``steps`` (conv_id, size, depth, h1, h2, chars) with depths 1 to size, as
    ``rebuilt`` gives them.  Returns conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 and the hashes (h1, h2) of the node's last turn, by which
    ``node_turns`` finds its role and text.  Conversations without turns are members of the root.  No conversations
    give no nodes, not even a root."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    place = {f"k{i}": F.xxhash64(F.lit(i), "depth", "h1", "h2") for i in (1, 2)}
    paths = written(_running(steps, "conv_id", place, F.bit_xor, zero), "paths")

    # equal conversations become one weighted sequence
    ends = paths.where("depth = size").select("conv_id", *KEY).unionByName(
        convs.where("size = 0").select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2")))
    ends = written(ends, "ends")
    seqs = written(ends.groupBy(*KEY).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight")), "sequences")

    # leaves: sequences that are no proper prefix of another
    root = convs.where("size > 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"))
    proper = paths.where("depth < size").select(*KEY).unionByName(root).distinct()
    leaves = seqs.join(proper, KEY, "left_anti").select("rep", F.col("rep").alias("leaf"))
    reps = written(seqs.join(leaves, "rep", "left").select(F.col("rep").alias("conv_id"), "weight", "leaf"), "representatives")

    # the prefixes of each sequence, the root among them, and their sums
    columns = ["conv_id", "weight", "leaf", *KEY, "h1", "h2", "chars"]
    tops = reps.withColumns({"depth": zero, "k1": zero, "k2": zero, "h1": none, "h2": none, "chars": zero})
    rows = written(paths.join(reps, "conv_id").select(*columns).unionByName(tops.select(*columns)), "prefixes")
    nodes = rows.groupBy(*KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count("leaf").alias("n_leaves"), F.min("leaf").alias("owner"),
        *[F.max(c).alias(c) for c in ("h1", "h2", "chars")])
    nodes = nodes.withColumns({f"q{i}": F.col(k).bitwiseXOR(v) for i, (k, v) in enumerate(place.items(), 1)})  # the parent's key
    nodes = written(nodes, "nodes")

    owned = nodes.select(F.col("owner").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("cost"))
    along = rows.where("leaf is not null").select("conv_id", *KEY).join(owned, ["conv_id", "depth"], "left")
    along = _running(along, "conv_id", {"below": F.coalesce("cost", zero)}, F.sum, zero, down=True)
    saved = along.groupBy(*KEY).agg(F.sum("below").alias("saved_tokens"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").join(parents, ["depth", "q1", "q2"])
    columns = [*KEY, "conv_id", "n_convs", "n_leaves", "h1", "h2", "parent_conv_id"]
    out = below.select(*columns).unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", none).select(*columns))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    out = out.join(children, KEY, "left").join(saved, KEY).join(_end_hashes(ends), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(_NO_END)).alias("ends_sha256"), "h1", "h2")


def node_turns(nodes: DataFrame, turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``nodes`` with the role and text of their last turn, found by its hashes; null for the root."""
    told = turns.select(F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    told = told.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role")}).dropDuplicates(["h1", "h2"])
    return nodes.drop("role", "text").join(told, ["h1", "h2"], "left")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of the comma-joined ids of each sequence in ascending order.

    Ids are range-sorted by (sequence, id), so one that a third of all conversations share lies in many tasks; each
    joins its ids into chunks of about a megabyte, and a sequence's chunks are hashed in order as a stream."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*KEY, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_chunks, "depth long, k1 long, k2 long, first long, ids string")
    chunks = chunks.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
    return chunks.mapInArrow(_hashes, "depth long, k1 long, k2 long, ends_sha256 string")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], int, int]]:
    """(key, start, end) of the runs of equal keys in a batch."""
    keys = np.stack([np.asarray(batch.column(c)) for c in KEY])
    at = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
    for a, b in zip([0, *at.tolist()], [*at.tolist(), batch.num_rows], strict=True):
        yield tuple(keys[:, a].tolist()), a, b


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_CHUNK = pa.schema([*[(c, pa.int64()) for c in KEY], ("first", pa.int64()), ("ids", pa.string())])
_HASH = pa.schema([*[(c, pa.int64()) for c in KEY], ("ends_sha256", pa.string())])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk for each run of a batch: a batch has some ten thousand ids."""
    for batch in batches:
        if batch.num_rows:
            ids = batch.column("conv_id").to_pylist()
            yield _batch([(*key, ids[a], ",".join(map(str, ids[a:b]))) for key, a, b in _runs(batch)], _CHUNK)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, state = None, None
    for batch in batches:
        done = []
        texts = batch.column("ids").to_pylist()
        for key, a, b in _runs(batch) if batch.num_rows else ():
            for t in texts[a:b]:
                if key != last:
                    if state is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = key, hashlib.sha256(t.encode())
                else:
                    state.update(b"," + t.encode())
        yield _batch(done, _HASH)
    if state is not None:
        yield _batch([(*last, state.hexdigest())], _HASH)
