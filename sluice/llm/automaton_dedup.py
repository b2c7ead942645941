"""Substring dedup by suffix automata of reference shards (operator 9).

Every run of ``length`` words that starts at two places of the corpus is removed, with all words it covers.

The reference of every document is the corpus itself, too large to send whole to every task, so reference and
documents are both routed.  A window of ``length`` words has a minimizer, the k-gram with the least hash among
its k-grams (the leftmost of equal ones).  Equal windows have equal minimizers at equal offsets; consecutive
windows with one minimizer place make a piece of at most 2 length - k words, and every window lies in just one
piece.  Minimizers that only one piece has cannot belong to a repeat.  The rest are dealt, by minimizer, to
reference shards; a shard builds the suffix automaton of its different pieces, with the number of places at
which each state's strings end, and streams the pieces through it: matching statistics, cut at ``length``
words, say for each window at how many places it starts.  Windows that start at two or more make the maximal
spans that are removed.

Hot groups: copies of a text are one text from the start, and equal pieces are one piece with a count (pieces
that occur twice need no automaton).  A minimizer with more than ``most_pieces`` different pieces, such as one
inside a line that thousands of documents share, would not fit a shard; the windows of its pieces are counted by
their 128-bit hashes instead, an exact way without a group in one task.

Texts are shuffled once, to a table bucketed by their hash (compressed); all later steps join it in place.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Words, mix64, scratch, text_slices, words_of, written

_MUL = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)


def pieces_of(hashes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer hash, first window, number of windows) of the pieces of one text's words."""
    windows = len(hashes) - length + 1
    if windows < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(len(hashes) - k + 1, np.uint64)
    for i in range(k):
        grams = grams * _MUL + hashes[i:len(grams) + i]
    grams = mix64(grams)
    found = []
    span, step = length - k + 1, 1 << 20  # k-grams in a window; windows at a time
    for lo in range(0, windows, step):
        hi = min(windows, lo + step)
        part = (grams[lo:hi + span - 1] & ~_PLACE) | np.arange(hi + span - 1 - lo, dtype=np.uint64)
        best, wide = part, 1  # sliding minimum by doubling
        while wide * 2 <= span:
            best = np.minimum(best[:-wide], best[wide:])
            wide *= 2
        rest = span - wide
        best = np.minimum(best[:len(best) - rest], best[rest:]) if rest else best
        found.append((best & _PLACE).astype(np.int64) + lo)
    at = np.concatenate(found)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return grams[at[first]], first, np.diff(np.append(first, windows))


class SuffixAutomaton:
    """Of word sequences; ``count[s]`` is the number of places at which the strings of state s end."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]

    def add(self, words: list, times: int) -> None:
        """A sequence of the reference that occurs at this many places."""
        nxt, link, length, count = self.next, self.link, self.len, self.count
        last = 0
        for c in words:
            if c in nxt[last]:
                q = nxt[last][c]
                if length[q] == length[last] + 1:
                    last = q
                else:
                    clone = self._clone(q, length[last] + 1)
                    p = last
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = clone
                    last = clone
            else:
                cur = len(nxt)
                nxt.append({}), link.append(0), length.append(length[last] + 1), count.append(0)
                p = last
                while p != -1 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                if p != -1:
                    q = nxt[p][c]
                    if length[q] == length[p] + 1:
                        link[cur] = q
                    else:
                        clone = self._clone(q, length[p] + 1)
                        while p != -1 and nxt[p].get(c) == q:
                            nxt[p][c] = clone
                            p = link[p]
                        link[q] = link[cur] = clone
                last = cur
            count[last] += times

    def _clone(self, q: int, size: int) -> int:
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(size)
        self.count.append(0)
        return len(self.next) - 1

    def finish(self) -> None:
        """Sums the places along the suffix links; after all sequences were added."""
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeats(self, words: list, length: int) -> list[bool]:
        """For each window of ``length`` words: whether the reference holds it at two places or more."""
        state, size, out = 0, 0, []
        for i, c in enumerate(words):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.len[state]
            if c in self.next[state]:
                state = self.next[state][c]
                size += 1
            while state and self.len[self.link[state]] >= length:  # keep the last ``length`` words
                state = self.link[state]
            size = min(size, length)
            if i >= length - 1:
                out.append(size == length and self.count[state] > 1)
        return out


def _mask(flags: list[bool]) -> int:
    return sum(1 << i for i, f in enumerate(flags) if f)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n words the windows with these starts cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def spans_of(gone: np.ndarray) -> list[dict]:
    """The maximal runs of removed words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
    return [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)]


def _texts(raw: pa.Array, most: int = 4 << 20) -> Iterator[tuple[list[bytes], Words]]:
    """The texts, unpacked some megabytes at a time, and their words."""
    press, held, size = zstandard.ZstdDecompressor(), [], 0
    for z in raw:
        held.append(press.decompress(z.as_buffer()))
        size += len(held[-1])
        if size >= most:
            yield held, words_of(pa.array(held, pa.large_binary()))
            held, size = [], 0
    if held:
        yield held, words_of(pa.array(held, pa.large_binary()))


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 35, k: int = 8, most_pieces: int = 256,
                    shard_words: int = 30_000, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` as (doc_id, n_words, spans, n_removed, kept): ``spans`` are the maximal runs of words
    removed (array of start and end, end exclusive), ``kept`` the words left, joined by one space, or with
    ``digest`` the hex SHA-256 of that.

    Windows are judged on the input.  Null and empty texts have no words.  Repeated rows are repeats of each other.
    Rows with null ids are rows like any other.  Other columns are ignored; an empty table gives no rows.
    """
    if not 1 <= k <= length or length - k + 1 > 62:
        raise ValueError("k must be at most length, and a window may have at most 62 k-grams")
    spark = docs.sparkSession
    hashed = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashed = hashed.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in text_slices(batches, "text"):
            made = [press.compress(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), pa.array(made, pa.binary())], names=["h1", "h2", "z"])

    # one row a different text, bucketed by hash; copies meet in the map tasks first
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = hashed.select("h1", "h2", "text").mapInArrow(packed, "h1 long, h2 long, z binary")
    unique = unique.groupBy("h1", "h2").agg(F.first("z").alias("z"), F.count("*").alias("copies"))
    path = scratch(spark, "texts")
    name = "texts_" + path.rpartition("-")[2]
    unique.write.bucketBy(n, "h1", "h2").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    texts = spark.table(name)

    def minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pieces_of(w.hashes[lo:hi], length, k)[0].view(np.int64) for _, w in _texts(batch.column("z")) for lo, hi in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), pa.array(made, pa.list_(pa.int64()))], names=["h1", "h2", "ms"])

    seen = written(texts.select("h1", "h2", "z").mapInArrow(minimizers, "h1 long, h2 long, ms array<long>"), "minimizers").select("h1", "h2", F.explode("ms").alias("m"))
    twice = written(seen.groupBy("m").count().where("count > 1").select("m"), "repeated")
    routed = seen.join(twice, "m").groupBy("h1", "h2").agg(F.collect_set("m").alias("ms"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task sends the words of a piece once
        for batch in batches:
            keys = zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), batch.column("copies").to_pylist(), batch.column("ms"), strict=True)
            for texts, w in _texts(batch.column("z")):
                rows: dict[str, list] = {c: [] for c in _PIECE.names}
                for text, lo, hi, (h1, h2, copies, ms) in zip(texts, w.ptr[:-1], w.ptr[1:], keys):
                    m, start, count = pieces_of(w.hashes[lo:hi], length, k)
                    m, words = m.view(np.int64), text.split()  # bytes split at the same characters
                    for i in np.flatnonzero(np.isin(m, ms.values.to_numpy())).tolist():
                        s, c = int(start[i]), int(count[i])
                        piece = b" ".join(words[s:s + c + length - 1])
                        ph = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
                        for col, x in zip(rows.values(), (h1, h2, copies, int(m[i]), s, c, ph, None if ph in seen else piece), strict=True):
                            col.append(x)
                        seen.add(ph)
                yield pa.RecordBatch.from_pydict(rows, schema=_PIECE)

    # a text that has copies is removed whole; here one of them stands for all
    cuts = texts.join(routed, ["h1", "h2"]).select("h1", "h2", "copies", "ms", "z").mapInArrow(cut, "h1 long, h2 long, copies long, m long, start long, n int, ph long, piece binary")
    cuts = written(cuts, "pieces")
    pieces = written(cuts.groupBy("m", "ph").agg(F.sum("copies").alias("times")), "references")
    groups = pieces.groupBy("m").agg(F.count("*").alias("pieces"), F.count_if(F.col("times") == 1).alias("single"))
    groups = written(groups.where("pieces > 1 and single > 0"), "groups")
    wanted = written(pieces.join(groups.select("m", (F.col("pieces") > most_pieces).alias("hot")), "m"), "wanted")
    open_ = cuts.where("piece is not null").select("m", "ph", "piece").join(wanted, ["m", "ph"]).groupBy("m", "ph", "times", "hot").agg(F.first("piece").alias("piece"))
    open_ = written(open_, "open")

    # reference shards
    total = groups.where(F.col("pieces") <= most_pieces).agg(F.sum("pieces")).first()[0] or 0
    shards = max(1, int(total * 2 * length // shard_words))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        automaton = SuffixAutomaton()
        own = [p.split(b" ") for p in pdf["piece"]]
        for words, times in zip(own, pdf["times"].tolist(), strict=True):
            automaton.add(words, times)
        automaton.finish()
        single = pdf["times"].to_numpy() == 1
        masks = [_mask(automaton.repeats(w, length)) for w, s in zip(own, single, strict=True) if s]
        return pd.DataFrame({"m": pdf["m"][single], "ph": pdf["ph"][single], "mask": np.array(masks, np.int64)})

    by_shard = open_.where("not hot").withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards)))
    matched = by_shard.groupBy("shard").applyInPandas(shard, "m long, ph long, mask long")

    # the windows of hot minimizers
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("m", "ph", "times", "i", "window")}
            for m, ph, times, piece in zip(*(batch.column(c).to_pylist() for c in ("m", "ph", "times", "piece")), strict=True):
                words = piece.split(b" ")
                for i in range(len(words) - length + 1):
                    for col, x in zip(out.values(), (m, ph, times, i, hashlib.blake2b(b" ".join(words[i:i + length]), digest_size=16).digest()), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("m", pa.int64()), ("ph", pa.int64()), ("times", pa.int64()), ("i", pa.int32()), ("window", pa.binary())]))

    spread = open_.where("hot").select("m", "ph", "times", "piece").mapInArrow(windows, "m long, ph long, times long, i int, window binary")
    spread = written(spread, "windows")
    again = written(spread.groupBy("window").agg(F.sum("times").alias("places")).where("places > 1").select("window"), "again")
    hot = spread.join(again, "window").groupBy("m", "ph").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))

    often = pieces.where("times > 1").select("m", "ph", F.lit(-1).cast("long").alias("mask"))
    masks = matched.unionByName(hot).unionByName(often).where("mask <> 0").groupBy("m", "ph").agg(F.bit_or("mask").alias("mask"))
    masks = written(masks, "masks")
    marks = cuts.select("h1", "h2", "m", "ph", "start", "n").join(masks, ["m", "ph"]).groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "n", "mask")).alias("marks"))
    judged = texts.join(marks, ["h1", "h2"], "left").select("h1", "h2", "z", "copies", "marks")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_words", "spans", "n_removed", "kept")}
            for copies, marks, z in zip(batch.column("copies").to_pylist(), batch.column("marks").to_pylist(), batch.column("z"), strict=True):
                words = zstandard.decompress(z.as_buffer()).split()
                size = len(words)
                if size < length:
                    gone = np.zeros(size, bool)
                elif copies > 1:
                    gone = np.ones(size, bool)
                else:
                    starts = [x["start"] + i for x in marks or () for i in range(x["n"]) if x["mask"] >> i & 1]
                    gone = covered(size, np.array(starts, np.int64), length)
                kept = b" ".join(itertools.compress(words, (~gone).tolist()))
                for col, x in zip(out.values(), (size, spans_of(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode()), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), *(pa.array(v, t) for v, t in zip(out.values(), _RESULT, strict=True))],
                                             names=["h1", "h2", *out])

    result = judged.mapInArrow(remove, "h1 long, h2 long, n_words long, spans array<struct<start:long,end:long>>, n_removed long, kept string")
    result = written(result, "kept")
    return hashed.select("doc_id", "h1", "h2").join(result, ["h1", "h2"]).select("doc_id", "n_words", "spans", "n_removed", "kept")


_PIECE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("copies", pa.int64()), ("m", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("ph", pa.int64()), ("piece", pa.binary())])
_RESULT = (pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.string())
