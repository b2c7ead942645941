"""N-gram Jaccard self-join by universe partition and pigeonhole (operator 7).

A document is the set of its word n-grams (64-bit hashes).  Two sets with Jaccard similarity of at least p %
differ in at most H elements, a bound given by their size band.  Elements are hashed into m segments; segment j
tolerates T_j differences, 0 (the subsets of both sets are equal) or 1 (they are equal after one deletion at
most).  If the T_j + 1 sum to more than H, a similar pair agrees in some segment within its T_j: pigeonhole.
Sets index each segment's subset, and for T = 1 its one-deletion neighbourhood; sets that share a signature are
candidates.

Cost-based allocation: for each size band, ``scheme`` picks m and the number of segments with T = 1 by the
signatures written and the expected number of weak ones (subsets so small that unrelated sets share them).
It leaves slack, so that a set need not index its poorest segments: one with no element, or just one, says
little and would gather unrelated sets in one bucket.  A set whose poor segments exceed the slack indexes all.

Copies (equal sets) are one set from the start.  The slack makes similar pairs agree in several segments, so a
set that shares fewer signatures than that is similar to none and is left out first; for this a bucket has one
entry a map task at most, however hot it is.  The buckets of the rest give the candidate graph.  One of few
members gives its pairs, which are counted; a larger, hot one is never expanded into pairs.  Of a similar pair
that meets in a small bucket, the signatures of small buckets that it shares and the hot ones that it can share
are as many as both sets need, or it is no candidate.  Any other similar pair shares hot signatures alone: sets
with fewer of them than they need have no such pair, and the others leave out their need - 1 hottest and are tied
to the least member of each bucket left, for of what a pair shares its rarest is left to both.  So a passage that
many texts have does not join them.  All similar pairs lie inside a component of pairs and ties.  Each component
is verified exactly: small ones packed together, large ones dealt into blocks by size, every pair of blocks whose
sizes allow a link in a task of its own; blocks grow with the root of the component, up to a bound.  A task
returns a spanning forest of its links and the number of links of each set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import mix64, text_slices, words_of, written
from sluice.llm.components import components

#: Least growth of size bands; a band's bound H is that of its largest size.
BAND = 1.3
#: Cost of a signature of one and of two elements, in signatures written.
WEAK = (2.0, 1.0)
_MUL = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=None)
def band_top(band: int, p: int) -> int:
    """Largest size of a band; a set similar to one of a band is in that band or the next."""
    if band < 0:
        return 8
    below = band_top(band - 1, p)
    return max(below + 1, below * 100 // p, int(below * BAND))


@lru_cache(maxsize=1 << 16)
def band_of(size: int, p: int) -> int:
    b = 0
    while band_top(b, p) < size:
        b += 1
    return b


def most_differences(a: int, p: int) -> int:
    """The most elements in which a set of at most a elements and a similar one that is no smaller differ."""
    return (a + a * 100 // p) * (100 - p) // (100 + p)


def _poisson(lam: float, k: int) -> float:
    return math.exp(-lam + k * math.log(lam) - math.lgamma(k + 1))


@lru_cache(maxsize=None)
def scheme(band: int, p: int) -> tuple[int, int, int, int]:
    """(segments, how many of them, the first ones, tolerate a difference, slack, least) of a size band; a set
    leaves out subsets of fewer than ``least`` elements if the slack allows it."""
    size, need, best = band_top(band, p), most_differences(band_top(band, p), p) + 1, None
    middle = (size * max(band_top(band - 1, p), 1)) ** 0.5
    for least in (1, 2):
        for tenth in range(0, 11, 2):
            for m in range(1, need + need // 2 + 8):
                ones = round(m * tenth / 10)
                slack = m + ones - need
                if slack < 0:
                    continue
                lam = middle / m
                few = [_poisson(lam, k) for k in range(3)]
                poor = (m - ones) * sum(few[:least]) + 2 * ones * sum(few[:least + 1])
                if slack < poor + 3 * math.sqrt(poor):
                    continue
                cost = (m - ones) + ones * (lam + 1) + m * sum(w * f for w, f in zip(WEAK[least - 1:], few[least:], strict=True))
                if best is None or cost < best[0]:
                    best = (cost, m, ones, slack, least)
                break
    return best[1:] if best else (need, 0, 0, 1)


def ngram_sets(hashes: np.ndarray, ptr: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-grams of each text; all words as one if there are fewer than n."""
    out = []
    for lo, hi in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
        w = hashes[lo:hi]
        k = min(n, len(w))
        if not k:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.full(len(w) - k + 1, np.uint64(k))
        for i in range(k):
            h = mix64(h * _MUL + w[i:len(w) - k + 1 + i])
        out.append(np.unique(h))
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a, b = mix64(s ^ np.uint64(0xA5A5A5A5)), mix64(s + np.uint64(0x5DEECE66D))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int((np.bitwise_xor.reduce(b) if len(b) else np.uint64(0)).view(np.int64))


def signatures(s: np.ndarray, p: int) -> np.ndarray:
    """Signatures of a set under the scheme of its band and, if it can be similar to a set of the band below,
    under that band's."""
    return indexed(s, p)[0]


def indexed(s: np.ndarray, p: int) -> tuple[np.ndarray, int]:
    """The signatures, and how many of them a set must share with others to be similar to any."""
    n = len(s)
    if n * 100 < p * (n + 1):  # similar to itself only
        return np.zeros(0, np.int64), 1
    own = band_of(n, p)
    out = [_signed(s, own, p)]
    if own and band_top(own - 1, p) * 100 >= p * n:
        out.append(_signed(s, own - 1, p))
    return np.unique(np.concatenate([x for x, _ in out])), min(x for _, x in out)


def _signed(s: np.ndarray, band: int, p: int) -> tuple[np.ndarray, int]:
    m, ones, slack, least = scheme(band, p)
    seg = ((mix64(s + np.uint64(band)) >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
    part = mix64(s ^ np.uint64(0xC0FFEE))
    size = np.bincount(seg, minlength=m)
    order = np.argsort(seg, kind="stable")
    total = np.zeros(m, np.uint64)  # a subset's hash is the sum of its elements' hashes
    filled = np.flatnonzero(size)
    if len(filled):
        total[filled] = np.add.reduceat(part[order], (np.cumsum(size) - size)[filled])
    loose = np.arange(m) < ones
    # a loose segment counts on if it and all subsets one element away are indexed
    weak = size < least + loose
    lost = int((weak * (1 + loose)).sum())
    drop = lost <= slack
    # segments in which a similar pair differs too much use up T + 1 of its differences each: those in which it
    # agrees make up slack + 1 at least, less what is left out
    need = -(-(slack + 1 - lost) // (2 if ones else 1)) if drop else 1
    at = mix64(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
    exact = np.arange(m)[size >= least] if drop else np.arange(m)
    out = [mix64(total[exact] + at[exact])]
    if ones:  # one deletion each
        keep = loose[seg] & ((size[seg] > least) if drop else True)
        out.append(mix64(total[seg[keep]] - part[keep] + at[seg[keep]]))
    return np.concatenate(out).view(np.int64), max(1, need)


#: Members up to which a bucket gives its pairs; a larger one is hot.
FEW = 8


def _runs(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at which sorted signatures change, and how many are equal from there."""
    first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(sig)))


#: Signatures that a map task gathers before it sends them on.
_GATHER = 4_000_000


def _packed(kind: int, a: np.ndarray, b: np.ndarray) -> bytes:
    """A kind and two equally long columns; members repeat, so they go as places among the different ones."""
    who, place = np.unique(b, return_inverse=True)
    place = zstandard.compress(np.diff(place, prepend=0).astype(np.int32).tobytes(), 1)
    return np.array([kind, len(a), len(who)], np.int64).tobytes() + a.astype(np.int64).tobytes() + who.astype(np.int64).tobytes() + place


def _unpacked(raw: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    kind, n, m = np.frombuffer(raw, np.int64, 3).tolist()
    a, who = np.frombuffer(raw, np.int64, n, 24), np.frombuffer(raw, np.int64, m, 24 + 8 * n)
    place = np.cumsum(np.frombuffer(zstandard.decompress(raw[24 + 8 * (n + m):]), np.int32), dtype=np.int64)
    return kind, a, who[place]


def _entries(n: int, p: int, parts: int, count: bool):
    """Texts to packed index entries by part of the hash space.  With ``count`` a signature has one entry: kinds are
    0 entries, 1 numbers shared, 2 entries already shared, 3 numbers needed.  Else it has one for each member: 0
    entries, 1 entries that are hot here already, in any part, 2 an entry of each of their signatures."""
    def send(sigs: list[np.ndarray], keys: list[int], needs: list[int]) -> pa.RecordBatch:
        sig = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
        member = np.repeat(np.array(keys, np.int64), [len(s) for s in sigs])
        rows: list[tuple[int, bytes]] = []
        sig, member = _different(sig, member)
        first, size = _runs(sig)
        if count:
            several = size > 1
            who, times = np.unique(member[np.repeat(several, size)], return_counts=True)
            if len(who):
                rows.append((int(who[0] % parts), _packed(1, times, who)))
            if keys:
                rows.append((int(keys[0] % parts), _packed(3, np.array(needs, np.int64), np.array(keys, np.int64))))
            for kind, at in ((0, first[~several]), (2, first[several])):
                rows += _by_part(kind, sig[at], member[at], parts)
        else:
            hot = np.repeat(size > FEW, size)
            for kind, at in ((0, np.flatnonzero(~hot)), (1, np.flatnonzero(hot)), (2, first[size > FEW])):
                rows += _by_part(kind, sig[at], member[at], parts, spread=kind == 1)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, keys, needs, held = [], [], [], 0
        for batch in text_slices(batches, "text"):
            w = words_of(batch.column("text"), lower=True)
            for own in ngram_sets(w.hashes, w.ptr, n):
                made, need = indexed(own, p)
                if len(made):
                    sigs.append(made)
                    keys.append(set_key(own)[0])
                    needs.append(need)
                    held += len(made)
                if held >= _GATHER:
                    yield send(sigs, keys, needs)
                    sigs, keys, needs, held = [], [], [], 0
        yield send(sigs, keys, needs)
    return run


def _different(sig: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, sorted."""
    order = np.lexsort((member, sig))
    sig, member = sig[order], member[order]
    new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (member[1:] != member[:-1]))) if len(sig) else np.zeros(0, bool)
    return sig[new], member[new]


def _by_part(kind: int, sig: np.ndarray, member: np.ndarray, parts: int, spread: bool = False) -> list[tuple[int, bytes]]:
    """Packed entries by part of the hash space of the signatures, or with ``spread`` of the members."""
    order = np.lexsort((sig, member))  # by member: the places pack well
    sig, member = sig[order], member[order]
    part = (mix64((member if spread else sig).view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    sig, member, part = sig[order], member[order], part[order]
    edge = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part)) if len(part) else [0]
    return [(int(part[i]), _packed(kind, sig[i:j], member[i:j])) for i, j in zip(edge[:-1], edge[1:], strict=True)]


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one part of the hash space: (member, signatures it shares, signatures it needs to share).  A member that a
    map task has counted for a signature is not counted for it again; copies seen by several tasks may be."""
    held = [_unpacked(r) for r in pdf["entries"]]
    out = [pd.DataFrame({"k1": b, "shared": a if kind == 1 else 0, "need": a if kind == 3 else 0}) for kind, a, b in held if kind in (1, 3)]
    entries = [(a, b, np.full(len(a), kind == 2)) for kind, a, b in held if kind in (0, 2)]
    if entries:
        sig, member, counted = (np.concatenate(x) for x in zip(*entries, strict=True))
        order = np.lexsort((~counted, member, sig))  # a counted entry before others of its member
        sig, member, counted = sig[order], member[order], counted[order]
        new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (member[1:] != member[:-1])))
        sig, member, counted = sig[new], member[new], counted[new]
        _, size = _runs(sig)
        who, times = np.unique(member[np.repeat(size > 1, size) & ~counted], return_counts=True)
        out.append(pd.DataFrame({"k1": who, "shared": times, "need": 0}))
    return pd.concat(out).astype("int64") if out else pd.DataFrame({"k1": [], "shared": [], "need": []}).astype("int64")


def _met(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one part of the hash space: pairs of members and the signatures of small buckets that they share there
    (hot false), and signatures of hot buckets and their members (hot true, shared 1)."""
    held = [_unpacked(r) for r in pdf["entries"]]
    hot = [(a, b) for kind, a, b in held if kind == 1]
    known = np.concatenate([np.zeros(0, np.int64), *(a for kind, a, _ in held if kind == 2)])
    few = [(a, b) for kind, a, b in held if kind == 0]
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if few:
        sig, member = _different(*(np.concatenate(x) for x in zip(*few, strict=True)))
        first, size = _runs(sig)
        many = (size > FEW) | np.isin(sig[first], known)
        hot.append((sig[np.repeat(many, size)], member[np.repeat(many, size)]))
        for n in range(2, FEW + 1):
            at = first[(size == n) & ~many][:, None]
            i, j = np.triu_indices(n, 1)
            pairs.append((member[at + i].ravel(), member[at + j].ravel()))  # members of a bucket are sorted
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
    out = [pd.DataFrame({"hot": False, "a": a[new], "b": b[new], "shared": np.diff(np.append(new, len(a)))})]
    out += [pd.DataFrame({"hot": True, "a": x, "b": y, "shared": 1}) for x, y in hot]
    return pd.concat(out).astype({"hot": "bool", "a": "int64", "b": "int64", "shared": "int64"})


def _candidates(met: DataFrame, needs: DataFrame) -> DataFrame:
    """(a, b) whose components hold all similar pairs, from what ``_met`` returns, a table, and the number of
    signatures (k1, need) that each member needs to share."""
    hot = met.where("hot").select(F.col("a").alias("sig"), F.col("b").alias("k1"))
    each = needs.join(hot.groupBy("k1").agg(F.count("*").alias("hot")), "k1", "left").withColumn("hot", F.coalesce("hot", F.lit(0)))
    each = written(each, "needs")
    pairs = met.where("not hot").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    for x in ("a", "b"):
        pairs = pairs.join(each.select(F.col("k1").alias(x), F.col("need").alias(f"need_{x}"), F.col("hot").alias(f"hot_{x}")), x)
    pairs = pairs.where(F.col("shared") + F.least("hot_a", "hot_b") >= F.greatest("need_a", "need_b")).select("a", "b")
    # hot buckets: a member may come twice, then it leaves out fewer of them
    hot = written(hot.join(each.where("hot >= need"), "k1"), "hot")
    sizes = written(hot.groupBy("sig").agg(F.count("*").alias("size")), "sizes")
    rarest = Window.partitionBy("k1").orderBy("size", "sig")
    hot = hot.join(sizes, "sig").withColumn("place", F.row_number().over(rarest)).where("place <= hot - need + 1")
    hot = written(hot.select("sig", "k1"), "rarest")
    least = written(hot.groupBy("sig").agg(F.min("k1").alias("b")), "least")
    return pairs.unionByName(hot.join(least, "sig").select(F.col("k1").alias("a"), "b"))


def similar_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the pairs of a left and a right set, different ones, that are similar; exact."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if len(sets) < 4:
        pairs = [(i, j) for i in left for j in right if i < j or i not in right or j not in left]
        pairs = [(i, j) for i, j in pairs if i != j and (c := len(np.intersect1d(sets[i], sets[j], assume_unique=True))) * 100 >= p * (size[i] + size[j] - c)]
        return np.array([x for x, _ in pairs], np.int64), np.array([y for _, y in pairs], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    shared = held[column] > 1
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = np.unique(column[order], return_inverse=True)[1], owner[order]
    place = np.full(len(sets), -1)
    place[right] = np.arange(len(right))
    row = np.full(len(sets), -1)
    row[left] = np.arange(len(left))
    common = np.zeros((len(left), len(right)), np.float32)  # counts below 2^24 are exact
    width, i = 8192, 0
    while i < len(column):
        j = int(np.searchsorted(column, column[i] + width))
        c, o = column[i:j] - column[i], owner[i:j]
        a = np.zeros((len(left), int(c[-1]) + 1), np.float32)
        b = np.zeros((len(right), int(c[-1]) + 1), np.float32)
        a[row[o[row[o] >= 0]], c[row[o] >= 0]] = 1
        b[place[o[place[o] >= 0]], c[place[o] >= 0]] = 1
        common += a @ b.T
        i = j
    inter = common.astype(np.int64)
    ok = inter * 100 >= p * (size[left][:, None] + size[right][None, :] - inter)
    i, j = np.nonzero(ok)
    i, j = left[i], right[j]
    apart = (i < j) if np.array_equal(left, right) else (i != j)
    return i[apart], j[apart]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The root of each of n nodes joined by the pairs."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)])


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, p: int = 90,
                 block: int = 128, block_elements: int = 1 << 20, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Every row of ``docs`` as (doc_id, n_shingles, n_links, component_id, text_hash, component_hash) under Jaccard
    similarity of at least p % of the sets of word n-grams; words are lowered (A-Z).

    n_links counts the other rows that the row's set is similar or equal to; component_id is the smallest doc_id
    of the rows that links reach, the row itself included.  A text with fewer than n words is one n-gram; empty and
    null texts have no n-grams and no links.  Repeated rows are copies, linked with each other.  A null doc_id is
    never a component_id unless no other id is there.  text_hash is the xxhash64 of the row's text, component_hash the
    least one among the rows of the component that have its component_id: with the ids they tell rows of one id, or
    without one, apart.  Other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            w = words_of(batch.column("text"), lower=True)
            sets = ngram_sets(w.hashes, w.ptr, n)
            keys = [set_key(s) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "th": batch.column("th"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "k1": pa.array([k for k, _ in keys], pa.int64()), "k2": pa.array([k for _, k in keys], pa.int64())})

    keyed = base.withColumn("th", F.xxhash64("text"))
    rows = written(keyed.mapInArrow(made, "doc_id long, th long, n long, k1 long, k2 long"), "sets")
    full = rows.where("n > 0")
    first = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "th")  # null ids last
    sets = full.groupBy("k1", "k2").agg(F.min(first).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"),
                                        F.min(F.struct("doc_id", "th")).alias("rep"))
    sets = written(sets.withColumn("v", F.monotonically_increasing_id()), "classes")

    # candidates: a set is its first key here; that two sets could share it only adds candidates
    elements = full.agg(F.sum("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), elements // 2_000_000)
    packed = "part int, entries binary"
    shares = base.select("text").mapInArrow(_entries(n, p, parts, True), packed).groupBy("part").applyInPandas(_shared, "k1 long, shared long, need long")
    shares = shares.groupBy("k1").agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
    # a set that shares fewer signatures than any similar pair does is similar to none
    needs = written(shares.where("shared >= need").select("k1", "need"), "likely")
    likely = sets.join(needs.select("k1"), "k1").select(F.col("rep.doc_id").alias("id"), F.col("rep.th").alias("h"))
    likely = written(likely, "likely-texts")
    if likely.count() * 64 <= broadcast_bytes:
        likely = F.broadcast(likely)  # two numbers a row
    again = keyed.join(likely, keyed["th"].eqNullSafe(F.col("h")) & keyed["doc_id"].eqNullSafe(F.col("id")))
    again = written(again.select("doc_id", "th", "text"), "texts")  # the members are among them
    met = again.select("text").mapInArrow(_entries(n, p, parts, False), packed).groupBy("part").applyInPandas(
        _met, "hot boolean, a long, b long, shared long")
    roots = components(_candidates(written(met, "met"), needs), "a", "b")

    # tasks: small components whole, several to a task; of large ones the blocks of equal or neighbouring size bands
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / p) + 1e-9).cast("long")  # similar sizes are at most one apart
    members = sets.join(roots, sets["k1"] == roots["node"]).select("v", "k1", "k2", "copies", "n", "rep", "root").withColumn("band", band)
    members = written(members, "members")
    per = members.groupBy("root").agg(F.count("*").alias("g"), F.sum("n").alias("w"))
    # blocks of a large component grow with its root, so that the sets sent grow with the power 1.5 of its members
    per = per.withColumn("size", F.greatest(F.lit(block), F.least(F.lit(4 * block), F.floor(F.sqrt(F.col("g") * block / 8)))))
    per = per.withColumn("large", F.greatest(F.ceil(F.col("g") / F.col("size")), F.ceil(F.col("w") / block_elements)) > 1)
    totals = per.agg(F.sum("w").alias("w"), F.sum("g").alias("g")).first()
    bins = max(1, int((totals["g"] or 0) // block), int((totals["w"] or 0) // block_elements))
    units = members.join(per.where("large").select("root", "size"), "root").groupBy("root", "band").agg(
        F.ceil(F.greatest(F.count("*") / F.first("size"), F.sum("n") / block_elements)).cast("int").alias("blocks"))
    units = written(units, "units")
    near = units.select("root", "blocks", F.struct("band", "blocks").alias("other"), F.explode(F.expr("sequence(band - 1, band + 1)")).alias("band"))
    near = near.groupBy("root", "band").agg(F.collect_list("other").alias("others"))  # three at most
    near = written(units.join(near, ["root", "band"]), "near")
    mine = F.struct("band", F.pmod(F.xxhash64("v"), "blocks").cast("int").alias("i"))
    others = F.flatten(F.transform("others", lambda o: F.transform(F.sequence(F.lit(0), o["blocks"] - 1), lambda i: F.struct(o["band"].alias("band"), i.alias("i")))))

    def task(other: Column) -> Column:
        first, second = F.least(F.col("mine"), other), F.greatest(F.col("mine"), other)
        name = F.concat_ws(":", F.lit("b"), "root", first["band"], first["i"], second["band"], second["i"])
        return F.struct(name.alias("task"), F.when(first == second, 2).when(F.col("mine") == first, 0).otherwise(1).alias("side"))

    whole = F.array(F.struct(F.concat_ws(":", F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(bins))).alias("task"), F.lit(2).alias("side")))
    placed = members.join(near, ["root", "band"], "left").withColumn("mine", mine).withColumn("others", others)
    placed = placed.select("v", "copies", "root", "k1", "k2", F.col("rep.doc_id").alias("id"), F.col("rep.th").alias("h"),
                           F.when(F.col("blocks").isNull(), whole).otherwise(F.transform("others", task)).alias("tasks"))
    placed = written(placed, "placed")
    row_bytes = 96 + 48 * F.size("tasks")
    if (placed.agg(F.sum(row_bytes)).first()[0] or 0) <= broadcast_bytes:
        placed = F.broadcast(placed)  # measured; otherwise texts and members meet by hash
    fetched = again.join(placed, again["th"].eqNullSafe(F.col("h")) & again["doc_id"].eqNullSafe(F.col("id")))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows of a representative
        for batch in text_slices(batches, "text"):
            w = words_of(batch.column("text"), lower=True)
            own = ngram_sets(w.hashes, w.ptr, n)
            keep = []
            for s, k1, k2, v in zip(own, *(batch.column(c).to_pylist() for c in ("k1", "k2", "v")), strict=True):
                keep.append(v not in seen and set_key(s) == (k1, k2))  # another text may have its id and hash
                if keep[-1]:
                    seen.add(v)
            made = pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("v", "copies", "root", "tasks")}, "elements": pa.array([s.tobytes() for s in own], pa.binary())})
            yield made.filter(pa.array(keep, pa.bool_()))

    held = fetched.select("v", "copies", "root", "k1", "k2", "tasks", "text").mapInArrow(
        shingled, "v long, copies long, root long, tasks array<struct<task:string,side:int>>, elements binary")
    held = held.select("v", "copies", "root", "elements", F.inline("tasks"))

    def verified(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.drop_duplicates("v").groupby("root", sort=False):
            own = [np.frombuffer(e, np.uint64) for e in part["elements"]]
            side, v, copies = (part[c].to_numpy() for c in ("side", "v", "copies"))
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            i, j = similar_pairs(own, left, right, p)
            if len(i):
                root = _forest(len(own), i, j)
                links = np.bincount(i, copies[j], len(own)) + np.bincount(j, copies[i], len(own))
                some = np.flatnonzero(links)
                out.append(pd.DataFrame({"v": v[some], "up": v[root[some]], "links": links[some].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"v": [], "up": [], "links": []}).astype("int64")

    links = held.groupBy("task").applyInPandas(verified, "v long, up long, links long")
    links = written(links, "links")
    up = components(links, "v", "up")
    degree = links.groupBy("v").agg(F.sum("links").alias("links"))
    ids = sets.join(up, sets["v"] == up["node"]).groupBy("root").agg(F.min("first").alias("least"))
    linked = up.join(ids, "root").select(F.col("node").alias("v"), "least").join(degree, "v")
    result = sets.join(linked, "v", "left").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                                   F.coalesce("least", "first").alias("least"))
    result = result.select("k1", "k2", "n_links", F.col("least.doc_id").alias("component_id"), F.col("least.th").alias("component_hash"))
    result = written(result, "result")
    own = rows.select("doc_id", F.col("n").alias("n_shingles"), "k1", "k2", F.col("th").alias("text_hash"))
    columns = ("doc_id", "n_shingles", "n_links", "component_id", "text_hash", "component_hash")
    out = own.where("n_shingles > 0").join(result, ["k1", "k2"]).select(*columns)
    alone = own.where("n_shingles = 0").withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("doc_id"), "component_hash": F.col("text_hash")})
    return out.unionByName(alone.select(*columns))
