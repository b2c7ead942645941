"""Benchmark decontamination by greedy string tiling (operator 4).

A document and a benchmark item are compared word by word, lowered and without punctuation around words.
Running Karp-Rabin: the hashes of all runs of s words of the item are looked up among those of the document;
matches are extended word by word, the longest ones that do not overlap earlier tiles are marked in both, and
s shrinks to the least tile.  Each item word is covered by one tile at most, so passages of an item are found in
any order, and words between them do not matter.  A document is contaminated by an item when its tiles cover at
least ``coverage`` of the item's words.

Candidates: only pairs that share a seed, a run of ``least`` words, are tiled.  The items' seeds are a table of
a size that is checked: items are cut into groups of at most ``most_words`` words, each group goes to the tasks
with the function, and documents are read once for each group (once for any benchmark of usual size).  Documents
are neither shuffled nor collected, and only contaminated pairs leave a task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import mix64, text_slices, words_of

_MUL = np.uint64(0x9E3779B97F4A7C15)


def bare(text: Column) -> Column:
    """Lowered text whose words have lost what stands around their letters and digits."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?<![\p{L}\p{N}])[^\p{L}\p{N}\s]+|[^\p{L}\p{N}\s]+(?![\p{L}\p{N}])", " ")


def runs(hashes: np.ndarray, s: int) -> np.ndarray:
    """Hashes of all runs of s words."""
    n = len(hashes) - s + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(s):
        h = h * _MUL + hashes[i:n + i]
    return mix64(h)


def tiles(doc: np.ndarray, item: np.ndarray, least: int = 5) -> list[tuple[int, int, int]]:
    """(start in document, start in item, words) of the greedy tiles of two word sequences: longest first,
    equal lengths by place in the item, then in the document."""
    out: list[tuple[int, int, int]] = []
    used_doc, used_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    s = max(least, min(len(item), 20))
    while s >= least:
        at = defaultdict(list)
        own = runs(item, s)
        for j in range(len(own)):
            if not used_item[j:j + s].any():
                at[int(own[j])].append(j)
        theirs = runs(doc, s)
        hits = np.flatnonzero(np.isin(theirs, np.fromiter(at, np.uint64, len(at)))) if at else ()
        found = []
        for i in hits:
            if used_doc[i:i + s].any():
                continue
            for j in at[int(theirs[i])]:
                if i and j and doc[i - 1] == item[j - 1] and not used_doc[i - 1] and not used_item[j - 1]:
                    continue  # part of a longer match
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not used_doc[i + n] and not used_item[j + n]:
                    n += 1
                if n >= s:
                    found.append((-n, j, int(i)))
        if not found:
            s = least if s > least and s // 2 < least else s // 2 if s > least else 0
            continue
        found.sort()
        longest = -found[0][0]
        if longest >= 2 * s:  # the search was too short for these: once more with their length
            s = longest
            continue
        marked = False
        for n, j, i in found:
            n = -n
            if not used_doc[i:i + n].any() and not used_item[j:j + n].any():
                used_doc[i:i + n] = used_item[j:j + n] = True
                out.append((i, j, n))
                marked = True
        if not marked:
            s = 0
        # what overlapped earlier tiles may leave shorter matches: the same length again, then shorter
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", least: int = 5, coverage: float = 0.5, most_words: int = 500_000) -> DataFrame:
    """The contaminated pairs: (doc_id, item_id, n_item_words, n_covered, coverage, tiles) with ``tiles`` as
    (start in the document, start in the item, words).

    Null and empty texts of either side match nothing; an item with fewer than ``least`` words is one tile of all
    its words.  Repeated documents and items give a row each.  Other columns are ignored."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), bare(F.col(text)).alias("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), bare(F.col(item_text)).alias("text"))
    size = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long")
    items = items.withColumn("size", size).where("size > 0")
    total = items.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-total // most_words))
    out = None
    for g in range(groups):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).select("item_id", "text").collect()  # about most_words words
        found = rows.mapInArrow(_matcher([(r["item_id"], r["text"]) for r in chosen], least, coverage), _PAIR)
        out = found if out is None else out.unionByName(found)
    return out


_PAIR = "doc_id long, item_id long, n_item_words int, n_covered int, coverage double, tiles array<struct<doc:int,item:int,words:int>>"
_TILES = pa.list_(pa.struct([("doc", pa.int32()), ("item", pa.int32()), ("words", pa.int32())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_words", pa.int32()), ("n_covered", pa.int32()), ("coverage", pa.float64()), ("tiles", _TILES)])


def _matcher(items: list[tuple[int, str]], least: int, coverage: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words_of(pa.array([t for _, t in items], pa.string()))
        words = [own.hashes[a:b] for a, b in zip(own.ptr[:-1], own.ptr[1:], strict=True)]
        seeds: dict[int, set[int]] = defaultdict(set)
        sizes = set()
        for x, w in enumerate(words):
            s = min(least, len(w))
            sizes.add(s)
            for h in runs(w, s).tolist():
                seeds[h].add(x)
        by_size = {s: np.array(sorted(h for x, w in enumerate(words) if min(least, len(w)) == s for h in runs(w, s).tolist()), np.uint64) for s in sizes}
        for batch in text_slices(batches, "text"):
            docs = words_of(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            cands: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
            for s, known in by_size.items():
                all_runs = runs(docs.hashes, s)  # of the whole batch; those across texts are left out below
                for i in np.flatnonzero(np.isin(all_runs, known)).tolist():
                    d = int(np.searchsorted(docs.ptr, i, side="right")) - 1
                    if i + s <= docs.ptr[d + 1]:
                        for x in seeds[int(all_runs[i])]:
                            cands[d][x] += 1
            out: dict[str, list] = {c: [] for c in _ARROW.names}
            for d, hit in cands.items():
                doc = docs.hashes[docs.ptr[d]:docs.ptr[d + 1]]
                for x, n in hit.items():
                    w = words[x]
                    s = min(least, len(w))
                    if n * s < coverage * len(w):  # too few seeds for that many words, each a tile's
                        continue
                    laid = tiles(doc, w, s)
                    got = sum(t[2] for t in laid)
                    if got >= coverage * len(w):
                        row = (ids[d], items[x][0], len(w), got, got / len(w), [dict(zip(("doc", "item", "words"), t, strict=True)) for t in laid])
                        for col, v in zip(out.values(), row, strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_ARROW)
    return match
