"""Ranked lexical search by the Best Position Algorithm (operator 11).

1. One pass over the documents keeps of each its length and its counts of the queries' terms, as a table in the shared
   folder.  Term and document counts are sums over that table, made by Spark.
2. The table is searched where it lies, a shard (a bounded number of postings) at a time, for all queries of a block.
   In a shard every term has its impact list, sorted by falling impact and, within an impact, by document.
3. For a query its lists are read side by side, to a depth that grows by half with each round.  A document seen for the
   first time is looked up in all lists of the query by direct access, which gives its whole score and its position in
   each of them.  The best position of a list is the last one up to which all have been seen, by sorted or by direct
   access; an unseen document lies beyond the best position of every list, so the impacts found there add up to the most
   it can have.  Reading stops when that is strictly below the k-th score, as an equal score could win by its id.
4. The k best of every shard are merged; no document of the k best overall is missing in its shard's.

Shards never exchange postings, so a frequent term is as many lists as there are shards and a hot group of equal
documents is spread like any other rows.  What a task holds is one shard and one block of queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import text_slices, words_of, written

#: Bytes that belong to no term: ASCII but for digits and letters.
APART = np.zeros(256, dtype=bool)
APART[:128] = True
APART[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

_POSTED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
_FOUND = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("n_read", pa.int64()), ("n_postings", pa.int64())])


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", block_bytes: int = 4 << 20, shard_postings: int = 4_000_000) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: (item_id, rank, doc_id, score, n_read, n_postings).

    Ranks run from 1 by falling score and, within a score, rising id.  Terms are maximal runs of ASCII digits, letters and
    characters beyond ASCII, A-Z lowered; null and empty texts have none.  Every row of ``docs`` is a document, repeated
    rows and null ids (last within a score) included; the rows of one item id, null among them, are one query of all their
    terms.  Items without terms, or whose terms no document holds, and empty tables give no rows.  Other columns are
    ignored.  Terms are compared by 64-bit hashes.

    ``n_read`` and ``n_postings`` are the positions read by sorted access in the document's shard and the length of the
    query's lists there.  Queries are searched in blocks of about ``block_bytes`` of text, each a pass over ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = None
    for b in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()  # about block_bytes of text
        ids, queries, vocabulary = _queries([r["item_id"] for r in chosen], [r["text"] for r in chosen])
        posted = written(rows.mapInArrow(_posting(vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>"), "postings")
        n_docs, length = posted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in posted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term of the block
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        found = posted.where(F.size("terms") > 0).mapInArrow(_searcher(queries, weight, n_docs, length or 0, k, shard_postings), "query int, doc_id long, score long, n_read long, n_postings long")
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        named = docs.sparkSession.createDataFrame(list(enumerate(ids)), "query int, item_id long")
        found = found.join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score", "n_read", "n_postings")
        out = found if out is None else out.unionByName(found)
    return out


def _queries(ids: list[int | None], texts: list[str | None]) -> tuple[list[int | None], list[np.ndarray], np.ndarray]:
    """The different ids, the terms of each as places in the vocabulary, and the vocabulary as sorted hashes."""
    w = words_of(pa.array(texts, pa.string()), lower=True, apart=APART)
    terms: dict[int | None, list[np.ndarray]] = {}
    for i, a, b in zip(ids, w.ptr[:-1], w.ptr[1:], strict=True):
        terms.setdefault(i, []).append(w.hashes[a:b])
    vocabulary = np.unique(w.hashes)
    return list(terms), [np.searchsorted(vocabulary, np.unique(np.concatenate(t))) for t in terms.values()], vocabulary


def _posting(vocabulary: np.ndarray):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            w = words_of(batch.column("text"), lower=True, apart=APART)
            n = np.diff(w.ptr)
            if len(vocabulary):
                at = np.searchsorted(vocabulary, w.hashes)
                at[at == len(vocabulary)] = 0
                hit = vocabulary[at] == w.hashes
                doc = np.repeat(np.arange(len(n)), n)[hit]
                entry, tf = np.unique(doc * len(vocabulary) + at[hit], return_counts=True)
                doc, term = np.divmod(entry, len(vocabulary))
            else:
                doc = term = tf = np.zeros(0, np.int64)
            upto = pa.array(np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(upto, pa.array(x.astype(np.int32))) for x in (term, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int64)), *lists], schema=_POSTED)
    return post


class Shard:
    """The impact lists of some documents, and for direct access each document's entries in them.

    ``ptr`` cuts documents, in the order of their ids, into entries of (term, impact, place in the term's list);
    ``start`` cuts lists, by term, into ``list_doc`` and ``list_impact``."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids, self.terms, self.impact = ids, terms, impact
        self.ptr = np.concatenate(([0], np.cumsum(counts)))
        doc = np.repeat(np.arange(len(ids)), counts)
        order = np.lexsort((doc, -impact, terms))
        self.start = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order)) - self.start[terms[order]]

    def top(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Documents and scores of the k best above 0, the positions read and those that there are."""
        sizes = np.diff(self.start)[query]
        heads = [self.list_impact[self.start[t]] > 0 for t in query[sizes > 0]]
        query = query[sizes > 0][np.array(heads, bool)]  # lists that add nothing need not be read
        a, sizes = self.start[query], (self.start[query + 1] - self.start[query])
        own = np.concatenate(([0], np.cumsum(sizes)))  # the query's lists, one after the other
        slot = np.full(len(self.start), -1)
        slot[query] = np.arange(len(query))
        seen_at = np.zeros(own[-1] + 1, bool)  # positions seen, by sorted or direct access
        seen = np.zeros(len(self.ids), bool)
        best = np.zeros(len(query), np.int64)  # positions up to which all are seen, list by list
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, 2 * k
        while depth < (sizes.max() if len(sizes) else 0):
            new = [self.list_doc[s + depth:s + min(depth + step, n)] for s, n in zip(a, sizes, strict=True) if depth < n]
            new = np.unique(np.concatenate(new))
            new = new[~seen[new]]
            depth += step
            step = max(step, depth // 2)
            seen[new] = True
            n = self.ptr[new + 1] - self.ptr[new]
            entry = np.repeat(self.ptr[new] - np.cumsum(n) + n, n) + np.arange(n.sum())
            of = slot[self.terms[entry]]
            which = np.repeat(np.arange(len(new)), n)[of >= 0]
            entry, of = entry[of >= 0], of[of >= 0]
            gained = np.zeros(len(new), np.int64)
            np.add.at(gained, which, self.impact[entry])
            seen_at[own[of] + self.place[entry]] = True
            docs, scores = np.concatenate((docs, new)), np.concatenate((scores, gained))
            most = 0
            for i, (s, size) in enumerate(zip(a, sizes, strict=True)):
                best[i] += _leading(seen_at, own[i] + best[i], own[i + 1])
                if best[i] < size:
                    most += int(self.list_impact[s + best[i]])
            if len(docs) > k:  # those below the k-th are no longer needed
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                docs, scores = docs[scores >= least], scores[scores >= least]
            if len(docs) >= k and scores.min() > most:
                break
        docs, scores = docs[scores > 0], scores[scores > 0]
        first = np.lexsort((docs, -scores))[:k]
        return docs[first], scores[first], int(np.minimum(sizes, depth).sum()), int(own[-1])


def _leading(flags: np.ndarray, start: int, end: int, chunk: int = 256) -> int:
    """How many flags from ``start`` on are set without a gap."""
    at = start
    while at < end:
        part = flags[at:min(at + chunk, end)]
        gap = int(part.argmin())
        if not part[gap]:
            return at + gap - start
        at += len(part)
        chunk *= 4
    return end - start


def _searcher(queries: list[np.ndarray], weight: np.ndarray, n_docs: int, length: int, k: int, shard_postings: int):
    def shard(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays([b.column("doc_id") for b in held])
        last = np.asarray(ids.is_null())
        number = np.asarray(ids.fill_null(0))
        order = np.lexsort((number, last))
        n = np.concatenate([np.asarray(b.column("n")) for b in held])
        terms = np.concatenate([np.asarray(b.column("terms").flatten()) for b in held]).astype(np.int64)
        tf = np.concatenate([np.asarray(b.column("tfs").flatten()) for b in held]).astype(np.int64)
        counts = np.concatenate([np.asarray(b.column("terms").value_lengths()) for b in held]).astype(np.int64)
        m = 50 + (50 * n * n_docs) // length
        impact = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, counts)))
        begin = np.cumsum(counts) - counts
        moved = np.repeat(begin[order] - np.cumsum(counts[order]) + counts[order], counts[order]) + np.arange(len(terms))
        lists = Shard(order, counts[order], terms[moved], impact[moved], len(weight))
        for q, query in enumerate(queries):
            docs, scores, n_read, n_postings = lists.top(query, k)
            if len(docs):
                same = [pa.array(np.full(len(docs), x), t) for x, t in ((q, pa.int32()), (n_read, pa.int64()), (n_postings, pa.int64()))]
                yield pa.RecordBatch.from_arrays([same[0], ids.take(pa.array(order[docs])), pa.array(scores), *same[1:]], schema=_FOUND)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column("terms").flatten())
            if size >= shard_postings:
                yield from shard(held)
                held, size = [], 0
        if held:
            yield from shard(held)
    return find
