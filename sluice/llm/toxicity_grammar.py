"""Toxicity by a weighted finite-state pattern grammar (operator 1).

Small transducers read a clause word by word and are composed into one machine:

* lexicon: words to classes (insult, threat, target, negation, reporting verb, other) with weights; an
  insult is a word or a stem ("stem*": every word that begins so), the longest entry counts;
* negation: an insult or threat within a few words after a negation keeps a part of its weight;
* reported speech: after a reporting verb the rest of the clause keeps a part of its weight;
* insult: insults weigh more in a clause that names a person;
* threat: a threat counts only in a clause that names a person ("a disease can kill" threatens nobody).

A clause is scored as a whole by the path through the composed machine: the weights of its insults and of its threats,
as the steps pass them on, times what the final state makes of either; a document's score is a logistic
function of the sum and the largest of its matched clauses' weights.

The word lists of targets, negations, reporting verbs and threats are fixed; the insults and all weights
are learned from labelled rows: log-odds of the share of toxic and of clean documents that hold a word or
stem, where the likelihood ratio says the difference is no chance; every word or stem that passes is an entry.  Learning reads at most
``most_labelled`` rows of each label (the smallest hashes of their ids), one of each family of near copies
(a family would make every word of its text a mark of toxicity).  Scoring reads every whole text, in one
pass without a shuffle; the model goes to the tasks with the function.  Its size is bounded by the labelled sample: an
entry needs at least ``least_texts`` of its toxic texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import mix64, text_slices, words_of, written

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"

#: The closed word classes, in English, German, French and Spanish.
TARGETS = "you your yours yourself he she they them him her du dich dir dein deine ihr euch tu toi vous votre usted ustedes ellos ellas".split()
NEGATIONS = "not never no nobody isn aren don nicht kein keine niemals pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says wrote writes called claims claimed quoted alleged sagte schrieb nannte déclaré écrit affirme dijo escribió llamó afirma".split()
THREATS = "kill murder destroy strangle stab umbringen erschlagen tuer assassiner matar asesinar".split()

WORDS = re.compile(r"[^\W\d_]+")
#: A word, or a mark that ends a clause.
PIECES = re.compile(r"[^\W\d_]+|[.!?;:\n]")
STEMS = (4, 5, 6, 7, 8)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(5).integers(1, 2**63, 16, dtype=np.uint64)


@dataclass(frozen=True)
class Transducer:
    """A weighted transducer over word classes: ``step`` maps (state, class) to (next state, factor on the word's
    weight), ``final`` maps (state, class) to a factor on the clause's weight of that class; what is missing stays, with
    factor 1."""

    start: object
    step: dict = field(default_factory=dict)
    final: dict = field(default_factory=dict)

    def states(self) -> set:
        return {self.start, *(s for s, _ in self.step), *(t for t, _ in self.step.values())}

    def move(self, state: object, kind: str) -> tuple[object, float]:
        return self.step.get((state, kind), (state, 1.0))


WEIGHED = (INSULT, THREAT)
KINDS = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both read the same clause; their factors multiply."""
    step, final = {}, {}
    for s in a.states():
        for t in b.states():
            for kind in WEIGHED:
                final[(s, t), kind] = a.final.get((s, kind), 1.0) * b.final.get((t, kind), 1.0)
            for kind in KINDS:
                (s2, x), (t2, y) = a.move(s, kind), b.move(t, kind)
                step[(s, t), kind] = ((s2, t2), x * y)
    return Transducer((a.start, b.start), step, final)


def negation(reach: int = 3, factor: float = 0.3) -> Transducer:
    """State: how many more words the last negation reaches."""
    step = {}
    for left in range(reach + 1):
        for kind in KINDS:
            step[left, kind] = (max(0, left - 1), factor if left and kind in (INSULT, THREAT) else 1.0)
        step[left, NEGATION] = (reach, 1.0)
    return Transducer(0, step)


def reported(factor: float = 0.5) -> Transducer:
    step = {("own", REPORT): ("reported", 1.0)}
    step |= {("reported", kind): ("reported", factor) for kind in (INSULT, THREAT)}
    return Transducer("own", step)


def insult(factor: float = 1.25) -> Transducer:
    """Target and insult: the insults of a clause that names a person weigh more."""
    return Transducer("nobody", {("nobody", TARGET): ("somebody", 1.0)}, {("somebody", INSULT): factor})


def threat(factor: float = 1.25) -> Transducer:
    """Threat verb and target: without a target, before or after it in the clause, a threat is none."""
    return Transducer("nobody", {("nobody", TARGET): ("somebody", 1.0)}, {("nobody", THREAT): 0.0, ("somebody", THREAT): factor})


GRAMMAR = compose(compose(negation(), reported()), compose(insult(), threat()))
CLOSED = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT)}


@dataclass(frozen=True)
class Model:
    """``entries``: word, or stem followed by ``*``, to weight; ``beta``: intercept, and the factors of the sum
    (as log(1 + sum)) and of the largest clause weight."""

    entries: dict[str, float]
    beta: tuple[float, float, float] = (-4.0, 1.0, 0.5)
    threats: frozenset = frozenset(THREATS)

    def heads(self) -> frozenset:
        """The first four letters of all entries, cut as words are cut."""
        return frozenset(e.rstrip("*")[:4] for e in self.entries)

    def weigh(self, word: str) -> float:
        found = self.entries.get(word)
        if found is None:
            found = next((w for n in reversed(STEMS) if len(word) >= n and (w := self.entries.get(word[:n] + "*")) is not None), 0.0)
        return found

    def clauses(self, text: str) -> list[float]:
        """Weights of the clauses in which an insult or a threat is matched."""
        out, state, weight = [], GRAMMAR.start, dict.fromkeys(WEIGHED, 0.0)
        for piece in [*PIECES.findall(text), "."]:
            if not piece.isalpha():
                total = sum(w * GRAMMAR.final[state, kind] for kind, w in weight.items())
                if total:
                    out.append(total)
                state, weight = GRAMMAR.start, dict.fromkeys(WEIGHED, 0.0)
                continue
            w = self.weigh(piece)
            kind = (THREAT if piece in self.threats else INSULT) if w else CLOSED.get(piece, OTHER)
            state, factor = GRAMMAR.step[state, kind]
            if w:
                weight[kind] += w * factor
        return out

    def features(self, texts: Iterable[str | None]) -> np.ndarray:
        """log(1 + sum) and largest of the clause weights of each text."""
        heads, out = self.heads(), []
        for text in texts:
            text = (text or "").lower()
            if heads.isdisjoint([w[:4] for w in WORDS.findall(text)]):
                out.append((0.0, 0.0))
            else:
                found = self.clauses(text)
                out.append((math.log1p(sum(found)), max(found, default=0.0)))
        return np.array(out, dtype=float).reshape(-1, 2)

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = self.beta[0] + features @ np.array(self.beta[1:])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _units(text: str) -> set[str]:
    words = set(WORDS.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def _families(texts: pa.Array, sketches: int = 4) -> list[list[int]]:
    """Smallest hashes of each text's three-word runs under some seeds: near copies share most of them."""
    w = words_of(texts, lower=True)
    out = []
    for lo, hi in zip(w.ptr[:-1], w.ptr[1:], strict=True):
        words = w.hashes[lo:hi]
        runs = mix64(mix64(words[:-2] + words[1:-1] * _MUL) + words[2:] * _MUL) if len(words) > 2 else words[:1] if len(words) else np.zeros(1, np.uint64)
        out.append([int(mix64(runs ^ seed).min().view(np.int64)) for seed in _SEEDS[:sketches]])
    return out


def _likelihood_ratio(p: Column, np_: int, n: Column, nn: int) -> Column:
    """G statistic of p of np_ against n of nn."""
    q = (p + n) / float(np_ + nn)
    term = lambda k, m, share: F.when(k > 0, k * F.log(k / float(m) / share)).otherwise(0.0)
    part = lambda k, m: term(k, m, q) + term(m - k, m, 1 - q)
    return F.when((q > 0) & (q < 1), 2 * (part(p, np_) + part(n, nn))).otherwise(0.0)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          most_labelled: int = 8000, least_texts: int = 4, least_ratio: float = 30.0, least_odds: float = 2.0) -> Model:
    """A model from the rows of ``docs`` that have a label.

    Of ids with several labels the largest counts; labels that are null, or without a document, are left out.
    Without toxic and clean rows the model has the fixed threats only."""
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    order = [F.xxhash64("__id"), F.col("__id")]
    chosen = marks.where("__label = 1").orderBy(*order).limit(most_labelled).unionByName(marks.where("__label = 0").orderBy(*order).limit(most_labelled))
    sample = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")  # at most 2 x most_labelled rows
    sample = written(sample.select(F.col("__label").alias("label"), F.coalesce("__text", F.lit("")).alias("text")), "labelled")

    # one text of each family: the sketches of at most 2 x most_labelled texts come to the driver
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("key"), pa.array(_families(batch.column("text")), pa.list_(pa.int64()))],
                                             names=["label", "key", "family"])
    sample = sample.withColumn("key", F.xxhash64("text"))
    rows = sample.mapInArrow(sketched, "label int, key long, family array<long>").collect()
    seen, keep = set(), set()
    for r in sorted(rows, key=lambda r: (-r["label"], r["key"])):
        if seen.isdisjoint(own := {(i, x) for i, x in enumerate(r["family"])}):
            keep.add(r["key"])
        seen |= own
    total = Counter(r["label"] for r in rows)

    texts = sample.dropDuplicates(["label", "key"])  # exact copies of a kept text count once, as in n_pos and n_neg

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: tuple[Counter, Counter] = (Counter(), Counter())  # of clean and of toxic texts
        for batch in batches:
            for t, y, k in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "key")), strict=True):
                if k in keep:
                    got[y].update(_units(t))
        units = sorted(got[0].keys() | got[1].keys())
        yield pa.RecordBatch.from_pydict({"unit": pa.array(units, pa.string()), "neg": pa.array([got[0][u] for u in units], pa.int64()), "pos": pa.array([got[1][u] for u in units], pa.int64())})

    labelled = [r for r in rows if r["key"] in keep]
    n_pos = len({r["key"] for r in labelled if r["label"] == 1})
    n_neg = len({r["key"] for r in labelled if r["label"] == 0})
    entries = dict.fromkeys(THREATS, 1.0)
    if not n_pos or not n_neg:
        return Model(entries)
    units = texts.mapInArrow(count, "unit string, neg long, pos long").groupBy("unit").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    units = units.where(F.col("pos") >= least_texts).withColumns({"odds": odds, "ratio": _likelihood_ratio(F.col("pos"), n_pos, F.col("neg"), n_neg)})
    learned = {r["unit"]: r["odds"] for r in units.where((F.col("odds") >= least_odds) & (F.col("ratio") >= least_ratio)).collect()}
    model = Model(entries | learned)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = model.features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "a": pa.array(f[:, 0]), "b": pa.array(f[:, 1])})
    rows = sample.mapInArrow(featured, "label int, a double, b double").collect()  # three numbers a labelled row
    x = np.array([(1.0, r["a"], r["b"]) for r in rows])
    y = np.array([float(r["label"]) for r in rows])
    share = marks.agg(F.count_if(F.col("__label") == 1).alias("p"), F.count("*").alias("n")).first()
    weight = np.where(y == 1, share["p"] / total[1], (share["n"] - share["p"]) / total[0])  # as in all labels
    return Model(model.entries, _logistic(x, y, weight / weight.mean()))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, rounds: int = 40) -> tuple[float, float, float]:
    """Newton's method; the factors are held at 0 or above, so more weight never scores less."""
    beta = np.zeros(x.shape[1])
    hold = ridge * np.array([0.01, 1.0, 1.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - hold * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(hold)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
        beta[1:] = np.maximum(beta[1:], 0)
    return tuple(float(b) for b in beta)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with ``into``: the toxicity of the text, 0 to 1.

    All rows and columns are kept; a column named ``into`` is replaced.  Null and empty texts get the score of
    a text without a match."""
    docs = docs.drop(into)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(model.features(batch.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, into])
    return docs.mapInArrow(scored, schema)
