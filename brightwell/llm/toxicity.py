"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes (insult, threat, target, negation, report, boundary, other)
by a lexicon. Three transducers read the classes of a clause: negation marks
insults and threats in its scope, reported speech marks those after it, target
marks those near a person addressed. They are composed into one machine. Every
marked insult or threat adds its lexicon weight to the sum of its mark, so that
"not an idiot" and "he wrote that she is an idiot" count less than "you idiot",
and words outside a matched clause count nothing.

The lexicon holds seeds and what the labels teach: words and word beginnings that
stand far more often in toxic documents, chosen greedily so that each explains
documents which those before do not. A logistic curve whose prior is the
grammar's own weights turns the sums into a score. Both are fitted on about
``SAMPLE`` labelled documents, chosen by a hash of the id; nothing but text enters
a score. Everything else covers all rows and whole texts.

Null and empty texts have the score of a text without a match. Documents with
several labels count as toxic if one says so; null labels are no labels. Repeated
rows get equal scores. Without labels the grammar's own weights hold. An empty
table gives no rows.
"""

from __future__ import annotations

import functools
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import crc_part, cut_lineage

#: Labelled documents that the lexicon and the curve are fitted on, about.
SAMPLE = 10_000
#: The least documents an entry must explain.
SUPPORT = 5
#: Least share of toxic documents among those with an entry, and how often a clean
#: document counts (one more is added): first for entries that are proof by
#: themselves, then, for documents these do not explain, for weak ones. Weak entries
#: have small weights, so it takes several to flag a text.
PRECISION = ((0.8, 3), (0.4, 1))
STEMS = range(4, 9)
THRESHOLD = 0.3
#: Spellings a worker remembers; beyond that it starts anew.
MEMORY = 300_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
NEGATED_INSULT, REPORTED_INSULT, NEGATED_THREAT, REPORTED_THREAT, AIMED_INSULT, AIMED_THREAT = range(7, 13)

# Seeds of the classes.
SEEDS = {
    INSULT: "idiot idiots moron morons imbecile stupid dumb dumbass fool jerk loser losers trash garbage scum scumbag filth vermin "
            "worthless pathetic disgusting clown pig asshole bastard bitch crétin débile connard salaud abruti minable ordure "
            "dummkopf trottel blödmann arschloch abschaum widerlich idiota imbécil estúpido estúpida escoria asqueroso asquerosa inútil",
    THREAT: "kill hurt stab strangle murder destroy",
    TARGET: "you your yours u ur he she him her they them du dich dir ihr euch tu te toi vous usted ustedes",
    NEGATION: "not never no isn't aren't wasn't don't doesn't nor nicht kein keine nie pas jamais nunca tampoco",
    REPORT: "said says say wrote writes quoted quotes claimed claims reported reportedly called alleged sagte schrieb écrit dijo escribió",
}
#: How far negation reaches, and how near a target must stand, in words.
SCOPE = 3
SEED_WEIGHT = 2.0

_PART = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
_ENDS = frozenset(".!?;:\n")


@dataclass
class Transducer:
    """A deterministic weighted transducer: (state, symbol) -> (state, symbol out).

    Symbols without an arc pass through unchanged and keep the state.
    """

    arcs: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)

    def step(self, state, symbol: int):
        return self.arcs.get((state, symbol), (state, symbol))

    def symbols(self) -> set[int]:
        return {s for _, s in self.arcs} | {out for _, out in self.arcs.values()}

    def states(self) -> set:
        return {s for s, _ in self.arcs} | {to for to, _ in self.arcs.values()} | {0}


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what ``first`` writes to ``second``.

    Pairs of states are numbered as they are reached, from (0, 0) as 0.
    """
    numbers, waiting, arcs = {(0, 0): 0}, [(0, 0)], {}
    symbols = first.symbols() | second.symbols()
    while waiting:
        here = waiting.pop()
        for symbol in symbols:
            one, middle = first.step(here[0], symbol)
            two, out = second.step(here[1], middle)
            if (one, two) not in numbers:
                numbers[one, two] = len(numbers)
                waiting.append((one, two))
            arcs[numbers[here], symbol] = (numbers[one, two], out)
    return Transducer(arcs)


def scope(opener: int, reach: int | None, marks: dict[int, int]) -> Transducer:
    """After ``opener``, symbols in ``marks`` are rewritten for ``reach`` words, or
    to the end of the clause if that is None."""
    arcs = {}
    top = reach or 1
    for state in range(top + 1):
        arcs[state, opener] = (top, opener)
        arcs[state, END] = (0, END)
        after = max(0, state - 1) if reach else state
        for symbol in range(13):
            if symbol not in (opener, END):
                arcs[state, symbol] = (after, marks.get(symbol, symbol) if state else symbol)
    return Transducer(arcs)


def grammar() -> Transducer:
    negation = scope(NEGATION, SCOPE, {INSULT: NEGATED_INSULT, THREAT: NEGATED_THREAT})
    report = scope(REPORT, None, {INSULT: REPORTED_INSULT, THREAT: REPORTED_THREAT})
    target = scope(TARGET, SCOPE, {INSULT: AIMED_INSULT, THREAT: AIMED_THREAT})
    return compose(compose(negation, report), target)


#: Marks in the order of the feature sums, and the prior weight of each.
MARKS = (INSULT, AIMED_INSULT, NEGATED_INSULT, REPORTED_INSULT, THREAT, AIMED_THREAT, NEGATED_THREAT, REPORTED_THREAT)
PRIOR = np.array([2.0, 3.0, 0.2, 0.4, 1.5, 3.0, 0.1, 0.3, 1.0, -3.0])  # one per mark, matched clauses, constant
TRUST = np.array([1.0, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0, 1.0, 0.1])  # how firmly the prior holds


@dataclass
class Model:
    words: dict[str, tuple[int, float]]
    stems: dict[str, tuple[int, float]]
    curve: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_with_constant(sums) @ self.curve, -40, 40)))


def _with_constant(sums: np.ndarray) -> np.ndarray:
    return np.column_stack([sums, np.ones(len(sums))])


def seeded() -> Model:
    return Model({w: (kind, SEED_WEIGHT) for kind, words in SEEDS.items() for w in words.split()}, {})


class Reader:
    """Turns texts into feature sums; remembers the class of spellings."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        machine = grammar()
        self.table = machine.arcs

    def look_up(self, word: str) -> tuple[int, float]:
        if word in _ENDS:
            return END, 0.0
        found = self.model.words.get(word)
        if found is None:
            for size in STEMS:
                if size > len(word):
                    break
                found = self.model.stems.get(word[:size])
                if found:
                    break
        if len(self.known) > MEMORY:
            self.known.clear()
        self.known[word] = found = found or (OTHER, 0.0)
        return found

    def sums(self, text: str) -> np.ndarray:
        """Weights summed by mark over all matched clauses, and their number (as a logarithm)."""
        out = np.zeros(len(MARKS) + 1)
        known = self.known
        parts = _PART.findall(text.lower())
        classes = [known.get(p) or self.look_up(p) for p in parts]
        hits = [i for i, c in enumerate(classes) if c[0] == INSULT or c[0] == THREAT]
        clauses, read_to = 0, -1
        for at in hits:
            if at < read_to:
                continue
            start, stop = at, at
            while start > 0 and classes[start - 1][0] != END:
                start -= 1
            while stop < len(classes) and classes[stop][0] != END:
                stop += 1
            state = 0
            for kind, weight in classes[start:stop]:
                state, mark = self.table.get((state, kind), (state, kind))
                if weight and mark in MARKS:
                    out[MARKS.index(mark)] += weight
            clauses, read_to = clauses + 1, stop
        out[:-1] = np.log1p(out[:-1])
        out[-1] = np.log1p(clauses)
        return out


def entries(text: str) -> set[str]:
    """The words of a text (as ``=word``) and their beginnings."""
    words = {w for w in _PART.findall((text or "").lower()) if w not in _ENDS}
    return {f"={w}" for w in words} | {w[:n] for w in words for n in STEMS if n <= len(w)}


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text and toxic of about ``sample`` labelled documents, equal texts once."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = known.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = 1_000_000 if rows <= sample else max(1, sample * 1_000_000 // rows)
    chosen = known.where(part < share).select(F.col("doc_id").alias("_id"), "toxic")
    # About ``sample`` rows of two numbers.
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return cut_lineage(found.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("same"))
                       .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))


def _counted(rows: DataFrame) -> DataFrame:
    """entry and in how many of the texts it stands."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(entries(text))
        if counts:  # a frame without rows would have no text column
            yield pd.DataFrame({"entry": list(counts), "n": list(counts.values())})
    return rows.select("text").mapInPandas(run, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def learned(sample: DataFrame) -> dict[str, float]:
    """Entries chosen greedily, with their weights (log-odds)."""
    toxic, clean = sample.where(F.col("toxic") > 0), sample.where(F.col("toxic") <= 0)
    often = _counted(toxic).where(F.col("n") >= SUPPORT)
    both = often.join(_counted(clean).withColumnRenamed("n", "clear"), "entry", "left").select("entry", "n", F.coalesce("clear", F.lit(0)).alias("clear"))
    # Rare and clear entries come through as common ones do: only what no grade takes is left behind.
    passes = [F.col("n") / (F.col("n") + times * F.col("clear") + 1) >= least for least, times in PRECISION]
    found = both.where(functools.reduce(operator.or_, passes)).collect()
    if not found:
        return {}
    likely, clear = {r["entry"]: r["n"] for r in found}, {r["entry"]: r["clear"] for r in found}
    totals = sample.agg(F.sum((F.col("toxic") > 0).cast("long")).alias("bad"), F.count(F.lit(1)).alias("all")).first()
    odds = (totals["all"] - totals["bad"] + 1) / (totals["bad"] + 1)
    grades = [frozenset(e for e, n in likely.items() if n / (n + times * clear.get(e, 0) + 1) >= least)
              for least, times in PRECISION]
    good = frozenset().union(*grades)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"found": [sorted(entries(t) & good) for t in batch["text"]]})
    # Few entries are mostly toxic, so a row of this bounded sample is short.
    sets = [set(r["found"]) for r in toxic.select("text").mapInPandas(run, "found array<string>").collect()]
    chosen: dict[str, float] = {}
    waiting = list(grades)
    while waiting:
        gain = Counter(e for s in sets for e in s & waiting[0])
        most = min(gain, key=lambda e: (-gain[e], len(e), e), default=None)
        if most is None or gain[most] < SUPPORT:
            waiting.pop(0)
            continue
        # The longest spelling of it that explains nearly as much: "=pathetic" rather than "path".
        alike = [e for e in gain if e.lstrip("=").startswith(most.lstrip("=")) and gain[e] >= 0.95 * gain[most]]
        best = max(alike, key=lambda e: (len(e), e))
        chosen[best] = float(np.log((likely[best] + 0.5) / (clear.get(best, 0) + 0.5) * odds))
        sets = [s for s in sets if best not in s]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, sample)
    model = seeded()
    for entry, weight in learned(rows).items():
        where, name = (model.words, entry[1:]) if entry.startswith("=") else (model.stems, entry)
        where[name] = (where.get(name, (INSULT, 0))[0] if where.get(name, (INSULT, 0))[0] in (INSULT, THREAT) else INSULT, weight)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for batch in batches:
            yield pd.DataFrame({"x": [reader.sums(t).tolist() for t in batch["text"]], "y": batch["toxic"]})
    found = rows.mapInPandas(run, "x array<double>, y int").toPandas()
    if len(found):
        found["x"] = found["x"].map(tuple)
        found = found.sort_values(["y", "x"])  # the fit then does not depend on which task came first
        model.curve = curve(np.array(found["x"].tolist()), (found["y"] > 0).to_numpy(dtype=float))
    return model


def curve(sums: np.ndarray, toxic: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic weights by Newton steps, held near ``PRIOR`` as firmly as ``TRUST`` says."""
    x, w = _with_constant(sums), PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (p - toxic) + TRUST * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(TRUST)
        move = np.linalg.solve(hess, grad)
        w = w - move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``THRESHOLD`` on) of each row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for batch in batches:
            chance = model.score(np.array([reader.sums(t or "") for t in batch["text"]]).reshape(len(batch), -1))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": chance,
                                "predicted": (chance >= THRESHOLD).astype("int32")})
    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from three quarters of the labels by id, then score every row:
    doc_id, held_out, score, predicted."""
    narrow = docs.select("doc_id", "text")
    model = fit(narrow, labels.select("doc_id", "toxic").where(crc_part(F.col("doc_id")) != 2))
    return score(narrow, model).select("doc_id", (crc_part(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted")
