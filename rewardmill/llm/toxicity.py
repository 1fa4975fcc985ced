"""Toxicity by a weighted finite-state pattern grammar.

Words become letters (insult, threat verb, intent, target, negator, reporter, ...) with a
lexical weight; the letters of one clause run through the composition of five weighted
transducers:

* *insult* turns an insulting word into a match; behind another insult, or behind an
  opening such as "piece of", into a stronger one;
* *threat* turns a threat verb into a match, a full one where an intent ("will", "going")
  stands at most a few words before it, else a weak one;
* *negation* weakens a match close behind a negator;
* *report* weakens a match behind somebody else's quoted speech;
* *target* strengthens an insult near a person addressed, before or behind it, and lets a
  threat count only where there is one: without it the threat's weight is held back.

Weights multiply along the composition, and the clause's score is the sum of its output
letters' weights; nothing is added to or taken from it beside the grammar. A document is
judged by its clauses, never by isolated words.

The lexicon's insults are learned: whole words first, then word stems among the words
left over, each with its smoothed log-odds between toxic and clean training documents.
A logistic curve over the clause scores, fitted on the half of the training rows that
the lexicon has not seen, turns them into a probability. Both fits use at most
``max_training_rows`` labelled rows, those of the smallest md5 of their id.

Scoring finds candidate words with one Aho-Corasick pass over the whole text and runs
the grammar only on the clauses they stand in, in time linear in the text.

Defined results: null and empty texts have no clause and get the score of a text
without matches; texts are read whole, however long; without any toxic training row every
score is the share of toxic rows (0 if there are no rows); repeated rows score alike, and a
repeated label counts as toxic if one of its rows is; equal scores need no order, the
result is a row a document; extra columns are kept, but ``score`` and ``predicted`` of the
input give way to the results.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardmill.llm.common import ship

OTHER, INSULT, VERB, INTENT, TARGET, NEGATION, REPORT, OPENING, LINK = "oivwtnrpl"
#: Kinds that the insult and threat transducers write.
MATCHED_INSULT, MATCHED_THREAT = "I", "H"

#: Fixed word lists of the grammar (English, French, German, Spanish).
VERBS = "kill murder hurt destroy shoot stab beat burn tuer frapper töten umbringen schlagen matar golpear".split()
INTENTS = "will shall going gonna want must should vais va veux doit werde wird muss soll voy quiero debe".split()
TARGETS = (
    "you your yourself u he she him her they them his their people tu vous toi il elle ils eux "
    "du dich dir ihr euch er sie ihn tú usted ustedes él ella ellos"
).split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't didn't pas jamais non nicht kein keine nie nunca jamás".split()
REPORTS = "said says say wrote writes claimed claims called calls quoted dit disait sagte sagt schrieb dijo dice escribió".split()
OPENINGS = "piece bunch pack bag espèce bande tas stück haufen pedazo montón".split()
LINKS = "of de von d".split()

#: Weights of the grammar's arcs.
PILED, OPENED = 1.2, 1.2
THREAT_WEIGHT, WITHOUT_INTENT = 2.0, 0.5
NEGATED, REPORTED = 0.3, 0.4
TARGETED = 1.3

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n|]")


#: A letter of the tapes: kind, weight, and how much of it was weakened on the way.
Letter = tuple[str, float, float]


class Transducer:
    """Weighted letter transducer: ``step(state, letter)`` gives (letter, state).

    ``step`` is a pure function, so composition is the product of states with one
    machine's output fed to the next.
    """

    def __init__(self, start, step):
        self.start, self.step = start, step

    def __call__(self, letters: list[Letter]) -> list[Letter]:
        state, out = self.start, []
        for s in letters:
            o, state = self.step(state, s)
            out.append(o)
        return out


def compose(*machines: Transducer) -> Transducer:
    """The transducer that feeds each machine's output to the next."""
    if len(machines) == 1:
        return machines[0]
    first, second = machines[0], compose(*machines[1:])

    def step(state, letter):
        middle, a = first.step(state[0], letter)
        out, b = second.step(state[1], middle)
        return out, (a, b)

    return Transducer((first.start, second.start), step)


def insult_machine() -> Transducer:
    """States: 0 plain, 1 behind an opening, 2 behind its link, 3 behind an insult."""

    def step(state, letter):
        kind, weight, weak = letter
        if kind == INSULT:
            factor = {2: OPENED, 3: PILED}.get(state, 1.0)
            return (MATCHED_INSULT, weight * factor, weak), 3
        if kind == OPENING:
            return letter, 1
        return letter, 2 if kind == LINK and state == 1 else 0

    return Transducer(0, step)


def threat_machine(reach: int = 4) -> Transducer:
    """State: how many more words an intent reaches."""

    def step(left, letter):
        kind, weight, weak = letter
        if kind == INTENT:
            return letter, reach
        if kind == VERB:
            letter = (MATCHED_THREAT, weight * (1.0 if left else WITHOUT_INTENT), weak)
        return letter, max(0, left - 1)

    return Transducer(0, step)


def weakening_machine(trigger: str, reach: int, factor: float) -> Transducer:
    """Matches at most ``reach`` words behind ``trigger`` lose weight."""

    def step(left, letter):
        kind, weight, weak = letter
        if kind == trigger:
            return letter, reach
        if left and kind in (MATCHED_INSULT, MATCHED_THREAT):
            letter = (kind, weight * factor, weak + weight)
        return letter, max(0, left - 1)

    return Transducer(0, step)


def target_machine(reach: int = 5) -> Transducer:
    """State: words that a target still reaches, whether there was one, and what a later
    target would add: an insult's bonus, a threat's whole weight. It is put on that target."""

    def step(state, letter):
        left, any_, bonus, held, held_weak = state
        kind, weight, weak = letter
        if kind == TARGET:
            return (kind, weight + bonus + held, weak + held_weak), (reach, True, 0.0, 0.0, 0.0)
        if kind == MATCHED_INSULT:
            if left:
                letter = (kind, weight * TARGETED, weak)
            else:
                bonus += weight * (TARGETED - 1)
        elif kind == MATCHED_THREAT and not any_:
            letter, held, held_weak = (kind, 0.0, 0.0), held + weight, held_weak + weak
        return letter, (max(0, left - 1), any_, bonus, held, held_weak)

    return Transducer((0, False, 0.0, 0.0, 0.0), step)


MACHINES = {
    "insult": insult_machine(),
    "threat": threat_machine(),
    "negation": weakening_machine(NEGATION, 3, NEGATED),
    "report": weakening_machine(REPORT, 8, REPORTED),
    "target": target_machine(),
}
GRAMMAR = compose(*MACHINES.values())
#: Kinds whose input letters carry a weight only for the machine that matches them.
_SCORED = (MATCHED_INSULT, MATCHED_THREAT, TARGET)


def clause_score(letters: list[Letter], grammar: Transducer = GRAMMAR) -> tuple[float, float]:
    """(score, weakened part) of one clause: sums over what the grammar writes."""
    total = weakened = 0.0
    for kind, weight, weak in grammar(letters):
        if kind in _SCORED:
            total += weight
            weakened += weak
    return total, weakened


@dataclass
class Lexicon:
    """Learned weights: ``words`` for whole words, ``stems`` for beginnings of words."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        w = self.words.get(word, 0.0)
        if not w:
            for k in range(min(len(word), MAX_STEM), MIN_STEM - 1, -1):
                w = self.stems.get(word[:k], 0.0)
                if w:
                    break
        return w


MIN_STEM, MAX_STEM = 4, 8
_KINDS = {
    w: kind
    for kind, words in ((LINK, LINKS), (OPENING, OPENINGS), (INTENT, INTENTS), (REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (VERB, VERBS))
    for w in words
}


class Scorer:
    """Clause features of texts under a lexicon; builds its automaton on first use."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.machine = None

    def _automaton(self):
        if self.machine is None:
            import ahocorasick

            self.machine = ahocorasick.Automaton()
            for key in {*self.lexicon.words, *self.lexicon.stems, *VERBS}:
                self.machine.add_word(key, len(key))
            self.machine.make_automaton()
        return self.machine

    def clauses(self, low: str) -> list[tuple[int, int]]:
        """Spans of the clauses of a lower-case text that hold a word's beginning which the
        lexicon knows. Every search stays behind the clause before: linear in the text."""
        spans, floor = [], 0
        for last, size in self._automaton().iter(low):
            at = last + 1 - size
            if at < floor or at and low[at - 1].isalpha():
                continue
            begin = max(floor, max(low.rfind(x, floor, at) for x in ".!?;:\n|") + 1)
            stop = _CLAUSE_END.search(low, last)
            floor = stop.start() if stop else len(low)
            spans.append((begin, floor))
        return spans

    def letter(self, word: str) -> Letter:
        weight = self.lexicon.weight(word)
        if weight:
            return INSULT, weight, 0.0
        kind = _KINDS.get(word, OTHER)
        return kind, THREAT_WEIGHT if kind == VERB else 0.0, 0.0

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """log of summed clause scores, best clause, log of distinct words, weakened part."""
        if not text:
            return (0.0, 0.0, 0.0, 0.0)
        low = text.lower()
        total = best = weak = 0.0
        found = set()
        for begin, stop in self.clauses(low):
            words = [m.group() for m in _WORD.finditer(low, begin, stop)]
            letters = [self.letter(w) for w in words]
            found.update(w for w, x in zip(words, letters) if x[0] == INSULT)
            score, weakened = clause_score(letters)
            total += score
            weak += weakened
            best = max(best, score)
        return (math.log1p(total), best, math.log1p(len(found)), math.log1p(weak))

    def __getstate__(self):
        return {"lexicon": self.lexicon, "machine": None}


def _distinct_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _class_counts(train: DataFrame, stems: bool, known: set[str]) -> dict[str, tuple[int, int]]:
    """Documents of each class that hold a word (or stem of a word not yet known)."""

    def count(batches):
        for pdf in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                words = _distinct_words(text or "") - known
                if stems:
                    words = {w[:k] for w in words for k in range(MIN_STEM, min(len(w), MAX_STEM) + 1)}
                for w in words:
                    seen.setdefault(w, [0, 0])[toxic] += 1
            if seen:
                yield pd.DataFrame(
                    [(w, a, b) for w, (a, b) in seen.items()], columns=["word", "clean", "toxic"]
                )

    rows = (
        train.mapInPandas(count, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter("toxic >= 4 AND toxic >= 0.5 * (toxic + clean)")
        .collect()
    )
    return {r["word"]: (r["clean"], r["toxic"]) for r in rows}


def _log_odds(clean: int, toxic: int, n: tuple[int, int]) -> float:
    return math.log((toxic + 0.5) / (n[1] + 1)) - math.log((clean + 0.5) / (n[0] + 1))


def learn_lexicon(train: DataFrame, n: tuple[int, int], least_odds: float = 2.5) -> Lexicon:
    """Whole words that clearly mark toxic documents, then stems among the other words."""
    counts = _class_counts(train, False, set())
    words = {
        w: o for w, (c, t) in counts.items()
        if t >= 6 and c <= t // 6 and (o := _log_odds(c, t, n)) >= least_odds
    }
    stems: dict[str, float] = {}
    for s, (c, t) in sorted(_class_counts(train, True, set(words)).items(), key=lambda x: len(x[0])):
        odds = _log_odds(c, t, n)
        shorter = max((stems.get(s[:k], 0.0) for k in range(MIN_STEM, len(s))), default=0.0)
        if odds >= least_odds and c <= t and (not shorter or odds > shorter + 0.5):
            stems[s] = odds
    return Lexicon(words, stems)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge on all but the intercept (last)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = ridge * np.diag([*[1.0] * (x.shape[1] - 1), 1e-6])
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b
        )
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return b


@dataclass
class Model:
    scorer: Scorer
    curve: list[float]

    def probability(self, texts) -> np.ndarray:
        x = np.array([self.scorer.features(t) for t in texts], dtype=float).reshape(-1, 4)
        z = x @ np.array(self.curve[:4]) + self.curve[4]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(
    docs: DataFrame, labels: DataFrame, max_training_rows: int = 24_000, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Fit lexicon and curve on ``labels`` (already restricted to training rows)."""
    spark = docs.sparkSession
    ship(spark)
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .filter("id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_order", F.md5(F.col("id").cast("string")))
        .orderBy("_order", "id")
        .limit(max_training_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").persist()  # max_training_rows bounds it
    try:
        half = F.substring("_order", -1, 1) < "8"
        n = {r["toxic"]: r["n"] for r in
             rows.filter(half).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        everything = {r["toxic"]: r["n"] for r in
                      rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not everything.get(1) or not everything.get(0):
            flat = 30.0 if everything.get(1) else -30.0
            return Model(Scorer(Lexicon()), [0.0, 0.0, 0.0, 0.0, flat])
        lexicon = learn_lexicon(
            rows.filter(half).select("text", "toxic"), (n.get(0, 0), n.get(1, 0))
        )
        scorer = Scorer(lexicon)

        def measure(batches):
            for pdf in batches:
                f = [scorer.features(t) for t in pdf["text"]]
                yield pd.DataFrame(f, columns=["a", "b", "c", "d"]).assign(
                    y=pdf["toxic"].to_numpy(dtype=float)
                )

        seen = rows.filter(~half).mapInPandas(
            measure, "a double, b double, c double, d double, y double"
        ).toPandas()  # at most max_training_rows rows of five numbers
        if seen["y"].nunique() < 2:
            share = everything.get(1, 0) / sum(everything.values())
            return Model(scorer, [0.5, 0.5, 0.5, 0.0, math.log(share / (1 - share))])
        x = seen[["a", "b", "c", "d"]].to_numpy()
        return Model(scorer, fit_logistic(x, seen["y"].to_numpy()).tolist())
    finally:
        rows.unpersist()


def score(
    docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text"
) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probability(texts))

    kept = docs.drop(*({"score", "predicted"} & set(docs.columns)))
    return kept.withColumn("score", probability(F.col(text_col))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def classify(
    docs: DataFrame, labels: DataFrame, train_on: Column, threshold: float = 0.7,
    max_training_rows: int = 24_000,
) -> DataFrame:
    """Train on the labelled rows where ``train_on`` holds, score every document."""
    return score(docs, train(docs, labels.filter(train_on), max_training_rows), threshold)
