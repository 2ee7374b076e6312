"""Toxicity of documents by a weighted grammar of finite-state transducers."""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.quality import fold, labelled_sample

#: At most this many labelled documents are fitted to, the first by a hash of their id.
TRAIN_DOCS = 6000
THRESHOLD = 0.3
#: Every fourth document by checksum is held out.
FOLDS, HELD_OUT = 4, 2
LEAST_PIECE, MOST_PIECE = 4, 12
MOST_PIECES = 2000

#: Symbols that the transducers read and write. Lower case is what a negation or a
#: report has weakened; an aimed threat is one with a target in its clause.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, WEAK_INSULT, WEAK_THREAT, AIMED = "OITPNRitK"
SYMBOLS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, WEAK_INSULT, WEAK_THREAT, AIMED)

#: Words of the closed classes, in the four languages of the corpus.
WORDS = {
    THREAT: "kill kills killed murder stab shoot strangle umbringen töten erschießen erstechen "
    "tuer étrangler poignarder matar apuñalar degollar",
    TARGET: "you your yourself he him she her they them u ur du dich dir ihr euch ihn sie "
    "tu te toi vous lui ti usted ustedes él ella vosotros",
    NEGATION: "not no never nor neither isn't aren't don't nicht kein keine nie niemals "
    "pas jamais aucun ni nunca jamás tampoco",
    REPORT: "said says told wrote claimed quoted reported allegedly sagte schrieb behauptete "
    "zitierte dit écrit affirmé cité dijo escribió afirmó citó",
}
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.;:!?\n]")
_STATES_AFTER_NEGATION = 3


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol) -> (state, symbol, plus, times).

    An arc adds ``plus`` and ``times`` the weight of the word it reads to the weight of
    the path. A symbol without an arc is passed on and leaves the state as it is.
    """

    arcs: dict[tuple[int, str], tuple[int, str, float, float]]

    def step(self, state: int, symbol: str) -> tuple[int, str, float, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0, 0.0))

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes; weights add up."""
        numbers = {(0, 0): 0}
        waiting, arcs = [(0, 0)], {}
        while waiting:
            pair = waiting.pop()
            for symbol in SYMBOLS:
                mine, between, plus, times = self.step(pair[0], symbol)
                its, out, more, factor = other.step(pair[1], between)
                if (mine, its) not in numbers:
                    numbers[mine, its] = len(numbers)
                    waiting.append((mine, its))
                arcs[numbers[pair], symbol] = (numbers[mine, its], out, plus + more, times + factor)
        return Transducer(arcs)


def _negations() -> Transducer:
    """An insult or threat within a few words after a negation is weakened."""
    arcs = {}
    for state in range(_STATES_AFTER_NEGATION + 1):
        arcs[state, NEGATION] = (_STATES_AFTER_NEGATION, OTHER, 0.0, 0.0)
        if state:
            arcs |= {(state, symbol): (state - 1, symbol, 0.0, 0.0) for symbol in SYMBOLS if symbol != NEGATION}
            arcs[state, INSULT] = (0, WEAK_INSULT, 0.0, 0.0)
            arcs[state, THREAT] = (0, WEAK_THREAT, 0.0, 0.0)
    return Transducer(arcs)


def _reports() -> Transducer:
    """What follows a verb of speech in its clause is weakened."""
    return Transducer(
        {
            (0, REPORT): (1, OTHER, 0.0, 0.0),
            (1, REPORT): (1, OTHER, 0.0, 0.0),
            (1, INSULT): (1, WEAK_INSULT, 0.0, 0.0),
            (1, THREAT): (1, WEAK_THREAT, 0.0, 0.0),
        }
    )


def _targets() -> Transducer:
    """A target before or after an insult adds to it, and makes a threat an aimed one."""
    none, target, threat, insult = range(4)
    return Transducer(
        {
            (none, TARGET): (target, OTHER, 0.0, 0.0),
            (none, THREAT): (threat, THREAT, 0.0, 0.0),
            (none, INSULT): (insult, INSULT, 0.0, 0.0),
            (target, INSULT): (target, INSULT, 0.5, 0.0),
            (target, THREAT): (target, AIMED, 0.0, 0.0),
            (threat, TARGET): (target, AIMED, 0.0, 0.0),
            (insult, TARGET): (target, OTHER, 0.5, 0.0),
            (insult, THREAT): (threat, THREAT, 0.0, 0.0),
        }
    )


def _insults() -> Transducer:
    """Weighs insults by their word; a weakened one counts for half."""
    return Transducer({(0, INSULT): (0, OTHER, 0.0, 1.0), (0, WEAK_INSULT): (0, OTHER, 0.0, 0.5)})


def _threats() -> Transducer:
    return Transducer({(0, AIMED): (0, OTHER, 4.0, 0.0), (0, WEAK_THREAT): (0, OTHER, 0.0, 0.0)})


GRAMMAR = _negations().then(_reports()).then(_targets()).then(_insults()).then(_threats())
_CLOSED = {word: symbol for symbol, words in WORDS.items() for word in words.split()}


@dataclass
class ToxicityModel:
    """Weights of insulting words by how they begin, and the calibration.

    A piece that ends in ``$`` is a whole word.
    """

    pieces: dict[str, float]
    offset: float
    slopes: tuple[float, float]

    @functools.cached_property
    def _finder(self) -> ahocorasick.Automaton:
        finder = ahocorasick.Automaton()
        for piece in self.pieces:
            finder.add_word(piece.rstrip("$"), len(piece.rstrip("$")))
        for word in WORDS[THREAT].split():
            finder.add_word(word, len(word))
        finder.make_automaton()
        return finder

    def __getstate__(self) -> dict:
        # Built again where it is needed.
        return {k: v for k, v in self.__dict__.items() if k != "_finder"}

    def _insult(self, word: str) -> float:
        marked = word + "$"
        ends = range(LEAST_PIECE, min(len(marked), MOST_PIECE) + 1)
        return max((self.pieces.get(marked[:end], 0.0) for end in ends), default=0.0)

    def clause(self, text: str) -> float:
        """Weight of the path that the grammar takes through a clause."""
        state, total = 0, 0.0
        for word in _WORD.findall(text):
            weight = self._insult(word)
            symbol = INSULT if weight else _CLOSED.get(word, OTHER)
            state, _, plus, times = GRAMMAR.step(state, symbol)
            total += plus + times * weight
        return max(total, 0.0)

    def clauses(self, text: str) -> list[float]:
        """Weights of the clauses that match; only these are read word by word."""
        lowered = text.lower()
        found, done = [], 0
        for end, size in self._finder.iter(lowered):
            start = end - size + 1
            if start < done or (start and lowered[start - 1].isalpha()):
                continue
            first = max(lowered.rfind(char, 0, start) for char in ".;:!?\n") + 1
            stop = _CLAUSE_END.search(lowered, end)
            done = stop.start() if stop else len(lowered)
            weight = self.clause(lowered[first:done])
            if weight:
                found.append(weight)
        return found

    def evidence(self, text: str) -> tuple[float, float]:
        found = self.clauses(text)
        return (math.log1p(sum(found)), math.log1p(max(found))) if found else (0.0, 0.0)

    def toxicity(self, text: str | None) -> float:
        total, most = self.evidence(text or "")
        return 1 / (1 + math.exp(-self.offset - self.slopes[0] * total - self.slopes[1] * most))


def _kinds(texts: Sequence[str]) -> list[int]:
    """A number per text that near copies share, so that they count as one text."""
    parents = list(range(len(texts)))

    def top(i: int) -> int:
        while parents[i] != i:
            parents[i] = parents[parents[i]]
            i = parents[i]
        return i

    firsts: dict[tuple[int, int], int] = {}
    factors = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)
    for i, text in enumerate(texts):
        words = text.split()
        shingles = {zlib.crc32(" ".join(words[k : k + 3]).encode()) for k in range(max(1, len(words) - 2))}
        for number, factor in enumerate(factors):
            least = min((s ^ (s >> 15)) * factor & 0xFFFFFFFF for s in shingles)
            other = firsts.setdefault((number, least), i)
            a, b = top(i), top(other)
            parents[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def _pieces_of(text: str) -> set[str]:
    found = set()
    for word in set(_WORD.findall(text.lower())):
        marked = word + "$"
        found.update(marked[:end] for end in range(LEAST_PIECE, min(len(marked), MOST_PIECE) + 1))
    return found


def _gain(a: int, b: int, all_a: int, all_b: int) -> float:
    """Likelihood ratio of a piece that holds in a of all_a toxic and b of all_b other texts."""
    total, rest = 0.0, all_a + all_b
    for seen, row, column in (
        (a, a + b, all_a), (b, a + b, all_b), (all_a - a, rest - a - b, all_a), (all_b - b, rest - a - b, all_b)
    ):
        if seen:
            total += seen * math.log(seen * rest / (row * column))
    return 2 * total


def learned_pieces(texts: Sequence[str], labels: Sequence[int]) -> dict[str, float]:
    """Beginnings of words that toxic texts have far more often, with their log odds.

    Near copies count once. A beginning has to stand out against all that were
    looked at. It is made as long as it can be without losing texts.
    """
    toxic, others = Counter(), Counter()
    kinds = {}
    for text, label, kind in zip(texts, labels, _kinds(texts), strict=True):
        kinds.setdefault((kind, label), text)
    for (_, label), text in kinds.items():
        (toxic if label else others).update(_pieces_of(text))
    all_toxic = sum(label for _, label in kinds)
    all_others = len(kinds) - all_toxic
    least = 2 * (math.log(max(2, len(toxic))) + 3)

    def weight(piece: str) -> float:
        a, b = toxic[piece], others[piece]
        return math.log((a + 0.5) / (all_toxic + 1)) - math.log((b + 0.5) / (all_others + 1))

    good = {
        piece: weight(piece)
        for piece, n in toxic.items()
        if n >= 3 and weight(piece) > 2 and _gain(n, others[piece], all_toxic, all_others) > least
    }
    longer = {piece[:-1] for piece in good if toxic[piece] >= 0.9 * toxic[piece[:-1]]}
    kept = {piece: w for piece, w in good.items() if piece not in longer}
    # What begins like a kept piece of nearly its weight adds nothing.
    found: dict[str, float] = {}
    for piece in sorted(kept, key=len):
        shorter = [found[piece[:n]] for n in range(LEAST_PIECE, len(piece)) if piece[:n] in found]
        if not shorter or kept[piece] > max(shorter) + 1:
            found[piece] = kept[piece]
    best = sorted(found, key=lambda piece: (-found[piece], piece))[:MOST_PIECES]
    return {piece: found[piece] for piece in best}


def _logistic(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    params = np.zeros(rows.shape[1])
    held = np.array([1e-3] + [0.02] * (rows.shape[1] - 1))
    for _ in range(50):
        likely = 1 / (1 + np.exp(-rows @ params))
        slope = rows.T @ (labels - likely) - held * params
        curve = (rows * (likely * (1 - likely) + 1e-6)[:, None]).T @ rows + np.diag(held)
        params = params + np.clip(np.linalg.solve(curve, slope), -1, 1)
    return params


def trained(texts: Sequence[str], labels: Sequence[int]) -> ToxicityModel:
    """Fit the weights of insults and the calibration to labelled texts.

    With no labels at all a text without a match scores 0.05; with one label only,
    the share of it.
    """
    model = ToxicityModel(learned_pieces(texts, labels), -3.0, (0.5, 0.5))
    if not texts:
        return model
    rows = np.array([(1.0, *model.evidence(text)) for text in texts])
    params = _logistic(rows, np.array(labels, float))
    # A match never makes a text less toxic.
    if min(params[1:]) < 0:
        both = _logistic(np.stack([rows[:, 0], rows[:, 1:].sum(axis=1)], axis=1), np.array(labels, float))
        params = np.array([both[0], max(both[1], 0.0), max(both[1], 0.0)])
    return ToxicityModel(model.pieces, float(params[0]), (float(params[1]), float(params[2])))


def with_toxicity(documents: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that a document is toxic.

    NULL and empty texts have no clause and get the score of a text without a match.
    Rows are scored one by one, so repeated rows get equal scores.
    """

    def scores(column: Iterable[str | None]) -> list[float]:
        return [model.toxicity(value) for value in column]

    @F.pandas_udf("double")
    def toxicity(column: pd.Series) -> pd.Series:
        return pd.Series(scores(column.tolist()), index=column.index, dtype="float64")

    return documents.withColumn(name, toxicity(F.col(text)))


def toxicity_model(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return trained(*labelled_sample(documents, labels, "toxic", FOLDS, HELD_OUT, TRAIN_DOCS))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_toxicity(documents, toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
