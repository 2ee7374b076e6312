"""Document quality from a linear-chain conditional random field over its lines."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import table

#: At most this many labelled documents are fitted to, the first by a hash of their id.
TRAIN_DOCS = 4000
THRESHOLD = 0.3
#: Every fifth document by checksum is held out.
FOLDS, HELD_OUT = 5, 0
_STEPS = 150
_CHARS_AT_ONCE = 1_000_000
_OTHER, _SPACE, _LOWER, _UPPER, _DIGIT, _POINT, _BANG = range(7)
_NEIGHBOUR = [2, 3, 5, 7, 8, 9, 12, 14]
_OWN = 15


_TABLES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Class by code point; those above the basic plane are one class with symbols."""
    if _TABLES:
        return _TABLES[0]
    kinds = np.zeros(0x10001, np.uint8)
    for code in range(0x10000):
        char = chr(code)
        if char.isspace():
            kinds[code] = _SPACE
        elif char.isupper():
            kinds[code] = _UPPER
        elif char.isalpha() or unicodedata.category(char) == "Mn":
            kinds[code] = _LOWER
        elif char.isdigit():
            kinds[code] = _DIGIT
    for char in ".,;:'\"?-()":
        kinds[ord(char)] = _POINT
    kinds[ord("!")] = _BANG
    _TABLES.append(kinds)
    return kinds


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(features, lengths, lines per text)`` of the lines of all texts in order.

    A line's features are shares of kinds of characters, lengths, its first and last
    character, whether the text had it before, words that repeat the one before them,
    and most of these of the lines beside it.
    """
    counts = np.array([text.count("\n") + 1 for text in texts])
    whole = "\n".join(texts) + "\n"
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kinds = _classes()[np.minimum(codes, 0x10000)]
    ends = np.flatnonzero(codes == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = (ends - starts).astype(float)

    def per_line(flags: np.ndarray) -> np.ndarray:
        # Sums over a line with its line break, which is only a blank.
        return np.add.reduceat(flags.astype(np.int64), starts).astype(float)

    spaces = kinds == _SPACE
    blanks = per_line(spaces) - 1
    filled = np.maximum(lengths - blanks, 1.0)
    word_starts = ~spaces & np.concatenate(([True], spaces[:-1]))
    words = per_line(word_starts)
    pipes = per_line(codes == ord("|"))
    seen_before, echoed = np.zeros(len(starts)), np.zeros(len(starts))
    place = 0
    for text in texts:
        known: set[str] = set()
        for line in text.split("\n"):
            if line.strip():
                seen_before[place] = line in known
                known.add(line)
                parts = line.split()
                echoed[place] = sum(map(str.__eq__, parts, parts[1:])) / len(parts)
            place += 1
    first = kinds[starts]
    last = codes[np.maximum(ends - 1, starts)]
    own = np.empty((len(starts), _OWN))
    own[:, 0] = 1.0
    own[:, 1] = np.log1p(lengths) / 5
    own[:, 2] = np.sqrt(per_line(kinds == _OTHER) / filled)
    own[:, 3] = np.sqrt(per_line(kinds == _UPPER) / filled)
    own[:, 4] = np.sqrt(per_line(kinds == _DIGIT) / filled)
    own[:, 5] = np.sqrt(per_line(kinds == _POINT) / filled)
    own[:, 6] = np.minimum(filled / np.maximum(words, 1.0) / 10, 3.0)
    own[:, 7] = np.sqrt(per_line(kinds == _BANG) / filled)
    own[:, 8] = first == _UPPER
    own[:, 9] = np.isin(last, [ord(c) for c in ".!?:\"'"])
    own[:, 10] = np.sqrt(pipes / filled)
    own[:, 11] = words == 0
    own[:, 12] = seen_before
    own[:, 13] = np.log1p(words) / 5
    own[:, 14] = np.sqrt(echoed)
    before = np.vstack([np.zeros(_OWN), own[:-1]])
    after = np.vstack([own[1:], np.zeros(_OWN)])
    ends_of = np.cumsum(counts)
    before[np.concatenate(([0], ends_of[:-1]))] = 0
    after[ends_of - 1] = 0
    # The bias of a neighbour says whether there is one.
    beside = [0, *_NEIGHBOUR]
    return np.hstack([own, before[:, beside], after[:, beside]]), lengths, counts


def _padded(values: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of like length together: ``(index of lines, which are there, texts)``."""
    starts = np.cumsum(counts) - counts
    sizes = np.ceil(np.log2(np.maximum(counts, 4))).astype(int)
    for size in np.unique(sizes):
        texts = np.flatnonzero(sizes == size)
        longest = counts[texts].max()
        steps = np.arange(longest)
        there = steps[None, :] < counts[texts][:, None]
        yield np.where(there, starts[texts][:, None] + steps, 0), there, texts


def marginals(
    scores: np.ndarray, there: np.ndarray, links: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: P(label) of lines, sums of P(pair of labels)."""
    chains, steps, _ = scores.shape
    ahead = np.zeros_like(scores)
    back = np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, steps):
        came = np.logaddexp(ahead[:, t - 1, 0, None] + links[0], ahead[:, t - 1, 1, None] + links[1])
        ahead[:, t] = np.where(there[:, t, None], came + scores[:, t], ahead[:, t - 1])
    for t in range(steps - 2, -1, -1):
        after = scores[:, t + 1] + back[:, t + 1]
        goes = np.logaddexp(links[:, 0] + after[:, 0, None], links[:, 1] + after[:, 1, None])
        back[:, t] = np.where(there[:, t + 1, None], goes, 0.0)
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    alone = np.exp(ahead + back - total[:, None, None])
    pairs = np.zeros((2, 2))
    if steps > 1:
        joint = (
            ahead[:, :-1, :, None] + links + (scores + back)[:, 1:, None, :] - total[:, None, None, None]
        )
        pairs = (np.exp(np.minimum(joint, 0.0)) * there[:, 1:, None, None]).sum(axis=(0, 1))
    return alone, pairs


@dataclass
class LineModel:
    """Weights of the lines' labels (bad, good), of pairs of labels, and the calibration."""

    weights: np.ndarray
    links: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def good_lines(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        good = np.empty(len(rows))
        scores = rows @ self.weights
        for index, there, _ in _padded(rows, counts):
            alone, _ = marginals(scores[index], there, self.links)
            good[index[there]] = alone[..., 1][there]
        return good

    def evidence(self, texts: Sequence[str]) -> np.ndarray:
        """Log odds of the length-weighted mean of the lines' marginals, per text."""
        rows, lengths, counts = line_features(texts)
        return self._evidence(self.good_lines(rows, counts), lengths, counts)

    @staticmethod
    def _evidence(good: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        starts = np.cumsum(counts) - counts
        weight = lengths + 1.0
        mean = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def quality(self, texts: Sequence[str]) -> np.ndarray:
        scores = np.empty(len(texts))
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= _CHARS_AT_ONCE):
                size += len(texts[end])
                end += 1
            found = self.slope * self.evidence(texts[start:end]) + self.offset
            scores[start:end] = 1 / (1 + np.exp(-found))
            start = end
        return scores


def _fit_lines(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, start: LineModel) -> LineModel:
    """Maximum likelihood by Adam, with a small penalty on the weights."""
    groups = list(_padded(rows, counts))
    params = np.concatenate([start.weights.ravel(), start.links.ravel()])
    split = start.weights.size
    wanted = np.stack([1 - labels, labels], axis=1)
    pairs = np.zeros((2, 2))
    for index, there, _ in groups:
        mine = wanted[index] * there[..., None]
        pairs += np.einsum("ntk,ntl->kl", mine[:, :-1], mine[:, 1:])
    speed, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, _STEPS + 1):
        weights, links = params[:split].reshape(-1, 2), params[split:].reshape(2, 2)
        scores, likely, seen = rows @ weights, np.empty_like(wanted), np.zeros((2, 2))
        for index, there, _ in groups:
            alone, both = marginals(scores[index], there, links)
            likely[index[there]] = alone[there]
            seen += both
        slope = np.concatenate([(rows.T @ (wanted - likely)).ravel(), (pairs - seen).ravel()])
        slope = slope / len(rows) - 1e-4 * params
        speed = 0.9 * speed + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        params = params + 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return LineModel(params[:split].reshape(-1, 2), params[split:].reshape(2, 2))


def _calibrated(model: LineModel, evidence: np.ndarray, labels: np.ndarray) -> LineModel:
    """Newton steps of a logistic regression on the evidence, slightly held back."""
    rows = np.stack([evidence, np.ones_like(evidence)], axis=1)
    params = np.array([1.0, 0.0])
    for _ in range(25):
        likely = 1 / (1 + np.exp(-rows @ params))
        slope = rows.T @ (labels - likely) - 0.1 * (params - [1.0, 0.0])
        curve = (rows * (likely * (1 - likely))[:, None]).T @ rows + 0.1 * np.eye(2)
        params = params + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return LineModel(model.weights, model.links, float(params[0]), float(params[1]))


def trained(texts: Sequence[str], labels: Sequence[int], rounds: int = 2) -> LineModel:
    """Fit to documents of known quality.

    Lines begin with their document's label. A line of a bad document that the
    model then takes for good counts as good in the next round; the worst line of
    a bad document stays bad. Without both labels every text gets the share of
    good ones, or 0.5.
    """
    known = np.array(labels, float)
    size = _OWN + 2 * (len(_NEIGHBOUR) + 1)
    model = LineModel(np.zeros((size, 2)), np.zeros((2, 2)))
    if len(known) == 0 or known.min() == known.max():
        share = (known.sum() + 1) / (len(known) + 2)
        return LineModel(model.weights, model.links, 0.0, float(np.log(share / (1 - share))))
    rows, lengths, counts = line_features(texts)
    of_text = np.repeat(known, counts)
    wanted = of_text
    starts = np.cumsum(counts) - counts
    for _ in range(rounds):
        model = _fit_lines(rows, counts, wanted, model)
        good = model.good_lines(rows, counts)
        worst = np.repeat(np.minimum.reduceat(good, starts), counts)
        wanted = np.where((of_text == 0) & (good > 0.5) & (good > worst), 1.0, of_text)
    evidence = LineModel._evidence(model.good_lines(rows, counts), lengths, counts)
    return _calibrated(model, evidence, known)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``most`` labelled rows outside the held-out fold."""
    usable = labels.filter(F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    chosen = usable.select("doc_id", label).orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(most)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # An id may have any number of rows, so they are bounded before they come to the driver.
    found = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), label)
    found = found.orderBy("doc_id", "text").limit(most).toPandas()
    return list(found["text"]), [int(x > 0) for x in found[label]]


def with_quality(documents: DataFrame, model: LineModel, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability that a document is good.

    NULL and empty texts have one empty line and get a score like any other.
    Rows are scored one by one, so repeated rows get equal scores.
    """

    @F.pandas_udf("double")
    def quality(column: pd.Series) -> pd.Series:
        return pd.Series(model.quality(column.fillna("").tolist()), index=column.index)

    return documents.withColumn(name, quality(F.col(text)))


def quality_model(spark: SparkSession, sf_dir: str) -> LineModel:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    texts, known = labelled_sample(documents, labels, "quality", FOLDS, HELD_OUT, TRAIN_DOCS)
    return trained(texts, known)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_quality(documents, quality_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
