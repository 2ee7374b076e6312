"""Remove word sequences that the corpus already had, by suffix automata of routed shards.

Texts are cut into segments by content: the windows that share their least run of
``ANCHOR`` words. Equal windows have equal least runs, so all texts with a window meet
it in the shard of its anchor, and only there. A shard's automaton stands for what its
texts had so far; the next segment is streamed through it for matching statistics
before it is added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.shingles import WordHashes, runs, split_words
from tallybrook.scratch import released, written

WINDOW = 20
ANCHOR = 8
#: A shard with more distinct segments is cut further, by whole windows.
MOST_SEGMENTS = 512

_TEXTS_AT_ONCE = 500

_CUTS = "doc_id long, row long, cuts array<struct<key: long, start: int, size: int, content: long>>"
_SEGMENTS = "key long, doc_id long, row long, start int, words array<long>"
_SPAN = "doc_id long, row long, start int, size int"


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self) -> None:
        self._next: list[dict[int, int]] = [{}]
        self._link = [-1]
        self._length = [0]

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self._next.append(arcs)
        self._link.append(link)
        self._length.append(length)
        return len(self._length) - 1

    def _split(self, before: int, symbol: int, state: int) -> int:
        """A copy of ``state`` for its strings of the length that ``before`` allows."""
        copy = self._state(self._length[before] + 1, self._link[state], dict(self._next[state]))
        self._link[state] = copy
        while before >= 0 and self._next[before].get(symbol) == state:
            self._next[before][symbol] = copy
            before = self._link[before]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for symbol in sequence:
            state = self._next[last].get(symbol)
            if state is not None:
                fits = self._length[state] == self._length[last] + 1
                last = state if fits else self._split(last, symbol, state)
                continue
            new, before = self._state(self._length[last] + 1, 0, {}), last
            while before >= 0 and symbol not in self._next[before]:
                self._next[before][symbol] = new
                before = self._link[before]
            if before >= 0:
                state = self._next[before][symbol]
                fits = self._length[state] == self._length[before] + 1
                self._link[new] = state if fits else self._split(before, symbol, state)
            last = new

    def matches(self, sequence: list[int]) -> list[int]:
        """Matching statistics: the longest known string that ends at each place."""
        state, length, found = 0, 0, []
        for symbol in sequence:
            while state and symbol not in self._next[state]:
                state = self._link[state]
                length = self._length[state]
            if symbol in self._next[state]:
                state = self._next[state][symbol]
                length += 1
            found.append(length)
        return found


def _cuts_of(words: np.ndarray, window: int, anchor: int) -> list[tuple[int, int, int, int]]:
    """``(key, first window, windows, content)`` of the segments of a text."""
    if len(words) < window:
        return []
    grams = runs(words, anchor)
    beside = np.lib.stride_tricks.sliding_window_view(grams, window - anchor + 1)
    # The first of equal ones, so that the choice depends on the window alone.
    least = beside.argmin(axis=1) + np.arange(len(beside))
    starts = np.flatnonzero(np.diff(least, prepend=-1))
    sizes = np.diff(starts, append=len(least))
    keys = grams[least[starts]].view(np.int64)
    # A segment is told by the windows at its ends and its length.
    whole = runs(words, window)
    ends = whole[starts + sizes - 1]
    contents = (whole[starts] * np.uint64(3) + ends * np.uint64(0x9E3779B97F4A7C15) + sizes.astype(np.uint64)).view(np.int64)
    if len(sizes) and sizes.max() > window:
        raise AssertionError("a segment is longer than its windows can be apart")
    return list(zip(keys.tolist(), starts.tolist(), sizes.tolist(), contents.tolist(), strict=True))


def _cut(window: int, anchor: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        # Cuts are Python objects, so only those of a few texts are held at a time.
        for whole in frames:
            for at in range(0, len(whole), _TEXTS_AT_ONCE):
                frame = whole.iloc[at : at + _TEXTS_AT_ONCE]
                cuts = []
                for text in frame["text"]:
                    words = split_words(text)
                    cuts.append(_cuts_of(hashes.of(words, len(words)), window, anchor))
                yield pd.DataFrame({"doc_id": frame["doc_id"], "row": frame["row"], "cuts": cuts})

    return run


def _read(window: int):
    """The words of the segments asked for; of a hot shard each window by itself."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            rows = []
            for doc_id, row, text, wanted in zip(*(frame[c] for c in ("doc_id", "row", "text", "wanted")), strict=True):
                words = split_words(text)
                numbers = hashes.of(words, len(words))
                whole = runs(numbers, window) if len(numbers) >= window else numbers[:0]
                signed = numbers.view(np.int64)
                for item in wanted:
                    start, size = item["start"], item["size"]
                    if item["hot"]:
                        keys = whole[start : start + size].view(np.int64)
                        rows += [(int(key), doc_id, row, start + i, None) for i, key in enumerate(keys)]
                    else:
                        rows.append((item["key"], doc_id, row, start, signed[start : start + size + window - 1]))
            yield pd.DataFrame(rows, columns=["key", "doc_id", "row", "start", "words"])

    return run


def _stream(window: int):
    """Shard by shard, in the order of documents: match each segment, then add it.

    Segments of one place, from repeated rows of a document, are matched before any is added.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, place_of, automaton = None, None, SuffixAutomaton()
        added: list[list[int]] = []
        for frame in frames:
            rows = []
            for key, doc_id, row, start, words in zip(*(frame[c] for c in ("key", "doc_id", "row", "start", "words")), strict=True):
                if key != shard:
                    shard, place_of, automaton, added = key, None, SuffixAutomaton(), []
                if (doc_id, start) != place_of:
                    for known in added:
                        automaton.add(known)
                    place_of, added = (doc_id, start), []
                sequence = words.tolist()
                if sequence in added:
                    continue
                for place, length in enumerate(automaton.matches(sequence)):
                    if length >= window:
                        rows.append((doc_id, row, start + place - window + 1, 1))
                added.append(sequence)
            yield pd.DataFrame(rows, columns=["doc_id", "row", "start", "size"]).astype("int64")

    return run


def _later(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(firsts, spans)``: the first of equal rows, and the places of all others."""
    firsts = rows.groupBy(*keys).agg(F.min(F.struct("doc_id", "start", "size", "row")).alias("first"))
    firsts = written(firsts, "firsts")
    place = F.struct("doc_id", "start")
    spans = rows.join(firsts, keys).filter(place > F.struct("first.doc_id", "first.start"))
    return firsts, spans.select("doc_id", "row", "start", "size")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")


def repeated_spans(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, row, start, size``: runs of windows whose words start earlier elsewhere.

    ``start`` is the first window, by its first word, and ``size`` how many follow each
    other. Earlier means in a document with a smaller id, or before in the same one. ``row``
    is the hash of the text, which tells rows of one id from each other.
    """
    texts = _texts(documents)
    cuts = written(texts.filter("doc_id IS NOT NULL").mapInPandas(_cut(window, anchor), _CUTS), "cuts")
    rows = cuts.select("doc_id", "row", F.explode("cuts").alias("cut")).select("doc_id", "row", "cut.*")
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    met = written(rows.join(often, "key"), "met")
    released(cuts)
    # Segments with the same words: all but the first are known as a whole.
    firsts, spans = _later(met, ["key", "content"])
    several = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wanted = firsts.join(several, "key").select(
        F.col("first.doc_id").alias("doc_id"),
        F.col("first.row").alias("row"),
        F.struct("key", "first.start", "first.size", (F.col("n") > MOST_SEGMENTS).alias("hot")).alias("item"),
    )
    wanted = wanted.groupBy("doc_id", "row").agg(F.collect_list("item").alias("wanted"))
    asked = texts.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "wanted")
    segments = written(asked.mapInPandas(_read(window), _SEGMENTS), "segments")
    shards = segments.filter("words IS NOT NULL").repartition("key").sortWithinPartitions("key", "doc_id", "start")
    matched = shards.mapInPandas(_stream(window), _SPAN)
    single = segments.filter("words IS NULL").select("key", "doc_id", "row", "start", F.lit(1).alias("size"))
    _, cold = _later(single, ["key"])
    return spans.unionByName(matched).unionByName(cold)


def without_repeats(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words that no repeated window covers.

    Words are runs between the six ASCII blanks, taken as they are; ``kept`` joins them
    by one space. A text with fewer words than a window is kept. NULL and blank texts
    have no words. Repeated rows with one id are one document, so neither removes the
    other; rows of one id with several texts lose what they repeat themselves, none
    what another one does. Rows without an id are compared with nothing. Windows go by 64-bit hashes.
    """
    spans = repeated_spans(documents, window, anchor)
    listed = spans.groupBy(F.col("doc_id").alias("of"), F.col("row").alias("of_row")).agg(
        F.collect_list(F.struct("start", "size")).alias("spans")
    )

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def kept(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, known in zip(texts, spans, strict=True):
            words = split_words(text)
            if known is None or not len(words):
                rows.append((len(words), 0, b" ".join(words).decode()))
                continue
            edges = np.zeros(len(words) + 1, np.int64)
            for span in known:
                edges[min(span["start"], len(words))] += 1
                edges[min(span["start"] + span["size"] + window - 1, len(words))] -= 1
            left = [words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]
            rows.append((len(words), len(words) - len(left), b" ".join(left).decode()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    joined = _texts(documents).join(listed, (F.col("doc_id") == F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    return joined.select("doc_id", kept("text", "spans").alias("found")).select("doc_id", "found.*")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
