"""The two classifiers: their parts against brute force, and held-out rows."""

import itertools
import random
import zlib

import numpy as np
import pytest

from compare import SF_DIR
from tallybrook.llm import quality, toxicity
from tallybrook.llm.catalog import QUERIES

ODD = [None, "", "\n\n", "word", "x" * 300_000, "a\n" * 5_000, "\U0001f600 ́", "no end"]


def test_marginals_are_sums_over_all_labellings():
    generator = np.random.default_rng(1)
    scores, links = generator.normal(size=(1, 6, 2)), generator.normal(size=(2, 2))
    there = np.array([[True] * 5 + [False]])
    alone, pairs = quality.marginals(scores, there, links)
    total, ones, both = 0.0, np.zeros(5), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=5):
        weight = sum(scores[0, t, y] for t, y in enumerate(labels))
        weight = np.exp(weight + sum(links[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        total += weight
        ones += weight * np.array(labels)
        for a, b in zip(labels, labels[1:], strict=False):
            both[a, b] += weight
    assert np.allclose(alone[0, :5, 1], ones / total)
    assert np.allclose(pairs, both / total)


def test_neighbours_decide_a_line():
    good = "The house is old and stands by the river.\nIt has a garden."
    bad = "BUY!!! NOW!!! ### $$$\nCLICK!!! HERE!!! @@@"
    model = quality.trained([good, bad] * 20, [1, 0] * 20)
    high, low = model.quality([good, bad])
    assert high > 0.9 and low < 0.1
    rows, _, counts = quality.line_features([bad + "\nfine", good + "\nfine"])
    lines = model.good_lines(rows, counts)
    assert lines[2] < lines[5]


@pytest.mark.parametrize("known", [([], []), (["a", "b"], [1, 1]), (["a"], [0])])
def test_models_without_both_labels_score_everything(known):
    for score in (quality.trained(*known).quality, lambda texts: [toxicity.trained(*known).toxicity(t) for t in texts]):
        found = list(score([text or "" for text in ODD]))
        assert all(0 <= value <= 1 for value in found)


def test_composition_is_one_machine_after_the_other():
    parts = [toxicity._negations(), toxicity._reports(), toxicity._targets(), toxicity._insults(), toxicity._threats()]
    for symbols in itertools.product("OITPNR", repeat=4):
        states, total = [0] * len(parts), 0.0
        for symbol in symbols:
            for i, part in enumerate(parts):
                states[i], symbol, plus, times = part.step(states[i], symbol)
                total += plus + 3.0 * times
        state, whole = 0, 0.0
        for symbol in symbols:
            state, _, plus, times = toxicity.GRAMMAR.step(state, symbol)
            whole += plus + 3.0 * times
        assert whole == pytest.approx(total)


def test_clauses_weigh_more_or_less_by_what_stands_around():
    model = toxicity.ToxicityModel({"moron$": 6.0, "idio": 5.0}, -4.0, (2.0, 2.0))
    weight = model.clause
    assert weight("what a moron") < weight("you moron")
    assert weight("he is not a moron") < weight("what a moron")
    assert weight("she said what a moron") < weight("what a moron")
    assert weight("kill the process") == 0 < weight("i will kill you")
    assert model.clauses("fine. you idiots! moronic. oxymoron") == [5.5]


@pytest.mark.parametrize(
    ("name", "label", "folds", "held_out", "least"),
    [("op1_toxicity", "toxic", 4, 2, 0.9), ("op4_quality", "quality", 5, 0, 0.9)],
)
def test_held_out_rows(spark, name, label, folds, held_out, least):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    rows = {row.doc_id: row for row in QUERIES[name](spark, folder).collect()}
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(rows) == documents.count()
    for doc_id, row in rows.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % folds == held_out)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(row[label], rows[row.doc_id].predicted) for row in labels if rows[row.doc_id].held_out]
    assert sum(a == b for a, b in held) >= least * len(held)


def test_odd_rows_are_scored(spark):
    rows = [(i, text, "s", 0) for i, text in enumerate(ODD)] + [(3, "word", "s", 0), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, score long")
    model = quality.trained(["good line.", "BAD!!! ###"] * 9, [1, 0] * 9)
    toxic = toxicity.trained(["you moron", "a fine day"] * 9, [1, 0] * 9)
    for scored in (quality.with_quality(df, model, name="p"), toxicity.with_toxicity(df, toxic, name="p")):
        found = scored.select("doc_id", "score", "p").collect()
        assert len(found) == len(rows) and all(0 <= row.p <= 1 for row in found)
        assert len({row.p for row in found if row.doc_id == 3}) == 1


def test_toxicity_ranks_held_out_rows(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.1")
    scored = QUERIES["op1_toxicity"](spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic IS NOT NULL")
    rows = scored.join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    bad = sorted(row.score for row in rows if row.toxic)
    good = sorted(row.score for row in rows if not row.toxic)
    wins = sum((b > g) + (b == g) / 2 for b in bad for g in good)
    assert wins >= 0.9 * len(bad) * len(good)
    caught = sum(row.predicted for row in rows if row.toxic)
    assert caught >= 0.8 * len(bad) and caught >= 0.8 * sum(row.predicted for row in rows)


_FITTED = """
import random
from tallybrook.llm import toxicity
draw = random.Random(1)
def text(marks):
    words = ["w%d" % draw.randrange(4000) for _ in range(40)]
    return " ".join(words[:20] + ["you", draw.choice(marks)] + words[20:])
texts = [text(["zorkel", "grimbat", "vexling"]) for _ in range(150)] + [text(["garden", "bridge"]) for _ in range(150)]
model = toxicity.trained(texts, [1] * 150 + [0] * 150)
print(sorted(model.pieces.items()), [model.toxicity(text) for text in texts[::17]])
"""


def test_another_process_learns_the_same():
    import os
    import subprocess
    import sys

    def fitted(seed):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        env = {**os.environ, "PYTHONHASHSEED": seed, "PYTHONPATH": root}
        return subprocess.run([sys.executable, "-c", _FITTED], env=env, capture_output=True, text=True, check=True).stdout

    assert fitted("1") == fitted("2") and "zorkel" in fitted("3")


def test_clauses_without_a_match_weigh_nothing():
    model = toxicity.ToxicityModel({"moron$": 6.0, "idio": 5.0}, -4.0, (2.0, 2.0))
    generator = random.Random(3)
    words = ["you", "moron", "idiots", "not", "he", "said", "i", "will", "kill", "the", "process", "fine", "them", "all"]
    for _ in range(500):
        clauses = [" ".join(generator.choices(words, k=generator.randrange(1, 8))) for _ in range(6)]
        every = [weight for weight in map(model.clause, clauses) if weight]
        assert model.clauses("; ".join(clauses)) == every


def test_a_repeated_id_is_bounded_before_the_driver(spark):
    documents = spark.createDataFrame([(1, f"text {i:03}") for i in range(300)] + [(2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    texts, known = quality.labelled_sample(documents, labels, "quality", 5, 9, 50)
    assert texts == [f"text {i:03}" for i in range(50)] and known == [1] * 50
