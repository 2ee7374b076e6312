"""Line, substring and near-duplicate removal against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import jaccard, line_dedup, substrings
from tallybrook.llm.components import components
from tallybrook.llm.substrings import SuffixAutomaton

SCHEMA = "doc_id long, source string, text string, dropped string, host string, n int, node long, component_id long"


def _frame(spark, rows):
    """Rows of id, source and text, with columns whose names the operators use."""
    filled = [(*row, "x", "y", 7, 8, 9) for row in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


def _noise(generator, count, words=400):
    return [f"w{generator.randrange(words)}" for _ in range(count)]


@pytest.fixture(scope="module")
def texts():
    """Ids and texts: copies, near copies with shared and own changes, shared passages, odd ones."""
    generator = random.Random(5)
    base, passage = _noise(generator, 140), _noise(generator, 60)
    rows = [(i, " ".join(_noise(generator, generator.randrange(1, 90)))) for i in range(60)]
    for i in range(60, 130):
        words = list(base)
        for _ in range(generator.randrange(0, 6)):
            words[generator.randrange(len(words))] = f"x{generator.randrange(40)}"
        rows.append((i, " ".join(words)))
    for i in range(130, 160):
        cut = generator.randrange(0, 30)
        before, after = _noise(generator, generator.randrange(0, 30)), _noise(generator, 20)
        rows.append((i, "\n".join([" ".join(before), " ".join(passage[cut:]), "\t".join(after)])))
    rows += [(160, None), (161, ""), (162, " \n\t "), (163, "one"), (164, "ONE"), (165, "one two"), (166, "ONE  two")]
    rows += [(167, "a " * 300), (168, "a " * 300), (169, "b a " * 200), (170, "É é " * 30)]
    rows += [(171, " ".join(_noise(generator, 20_000))), (172, rows[3][1]), (173, rows[3][1].upper())]
    rows += [(3, rows[3][1]), (None, rows[3][1]), (None, None)]
    return rows


def _components(rows, length, percent):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        runs = [tuple(words[k : k + length]) for k in range(len(words) - length + 1)] or [tuple(words)]
        sets[doc_id] = set(runs) if words else set()
    ids = sorted(sets)
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for at, a in enumerate(ids):
        for b in ids[:at]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("length", "percent"), [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, texts, length, percent):
    df = _frame(spark, [(i, "s", text) for i, text in texts])
    found = [tuple(row) for row in jaccard.similar_documents(df, length, percent).collect()]
    assert len(found) == len(texts)
    assert sorted(row for row in found if row[0] is None) == [(None, None, None)] * 2
    expected = _components([row for row in texts if row[0] is not None], length, percent)
    assert {row[0]: row[1:] for row in found if row[0] is not None} == expected
    assert sum(row[0] == 3 for row in found) == 2


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 200)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    labels = dict(map(tuple, found.collect()))
    assert {labels[i] for i in range(1, 41)} == {1}
    assert {labels[i] for i in range(100, 150)} == {100}


def _kept(rows, window=20):
    seen, found = set(), {}
    for doc_id, text in sorted(rows):
        words = (text or "").encode().split()
        covered = set()
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            if run in seen:
                covered.update(range(k, k + window))
            seen.add(run)
        left = [word for k, word in enumerate(words) if k not in covered]
        found[doc_id] = (len(words), len(words) - len(left), b" ".join(left).decode())
    return found


@pytest.mark.parametrize("most", [substrings.MOST_SEGMENTS, 2])
def test_repeats_are_removed_as_by_brute_force(spark, texts, monkeypatch, most):
    monkeypatch.setattr(substrings, "MOST_SEGMENTS", most)
    df = _frame(spark, [(i, "s", text) for i, text in texts])
    found = [tuple(row) for row in substrings.without_repeats(df).collect()]
    assert len(found) == len(texts)
    named = [row for row in texts if row[0] is not None]
    expected = _kept(named[:-1])
    assert {row[0]: row[1:] for row in found if row[0] is not None} == expected
    assert sorted(row[2] for row in found if row[0] is None) == [0, 0]


@pytest.mark.parametrize("most", [substrings.MOST_SEGMENTS, 2])
def test_repeated_rows_keep_a_passage_shared_with_others(spark, monkeypatch, most):
    monkeypatch.setattr(substrings, "MOST_SEGMENTS", most)
    passage = " ".join(f"shared{i}" for i in range(60))
    own = {i: [" ".join(f"own{i}{side}{j}" for j in range(25)) for side in "ab"] for i in (3, 5, 7)}
    texts = {i: f"{a} {passage} {b}" for i, (a, b) in own.items()}
    rows = [(i, texts[i]) for i in (3, 3, 5, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((row.doc_id, row.kept) for row in substrings.without_repeats(df).collect())
    assert found == [(3, texts[3])] * 2 + [(i, " ".join(own[i])) for i in (5, 7)]


def test_suffix_automaton_matches_brute_force():
    generator = random.Random(3)
    automaton, known = SuffixAutomaton(), []
    for _ in range(40):
        sequence = [generator.randrange(3) for _ in range(generator.randrange(1, 25))]
        for place, length in enumerate(automaton.matches(sequence)):
            ends = [sequence[place + 1 - n : place + 1] for n in range(place + 2)]
            inside = [n for n, end in enumerate(ends) if n == 0 or any(end == k[i : i + n] for k in known for i in range(len(k)))]
            assert length == max(inside)
        automaton.add(sequence)
        known.append(sequence)


def _lines_kept(rows, ratio, least):
    pages, counts = {}, {}
    for _, source, text in rows:
        pages[source] = pages.get(source, 0) + 1
        for line in {line.strip(" \t\n\x0b\x0c\r") for line in (text or "").split("\n")} - {""}:
            counts[source, line] = counts.get((source, line), 0) + 1
    found = []
    for doc_id, source, text in rows:
        kept = [
            line
            for line in (text or "").split("\n")
            if counts.get((source, line.strip(" \t\n\x0b\x0c\r")), 0) < least
            or counts[source, line.strip(" \t\n\x0b\x0c\r")] <= ratio * pages[source]
        ]
        found.append((doc_id, source, None if text is None else "\n".join(kept)))
    return sorted(found, key=repr)


def test_boilerplate_goes_by_host(spark):
    rows = [(i, "a", f"menu\nline {i}\n\n menu \t\nlast {i % 2}") for i in range(8)]
    rows += [(i, "b", f"line {i}\nmenu\r\nx") for i in range(8, 20)]
    rows += [(20, None, "menu"), (21, None, "menu"), (22, None, "menu"), (23, "c", "alone"), (24, "a", None), (25, "a", "")]
    rows += [(26, "d", "menu\n" * 3), (26, "d", "menu\n" * 3), (None, "b", "menu\nother")]
    df = _frame(spark, rows)
    result = line_dedup.without_boilerplate(df, ratio=0.3)
    assert set(df.columns) <= set(result.columns)
    found = sorted((tuple(row) for row in result.select("doc_id", "source", "text").collect()), key=repr)
    assert found == _lines_kept(rows, 0.3, line_dedup.LEAST_PAGES)
    assert result.filter("dropped = 'x' AND host = 'y'").count() == len(rows)


def test_a_line_on_exactly_the_ratio_stays(spark):
    rows = [(i, "a", "often" if i < 3 else f"line {i}") for i in range(10)]
    kept = line_dedup.without_boilerplate(_frame(spark, rows), ratio=0.3)
    assert kept.filter(F.col("text") == "often").count() == 3


def test_two_texts_of_one_id_keep_what_only_the_other_repeats(spark):
    generator = random.Random(12)
    passage, own, other = (_noise(generator, 30) for _ in range(3))
    first, second = [*passage, *own], [*other, *_noise(generator, 20)]
    rows = [(1, " ".join(passage)), (2, " ".join(first)), (2, " ".join(second)), (2, " ".join(first))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(tuple(row) for row in substrings.without_repeats(df).collect())
    assert found == sorted([(1, 30, 0, rows[0][1]), (2, 50, 0, rows[2][1]), *[(2, 60, 30, " ".join(own))] * 2])


def test_hosts_may_be_in_a_column_with_a_dot(spark):
    rows = [(i, "a", f"menu\nown {i}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, `site.host` string, `the.text` string")
    found = line_dedup.without_boilerplate(df, "site.host", "the.text", counts=("n", "m"))
    assert sorted(tuple(row) for row in found.select("doc_id", "`the.text`", "n", "m").collect()) == [
        (i, f"own {i}", 2, 1) for i in range(8)
    ]
