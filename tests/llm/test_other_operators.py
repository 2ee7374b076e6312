"""Decontamination, search, mixing, pages, chat and the pipeline."""

import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import SF_DIR
from tallybrook.llm import chat, decontamination, mixing, pages, topk
from tallybrook.llm.common import permuted

ITEM = "A train leaves Paris at 9 and runs 120 km to the coast at 9 every single day of the week"


def _leaks(spark, texts, items):
    docs = spark.createDataFrame([(i, text, 1, "k") for i, text in texts], "doc_id long, text string, size int, key string")
    bench = spark.createDataFrame([(i, text, 2) for i, text in items], "item_id long, text string, pos int")
    return {(r.doc_id, r.item_id): r.n_changed for r in decontamination.leaks(docs, bench).collect()}


def test_items_are_found_with_other_values(spark):
    other = ITEM.replace("9", "7").replace("120", "85").replace("Paris", "Rome")
    unsteady = ITEM.replace("at 9 and", "at 7 and").replace("at 9 every", "at 4 every")
    texts = [
        (1, f"Before this. {ITEM} And after."),
        (2, f"Before this. {other} And after."),
        (3, unsteady),
        (4, "A train leaves the town and never comes back to where it was."),
        (5, None), (6, ""), (7, "9 8 7 " * 50), (8, " ".join(ITEM.split()[:9])), (9, f"x\n\n{ITEM.upper()}"),
        (1, f"Before this. {ITEM} And after."), (None, ITEM),
    ]
    items = [(10, ITEM), (11, "five words are enough here"), (12, "too short"), (13, None), (14, ""), (None, ITEM)]
    found = _leaks(spark, texts, items)
    assert found[1, 10] == 0 and found[2, 10] == 3
    # The copy in capitals as well; document 8 breaks off within the item.
    assert set(found) == {(1, 10), (2, 10), (9, 10)} and found[9, 10] == 0
    assert _leaks(spark, [(1, "So. Five words, are enough here!")], items) == {(1, 11): 0}
    assert _leaks(spark, [(1, "It is TOO short!")], items) == {(1, 12): 0}


def _leaks_in_any_case(spark, texts, items):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.n_changed for r in decontamination.leaks(docs, bench).collect()}


def test_items_are_found_in_any_case(spark):
    other = ITEM.replace("9", "7").replace("120", "85").upper()
    half = " ".join(ITEM.split()[:10]) + " " + " ".join(ITEM.split()[10:]).upper()
    texts = [
        (1, f"Before this. {ITEM} And after."), (2, f"x\n\n{ITEM.upper()}"), (3, ITEM.lower()), (4, f"SO!! {other}"), (5, half),
        (6, ITEM.upper().replace("AT 9 AND", "AT 7 AND")), (7, ITEM.replace("Paris", "Rome")), (8, "A TRAIN LEAVES THE TOWN " * 9),
    ]
    found = _leaks_in_any_case(spark, texts, [(10, ITEM), (11, "many words without any capital or number in them at all")])
    assert found == {(1, 10): 0, (2, 10): 0, (3, 10): 0, (4, 10): 2, (5, 10): 0, (7, 10): 1}


def test_search_without_a_broadcast_moves_no_texts(spark):
    texts = [(i, f"{i} people said so. " * 40 + (ITEM if i % 3 == 0 else "Nothing else.")) for i in range(30)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(10, ITEM), (11, "five words are enough here")], "item_id long, text string")
    usual = decontamination.leaks(documents, benchmark).collect()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontamination.leaks(documents, benchmark)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(found.collect()) == sorted(usual)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {row.doc_id for row in usual} == {i for i in range(30) if i % 3 == 0}
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    below = plan.splitlines()[plan.splitlines().index(join) + 1 :]
    moved = next(line for line in below if "Project [" in line)
    assert "words" not in moved.split("AS found")[-1] and "hashes" not in moved.split("AS found")[-1]


def test_texts_are_read_once_for_windows_of_all_sizes(spark):
    words = ITEM.split()
    benchmark = spark.createDataFrame([(size, " ".join(words[:size])) for size in range(1, 10)], "item_id long, text string")
    texts = [(size, f"So. {' '.join(words[:size])}") for size in range(10)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    found = decontamination.leaks(documents, benchmark)
    # One of the two windows of an item of 9 words is not enough.
    places = {(doc, item) for doc in range(10) for item in range(1, doc + 1)}
    assert {(row.doc_id, row.item_id) for row in found.collect()} == places

    plans = {"documents": found, "benchmark": decontamination.item_windows(benchmark, True)}
    plans = {name: frame._jdf.queryExecution().optimizedPlan().toString().splitlines() for name, frame in plans.items()}
    cuts = {name: sum("Generate explode(" in line and "sequence(" in line for line in plan) for name, plan in plans.items()}
    # Items once more for their counts.
    assert cuts["documents"] == 1 and cuts["benchmark"] <= 2
    assert not any("Filter" in line and ("regexp_replace(" in line or "split(" in line) for plan in plans.values() for line in plan)


def test_the_key_of_a_window_is_made_once(spark):
    documents = spark.createDataFrame([(1, f"So. {ITEM}")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    found = decontamination.leaks(documents, benchmark)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("explode(array(xxhash64(" in line for line in plan) == 1
    assert not any("Filter" in line and "xxhash64(" in line for line in plan)
    assert [row.doc_id for row in found.collect()] == [1]


@pytest.mark.parametrize("most", [2**10, 2**4])
def test_sieve_loses_no_key(spark, monkeypatch, most):
    monkeypatch.setattr(decontamination, "_LEAST_SIEVE", 2**4)
    monkeypatch.setattr(decontamination, "_MOST_SIEVE", most)
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    passes = decontamination._sieve(keys, 5000)
    assert keys.filter(passes(F.col("key"))).count() == 5000
    others = spark.range(5000, 25000).select(F.xxhash64("id").alias("key"))
    assert others.filter(passes(F.col("key"))).count() < (2000 if most == 2**10 else 20001)
    none = decontamination._sieve(keys.limit(0), 0)
    assert others.filter(none(F.col("key"))).count() == 0


def test_items_of_placeholders_or_few_words_are_found_verbatim(spark):
    table, names, sums = "1 2 3 4 5 6 7 8 9 10 11 12", "Anna Berta Carla Dora Emil Fritz Gustav Hans Ida", "12 + 30 = 42"
    few = [(1, table), (2, names), (3, sums), (4, "Answer is Paris"), (5, None), (6, " ")]
    texts = [
        (1, f"See {table} there, 7 times."), (2, f"so. {names.upper()}"), (3, f"And {sums} is right."), (4, "THE ANSWER IS PARIS!"),
        (5, "1 2 3 4 5 6 7 8 9 10 11 13"), (6, "See 1 2 3 5 4 6 8 7 9 there"), (7, "12 + 31 = 43"), (8, "The answer is Rome."),
    ]
    found = _leaks_in_any_case(spark, texts, few)
    assert set(found) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 1)}  # doc 5 has 4 of 5 windows
    assert set(found.values()) == {0}


def test_search_is_exact_with_ties_and_copies(spark):
    generator = np.random.default_rng(2)
    vectors = generator.normal(size=(900, 8)).astype(np.float32)
    vectors[300:600] = vectors[300]
    rows = [(i, [float(x) for x in v], 5, "s") for i, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [1.0] * 7 + [None]), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (1000, [1.0, 2.0]), (None, [1.0] * 8)]
    rows += [(i, v, 5, "s") for i, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, block string")
    for size in (topk.SHARD_ROWS, 100):
        saved, topk.SHARD_ROWS = topk.SHARD_ROWS, size
        try:
            found = sorted(map(tuple, topk.top_k(df).collect()))
        finally:
            topk.SHARD_ROWS = saved
        whole = np.floor(vectors.astype(float) * 1024).astype(np.int64)
        expected = []
        for query in range(0, 900, 100):
            scores = sorted((-int(whole[query] @ v), i) for i, v in enumerate(whole) if i != query)
            expected += [(query, rank, i, -score) for rank, (score, i) in enumerate(scores[:10], 1)]
        assert found == expected


def test_fewer_candidates_than_wanted(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == [(0, 1, 1, 2 * 1024 * 1024), (0, 2, 2, 2 * 1024 * 1024)]


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_permutations_are_permutations(spark, size):
    ids = spark.range(size)
    images = [row[0] for row in ids.select(permuted(F.col("id"), F.lit(size).cast("long"), F.lit(3).cast("long"))).collect()]
    assert sorted(images) == list(range(size))
    if size == 1000:
        assert sum(a == b for a, b in enumerate(images)) < 20


def _targets(sizes):
    names = sorted(sizes, key=lambda name: (name is None, name))
    weights = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    total, cut = sum(sizes.values()), {}
    while True:
        left = total - sum(cut.values())
        open_weight = sum(w for name, w in weights.items() if name not in cut)
        shares = {name: left * w / open_weight for name, w in weights.items() if name not in cut}
        over = [name for name in shares if shares[name] > 3 * sizes[name]]
        if not over:
            return shares | cut
        cut |= {name: 3 * sizes[name] for name in over}


def test_mix_meets_its_targets(spark):
    generator = random.Random(1)
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else generator.choice(["a", "b", "c", None, "ä"])
        rows.append((i, source, "w " * generator.randrange(0, 400), 1, 2))
    rows += [(400, "tiny", "just three words", 1, 2), (401, "none", None, 1, 2), (402, "none", " \n", 1, 2)]
    rows += [(5, rows[5][1], rows[5][2], 1, 2), (None, "a", "w " * 50, 1, 2), (403, "long", "w " * 20_000, 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int, block int")
    found = mixing.words_taken(df).collect()
    again = mixing.words_taken(df.repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again)) and len(found) == len(rows)
    sizes, taken, stated = {}, {}, {}
    for row in found:
        assert 0 <= row.taken <= 3 * row.size
        sizes[row.source] = sizes.get(row.source, 0) + row.size
        taken[row.source] = taken.get(row.source, 0) + row.taken
        stated[row.source] = row.target
    assert {row.source: row.source_size for row in found} == sizes
    expected = _targets(sizes)
    for source in sizes:
        assert stated[source] == pytest.approx(expected[source])
        assert abs(taken[source] - expected[source]) <= max(0.03 * expected[source], 2 * mixing.BLOCK_WORDS)


def test_shards_draw_their_own_counts(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "w " * 4000) for i in range(400)], "doc_id long, source string, text string")
    _, _, slots = mixing.mixture(df)
    counts = slots.groupBy("shard").pivot("number").count().orderBy("shard").collect()
    assert len(counts) > 5 and len({row["0"] for row in counts[:-1]}) > 1
    assert slots.select("shard", "slot").distinct().count() == slots.count()


def test_scores_beyond_64_bits_are_an_error(spark):
    for big in (1e300, 3e9):
        df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [big, 0.0])], "vec_id long, embedding array<double>")
        with pytest.raises(ValueError, match="64 bits"):
            topk.top_k(df).collect()
    df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [2e6, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(row) for row in topk.top_k(df).collect()] == [(0, 1, 1, 1024 * 1024 * 2_000_000)]


def test_vectors_move_once_however_many_queries_there_are(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    for every in (100, 1):
        plan = topk.top_k(df, every=every)._jdf.queryExecution().toString()
        plan = plan.split("== Physical Plan ==")[1]
        assert plan.count("Generate explode") == 1 and "CoGroup" not in plan


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
<body class="with-sidebar"><header><a href=/>Home</a> <a href=/b>Blog</a></header>
<nav><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></nav><div class="ad">Buy now, it is very cheap today.</div>
<article><header><h1>Title &amp; more</h1></header><p>First  paragraph
with <b>bold</b>text &lt;here&gt;.<p>Short.</p><aside>Related: <a href=x>other story</a></aside>
<ul><li>point one</li><li><a href=y>linked point</a></li></ul>
<form><input name=q><button>Send</button></form><p>Last&nbsp;one.</p>
<section id="comments"><article><p>A reader says a lot of words about this and goes on for long.</p></article></section></article>
<div id="cookie-notice">We use cookies on this site to do things.</div><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    text = pages.main_text(PAGE, pages.trained_tree())
    assert text.split("\n\n") == [
        "Title & more", "First paragraph with boldtext <here>.", "Short.", "point one", "linked point", "Last one."
    ]


@pytest.mark.parametrize("wrapper", ["div class='content-sidebar-wrap'", "div class='layout-with-sidebar'", "form id='search'", "div id='share-page'"])
def test_an_article_in_a_marked_wrapper_stays(wrapper):
    end = wrapper.split()[0]
    page = f"<body><{wrapper}><div>side</div><article><h1>Head</h1><p>The text is here.</p><div class='share'>Tell others</div></article></{end}></body>"
    assert pages.main_text(page, pages.trained_tree()) == "Head\n\nThe text is here."
    for firm in ("aside", "nav", "div class='comments'"):
        page = f"<body><{firm}><article><p>Somebody says this about it.</p></article></{firm.split()[0]}></body>"
        assert pages.main_text(page, pages.trained_tree()) == ""


def test_pages_without_article_go_by_words_and_links():
    body = "<div>" + "</div><div>".join(["word " * 40, "other " * 30, "more " * 50]) + "</div>"
    menu = "".join(f'<div><a href="/{i}">item</a></div>' for i in range(8))
    text = pages.main_text(f"<body>{menu}{body}{menu}</body>", pages.trained_tree())
    assert [part.split()[0] for part in text.split("\n\n")] == ["word", "other", "more"]


@pytest.mark.parametrize("silent", ["button", "svg", "noscript", "object", "canvas", "template", "select", "video"])
@pytest.mark.parametrize("around", ["<div class=x>{}Buy <i>it</i></div>", "<p>{}Buy</p>", "{}Buy"])
def test_an_unclosed_silent_element_does_not_silence_the_page(silent, around):
    tree = pages.trained_tree()
    kept = "<main><h1>Head</h1><p>The text is here.</p></main>"
    assert pages.main_text(f"<body>{around.format(f'<{silent}>')}{kept}</body>", tree) == "Head\n\nThe text is here."
    inner = f"<article><h1>Head</h1><div><{silent}>Buy</div><p>The text is here.</p></article>"
    assert pages.main_text(f"<body>{inner}</body>", tree) == "Head\n\nThe text is here."


@pytest.mark.parametrize("head", [
    "<head><title>T</title><meta charset=utf-8>", "<head><title>T</title><noscript><img src=x></noscript><body>",
    "<head><style>p {}</style><script>var a = '<p>no</p>';</script>", "<head><title>T</title></head><body>", "",
])
def test_a_head_ends_where_the_text_begins(head):
    page = f"<html>{head}<article><p>The text is here.</p></article>"
    assert pages.main_text(page, pages.trained_tree()) == "The text is here."
    long = "<p>" + "</p><p>".join(f"{word} " * 40 for word in ("one", "two", "three")) + "</p>"
    found = pages.main_text(f"<html>{head}{long}", pages.trained_tree())
    assert [part.split()[0] for part in found.split("\n\n")] == ["one", "two", "three"]


def test_closed_silent_elements_keep_what_is_in_them():
    page = (
        "<body><template><article><p>Not of the page.</p></article></template><article><p>One <button><p>Buy</p><span>now"
        "</button>and two.</p><svg><g><text>chart</text></g><svg></svg></svg><select><option>a<option>b</select>"
        "<noscript><article><p>Turn it on.</p></article></noscript><textarea><p>typed</textarea><p>Three.</p></article>"
    )
    assert pages.main_text(page, pages.trained_tree()) == "One and two.\n\nThree."


@pytest.mark.parametrize("wrapper", [
    "div class='content-sidebar-wrap'", "div class='layout-with-search'", "section class='social-science'", "form id='form1'",
])
def test_a_marked_wrapper_of_the_whole_text_is_weighed(wrapper):
    words = ("one", "two", "three")
    text = "".join(f"<p>{word} {'and so on ' * 15}</p>" for word in words)
    menu = "<ul>" + "<li><a href=x>item</a></li>" * 5 + "</ul>"
    share = "<div class='share'>Tell all of your friends about this story today please</div>"
    cookies = f"<div class='cookie-notice'>{'We use cookies on this site. ' * 4}</div>"
    comments = f"<div id='comments'><p>{'a reader says that ' * 20}</p></div>"
    page = f"<body>{menu}<{wrapper}><h2>Head of it</h2>{text}{share}{comments}{menu}</{wrapper.split()[0]}>{cookies}</body>"
    found = pages.main_text(page, pages.trained_tree()).split("\n\n")
    assert [part.split()[0] for part in found] == ["Head", *words]
    # The same mark beside an article, or on a small part, says what it always did.
    beside = f"<body><article><p>The text.</p></article><{wrapper}>{text}</{wrapper.split()[0]}></body>"
    assert pages.main_text(beside, pages.trained_tree()) == "The text."


def _article(page):
    inner = re.search(r"<article>(.*?)(</article>|$)", re.sub(r"<[^>]*$", "", page or ""), re.S)
    parts = re.split(r"</?(?:p|h1)>", inner.group(1)) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part.replace("<br>", " "))).split()) for part in parts]
    return "\n\n".join(text for text in texts if text)


def test_given_pages_and_odd_ones(spark):
    given = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html")
    odd = [(-1, None, None), (-2, "u", ""), (-3, "u", "plain"), (-4, "u", "<article><p>cut &am"), (-4, "u", "<article><p>cut &am"), (-5, "u", "<article><p>" + "word " * 200_000)]
    df = given.unionByName(spark.createDataFrame(odd, given.schema)).withColumn("text", F.lit(3)).withColumn("blocks", F.lit(1))
    found = {row.page_id: row for row in pages.extracted(df).collect()}
    for row in given.collect():
        assert found[row.page_id].text == _article(row.html)
    assert all(row.n_chars == len(row.text) for row in found.values())
    assert found[-1].text == found[-2].text == "" and found[-4].text == "cut &am"
    assert pages.extracted(df).count() == df.count()


def test_events_are_folded(spark):
    rows = [
        (1, 1, "m1", "message", "user", "hi"), (1, 2, "m2", "delta", "assistant", "a"), (1, 3, "m2", "delta", "assistant", "b"),
        (1, 4, "m2", "edit", None, "new"), (1, 5, "m2", "delta", None, "!"), (1, 6, "m3", "message", "user", "more"),
        (1, 7, "m2", "regenerate", "assistant", "again"), (1, 8, "m2", "delta", None, None), (1, 9, "m4", "message", "user", None),
        (1, 10, "m5", "unknown", "user", "x"), (None, 1, None, "message", None, "n"), (2, 1, "m1", "message", "user", "z"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, seq long, msg_id string, kind string, role string, text string")
    found = chat.final_messages(df).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.role, r.text) for r in found] == [
        (None, "", "n"), (1, "user", "hi"), (1, "assistant", "again"), (1, "user", ""), (2, "user", "z")
    ]


def test_texts_come_back_from_the_template(spark):
    generator = random.Random(4)
    parts = [*chat.CONTROLS, "\\", "\n", "<", "s>", "[", "n", "\\\\", "é", "\U0001f600", "\x00", "user", " ", "$1"]
    rows, order = [], {}
    for conv in range(60):
        for turn in range(generator.randrange(1, 6)):
            role = generator.choice(["user", "assistant", "system", None, "", "odd\nrole", "\\n", "a</s>b", "\\"])
            text = None if generator.random() < 0.1 else "".join(generator.choices(parts, k=generator.randrange(0, 12)))
            rows.append((conv, turn, role, text))
            order.setdefault(conv, []).append((role or "", text or ""))
    rows += [(99, 0, "user", "same"), (99, 0, "user", "same"), (None, 1, "assistant", "x"), (98, None, "assistant", "y" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    back = chat.read_back(chat.rendered(chat.final_messages(chat.conversation_events(df))))
    found = {row.conv_id: row for row in back.collect()}
    for conv, turns in order.items():
        assert [tuple(turn) for turn in found[conv].turns] == turns
        assert found[conv].loss_text == "".join(text for role, text in turns if role == "assistant")
        for span in found[conv].loss:
            piece = found[conv].formatted[span.start : span.start + span.length]
            assert found[conv].formatted[span.start + span.length :].startswith(chat.CLOSE)
            assert piece.count("\n") <= found[conv].formatted.count("\n")
    assert len(found[99].turns) == 2 and found[None].loss_text == "x" and len(found[98].loss_text) == 200_000


def test_probe_conversation(spark):
    from tallybrook.llm.catalog import QUERIES

    row = QUERIES["op8_chat"](spark, SF_DIR).filter("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    turns = f"user\n{text}\nassistant\n{text}\n"
    assert row.n_turns == 2 and row.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()


def test_pipeline_stages_on_a_small_corpus(spark, tmp_path):
    generator = random.Random(8)
    words = [f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}rd" for i in range(300)]

    def prose(count):
        return ". ".join(" ".join(generator.choices(words, k=8)).capitalize() for _ in range(count)) + "."

    rows = [(i, f"{prose(9)}\nread our terms\n{prose(7)}", "en", "hot" if i % 3 else f"s{i % 4}", 0) for i in range(120)]
    item = prose(3)
    rows += [(200, f"{prose(5)} {item} {prose(5)}", "en", "hot", 0), (201, rows[7][1], "en", "s1", 0)]
    rows += [(202, rows[8][1].replace(". ", ". Also ", 1), "en", "hot", 0), (203, None, None, None, None)]
    junk = [(300 + i, "\n".join("BUY### NOW$$$ !!!" for _ in range(12)), "en", "hot", 0) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows + junk, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(row[0], 1, 0) for row in rows[:100]] + [(row[0], 0, 0) for row in junk[:25]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("score", F.lit("mine"))
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{number}")
        docs = spark.read.parquet(f"{tmp_path}/stage{number}")
        kept.append({row.doc_id for row in docs.collect()})
        if number < 4:
            assert docs.columns == before
        if number == 1:
            assert docs.filter(F.col("text").contains("read our terms")).count() == 0
            assert docs.filter("n_chars <> length(text)").count() == 0
    good = {row[0] for row in rows} - {203}
    assert kept[0] - {203} == good and kept[1] == kept[0]
    assert kept[2] - {203} == good - {201, 202}
    assert kept[3] - {203} == kept[4] - {203} == good - {200, 201, 202}


def test_stages_keep_rows_of_one_id_and_columns_with_their_names(spark):
    rows = [(1, "one two three four five six seven", "s", 77, 5), (2, "nothing like the others in here at all", "s", 77, 5)]
    rows += [(2, "another text of the same id but not the same words", "s", 77, 5), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines int, n_dropped int")
    cleaned = corpus_pipeline.without_boilerplate(spark, df, "")
    assert sorted(cleaned.collect()) == sorted(df.collect())
    kept = corpus_pipeline.one_of_each(spark, df, "")
    assert sorted(tuple(row) for row in kept.collect()) == sorted(set(rows))
