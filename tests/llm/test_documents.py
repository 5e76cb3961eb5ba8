"""Operators on documents against plain versions, with odd rows and hot groups."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import boosting, components, contamination, crossentropy, kernel, setjoin, stats, suffixes
from siltstone.sources.staging import stage
from tests.llm import plain

DRAW = random.Random(11)
WORDS = ["".join(DRAW.choice("abcdefgh") for _ in range(DRAW.randint(2, 7))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(DRAW.choice(WORDS) for _ in range(n))


def edited(text: str, share: float) -> str:
    return " ".join(DRAW.choice(WORDS) if DRAW.random() < share else w for w in text.split(" "))


def corpus() -> dict[int, str | None]:
    passage, base = prose(60), prose(120)
    texts = [prose(DRAW.randint(5, 150)) for _ in range(40)]
    texts += [prose(20) + " " + passage + " " + prose(20) for _ in range(15)]  # a shared passage
    texts += [edited(base, 0.02 + 0.002 * i) for i in range(40)]  # a chain of near copies
    texts += [texts[3]] * 6 + ["", None, "  \n ", "one", "one two three", "One two three", "ü" * 80, "x" * 300, "x" * 300]
    texts += ["a\n\nb\nb\n \n \nb\tc", ("k l m n o p q r " * 6).strip(), "\x00zero " * 20]
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, f"k{i}", i) for i, t in texts.items()]
    return stage(spark.createDataFrame(rows, "doc_id long, text string, kept string, label long").repartition(5), "docs")


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# ---- near duplicates --------------------------------------------------------

@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates(docs, texts, n):
    out = {r["doc_id"]: r for r in setjoin.linked(docs, setjoin.Rule(shingle=n)).collect()}
    want = plain.near_components(texts, n, 80)
    assert {i: r["component_id"] for i, r in out.items()} == want
    assert len(set(want.values())) < len(want) - 8
    for i, r in out.items():
        assert r["n_shingles"] == len(plain.shingles(texts[i], n))
        assert r["kept"] == (want[i] == i)


def test_near_duplicates_in_nodes_that_branch(spark, texts, monkeypatch):
    """Small chunks, so that nodes branch and unsettled rows are compared in several chunks."""
    monkeypatch.setattr(setjoin, "CHUNK", 4)
    docs = stage(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "docs")
    out = {r["doc_id"]: r["component_id"] for r in setjoin.linked(docs, setjoin.Rule(shingle=4)).collect()}
    assert out == plain.near_components(texts, 4, 80)


def test_near_duplicates_list_no_pairs_of_a_group(spark, monkeypatch):
    """Two families of copies that are just too different from each other: no table has a row for each pair of them."""
    base, texts, counts = [f"w{i}" for i in range(200)], {}, []
    for i in range(150):
        copy = [f"{w}x" if i % 2 and k % 30 == 15 else w for k, w in enumerate(base)]
        copy[10 + i] += "y"
        texts[i] = " ".join(copy)

    def counted(df, name):
        out = stage(df, name)
        counts.append((out.count(), name))
        return out

    monkeypatch.setattr(setjoin, "stage", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in setjoin.linked(docs, setjoin.Rule(shingle=4)).collect()}
    assert out == plain.near_components(texts, 4, 80)
    assert set(out.values()) == {0, 1}
    assert max(counts)[0] <= (setjoin.TREES + 1) * len(texts), max(counts)


def test_near_duplicates_without_ids_and_with_repeated_ids(spark):
    text = prose(30)
    rows = [(None, text), (7, text), (7, prose(30)), (9, text), (None, None)]
    out = setjoin.linked(spark.createDataFrame(rows, "doc_id long, text string"), setjoin.Rule()).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in out) == [
        (-1, -1, True), (-1, -1, True), (7, 7, True), (7, 7, True), (9, 7, False)]


def test_recall_grows_with_trees():
    assert setjoin.recall(setjoin.Rule(trees=16), 0.8, 0) > 1 - 1e-10
    assert setjoin.recall(setjoin.Rule(trees=16), 0.9, 6) > 0.9999


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(200, 260)] + [(5, 5), (300, 299), (299, 300)]
    out = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["v"]: r["label"] for r in out} == {
        **{i: 0 for i in range(61)}, 100: 100, **{i: 100 for i in range(200, 260)}, 299: 299, 300: 299}


def test_components_of_what_tasks_read_together(spark, monkeypatch):
    """Edges of a task become stars before anything is shuffled, in steps as well, so few tables are written."""
    edges = [(i, i + 1) for i in range(400)] + [(500 + i % 7, 500 + i) for i in range(300)] + [(500, 506), (None, 3), (3, None)]
    want = {i: 0 for i in range(401)} | {500 + i: 500 + i % 7 for i in range(300)}
    want |= {i: 500 for i, label in want.items() if label == 506}
    frame = spark.createDataFrame(edges, "a long, b long")
    names = []
    monkeypatch.setattr(components, "stage", lambda df, name: names.append(name) or stage(df, name))
    assert {r["v"]: r["label"] for r in components.components(frame.coalesce(1)).collect()} == want
    assert names.count("pointers") == 2
    batches = [pa.RecordBatch.from_pydict({"a": pa.array([a]), "b": pa.array([b])}) for a, b in edges[:60]]
    monkeypatch.setattr(components, "STEP_EDGES", 8)
    out = [r for batch in components._stars(batches) for r in zip(*batch.to_pydict().values())]
    assert {r["v"]: r["label"] for r in components.components(spark.createDataFrame(out, "a long, b long")).collect()} == {i: 0 for i in range(61)}


# ---- repeats ----------------------------------------------------------------

@pytest.mark.parametrize("length", [30, 50])
def test_repeats(docs, texts, length):
    out = {r["doc_id"]: r for r in suffixes.deduplicated(docs, length).collect()}
    for (i, text), (kept, spans) in zip(texts.items(), plain.repeats(list(texts.items()), length)):
        assert bytes(out[i]["kept"]) == kept
        assert [(s["start"], s["end"]) for s in out[i]["spans"]] == spans
        assert out[i]["n_bytes"] == len((text or "").encode()) and out[i]["label"] == i


def test_repeats_without_ids_and_with_repeated_ids(spark):
    text = "The same fifty bytes and more, told again and again by everyone."
    rows = [(None, text), (4, text), (4, text), (2, text[:55]), (None, text)]
    out = suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain.repeats(rows, 50)
    assert sorted((r["doc_id"] or -1, bytes(r["kept"])) for r in out) == sorted(
        (i or -1, kept) for (i, _), (kept, _) in zip(rows, want))


@pytest.mark.parametrize("letters", [1, 2, 4, 256])
def test_suffix_array(letters):
    data = np.random.default_rng(letters).integers(0, letters, 700).astype(np.uint8)
    data[300:500] = data[:200]
    order = suffixes.suffix_array(data, 800 if letters == 1 else 56)
    text = data.tobytes()
    assert sorted(order.tolist()) == list(range(700))
    prefixes = [text[i:i + 56] for i in order]
    assert prefixes == sorted(prefixes)
    same = suffixes.same_as_before(data, order, 50)
    for k in range(1, 700):
        if max(order[k - 1], order[k]) + 50 <= 700:
            assert same[k] == (prefixes[k - 1][:50] == prefixes[k][:50])


# ---- statistics and models --------------------------------------------------

def test_statistics(texts):
    found = stats.statistics(pa.array(list(texts.values()), pa.string()))
    got = list(zip(*(found[c].tolist() for c in stats.COUNTS)))
    assert got == [plain.statistics(t) for t in texts.values()]
    assert all(np.isfinite(found[f]).all() for f in stats.FEATURES)


def test_trees_follow_their_signs():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(3000, 3))
    y = (x[:, 0] + 0.5 * np.sin(3 * x[:, 0]) - x[:, 1] + 0.3 * draw.normal(size=3000) > 0).astype(float)
    forest = boosting.fit(x, y, np.array([1, -1, 0]))
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.93
    for feature, sign in ((0, 1), (1, -1)):
        at = np.repeat(draw.normal(size=(50, 3)), 60, 0)
        at[:, feature] = np.tile(np.linspace(-3, 3, 60), 50)
        assert (sign * np.diff(forest.raw(at).reshape(50, 60), axis=1) >= -1e-12).all()


def test_trees_without_labels():
    for y in (np.ones(4), np.zeros(4), np.zeros(0)):
        score = boosting.fit(np.zeros((len(y), 2)), y, np.zeros(2)).score(np.zeros((3, 2)))
        assert np.allclose(score, y.mean() if len(y) else 1.0, atol=1e-5)


def test_isotonic():
    assert kernel.isotonic(np.array([1.0, 3, 2, 2, 5]), np.array([1.0, 1, 1, 2, 1])).tolist() == [1, 2.25, 2.25, 2.25, 5]


def labelled(spark):
    rows, labels = [], []
    for i in range(600):
        good = DRAW.random() < 0.7
        text = prose(DRAW.randint(30, 90))
        rows.append((i, text if good else DRAW.choice([text.upper(), text.replace(" ", " | "), " ".join([WORDS[0]] * 60)]), "x", i))
        labels += [(i, int(good))] if i % 2 else []
    rows += [(600, "", "x", 0), (601, None, "x", 0), (None, prose(40), "x", 0), (3, prose(40), "x", 0)]
    labels += [(1, None), (None, 1), (5, 1), (5, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string, y long"),
            spark.createDataFrame(labels, "doc_id long, quality int"), dict((i, t) for i, t, _, _ in rows))


def test_classifiers_on_held_out_rows(spark):
    docs, labels, texts = labelled(spark)
    measured = stage(stats.measure(docs), "measured")
    model = kernel.learn(measured, labels)
    out = kernel.score(measured, model).collect()
    assert len(out) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    good = {i: t == t.lower() and "|" not in t and len(set(t.split())) > 5 for i, t in texts.items() if t and i is not None and i != 3}
    held = [r for r in out if r["doc_id"] in good and r["doc_id"] % 2 == 0]
    assert np.mean([r["predicted"] == good[r["doc_id"]] for r in held]) > 0.97
    assert kernel.accepted(docs, model).columns == docs.columns
    assert kernel.accepted(docs, model).count() == sum(r["predicted"] for r in out)
    judged = boosting.judge(measured, boosting.learn(measured, labels)).collect()
    assert np.mean([r["kept"] == good[r["doc_id"]] for r in judged if r["doc_id"] in good]) > 0.97
    assert not any(r["kept"] for r in judged if r["doc_id"] in (600, 601))


def test_labels_outside_the_learning_folds_change_nothing(spark):
    docs, labels, _ = labelled(spark)
    measured = stage(stats.measure(docs), "measured")
    flipped = labels.withColumn("held", kernel.fold_of() == 1).selectExpr("doc_id", "if(held, 1 - quality, quality) AS quality")
    one, two = kernel.learn(measured, labels), kernel.learn(measured, flipped)
    assert np.allclose(one.weights, two.weights) and np.allclose(one.shares, two.shares)


def test_classifiers_without_rows(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs, _, _ = labelled(spark)
    measured = stage(stats.measure(docs), "measured")
    assert {r["score"] for r in kernel.score(measured, kernel.learn(measured, labels)).collect()} <= {0.5}
    assert stats.measure(none).collect() == []


# ---- language models and test items -----------------------------------------

def test_losses(spark, texts):
    rows = [(i, t) for i, t in texts.items() if i < 60] + [(900, ""), (901, None), (902, "alone")]
    target = [1, 5, 9, 20, 44, 900, 12345]
    out = crossentropy.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                             spark.createDataFrame([(i,) for i in [*target, 5, None]], "doc_id long")).collect()
    want = plain.losses({i: t or "" for i, t in rows}, set(target), crossentropy.MIXED, crossentropy.ADDED)
    assert len(out) == len(rows)
    for r in out:
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(want[r["doc_id"]])
        assert r["difference"] == pytest.approx(r["target_loss"] - r["background_loss"])


def test_losses_of_nothing(spark, none):
    assert crossentropy.score(none, none.select("doc_id")).collect() == []


@pytest.mark.parametrize("block_items", [2, 1000])
def test_test_items(spark, block_items):
    items = [prose(30) for _ in range(5)] + ["", None, "tiny", "two words", prose(30)]
    items.append(items[0])
    rows = [(i, prose(80), "x") for i in range(30)]
    rows += [(100, prose(20) + " " + items[1].upper() + "! " + prose(20), "x"), (101, edited(items[2], 0.15), "x"), (102, items[0], "x"),
             (103, " ".join(items[3].split()[:8]) + " " + prose(50), "x"), (104, None, "x"), (105, "", "x"), (None, items[4], "x"),
             (106, "of two words", "x")]
    rows += [(200 + i, prose(5) + " " + items[9] + " " + prose(5), "x") for i in range(40)]  # an item that leaked often
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["share"] for r in contamination.matches(docs, benchmark, block_items).collect()}
    assert set(found) == {(100, 1), (101, 2), (102, 0), (102, 10), (None, 4), (106, 8), *((200 + i, 9) for i in range(40))}
    assert found[100, 1] == 1 and found[102, 0] == 1 and found[101, 2] < 1
    left = contamination.clean(docs, benchmark, block_items)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {*range(30), 103, 104, 105}


def test_edited_test_items_against_every_alignment(spark):
    """As if every item were aligned with every document, also where no run of three or five words was left."""
    items = [prose(n) for n in (3, 4, 15, 40, 40, 60)]
    copies = []
    for item in items[2:]:
        for step in (2, 3, 4, 5):
            copies.append(" ".join(f"new{k}" if k % step == step - 1 else w for k, w in enumerate(item.split())))
            copies.append(" ".join(f"{w} new{k}" if k % step == step - 1 else w for k, w in enumerate(item.split())))
        copies += [" ".join(f"{w} new" for w in item.split())] + [edited(item, s) for s in (0.1, 0.2, 0.25, 0.3, 0.4)]
    texts = [f"{prose(30)} {c} {prose(30)}" for c in copies] + copies + [prose(60) for _ in range(20)]
    found = contamination.matches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3),
                                  spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    split = [contamination.word_hashes(pa.array([t]))[0] for t in texts]
    want = {}
    for b, item in enumerate(items):
        words = contamination.word_hashes(pa.array([item]))[0]
        for i, text in enumerate(split):
            share = contamination.aligned(words, text) / len(words)
            if share >= contamination.SHARE:
                want[i, b] = share
    assert {(r["doc_id"], r["item_id"]): r["share"] for r in found.collect()} == want
    assert len(want) > 60


def test_no_test_items(spark, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert contamination.matches(none, benchmark).collect() == []
    assert contamination.clean(none, benchmark).columns == ["doc_id", "text"]


def test_alignment():
    for _ in range(200):
        a, b = ([DRAW.choice("abc") for _ in range(DRAW.randint(0, 12))] for _ in range(2))
        got = contamination.aligned(*(np.array([ord(c) for c in x], np.uint64) for x in (a, b)))
        assert got == pytest.approx(plain.aligned(a, b, contamination.MATCH, contamination.MISMATCH, contamination.GAP))
