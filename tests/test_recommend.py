"""The best unseen items by bounds, against scores of all pairs."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.checks import gold_checks
from siltstone.checks.registry import Tables
from siltstone.operators import assemble
from siltstone.plans import gold, recommend, retrieval


def made(seed: int, users: int, items: int, tags: int, rank: int, per_item: int = 4):
    """Users and items as the search takes them; numbers in coarse steps, so that scores tie."""
    draw = np.random.default_rng(seed)
    kinds = [sorted(draw.choice(tags, draw.integers(0, per_item + 1), False).tolist()) for _ in range(items)]
    shop = [(1000 - 3 * i, round(draw.random(), 1), draw.normal(size=rank).round(1).tolist(), kinds[i]) for i in range(items)]
    people = []
    for u in range(users):
        own = draw.choice(tags + 5, draw.integers(0, tags), False).tolist()
        seen = draw.choice([s[0] for s in shop] + [-5, 10**6], draw.integers(0, items), False).tolist()
        people.append((u, round(draw.random(), 1), draw.normal(size=rank).round(1).tolist(), own, draw.random(len(own)).round(1).tolist(), seen))
    return people, shop


def plain(people, shop, n):
    out = []
    for user, number, vector, tags, weights, seen in people:
        weight = dict(zip(tags, weights))
        scored = []
        for app, base, other, kinds in shop:
            if app not in seen:
                score = number + base + float(np.dot(vector, other)) + sum(weight.get(t, 0.0) for t in kinds)
                scored.append((-int(np.floor(score * 1e6 + 0.5)), app))
        out += [(user, app, -s, k) for k, (s, app) in enumerate(sorted(scored)[:n], 1)]
    return out


USERS = "user_id long, number double, vector array<double>, tags array<int>, weights array<double>, seen array<long>"
ITEMS = "app_id long, number double, vector array<double>, tags array<int>"


@pytest.mark.parametrize(("seed", "items", "rank", "shard", "block"), [
    (1, 300, 0, 10**6, 16), (2, 300, 4, 10**6, 16), (3, 200, 3, 60, 8), (4, 7, 2, 10**6, 128), (5, 120, 0, 50, 1)])
def test_best_items(spark, monkeypatch, seed, items, rank, shard, block):
    monkeypatch.setattr(retrieval, "BLOCK", block)
    people, shop = made(seed, 40, items, 12, rank)
    got = retrieval.best_items(spark.createDataFrame(people, USERS), spark.createDataFrame(shop, ITEMS), 5, shard).collect()
    rows = sorted((r.user_id, r.app_id, round(r.final_score * 1e6), r.place) for r in got)
    assert rows == sorted(plain(people, shop, 5))
    by = {u[0]: u for u in people}
    of = {i[0]: i for i in shop}
    for r in got:
        user, item = by[r.user_id], of[r.app_id]
        assert r.product == pytest.approx(float(np.dot(user[2], item[2])))
        assert r.content == pytest.approx(sum(w for t, w in zip(user[3], user[4]) if t in item[3]))


def test_nothing_to_search(spark):
    people, shop = made(6, 3, 4, 5, 0)
    users, items = spark.createDataFrame(people, USERS), spark.createDataFrame(shop, ITEMS)
    assert retrieval.best_items(users, items.limit(0), 3).count() == 0
    assert retrieval.best_items(users.limit(0), items, 3).count() == 0
    all_met = users.withColumn("seen", F.array(*[F.lit(s[0]).cast("long") for s in shop]))
    assert retrieval.best_items(all_met, items, 3).count() == 0


def test_bounds_hold():
    """No item of a block scores more for a user than the block's bound says, whatever the sign of the vectors."""
    people, shop = made(7, 30, 400, 15, 3)
    table = pa.table({"app_id": [s[0] for s in shop], "number": [s[1] for s in shop],
                      "vector": pa.array([s[2] for s in shop], pa.list_(pa.float64())), "tags": pa.array([s[3] for s in shop], pa.list_(pa.int32()))})
    shard = retrieval.Shard(table)
    vector, weights = np.array([p[2] for p in people]), np.zeros((30, shard.n_tags))
    for u, p in enumerate(people):
        for t, w in zip(p[3], p[4]):
            if t < shard.n_tags:
                weights[u, t] = w
    scores = vector @ shard.vector.T + shard.number + np.array([[weights[u, t].sum() for t in shard.tags] for u in range(30)])
    none = np.empty(0, np.int64)
    _, looked = shard.best(np.zeros(30), vector, weights, (none, none), 3)
    best, _ = shard.best(np.zeros(30), vector, weights, (none, none), 1)
    assert (best[:, 0] >> retrieval.PLACE_BITS == np.floor(scores.max(1) * 1e6 + 0.5)).all()
    assert looked.max() <= 400


def test_items_looked_at_grow_less_than_the_catalogue():
    """Eight times the items, of as many kinds: a user looks at less than four times as many."""
    means = []
    for items in (2_000, 16_000):
        draw = np.random.default_rng(8)
        kinds = np.column_stack([draw.integers(0, 7, items), 7 + draw.integers(0, 25, items), 32 + draw.integers(0, 10, items), 42 + draw.integers(0, 12, items)])
        table = pa.table({"app_id": np.arange(items), "number": 0.3 * draw.normal(0.5, 0.1, items), "vector": pa.array([[]] * items, pa.list_(pa.float64())),
                          "tags": pa.array(kinds.tolist(), pa.list_(pa.int32()))})
        weights = draw.dirichlet(np.ones(54), 200) * 0.3
        none = np.empty(0, np.int64)
        best, looked = retrieval.Shard(table).best(np.zeros(200), np.zeros((200, 0)), weights, (none, none), 10)
        assert (best > 0).all()
        means.append(looked.mean())
    assert means[0] < 2_000 and means[1] < 4 * means[0]


def test_copies_cost_a_set():
    """Sixty copies of each item: no more bounds than kinds of items, few items scored, and the least ids of the best kinds found."""
    draw = np.random.default_rng(9)
    kinds = [sorted(draw.choice(30, 4, False).tolist()) for _ in range(400)]
    number = draw.random(400) * 0.3
    table = pa.table({"app_id": np.arange(24_000), "number": np.tile(number, 60), "vector": pa.array([[]] * 24_000, pa.list_(pa.float64())),
                      "tags": pa.array(kinds * 60, pa.list_(pa.int32()))})
    shard = retrieval.Shard(table)
    assert len(shard.begin) <= 400
    weights, none = draw.dirichlet(np.ones(30), 50), np.empty(0, np.int64)
    first = np.flatnonzero(shard.app < 400)
    best, looked = shard.best(np.zeros(50), np.zeros((50, 0)), weights, (np.repeat(np.arange(50), len(first)), np.tile(first, 50)), 70)
    assert looked.max() < 24_000 / 10
    scores = np.array([[w[k].sum() for k in kinds] for w in weights]) + number
    units = np.floor(np.tile(scores, 60) * 1e6 + 0.5).astype(np.int64)[:, 400:]
    for u in range(50):
        want = sorted(zip(-units[u], range(400, 24_000)))[:70]
        app = np.sort(shard.app)[(1 << retrieval.PLACE_BITS) - 1 - (best[u] & ((1 << retrieval.PLACE_BITS) - 1))]
        assert [(-int(k >> retrieval.PLACE_BITS), int(a)) for k, a in zip(best[u], app)] == want


def test_many_copies_cost_one_bound():
    """A set of many blocks has one bound, and later blocks are looked at where the first ones are met."""
    draw = np.random.default_rng(12)
    kinds = [sorted(draw.choice(20, 3, False).tolist()) for _ in range(30)]
    number = draw.random(9_000).round(3)
    table = pa.table({"app_id": np.arange(9_000), "number": number, "vector": pa.array([[]] * 9_000, pa.list_(pa.float64())),
                      "tags": pa.array(kinds * 300, pa.list_(pa.int32()))})
    shard = retrieval.Shard(table)
    assert shard.columns == shard.sets <= 30 and len(shard.begin) >= 30 * 4
    weights = draw.dirichlet(np.ones(20), 10).round(2)
    scores = np.tile(np.array([[w[k].sum() for k in kinds] for w in weights]), 300) + number
    met = [np.argsort(-s, kind="stable")[:m] for s, m in zip(scores, range(0, 1000, 100))]  # the best ones, up to some hundred
    seen = np.repeat(np.arange(10), [len(m) for m in met]), shard.by_app[np.concatenate(met)]
    best, _ = shard.best(np.zeros(10), np.zeros((10, 0)), weights, seen, 8)
    for u in range(10):
        left = np.setdiff1d(np.arange(9_000), met[u])
        want = sorted((-int(np.floor(scores[u, a] * 1e6 + 0.5)), int(a)) for a in left)[:8]
        got = [(-int(k >> retrieval.PLACE_BITS), int(shard.apps[(1 << retrieval.PLACE_BITS) - 1 - (k & ((1 << retrieval.PLACE_BITS) - 1))])) for k in best[u]]
        assert got == want


def test_items_out_of_reach_are_not_walked(spark):
    """Of a set no more items are searched than a user can get beyond those met, and the result is that of all items."""
    shop = [(i, float(i % 50), [], [i % 2]) for i in range(400)]
    people = [(1, 0.0, [], [0], [1.0], []), (2, 0.0, [], [1], [2.0], [i for i in range(400) if i % 50 == 49 and i < 300])]
    users, items = spark.createDataFrame(people, USERS), spark.createDataFrame(shop, ITEMS)
    assert retrieval._within_reach(users, items, 3, 100, lambda df, name: df).count() == 2 * (3 + 6)
    assert retrieval._within_reach(users, items, 3, 400, lambda df, name: df).count() == 400
    got = retrieval.best_items(users, items, 3, 100, lambda df, name: df.localCheckpoint()).collect()
    assert sorted((r.user_id, r.app_id, round(r.final_score * 1e6), r.place) for r in got) == sorted(plain(people, shop, 3))


def test_tag_lists(spark, no_stage):
    """The lists of a user have the weights of the profile, heaviest first, across batches; items without tags are met as well."""
    inter = spark.createDataFrame([(u, a) for u in range(1, 9) for a in range(30) for _ in range(1 + (u * a) % 3) if (u + a) % 4], "user_id long, app_id long")
    bridge = spark.createDataFrame([(a, t) for a in range(20) for t in (a % 3, 3 + a % 5)], "app_id long, tag int")
    weight = {(r.user_id, r.tag): r.weight for r in gold.tag_profile(inter, bridge, no_stage).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = gold.tag_lists(gold.user_items(inter, no_stage), assemble.sorted_set(bridge, "app_id", "tag", "tags")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == 8 and weight == {(r.user_id, t): w for r in rows for t, w in zip(r.tags, r.weights)}
    for r in rows:
        assert list(zip(r.weights, r.tags)) == sorted(zip(r.weights, r.tags), reverse=True)
        assert sorted(r.seen) == [a for a in range(30) if (r.user_id + a) % 4]


def interactions(spark, seen):
    frame = spark.createDataFrame(seen, "user_id bigint, app_id bigint")
    return frame.withColumns({"is_recommended": F.lit(True), "hours": F.lit(1.0), "helpful": F.lit(0), "funny": F.lit(0)})


def test_every_user_gets_n_unseen_items(spark):
    """User 1 has met every item of the only tag; user 3 has met nothing; null keys are nobody."""
    inter = interactions(spark, [(1, i) for i in range(5)] + [(2, 0), (2, 1), (2, 10), (None, 4), (2, None)])
    bridge = spark.createDataFrame([(i, "a") for i in range(5)] + [(i, "b") for i in (10, 11)] + [(i, f"c{i}") for i in range(20, 30)] + [(None, "a"), (30, None)],
                                   "app_id bigint, tag string")
    users = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "user_id bigint")
    best = recommend.recommended(inter, bridge, 6, users=users).collect()
    of_user = {u: [r.app_id for r in sorted(best, key=lambda r: r.place) if r.user_id == u] for u in (1, 2, 3)}
    assert len(best) == 18 and all(len(set(v)) == 6 for v in of_user.values())
    assert not set(of_user[1]) & set(range(5)) and not set(of_user[2]) & {0, 1, 10}
    assert of_user[2][:3] == [2, 3, 4]  # two of three tags of the user are theirs, and user 1 has met them
    assert of_user[3][:2] == [0, 1]  # the most popular


def test_trained_factors(spark):
    """Two groups of users with items of their own: unseen items of the own group come first."""
    seen = [(u * 10**11, i) for u in range(1, 13) for i in range(1, 13) if u % 2 == i % 2 and (u + i) % 6]
    bridge = spark.createDataFrame([(i, "t") for i in range(1, 13)], "app_id bigint, tag string")
    best = recommend.recommended(interactions(spark, seen), bridge, 2, lambda w: recommend.als_factors(w, 4, 10)).collect()
    assert len(best) == 24 and all(np.isfinite(r.cf_score) for r in best)
    first = [r for r in best if r.place == 1]
    assert np.mean([(r.user_id // 10**11) % 2 == r.app_id % 2 for r in first]) >= 0.9


def test_training_blocks_grow_in_number(spark, monkeypatch):
    """No block of the training has more than its share of ratings, however many there are, and many blocks train as well as few."""
    assert recommend.als_blocks(600_000) == {"numUserBlocks": 10, "numItemBlocks": 10, "checkpointInterval": 10}
    assert recommend.als_blocks(216_000_000)["numUserBlocks"] == 108 and recommend.als_blocks(216_000_001)["numItemBlocks"] == 109
    monkeypatch.setattr(recommend, "ALS_RATINGS", 3)
    seen = [(u, i) for u in range(1, 13) for i in range(1, 13) if u % 2 == i % 2 and (u + i) % 6]
    assert recommend.als_blocks(len(seen))["numUserBlocks"] > 10
    made = recommend.als_factors(gold.interaction_features(interactions(spark, seen)), 4, 10)
    users, items = ({r[0]: np.array(r.vector) for r in df.collect()} for df in (made.users, made.items))
    assert len(users) == len(items) == 12
    score = {(u, i): users[u] @ items[i] for u in users for i in items}
    assert np.mean([score[p] for p in seen]) > np.mean([x for (u, i), x in score.items() if u % 2 != i % 2]) + 0.3


@pytest.mark.parametrize(("rank", "shard"), [(0, 10**6), (3, 10**6), (2, 7)])
def test_all_items(spark, rank, shard):
    """Every unseen pair has its score, whatever the shards."""
    people, shop = made(10, 9, 30, 12, rank)
    users = spark.createDataFrame([(u, n, v, s) for u, n, v, _, _, s in people], "user_id long, number double, vector array<double>, seen array<long>")
    items = spark.createDataFrame([s[:3] for s in shop], "app_id long, number double, vector array<double>")
    got = {(r.user_id, r.app_id): r.score for r in retrieval.all_items(users, items, shard).collect()}
    want = {(p[0], s[0]): p[1] + s[1] + float(np.dot(p[2], s[2])) for p in people for s in shop if s[0] not in p[5]}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_scores_of_all_pairs_are_rounded_in_the_task(spark):
    """Six digits, as Spark's round gives them, but not by Spark: no pair becomes a decimal number on its way."""
    values = [0.1234564, 0.1234566, -0.1234564, -0.1234566, 2.5e-7, -7.5e-7, 3.0, 1e300, float("inf"), float("nan")]
    users = spark.createDataFrame([(1, 0.0, [], [])], "user_id long, number double, vector array<double>, seen array<long>")
    items = spark.createDataFrame([(i, v, []) for i, v in enumerate(values)], "app_id long, number double, vector array<double>")
    got = {r.app_id: r.score for r in retrieval.all_items(users, items).collect()}
    want = {r.app_id: r.score for r in items.select("app_id", F.round("number", 6).alias("score")).collect()}
    assert all(got[i] == want[i] or np.isnan(got[i]) and np.isnan(want[i]) for i in want)
    bridge = spark.createDataFrame([(1, "t"), (2, "t")], "app_id bigint, tag string")
    found = recommend.unseen_scores(interactions(spark, [(1, 1), (2, 2)]), bridge, recommend.baseline_factors)
    assert "round(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_trained_scores_of_all_pairs(spark):
    """Not only ten of a user: all unseen pairs, also with an item that nobody has met, which scores nothing."""
    seen = [(u, i) for u in range(1, 9) for i in range(1, 21) if u % 2 == i % 2 and (u + i) % 5] + [(None, 3), (4, None)]
    bridge = spark.createDataFrame([(i, "t") for i in (1, 2, 30, None)], "app_id bigint, tag string")
    got = recommend.unseen_scores(interactions(spark, seen), bridge, lambda w: recommend.als_factors(w, 4, 10)).collect()
    items = {i for _, i in seen if i} | {30}
    assert {(r.user_id, r.app_id) for r in got} == {(u, i) for u in range(1, 9) for i in items} - set(seen) and len(got) > 8 * 10
    assert all(r.cf_score == 0 for r in got if r.app_id == 30)
    own, other = ([r.cf_score for r in got if r.app_id != 30 and (r.user_id % 2 == r.app_id % 2) == same] for same in (True, False))
    assert np.mean(own) > np.mean(other) + 0.3


def test_baseline_of_one_interaction(spark):
    best = recommend.recommended(interactions(spark, [(1, 1)]), spark.createDataFrame([(1, "a"), (2, "a")], "app_id bigint, tag string"), 3).collect()
    assert [(r.app_id, r.cf_score, r.content_score, r.popularity_score) for r in best] == [(2, 0.0, 1.0, 0.0)]


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_looked_at_grows_with_users(spark):
    """From sf0.001 to sf0.01 users and items grow tenfold; what is scored grows less than users times items."""
    sums = []
    for size in ("0.001", "0.01"):
        t = Tables(spark, f"/root/testdata/sf{size}")
        found = recommend.recommended(gold_checks.interactions(t), t.fixture("item_tags"), 10)
        users = found.groupBy("user_id").agg(F.max("looked").alias("looked"), F.count("*").alias("n"))
        row = users.agg(F.count("*").alias("users"), F.avg("looked").alias("looked"), F.min("n").alias("least")).first()
        assert row.least == 10
        sums.append(row.looked)
    assert sums[1] < 10 * sums[0]  # at sf0.001 all of the 200 items may be looked at


def test_vectors_are_not_sent_by_pair(spark, no_stage):
    """What is dealt out has a row for each item and block of users, not for each pair, and the profiles are the weighted means."""
    from siltstone.plans import recommend

    pairs = [(u, a, 1.0 + (u + a) % 3) for u in range(200) for a in range(12) if (u * a) % 5]
    weighted = spark.createDataFrame([*pairs, (None, 1, 1.0), (1, None, 1.0)], "user_id long, app_id long, interaction_weight double")
    vector = {a: [float(a), 1.0, float(a % 4)] for a in range(11)}  # one item has none
    items = spark.createDataFrame([*vector.items(), (99, None)], "app_id long, embedding array<float>")
    dealt = recommend._blocks_of_users(weighted, items, no_stage)
    assert dealt.count() <= recommend.BLOCKS * len(vector) < len(pairs)
    assert dealt.rdd.getNumPartitions() == recommend.BLOCKS
    for row in recommend.user_profiles(weighted, items, no_stage).filter("user_id is not null").collect():
        own = [(w, vector[a]) for u, a, w in pairs if u == row.user_id and a in vector]
        want = [sum(w * v[i] for w, v in own) / sum(w for w, _ in own) for i in range(3)]
        assert row.profile == pytest.approx(want)
    near = recommend.profile_neighbours(weighted, items, no_stage)
    assert near.count() == sum(a in vector for _, a, _ in pairs)
    assert near.filter("cosine > 1 or cosine is null").count() == 0


def test_vectors_are_read_not_shuffled(spark, no_stage, monkeypatch):
    """No vector is in what is dealt out; files that are read in steps give the means and cosines whatever the steps, copies and gaps."""
    from siltstone.sources import staging

    draw = np.random.default_rng(13)
    pairs = [(int(u), int(a), 1.0 + int(u + a) % 3) for u, a in draw.integers(0, 40, (600, 2))]
    weighted = spark.createDataFrame([*pairs, (None, 1, 1.0), (1, None, 1.0)], "user_id long, app_id long, interaction_weight double")
    vectors = [(a, draw.normal(size=3).tolist()) for a in [*range(3, 35), 5, 5, 5, 34, 99]]  # some items have none, some several
    items = spark.createDataFrame([*vectors, (2, None), (None, [1.0, 2.0, 3.0])], "app_id long, embedding array<float>")
    assert recommend._blocks_of_users(weighted, items, no_stage).columns == ["app_id", "users", "weights"]
    monkeypatch.setattr(staging.in_order, "__defaults__", (4,))
    of = {}
    for a, v in vectors:
        of.setdefault(a, []).append(np.array(v, np.float32).astype(float))
    profile = {}
    for u in {u for u, a, _ in pairs if a in of}:
        own = [(w, v) for x, a, w in pairs if x == u for v in of.get(a, [])]
        profile[u] = sum(w * v for w, v in own) / sum(w for w, _ in own)
    got = {r.user_id: r.profile for r in recommend.user_profiles(weighted.filter("user_id is not null"), items, no_stage).collect()}
    assert got.keys() == profile.keys() and all(got[u] == pytest.approx(profile[u]) for u in got)
    near = sorted((r.user_id, r.app_id, r.cosine) for r in recommend.profile_neighbours(weighted, items, no_stage).collect())
    want = sorted((u, a, round(float(profile[u] @ v / np.sqrt((profile[u] @ profile[u]) * (v @ v))), 6)) for u, a in {p[:2] for p in pairs} for v in of.get(a, []))
    assert [r[:2] for r in near] == [r[:2] for r in want] and [r[2] for r in near] == pytest.approx([r[2] for r in want], abs=2e-6)
    files = staging.sorted_files(items.filter("app_id is not null").repartition(3), "app_id", "test")
    ids = [i for b in staging.in_order(files) for i in b.column("app_id").to_pylist()]
    assert ids == sorted(ids) and len(ids) == len(vectors) + 1
