"""Hot keys: a third of the rows on one key, a third without a key, many exact copies."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import dedup, quantiles, skew
from siltstone.plans import recommend

ROWS = 30_000


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Written to files, so that the file position can be the order."""
    path = str(tmp_path_factory.mktemp("skew") / "facts")
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 5000)
    spark.range(ROWS, numPartitions=8).select(
        key.cast("bigint").alias("k"), (F.col("id") % 4).alias("v"), F.col("id")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def shuffle_joins(spark):
    """No automatic broadcast and no merging of small partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_share(df) -> float:
    """Share of the fullest task; uses ``n``, or Spark would drop the join."""
    tasks = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("count"), F.max("n").alias("used"))
    sizes = [r["count"] for r in tasks.collect()]
    return max(sizes) / sum(sizes)


def test_hot_rows_are_spread(facts, shuffle_joins):
    lookup = facts.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    plain = largest_share(facts.join(lookup.hint("shuffle_merge"), "k", "left"))
    spread = largest_share(skew.counted_join(facts, lookup, ["k"]))
    assert plain > 0.33
    assert spread < 0.2


def test_lookup_join_equals_plain_join(facts, shuffle_joins):
    lookup = facts.filter("k % 2 = 1").groupBy("k").agg(F.max("id").alias("last"))
    for how in ("left", "inner"):
        ours = skew.lookup_join(facts, lookup, ["k"], how).select("id", "k", "last")
        plain = facts.join(lookup, "k", how).select("id", "k", "last")
        assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, plain.collect()))


def test_mark_all_copies(facts, no_stage):
    rows = [tuple(r) for r in facts.select("k", "id").collect()]
    count = Counter(k for k, _ in rows if k is not None)
    for stage in (None, no_stage):
        marked = dedup.mark_all_copies(facts, ["k"], stage).select("id", "is_duplicate").collect()
        assert len(marked) == ROWS
        want = {i: k is not None and count[k] > 1 for k, i in rows}
        assert {r.id: r.is_duplicate for r in marked} == want


def test_mark_later_copies_of_equal_rows(spark, facts):
    """Rows that are equal in every column still leave exactly one first row per key."""
    from siltstone.sources.readers import ROW_ID, with_row_id

    copies = with_row_id(facts).select("k", "v", *ROW_ID)
    marked = dedup.mark_later_copies(copies, ["k"], ROW_ID)
    assert marked.count() == ROWS
    firsts = marked.filter("NOT is_duplicate AND k IS NOT NULL")
    assert firsts.count() == firsts.select("k").distinct().count() == facts.select("k").distinct().count() - 1
    assert marked.filter("is_duplicate AND k IS NULL").count() == 0


def test_keep_first(facts):
    want = {}
    for r in facts.orderBy("id").collect():
        want.setdefault(r.k, r.id)
    for unique in (False, True):
        rows = dedup.keep_first(facts, ["k"], ["id"], unique).collect()
        assert {r.k: r.id for r in rows} == want and len(rows) == len(want)


def test_keep_first_by_address_leaves_the_payload_alone(facts):
    """Neither sorts nor aggregates hold a column besides key and order, but for rows without a key."""
    wide = facts.select("*", *[F.concat(F.lit("payload"), "id").alias(f"payload{i}") for i in range(3)]).filter("k is not null")
    plan = dedup.keep_first(wide, ["k"], ["id"], unique=True)._jdf.queryExecution().optimizedPlan().toString()
    heavy = [line for line in plan.splitlines() if line.strip(" +-:").startswith(("Aggregate", "Sort"))]
    assert heavy and not any("payload" in line for line in heavy if "min_by" not in line)


def test_exact_quantiles_of_awkward_values(spark):
    """One value for most rows, negatives, tiny and huge values, an empty column."""
    import math
    import random

    rng = random.Random(5)
    heavy = [1.0] * 700 + [rng.lognormvariate(3, 4) for _ in range(299)] + [1e300]
    mixed = [rng.gauss(0, 1e-6) for _ in range(500)] + [-math.exp(rng.uniform(0, 40)) for _ in range(500)]
    df = spark.createDataFrame([(h, m, None, float("nan")) for h, m in zip(heavy, mixed)],
                               "heavy double, mixed double, none double, nan double")
    qs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.column_name, r["quantile"]): r.value
           for r in quantiles.exact_quantiles(df, ["heavy", "mixed", "none", "nan"], qs).collect()}
    for name, values in (("heavy", sorted(heavy)), ("mixed", sorted(mixed))):
        for q in qs:
            assert got[name, q] == values[max(1, math.ceil(q * len(values))) - 1], (name, q)
    assert {name for name, _ in got} == {"heavy", "mixed"}


@pytest.fixture(scope="module")
def measures(spark, tmp_path_factory):
    """Whole numbers, one value for nine tenths of the rows, and two far apart clusters."""
    path = str(tmp_path_factory.mktemp("quantiles") / "measures")
    spark.range(0, 40_000, 1, 8).select(
        ((F.col("id") * 7919) % 40_009).cast("int").alias("whole"), F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id") / 3).alias("hot"),
        F.when(F.col("id") % 3 == 0, 1e15 + F.col("id")).otherwise(F.col("id") * 1e-9).alias("far")).write.parquet(path)
    return spark.read.parquet(path)


def expected_quantiles(df, qs):
    import math

    out = {}
    for name in df.columns:
        values = sorted(r[0] for r in df.select(name).collect())
        out |= {(name, q): float(values[max(1, len(values) - math.floor(len(values) - q * len(values))) - 1]) for q in qs}
    return out


@pytest.mark.parametrize(("ranked", "room"), [(100_000, None), (10, None), (10, 1.0), (100_000, -0.01)])
def test_quantiles_of_narrow_and_wrong_brackets(measures, monkeypatch, ranked, room):
    """All values in one bracket that has to be cut again and again; and brackets that lie beside the rank."""
    monkeypatch.setattr(quantiles, "RANKED", ranked)
    if room is not None:
        monkeypatch.setattr(quantiles, "ROOM", room)
    if room is not None and room < 0:
        real = quantiles._brackets
        monkeypatch.setattr(quantiles, "_brackets", lambda *a: {
            pair: [n, *sorted((low, high))] for pair, (n, low, high) in real(*a).items()})
    qs = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = {(r.column_name, r["quantile"]): r.value for r in quantiles.exact_quantiles(measures, measures.columns, qs).collect()}
    assert got == expected_quantiles(measures, qs)


def test_quantiles_scan_the_table_twice(measures):
    """One written table of counts, one sketch before it; what comes out reads the counts alone."""
    from siltstone.sources.staging import stage as write

    written = []

    def stage(df, name):
        written.append((name, df._jdf.queryExecution().executedPlan().toString().count("Scan parquet")))
        return write(df, name)

    found = quantiles.exact_quantiles(measures, measures.columns, [0.5, 0.999], stage)
    assert written == [("bracket-values", 1)]
    assert found.count() == 6
    folder = measures.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    assert folder not in found._jdf.queryExecution().executedPlan().toString()


def test_similarity_is_exact(spark):
    """Against brute force, with a group of equal items and small blocks."""
    import random

    rng = random.Random(3)
    tags = {i: frozenset(rng.sample("abcdefghij", rng.randint(1, 6))) for i in range(120)}
    tags |= {i: frozenset("abc") for i in range(120, 200)}
    bridge = spark.createDataFrame([(i, t) for i, ts in tags.items() for t in ts], "app_id bigint, tag string")
    names = {}
    for i in sorted(tags):
        names.setdefault(tags[i], i)
    sets = sorted(names.items(), key=lambda item: item[1])
    for threshold in (0.3, 0.5, 0.6, 0.8, 1.0):
        want = {
            (a, b): len(x & y) / len(x | y)
            for n, (x, a) in enumerate(sets) for y, b in sets[n + 1:] if len(x & y) / len(x | y) >= threshold - 1e-9}
        got = recommend.content_similarity(bridge, threshold, block=10).collect()
        assert {(r.set_id_a, r.set_id_b): r.jaccard for r in got} == pytest.approx(want)
        assert len(got) == len(want)


def test_index_rows_are_linear(spark):
    """Sets of 50, 100 and 200 tags: two fifths of the tags, and one."""
    bridge = spark.createDataFrame([(n, f"{n} {k}") for n in (50, 100, 200) for k in range(n)] + [(1, "x")], "app_id bigint, tag string")
    ordered = bridge.groupBy(F.col("app_id").alias("set_id")).agg(F.sort_array(F.collect_list(F.struct(F.lit(1).alias("n"), "tag"))).alias("ranked"))
    rows = {r.set_id: r["count"] for r in recommend.prefix_index(ordered, 0.6, 2000).groupBy("set_id").count().collect()}
    assert rows == {1: 1, 50: 21, 100: 41, 200: 81}


def test_dense_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7_000_000_000).alias("big")).union(spark.range(5).toDF("big"))
    ids = recommend.dense_ids(df, "big", "no", buckets=8).collect()
    assert sorted(r.no for r in ids) == list(range(len({r.big for r in ids})))
