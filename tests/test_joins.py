import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lanelux.operators import joins
from lanelux.operators.joins import band_join, hot_keys, interval_join, key_shares, skew_safe_join

WAYS = [{}, {"broadcast_rows": 0, "rows_per_task": 1_000_000}, {"broadcast_rows": 0, "rows_per_task": 7}, {"rows_per_task": 150}]


@pytest.fixture(scope="module")
def fact(spark):
    """A third of all rows share one key; some keys are NULL."""
    rnd = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None]), rnd.randint(0, 300)) for i in range(600)]
    return spark.createDataFrame(data, "id long, k string, v int")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("z", 4), (None, 5)], "k string, w int")


@pytest.mark.parametrize("way", range(len(WAYS)))
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_safe_join_equals_plain_join(spark, rows, fact, dim, how, way):
    way = dict(WAYS[way])
    if way:
        # Small enough for two rows of hot keys, too small for the five of the other side.
        way["broadcast_rows"] = 4
    got = skew_safe_join(fact, dim, ["k"], how=how, spread_by=["id"], **way)
    want = fact.join(dim, "k", how)
    names = sorted(want.columns)
    assert rows(got.select(*names)) == rows(want.select(*names))


def test_join_condition_applies_on_every_path(fact, dim, rows):
    plain = fact.join(dim, (fact.k == dim.k) & (fact.v > dim.w * 50)).select("id", "w")
    for limits in ({}, {"broadcast_rows": 4, "rows_per_task": 7}):
        got = skew_safe_join(fact, dim, ["k"], condition=F.col("v") > F.col("w") * 50, spread_by=["id"], **limits)
        assert rows(got.select("id", "w")) == rows(plain)


def test_hot_keys_are_split_and_few(fact):
    hot = {r["_hot_k"]: r["_shares"] for r in hot_keys(fact, ["k"], 50, 10).collect()}
    assert hot["hot"] == 4
    # Without room for their list, all keys are split alike.
    assert hot_keys(fact, ["k"], 19, 1) is None


@pytest.mark.parametrize("rows_per_task", [1, 7, 50, 1000])
@pytest.mark.parametrize("room", [0, 1, 4, 100])
def test_no_share_is_larger_than_a_task_should_hold(fact, rows_per_task, room):
    """Also where the list of hot keys has no room, and then no key is split much finer than it must be."""
    counts = {r["k"]: r["count"] for r in fact.groupBy("k").count().collect()}
    listed, others = key_shares(fact, ["k"], rows_per_task, room)
    hot = {r["_hot_k"]: r["_shares"] for r in listed.collect()}
    assert len(hot) <= room
    for k, n in counts.items():
        assert n <= hot.get(k, others) * rows_per_task
        assert k not in hot or (hot[k] - 1) * rows_per_task < n
    assert others == 1 or sum(n > others // 2 * rows_per_task for n in counts.values()) > room


def test_no_task_gets_the_whole_hot_key(fact, dim):
    joined = skew_safe_join(fact, dim, ["k"], spread_by=["id"], broadcast_rows=4, rows_per_task=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_share" in plan


SEGMENTS = [
    ("r1", "0.0", "10.0", "s0"),
    ("r1", "10.0", "20.0", "s1"),
    ("r1", "15.0", "47.5", "s2"),
    ("r1", "30.0", "25.0", "reversed"),
    ("r1", None, "25.0", "open"),
    ("r2", "0.0", "99999999.0", "long"),
    ("r2", "9.99999999", "10.00000001", "thin"),
]


@pytest.mark.parametrize("way", range(3))
def test_interval_join_equals_brute_force(spark, rows, way):
    limits = [{}, {"broadcast_rows": 0}, {"broadcast_rows": 20, "rows_per_task": 3}][way]
    if way == 1:
        limits = {"broadcast_rows": 20, "rows_per_task": 10_000}
    rnd = random.Random(2)
    points = [(i, rnd.choice(["r1", "r1", "r2", "r3"]), Decimal(rnd.choice([0, 10, 20, 25, 47]) + rnd.choice([0, 1, 5]) / 10)) for i in range(200)]
    points.append((1000, "r2", Decimal("500000.25")))
    points.append((1001, "r2", None))
    segments = [(k, lo and Decimal(lo), Decimal(hi), n) for k, lo, hi, n in SEGMENTS]
    p = spark.createDataFrame(points, "id long, road string, at decimal(10,4)")
    s = spark.createDataFrame(segments, "road string, lo decimal(38,8), hi decimal(38,8), name string")
    got = interval_join(p, s, ["road"], "at", "lo", "hi", cell=10.0, domain=(-1000.0, 1000.0), spread_by=["id"], **limits)
    want = sorted(
        (i, n) for i, r, a in points for k, lo, hi, n in segments
        if a is not None and lo is not None and r == k and lo <= round(a, 4) <= hi
    )
    assert sorted((r["id"], r["name"]) for r in got.select("id", "name").collect()) == want
    assert len({w for w in want if w[0] == 1000}) == 1


def test_cells_of_a_road_with_most_rows_on_one_kilometre(spark):
    """90% of the rows lie on 1 of 100 km: parts of the dense cell hold few rows each, and the join is exact."""
    rnd = random.Random(5)
    near = [round(rnd.uniform(42, 43) if rnd.random() < 0.9 else rnd.uniform(0, 100), 4) for _ in range(6000)]
    points = spark.createDataFrame([(i, "r1", Decimal(str(at))) for i, at in enumerate(near)], "id long, road string, at decimal(10,4)")
    segments = [("r1", Decimal(k) / 20, Decimal(k + 1) / 20, k) for k in range(2000)] + [("r1", Decimal(0), Decimal(100), -1)]
    s = spark.createDataFrame(segments, "road string, lo decimal(18,4), hi decimal(18,4), seg long")
    placed = points.withColumn("_cell", F.floor(F.col("at").cast("double") / 10))
    cuts = joins.dense_cells(placed, ["road"], "at", 1000)
    assert cuts.count() == 1
    parted = placed.join(cuts, ["road", "_cell"], "left").groupBy("_cell", joins.part_of(F.col("at")).alias("p")).count()
    largest = parted.agg(F.max("count")).first()[0]
    assert placed.groupBy("_cell").count().agg(F.max("count")).first()[0] > 5000 and largest < 250
    got = interval_join(
        points, s, ["road"], "at", "lo", "hi", cell=10.0, domain=(0.0, 100.0), spread_by=["id"], broadcast_rows=0, rows_per_task=1000
    )
    assert "_part" not in got.columns
    want = sorted((i, k) for i, at in enumerate(near) for _, lo, hi, k in segments if lo <= Decimal(str(at)) <= hi)
    assert sorted((r["id"], r["seg"]) for r in got.select("id", "seg").collect()) == want


BANDS = {
    "plain": [("A", 0, 49), ("B", 50, 99), ("C", 100, 2_147_483_647)],
    "overlap": [("A", 0, 60), ("B", 50, 99), ("C", 90, 300)],
    "gap": [("A", 0, 40), ("B", 60, 99)],
}


@pytest.mark.parametrize("kind", sorted(BANDS))
@pytest.mark.parametrize("broadcast_bands", [1000, 0])
def test_band_join_equals_brute_force(spark, fact, kind, broadcast_bands):
    bands = spark.createDataFrame(BANDS[kind], "klasse string, lo int, hi int")
    got = band_join(fact, bands, "v", "lo", "hi", spread_by=["id"], broadcast_bands=broadcast_bands, rows_per_task=50)
    want = sorted((r["id"], k) for r in fact.collect() for k, lo, hi in BANDS[kind] if lo <= r["v"] <= hi)
    assert sorted((r["id"], r["klasse"]) for r in got.select("id", "klasse").collect()) == want


def test_band_join_of_nothing(spark, fact):
    bands = spark.createDataFrame(BANDS["plain"], "klasse string, lo int, hi int")
    assert band_join(fact.where("v < 0"), bands, "v", "lo", "hi", broadcast_bands=0).count() == 0


def test_places_in_an_order(spark):
    """Places equal those of a sort, with ties, nulls and more ranges than rows; no window takes all rows."""
    from lanelux.operators.order import numbered

    rows = spark.range(500).selectExpr("if(id % 9 = 0, null, (id * 7919) % 50) AS a", "cast(id % 3 AS string) AS b", "id")
    got = numbered(rows, ["a", F.desc("b"), "id"])
    want = sorted(rows.collect(), key=lambda r: (r["a"] is not None, r["a"] or 0, -int(r["b"]), r["id"]))
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r["place"])] == [tuple(r) for r in want]
    assert sorted(r["place"] for r in numbered(rows, ["b"]).collect()) == list(range(1, 501))
    assert numbered(rows.limit(0), ["a"]).count() == 0
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
