"""Skew, plans, and the paths that only large data takes."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityweave.operators import align, clean, profile
from cityweave.operators.quantiles import exact_quantiles
from workload import feeds


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sides(spark):
    """Key ``hot`` has 40 x 30 x 20 rows, the others a few."""

    def side(name, sizes):
        rows = [("d", city, 1, 0, i) for city, n in sizes.items() for i in range(n)]
        return spark.createDataFrame(rows, f"date string, city string, hour int, minute int, {name} int")

    return [
        side("t", {"hot": 40, "b": 3, "c": 1, "t only": 5}),
        side("w", {"hot": 30, "b": 2, "c": 1}),
        side("a", {"hot": 20, "b": 1, "a only": 2}),
    ]


@pytest.mark.parametrize("cell_rows", [5, 50, 1000, 10_000])
def test_hot_key_is_cut_into_cells_and_nothing_is_lost(spark, cell_rows):
    sides = _sides(spark)
    cells = align.hot_cells(sides, cell_rows=cell_rows, share=10)
    row = cells.first()
    assert cells.count() == 1 and row["city"] == "hot"
    parts = row["s0"] * row["s1"] * row["s2"]
    assert parts >= 40 * 30 * 20 / cell_rows
    joined = align.join_topics(*sides, hot=cells)
    expected = set(itertools.product(range(40), range(30), range(20)))
    hot = [(r["t"], r["w"], r["a"]) for r in joined.where("city = 'hot'").collect()]
    assert len(hot) == len(expected) and set(hot) == expected
    plain = align.join_topics(*sides)
    assert joined.columns == plain.columns
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))


def test_no_hot_key_no_cells(spark):
    assert align.hot_cells(_sides(spark)) is None


def test_rows_per_key_multiply_and_keys_must_be_in_all_topics(spark):
    joined = align.join_topics(*_sides(spark))
    counts = {r["city"]: r["count"] for r in joined.groupBy("city").count().collect()}
    assert counts == {"hot": 24_000, "b": 6}


def test_equal_column_names_are_refused(spark):
    sides = _sides(spark)
    with pytest.raises(ValueError):
        align.join_topics(sides[0], sides[0])


def test_alignment_shuffles_each_topic_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(align.join_topics(*_sides(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 3 and "NestedLoop" not in text and "Cartesian" not in text


def test_boxes_join_on_cells(spark, sf_dir):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 2.0, 1.0)], "city string, min_lon double, min_lat double, max_lon double, max_lat double")
    points = spark.range(10).select((F.col("id") / 3).alias("lon"), (F.col("id") / 5).alias("lat"))
    text = plan(clean.bbox_assign(points, boxes))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_outlier_fences_reach_the_scan(spark, sf_dir):
    text = plan(profile.iqr_outliers(feeds.table(spark, sf_dir, "lineitem").select("l_quantity"), "l_quantity"))
    assert "LessThan(l_quantity" in text and "GreaterThan(l_quantity" in text
    assert "ReadSchema: struct<l_quantity:double>" in text


def test_latest_per_key_reduces_before_the_shuffle(spark, sf_dir):
    text = plan(clean.latest_per_key(feeds.table(spark, sf_dir, "events").drop("props"), "user_id", "ts"))
    assert "partial_max" in text and "Window" not in text


def _numbers(seed, n):
    rnd = random.Random(seed)
    half = [7.0] * (n // 3)  # a third of all rows share one value
    rest = [rnd.lognormvariate(0, 3) for _ in range(n - len(half) - 20)] + [float("nan")] * 10 + [None] * 10
    return half + rest


@pytest.mark.parametrize("exact_rows", [1, 7, 100, 1500])
def test_quantiles_by_narrowing_equal_brute_force(spark, exact_rows):
    columns = {f"c{i}": _numbers(i, 2000) for i in range(4)}
    columns["same"] = [3.0] * 2000
    columns["none"] = [None] * 2000
    columns["two"] = [0.0, 1.0] * 1000
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(3)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = exact_quantiles(df, list(columns), probs, exact_rows=exact_rows)
    for name, data in columns.items():
        present = [x for x in data if x is not None and x == x]
        expected = list(np.percentile(present, [100 * p for p in probs])) if present else [None] * len(probs)
        assert found[name] == (pytest.approx(expected, rel=1e-12) if present else expected), name


def test_unmatched_cities(spark):
    def topic(*names):
        return spark.createDataFrame([(n,) for n in names], "city string")

    rows = align.unmatched_cities(topic("Hanoi", "Ho Chi Minh City"), topic("Ha Noi", "Ho Chi Minh"), topic("ha noi")).collect()
    assert {(r["city"], r["topics"]) for r in rows} == {("ho chi minh city", 1), ("ho chi minh", 1)}


def test_repeats_are_counted_before_they_meet(spark):
    """A bucket in which every side repeats one reading a hundred times: one combination, a million times."""

    def topic(**columns):
        value = ", ".join(f"{v} AS {k}" for k, v in columns.items())
        return spark.range(100).selectExpr("'Hanoi' AS city", "'2025-01-01' AS date", "concat('10:00:', lpad(id % 60, 2, '0')) AS time", value)

    topics = [topic(t="1"), topic(w="id % 2"), topic(a="3")]
    each = align.align_counted(*topics, bucket_minutes=60, cell_rows=10, share=10).collect()
    assert sorted((r.t, r.w, r.a, r.copies) for r in each) == [(1, 0, 3, 500_000), (1, 1, 3, 500_000)]
    assert align.align_topics(*topics, bucket_minutes=60).count() == 1_000_000


def test_hot_key_of_rows_that_repeat_is_cut_as_planned(spark):
    rows = [("d", "hot", 1, 0, i % 40) for i in range(400)]
    sides = [align.counted(spark.createDataFrame(rows, f"date string, city string, hour int, minute int, {n} int"), f"c{n}") for n in "tw"]
    cells = align.hot_cells(sides, cell_rows=100, share=10)
    row = cells.first()
    assert row.s0 * row.s1 >= 16
    salted = align._salted(sides[0], cells, 0, 2)
    assert max(r["count"] for r in salted.groupBy("p0", "p1").count().collect()) <= 4 * 40 / row.s0


def test_nothing_is_shuffled_after_the_alignment(spark, sf_dir):
    text = plan(feeds.fixed_model().label(clean.dropna_any(align.align_counted(*feeds.stored(spark, sf_dir), bucket_minutes=240))))
    joins = text.index("Join")
    assert "Exchange" not in text[:joins] and "Aggregate" not in text[:joins]


def test_densities_need_no_row_per_point(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    text = plan(profile.kde_curve(df, ["x"]))
    assert text.count("Generate") == 2  # the columns before the sums, the points after them
    assert "Generate" not in text[text.index("Aggregate") : text.rindex("Aggregate")]


def test_digests_travel_to_count_duplicates(spark):
    df = spark.createDataFrame([("a", 0.0, None), ("a", -0.0, None), ("a", 0.0, "x"), (None, 0.0, "x"), (None, 0.0, "x")], "t string, d double, u string")
    assert profile.profile_duplicates(df).first()[0] == 2
    assert "hashpartitioning(digest" in plan(profile.profile_duplicates(df))


def test_levels_are_numbered_alike_however_they_are_joined(spark):
    from cityweave.operators import features

    df = spark.range(3000).select(F.concat(F.lit("v"), (F.col("id") * 7919 % 211).cast("string")).alias("v"))
    for encode in (features.label_encode, features.string_index):
        few, many = (sorted(map(tuple, encode(df, "v", "n", few=n).collect())) for n in (1000, 1))
        assert few == many and {n for _, n in few} == set(range(211))


def test_tail_of_a_large_sample(spark):
    from cityweave.operators.stats import _upper_tail

    # With two degrees of freedom the tail is (1 + 2 f / d2) ** (-d2 / 2).
    for d2 in (10, 10**6, 10**12, 10**13):
        for f in (0.1, 1.0, 3.0, 30.0):
            assert _upper_tail(spark, f, 2, d2) == pytest.approx(np.exp(-d2 / 2 * np.log1p(2 * f / d2)), rel=1e-5)
