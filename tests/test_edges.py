"""The edge cases of FIXTURES.md on hand-made rows."""

import bisect
import json
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cityweave.functions import timeparts, values
from cityweave.operators import choices, clean, features, flatten, kept, lines, profile, quality, stats
from cityweave.plans import jobs
from cityweave.schemas import ENVELOPE, INT, RAW, TEXT, struct
from cityweave.sinks.files import fan_out, write_documents, write_json
from cityweave.sources.concat_json import read_concat_json
from cityweave.sources.topics import read_collection, read_topic

NAN = float("nan")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_concatenated_objects(spark, tmp_path):
    (tmp_path / "a").write_text('{"a":1}{"a":2}\n{"a":3}')
    (tmp_path / "b").write_text('{"a":4} \n {"a":5}{"a":')
    good, bad = clean.valid_records(read_concat_json(spark, str(tmp_path), struct(a=INT)))
    assert sorted(column(good, "a")) == [1, 2, 3, 4, 5]
    assert column(bad, "_corrupt_record") == ['{"a":']


def test_concatenated_objects_cut_by_the_reader(spark, tmp_path):
    (tmp_path / "a").write_text('{"a":1,"b":{"c":"x"}}{"a":2}{"a":3,"b":{"c":"y"}}')
    (tmp_path / "b").write_text('{"a":4}')
    schema = struct(a=INT, b=struct(c=TEXT))
    good, bad = clean.valid_records(read_concat_json(spark, str(tmp_path), schema, whole_files=False))
    assert sorted(column(good, "a")) == [1, 2, 3, 4] and bad.count() == 0


def test_objects_are_told_apart_outside_of_strings(spark, tmp_path):
    texts = ['{"a":1}\n{"a":2}{"a":3}', '{"a":4,"s":"x} {y}{z"} {"a":5,"s":"}"}', '{"a":6,"s":"\\"}{\\\\"}{"a":7}  ', "{}{}"]
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.json").write_text(text)
    schema = struct(a=INT, s=TEXT)
    for whole in (True, False):
        good, bad = clean.valid_records(read_concat_json(spark, str(tmp_path), schema, whole_files=whole))
        assert bad.isEmpty()
        got = sorted((r.a is None, r.a or 0, r.s) for r in good.collect())
        assert [a for none, a, _ in got if not none] == [1, 2, 3, 4, 5, 6, 7] and sum(none for none, _, _ in got) == 2
        assert {r.s for r in good.collect()} == {None, "x} {y}{z", "}", '"}{\\'}


def test_more_than_one_object_is_rejected_whole(spark):
    texts = ['{"a":1}{"a":2}', '{"a":1} x', 'x {"a":1}', '[{"a":1}]', '{"a":1}]', '{"a":1}],[{"a":2}', '{"a":"}', '{"a":1', "", None, "12", '{"a":1}}']
    good = ['{"a":1}', ' {"a":1}\n', '{"a":1,"b":{"c":[{},"}{"]}}', "{}"]
    lines = spark.createDataFrame([(t,) for t in texts + good], "value string")
    kept, bad = clean.valid_records(clean.parse_records(lines, struct(a=INT)))
    assert kept.count() == len(good)
    assert sorted(r._corrupt_record for r in bad.collect()) == sorted(t or "" for t in texts)


def test_lines_that_are_no_records_are_kept_aside(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"location":{"name":"a"}}\n{"location":\n\n{"location":{"name":"b"}}{"location":{"name":"c"}}\n')
    assert [r.location.name for r in read_topic(spark, "air", str(tmp_path)).collect()] == ["a"]
    rows = read_topic(spark, "air", str(tmp_path), rejects=True).collect()
    assert sorted(r._corrupt_record or "" for r in rows) == ["", '{"location":', '{"location":{"name":"b"}}{"location":{"name":"c"}}']
    spark.read.text(str(tmp_path)).createOrReplaceTempView("air_lines")
    assert read_topic(spark, "air", "air_lines", format="table").count() == 4


def test_concatenated_objects_as_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text('{"a":1}{"a":2}\n{"a":3}')
    stream = read_concat_json(spark, str(tmp_path / "in"), struct(a=INT), streaming=True)
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(column(spark.read.parquet(str(tmp_path / "out")), "a")) == [1, 2, 3]


def test_records_that_do_not_parse(spark):
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":',), (None,), ("  ",)], "value string")
    good, bad = clean.valid_records(clean.parse_records(lines, struct(a=INT)))
    assert column(good, "a") == [1]
    assert sorted(column(bad, "_corrupt_record")) == ["", "  ", '{"a":']


TRAFFIC_LINES = [
    '{"_id":"1","properties":{"id":"1","city":"Hanoi","iconCategory":1,"magnitudeOfDelay":2,"startTime":"2025-01-01T10:00:00Z",'
    '"length":5,"delay":3,"events":[{"code":7,"description":"x"},{"code":8,"description":"y"}]}}',
    '{"_id":"2","properties":{"id":"2","city":"Hanoi","iconCategory":1,"magnitudeOfDelay":2,"startTime":"2025-01-01T10:00:00Z",'
    '"length":5,"delay":3,"events":[]}}',
    '{"_id":"3","properties":{"id":"3","city":"Hanoi","iconCategory":1,"magnitudeOfDelay":2,"startTime":null,"length":5,'
    '"delay":3,"events":[{"code":7,"description":"x"}]}}',
    '{"_id":"4","properties":null}',
    '{"_id":"5","properties":{"id":"5","city":"Hanoi","iconCategory":1,"magnitudeOfDelay":2,"startTime":"NaT","length":5,"delay":3}}',
]


def _traffic(spark):
    lines = spark.createDataFrame([(t,) for t in TRAFFIC_LINES], "value string")
    return clean.valid_records(clean.parse_records(lines, RAW["traffic"]))[0]


def test_first_event_of_none_some_and_missing(spark):
    flat = flatten.flatten_traffic(_traffic(spark)).orderBy("_id")
    assert column(flat, "event_code") == [7, None, 7, None, None]


def test_traffic_job_drops_what_is_incomplete(spark):
    rows = jobs.topic_job(_traffic(spark), "traffic").collect()
    assert [(r["_id"], r["date"], r["time"], r["length"]) for r in rows] == [("1", "2025-01-01", "10:00:00", 5.0)]


def test_missing_location_is_dropped(spark):
    text = '{"current":{"uv":1,"air_quality":{"co":1,"o3":1,"so2":1,"pm2_5":1,"pm10":1,"us-epa-index":1,"gb-defra-index":1}},"report_time":"2025-01-01 00:00:00"}'
    full = text.replace('{"current"', '{"location":{"name":"Hanoi"},"current"', 1)
    lines = spark.createDataFrame([(text,), (full,), (full,)], "value string")
    raw = clean.valid_records(clean.parse_records(lines, RAW["air"]))[0]
    assert column(jobs.topic_job(raw, "air"), "city") == ["Hanoi"]


def test_pollers_clock_in_another_zone(spark):
    df = spark.createDataFrame([("2025-01-01 05:30:00",)], "report_time string")
    row = timeparts.split_report_time(df, source_tz="Asia/Ho_Chi_Minh").first()
    assert (row["date"], row["time"]) == ("2024-12-31", "22:30:00")


def test_times(spark):
    df = spark.createDataFrame([("2025-01-01 10:00:00",), ("2025-01-01 10:00:00.5",), ("NaT",), (None,)], "report_time string")
    assert column(timeparts.split_report_time(df), "time") == ["10:00:00", "10:00:00.500000", None, None]
    iso = spark.createDataFrame([("2025-01-01T10:00:00Z",), ("2025-01-01T10:00:00+07:00",), (None,), ("x",)], "t string")
    assert column(iso.select(timeparts.clock_text(timeparts.iso_to_naive(F.col("t"))).alias("t")), "t") == [
        "2025-01-01 10:00:00", "2025-01-01 03:00:00", None, None,
    ]


def test_times_do_not_depend_on_the_session_zone(spark):
    iso = spark.createDataFrame([("2025-03-30T01:30:00Z",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        text = timeparts.clock_text(timeparts.iso_to_naive(F.col("t")))
        epoch = timeparts.clock_text(timeparts.epoch_to_clock(F.lit(1743298200)))
        assert tuple(iso.select(text, epoch).first()) == ("2025-03-30 01:30:00",) * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_buckets(spark):
    df = spark.createDataFrame([(13, 59), (0, 4)], "hour int, minute int")
    assert [tuple(r) for r in timeparts.bucket_start(df, 15).collect()] == [(13, 45), (0, 0)]
    assert [tuple(r) for r in timeparts.bucket_start(df, 240).collect()] == [(12, 0), (0, 0)]
    with pytest.raises(ValueError):
        timeparts.bucket_start(df, 7)


def test_city_names(spark):
    df = spark.createDataFrame([("Hanoi",), ("Hanoi Old Quarter",), ("HANOI",), ("Ap Ba",), (None,)], "city string")
    assert column(values.normalise_city(df), "city") == ["ha noi", "hanoi old quarter", "hanoi", "da nang", None]


def test_single_objects_among_random_texts(spark):
    draw = random.Random(3)
    signs = ['{"a":1}', '{"a":2,"b":[{"c":"}"}]}', "{", "}", "[", "]", ",", " ", '"', '"b":1', "1", '\\', ":", "null", "{}", "\n"]
    texts = {"".join(draw.choice(signs) for _ in range(draw.randint(1, 6))) for _ in range(4000)}
    texts |= {f'{{"a":1}}{rest}' for rest in ("", " ", "]", "]{}", '],"a":{"b":2}', ',"x":2', "}", "} ", ',{"a":2}', "x", ']}', "}]", '],[{"a":1}', " null")}
    lines = spark.createDataFrame([(t,) for t in sorted(texts)], "value string").withColumn("text", F.col("value"))

    def single(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    for bad in ("_corrupt_record", "bad\"'s `column`"):
        rows = clean.parse_records(lines, struct(a=INT), bad=bad).collect()
        assert len(rows) == len(texts)
        # A string whose quotes or escapes are broken may still be one of the parser's own notations; none is among these.
        wrong = [(r["text"], r[bad]) for r in rows if (r[bad] is None) != single(r["text"]) or r[bad] not in (None, r["text"])]
        assert not wrong, wrong[:10]


def test_choice(spark):
    df = spark.createDataFrame([((1.5, None),), ((None, 2),), ((1.5, 2),), ((None, None),)], "c struct<double:double,int:int>")
    assert column(df.select(values.resolve_choice(F.col("c")).alias("c")), "c") == [1.5, 2.0, 1.5, None]


def test_kinds_of_a_field(spark):
    sent = {
        "12.5": ("double", 12.5), "3": ("int", 3.0), "5.0": ("double", 5.0), '"7.25"': ("string", 7.25), '"far"': ("string", None), "null": ("null", None),
        "1e3": ("double", 1000.0), "true": ("boolean", None), "[1]": ("array", None), '{"b": 1}': ("object", None), "99999999999999999999": ("double", 1e20),
        '"NaN"': ("string", None), '"Infinity"': ("string", None), '""': ("string", None),
    }
    rows = [(t, '{"a b": {"it\'s": %s}}' % t) for t in sent] + [("absent", '{"a b": {}}'), ("cut", '{"a b":'), ("none", None), ("list", "[1, 2]")]
    df = spark.createDataFrame(rows, "t string, text string").select("t", choices.open_record(F.col("text")).alias("record"))
    value = choices.nested(F.col("record"), "a b", "it's")
    found = {r["t"]: (r["kind"], r["number"]) for r in df.select("t", choices.kind(value).alias("kind"), choices.number_of(value).alias("number")).collect()}
    assert found == sent | {t: ("missing", None) for t in ("absent", "cut", "none", "list")}
    with pytest.raises(ValueError):
        choices.place("'", "\"'")
    kinds = choices.field_kinds(df)
    told = {(".".join(r["path"]), r["kind"]): r["rows"] for r in kinds.collect()}
    name = "a b.it's"
    assert told == {
        (name, "double"): 4, (name, "int"): 1, (name, "string"): 5, (name, "null"): 1, (name, "boolean"): 1, (name, "array"): 1,
        (name + ".b", "int"): 1, ("a b", "object"): 1, ("", "array"): 1,
    }
    assert [tuple(r) for r in choices.choices(kinds).collect()] == [(["a b", "it's"], ["array", "boolean", "double", "int", "string"], 12)]
    assert {(".".join(r["path"]), r["kind"]): r["rows"] for r in choices.field_kinds(df, depth=1).collect()} == {("a b", "object"): 15, ("", "array"): 1}
    assert choices.field_kinds(df.limit(0)).count() == 0


def test_profiles_kept_day_by_day(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("topic"),
        F.when(F.col("id") % 5 > 0, F.hash("id") % 1000).cast("double").alias("x"), F.lit(None).cast("int").alias("gone"),
        F.when(F.col("id") % 3 == 0, NAN).otherwise(0.0).alias("`z.z"),
    )
    for k in (200, 4096):
        daily = kept.profiles(rows, ["topic", "day"], ["x", "gone", "`z.z"], k=k)
        assert daily.count() == 90  # a day has one topic here
        found = {(r["topic"], r["column"]): r for r in kept.kept_quantiles(kept.merged(daily, ["topic"]), (0.0, 0.1, 0.5, 0.99, 1.0)).collect()}
        for topic in ("a", "b"):
            gone, zeros, x = (found[topic, c] for c in ("gone", "`z.z", "x"))
            assert (gone["rows"], gone["missing"], gone["low"], gone["quantiles"]) == (30_000, 30_000, None, None)
            assert (zeros["missing"], zeros["zeros"], zeros["quantiles"]) == (10_000, 20_000, [0.0] * 5)
            values = sorted(r["x"] for r in rows.where(F.col("topic") == topic).select("x").na.drop().collect())
            assert (x["rows"], x["missing"], x["low"], x["high"]) == (30_000, 30_000 - len(values), values[0], values[-1])
            assert (x["quantiles"][0], x["quantiles"][-1]) == (values[0], values[-1])
            for p, at in zip((0.1, 0.5, 0.99), x["quantiles"][1:4], strict=True):
                room = 3 * kept.rank_error(k) * len(values)
                assert bisect.bisect_left(values, at) - room <= p * len(values) <= bisect.bisect_right(values, at) + room
    whole = {r["column"]: r["rows"] for r in kept.merged(kept.merged(daily, ["topic"])).collect()}
    assert whole == {"x": 60_000, "gone": 60_000, "`z.z": 60_000}
    assert kept.merged(kept.profiles(rows.limit(0), ["topic"]), ["topic"]).count() == 0
    assert {r["column"] for r in kept.profiles(rows.limit(5), ["topic"]).select("column").collect()} == {"day", "x", "gone", "`z.z"}
    with pytest.raises(ValueError):
        kept.kept_quantiles(daily, [1.5])


def test_gaps_and_repeats(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, NAN), (1, 1.0)], "a int, b double")
    assert sorted(column(clean.dropna_any(df), "a")) == [1, 1]
    twice = spark.createDataFrame([(1, NAN, None), (1, NAN, None), (1, NAN, "x")], "a int, b double, c string")
    assert clean.dedupe_rows(twice).count() == 2
    assert profile.profile_duplicates(twice).first()["duplicates"] == 1
    assert {r["column"]: r["nulls"] for r in profile.profile_nulls(twice).collect()} == {"a": 0, "b": 3, "c": 2}
    assert column(features.impute_mean(df, ["b"]).orderBy("a"), "b") == [1.0] * 4


def test_repeats_that_differ_only_in_their_folder(spark):
    raw = _traffic(spark).where("_id = '1'")
    raw = raw.withColumn("partition_3", F.lit("01")).unionByName(raw.withColumn("partition_3", F.lit("02")))
    assert jobs.topic_job(raw, "traffic").count() == 1


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert flatten.drop_columns(df, "b", "zz").columns == ["a"]
    with pytest.raises(ValueError):
        flatten.drop_columns(df, "zz", strict=True)


def test_box_edges(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 2.0, 1.0), ("b", 2.0, 0.0, 3.0, 1.0)], "city string, min_lon double, min_lat double, max_lon double, max_lat double")
    points = spark.createDataFrame([(1, 2.0, 1.0), (2, 2.5, 0.5), (3, 9.0, 9.0), (4, 0.0, 0.0), (5, -0.1, 0.5)], "id int, lon double, lat double")
    found = {(r["id"], r["city"]) for r in clean.bbox_assign(points, boxes).collect()}
    assert found == {(1, "a"), (1, "b"), (2, "b"), (4, "a")}


BOXES = "city string, min_lon double, min_lat double, max_lon double, max_lat double"


def test_lines_meet_boxes(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 2.0, 1.0), ("b", 2.0, 0.0, 3.0, 1.0), ("none", 5.0, 0.0, 4.0, 1.0)], BOXES)
    texts = {
        1: "[[-1, 0.5], [4, 0.5]]",  # through both, no position inside
        2: "[[-1, -1], [0, 0]]",  # ends on a corner
        3: "[[-1, 0.5], [1, 2.5]]",  # passes the corner by
        4: "[2.0, 1.0]",  # a point on the corner of both
        5: "[[[0.5, -9], [0.5, 9]], [[2.5, 0.25, 7], [2.5, 0.75, 7]]]",  # upright lines, with heights
        6: "[[0.5, 0.5], [0.5]]", 7: "[[0.5, NaN], [0.5, 1]]", 8: "[[1e9, 0.5], [-1e9, 0.5]]", 9: "[]", 10: "", 11: None, 12: "x", 13: "[[[]]]",
        14: "[[[0.5, 0.5]], [[null, 1]]]",  # the good one of two paths counts
    }
    lines_of = spark.createDataFrame(list(texts.items()), "id int, coordinates string").withColumn("_x.y", F.lit(1))
    for cell in (0.3, 1.0, 50.0):
        found = lines.lines_in_boxes(lines_of, boxes, cell=cell)
        assert found.columns == ["id", "_x.y", "city", "segments", "inside"]
        assert {(r["id"], r["city"]): (r["segments"], round(r["inside"], 9)) for r in found.collect()} == {
            (1, "a"): (1, 2.0), (1, "b"): (1, 1.0), (2, "a"): (1, 0.0), (4, "a"): (1, 0.0), (4, "b"): (1, 0.0),
            (5, "a"): (1, 1.0), (5, "b"): (1, 0.5), (14, "a"): (1, 0.0),
        }, cell
    assert lines.lines_in_boxes(lines_of.limit(0), boxes).count() == 0 == lines.lines_in_boxes(lines_of, boxes.limit(0)).count()


def test_lines_meet_boxes_as_walked_in_small_steps(spark):
    draw = random.Random(7)
    boxes = [(f"b{i}", x, y, x + draw.uniform(0.5, 3), y + draw.uniform(0.5, 3)) for i in range(12) for x, y in [(draw.uniform(-5, 5), draw.uniform(-5, 5))]]
    rows = [(i, [[draw.uniform(-6, 6), draw.uniform(-6, 6)] for _ in range(draw.randint(2, 4))]) for i in range(80)]
    df = spark.createDataFrame([(i, str(path)) for i, path in rows], "id int, coordinates string")
    found = {(r["id"], r["city"]): r["inside"] for r in lines.lines_in_boxes(df, spark.createDataFrame(boxes, BOXES), cell=0.7).collect()}
    steps = 1000
    for i, path in rows:
        for city, x_min, y_min, x_max, y_max in boxes:
            walked = 0.0
            for (x0, y0), (x1, y1) in zip(path, path[1:], strict=False):
                at = [(s + 0.5) / steps for s in range(steps)]
                hits = sum(x_min <= x0 + (x1 - x0) * t <= x_max and y_min <= y0 + (y1 - y0) * t <= y_max for t in at)
                walked += hits / steps * ((x1 - x0) ** 2 + (y1 - y0) ** 2) ** 0.5
            assert abs(found.get((i, city), 0.0) - walked) < 0.05
            assert walked == 0 or (i, city) in found


def test_latest_per_key_breaks_ties_on_all_columns(spark):
    df = spark.createDataFrame([("k", "t1", 1, "z"), ("k", "t2", 1, "a"), ("k", "t2", 2, "a"), ("m", None, 1, "q")], "_id string, report_time string, x int, y string")
    assert {tuple(r) for r in clean.latest_per_key(df, "_id", "report_time").collect()} == {("k", "t2", 2, "a"), ("m", None, 1, "q")}


def test_constant_column(spark):
    df = spark.createDataFrame([(float(5),)] * 4, "a double")
    assert set(column(features.zscore(df, ["a"]), "a")) == {0.0}
    assert set(column(features.robust_scale(df, ["a"]), "a")) == {0.0}
    assert profile.profile_outliers(df).first()["num_outliers"] == 0
    assert [(r["bin"], r["count"]) for r in profile.histogram(df).collect()] == [(0, 4)]
    assert profile.kde_curve(df).count() == 0


def test_percentages_round_ties_to_even(spark):
    df = spark.range(1).select(values.percent(F.lit(615), F.lit(60000)).alias("a"), values.percent(F.lit(1), F.lit(0)).alias("b"))
    assert tuple(df.first()) == (round(615 / 60000 * 100, 2), None)


def test_empty_profile(spark):
    df = spark.createDataFrame([], "a double, b string")
    for report in (profile.histogram, profile.kde_curve, profile.boxplot_stats):
        assert report(df).count() == 0
    assert profile.profile_outliers(df).first()["num_outliers"] == 0
    assert [r["zero_percentage"] for r in profile.profile_zeros(df).collect()] == [None, None]


def test_anova(spark):
    rows = [("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 5.0), ("c", 4.0)]
    df = spark.createDataFrame(rows, "g string, y double").withColumn("one", F.lit("x")).withColumn("own", F.col("y").cast("string")).withColumn("same", F.col("g"))
    found = {r["feature"]: r for r in stats.anova_f(df, ["g", "one", "own"], "y").collect()}
    assert "one" not in found  # a single level
    assert found["own"]["f_stat"] is None and found["own"]["significant"] is False  # no level repeats
    between = 2 * (1.5 - 3) ** 2 + 2 * (4 - 3) ** 2 + (4 - 3) ** 2
    assert found["g"]["f_stat"] == pytest.approx((between / 2) / (2.5 / 2))
    flat = df.withColumn("y", F.when(F.col("g") == "a", 1.0).otherwise(2.0))
    assert stats.anova_f(flat, ["g"], "y").first()["f_stat"] is None  # no variance inside the levels


def test_p_values_equal_the_f_distribution(spark):
    cases = [(0.5681, 4, 14995), (3.0, 2, 10), (12.5, 1, 3), (0.01, 7, 2), (1.0, 30, 1000000), (250.0, 3, 50), (0.999, 1, 1)]
    ours = [stats._upper_tail(spark, f, a, b) for f, a, b in cases]
    package = spark._jvm.org.apache.commons.math3.distribution
    for (f, a, b), p in zip(cases, ours):
        assert p == pytest.approx(1 - package.FDistribution(float(a), float(b)).cumulativeProbability(float(f)), abs=1e-9)


def test_levels_numbered_across_the_cluster(spark):
    words = [f"w{i % 37:02d}" for i in range(400)] + ["w05"] * 300 + [None]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    for encode in (features.label_encode, features.string_index):
        near = {tuple(r) for r in encode(df, "t", "n").collect()}
        far = {tuple(r) for r in encode(df, "t", "n", few=3).collect()}
        assert near == far and len(near) == 38
    assert features.string_index(df, "t", "n").where("t = 'w05'").first()["n"] == 0


def test_explode_envelope(spark):
    text = '{"incidents":[{"type":"F","properties":{"id":"1"}},{"type":"F","properties":{"id":"2"}}]}'
    polls = clean.valid_records(clean.parse_records(spark.createDataFrame([(text,)], "value string"), ENVELOPE))[0]
    stamped = flatten.stamp_incident(flatten.explode_incidents(polls), F.lit("Hanoi"))
    assert {(r["_id"], r["city"]) for r in stamped.select("_id", "properties.city").collect()} == {("1", "Hanoi"), ("2", "Hanoi")}


def test_rules_never_stop_a_job(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    outcome = fan_out(df, str(tmp_path / "json"), ("parquet", {"path": str(tmp_path / "docs")}), [("ColumnCount", ">", 0), ("RowCount", ">", 5), (("Completeness", "b"), "==", 0.5)])
    assert [r["outcome"] for r in outcome.collect()] == ["Passed", "Failed", "Passed"]
    assert spark.read.parquet(str(tmp_path / "docs")).count() == spark.read.schema("a int, b string").json(str(tmp_path / "json")).count() == 2
    assert quality.evaluate_rules(df).first()["rule"] == "ColumnCount > 0"


def test_upload_batches(spark, tmp_path):
    write_json(spark.range(250).coalesce(1), str(tmp_path / "out"), max_records=100)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3


def test_folder_levels(spark, tmp_path):
    folder = tmp_path / "2025" / "01" / "31" / "07"
    folder.mkdir(parents=True)
    (folder / "f.json").write_text(TRAFFIC_LINES[0] + "\n")
    row = read_topic(spark, "traffic", str(tmp_path), layout="bare").first()
    assert [row[f"partition_{i}"] for i in range(4)] == ["2025", "01", "31", "07"] and row["_id"] == "1"
    named = tmp_path / "named"
    write_json(_traffic(spark).withColumns({f"partition_{i}": F.lit(str(i)) for i in range(4)}), str(named), partition_by=[f"partition_{i}" for i in range(4)])
    scan = read_topic(spark, "traffic", str(named)).where("partition_1 = '1'")
    assert scan.count() == 5 and "PartitionFilters: [isnotnull(partition_1" in scan._jdf.queryExecution().toString()


def test_documents_go_through_any_connector(spark, tmp_path):
    write_documents(spark.range(3).withColumnRenamed("id", "_id"), "parquet", {"path": str(tmp_path / "c")})
    read = read_collection(spark, "parquet", {"path": str(tmp_path / "c")})
    assert sorted(column(read, "_id")) == ["0", "1", "2"]


def test_kde_binned_is_close_to_exact(spark):
    df = spark.range(5000).select((F.rand(3) + F.rand(4)).alias("x"))
    df = spark.createDataFrame(df.collect(), "x double")
    exact = {r["point"]: r["density"] for r in profile.kde_curve(df).collect()}
    binned = {r["point"]: r["density"] for r in profile.kde_curve(df, mode="binned").collect()}
    assert len(exact) == 200 and max(abs(exact[i] - binned[i]) for i in exact) < 1e-3
    assert math.isclose(sum(exact.values()) * 2 / 199, 1, abs_tol=0.1)


def test_significant_features(spark):
    rows = [(g, w, y + 0.01 * i) for i, (g, w, y) in enumerate([("a", "x", 1.0), ("b", "y", 9.0)] * 20 + [("a", "y", 1.0), ("b", "x", 9.0)] * 20)]
    df = spark.createDataFrame(rows, "g string, w string, y double")
    assert column(stats.significant_features(df, ["g", "w"], "y"), "feature") == ["g"]


def test_splits(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("_id"))
    first, second = features.random_split(df)
    assert first.count() + second.count() == 2000 and 1500 < first.count() < 1700
    same = features.hash_split(df.repartition(7), "_id")
    for one, other in zip(features.hash_split(df, "_id"), same):
        assert {r[0] for r in one.collect()} == {r[0] for r in other.collect()}
    assert same[0].count() + same[1].count() == 2000


def test_long_level_texts_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(features, "FEW_BYTES", 100)
    df = spark.createDataFrame([("x" * 90,), ("y" * 90,), ("x" * 90,)], "t string")
    assert sorted(r["n"] for r in features.label_encode(df, "t", "n").collect()) == [0, 0, 1]


def test_a_collection_of_topics(spark):
    raws = {"traffic": _traffic(spark)}
    assert jobs.topic_jobs(raws)["traffic"].count() == 1


def test_first_vertex_of_any_geometry(spark):
    texts = ["[106.68, 10.77]", "[[1e2,-2.5],[3,4]]", "[[[ 7 , 8 ]]]", "[]", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select(flatten.first_vertex(F.col("c")).alias("v")).collect()
    assert [(r.v.lon, r.v.lat) for r in rows] == [(106.68, 10.77), (100.0, -2.5), (7.0, 8.0), (None, None), (None, None), (None, None)]


def test_incidents_keep_all_their_fields(spark, tmp_path):
    incident = {
        "_id": "1", "type": "Feature", "geometry": {"type": "Point", "coordinates": [1.5, 2]},
        "properties": {"id": "1", "from": "a", "to": "b", "roadNumbers": ["A1"], "timeValidity": "present", "probabilityOfOccurrence": "certain",
                       "numberOfReports": 3, "lastReportTime": "t", "tmc": {"countryCode": "VN", "points": [{"location": 1, "offset": 2}]}},
    }
    (tmp_path / "in.json").write_text(json.dumps(incident))
    raw = read_topic(spark, "traffic", str(tmp_path))
    back = json.loads(raw.select(F.to_json(F.struct("_id", "type", "geometry", "properties")).alias("j")).first().j)
    assert back["properties"] == incident["properties"] and back["geometry"]["coordinates"] == "[1.5,2]"
