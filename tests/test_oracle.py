"""Every query gives the rows of its SQL twin."""

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as entry_points
from workload import feeds
from workload.oracle import ORACLE, aligned
from workload.queries import REGISTRY


@pytest.fixture(scope="module")
def db(sf_dir):
    return duck(sf_dir)


# The smallest tables have no hour in which all three topics meet, so there is nothing to train on.
TRAINED = {"train_lr", "train_dt", "train_rf", "train_rf_tuned", "train_pipeline", "score_batch", "stream_score", "model_roundtrip", "pollution_fit"}
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, db, name):
    if name in TRAINED and sf_dir != LARGER:
        sf_dir, db = LARGER, duck(LARGER)
    assert spark_rows(REGISTRY[name](spark, sf_dir)) == duck_rows(db, ORACLE[name])


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(REGISTRY)


def test_entry_equals_sql(spark):
    rows = spark_rows(entry_points.entry(spark))
    assert rows == duck_rows(duck("/root/testdata/sf0.001"), aligned(240))
    assert len(rows[1]) == 11


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_feed_text_is_json_in_the_raw_schema(spark, sf_dir):
    for topic in ("air", "traffic", "weather"):
        lines = feeds.feed(spark, sf_dir, topic)
        assert feeds.raw(spark, sf_dir, topic).count() == lines.count()
