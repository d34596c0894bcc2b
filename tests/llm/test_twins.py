"""Queries with an SQL twin give the twin's rows; every query runs on an empty table and on awkward rows."""

import pytest
from cases import CLASHING, as_table, documents
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as entry_points
from cityweave.llm.oracle import ORACLE
from cityweave.llm.queries import REGISTRY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, name):
    assert spark_rows(REGISTRY[name](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLE[name])


def test_registered():
    assert {*REGISTRY, "pipeline"} <= set(entry_points.queries())
    assert [sum(name.startswith(f"op{n}_") for name in REGISTRY) for n in range(1, 14)] == [1] * 13


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    labels = spark.createDataFrame([(1, 0, 1), (5, 1, 1), (None, 1, 0), (77, None, None)], "doc_id long, toxic int, quality int")
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    empty = documents(spark, [])
    full = as_table(tmp_path_factory.mktemp("full"), spark, documents(spark, extra=CLASHING), labels=labels, conversations=talk)
    none = as_table(tmp_path_factory.mktemp("none"), spark, empty, labels=labels.limit(0), conversations=talk)
    return full, none, documents(spark).count()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - {"op1_poisson_mix", "op8_chat_format", "op12_turn_repair"}))
def test_a_row_per_document(spark, awkward, name):
    full, none, n = awkward
    assert REGISTRY[name](spark, full).count() == n
    assert REGISTRY[name](spark, none).count() == 0


def test_no_documents_to_mix(spark, awkward):
    assert REGISTRY["op1_poisson_mix"](spark, awkward[1]).count() == 0


def test_conversation_that_is_added(spark, awkward):
    assert [r.conv_id for r in REGISTRY["op8_chat_format"](spark, awkward[1]).collect()] == [-7]
