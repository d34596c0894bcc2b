"""Stage by stage, what the pipeline keeps is what a plain version of the stage keeps."""

import hashlib
import re

import pytest
from cases import CLASHING, as_table, documents, near_groups
from tokenizers import Tokenizer

import corpus_pipeline
from cityweave.llm import toxicity
from cityweave.llm.queries import BYTE_BPE, REGISTRY


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path_factory.mktemp('stage')}/{n}"
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_rejected_are_those_that_score(spark, sf_dir, stages):
    scored = REGISTRY["op7_toxicity"](spark, sf_dir)
    assert ids(stages[1]) == ids(scored.where("predicted = 0"))
    assert toxicity.LIMIT == 0.7


def test_copies(stages):
    first = {}
    for r in sorted(stages[1].collect()):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
    assert ids(stages[2]) == sorted(first.values())


def test_near_copies(stages):
    groups = near_groups([(r.doc_id, r.text) for r in stages[2].collect()])
    assert ids(stages[3]) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_mix_is_of_what_was_kept(stages):
    kept = {tuple(r) for r in stages[3].collect()}
    mixed = [tuple(r) for r in stages[4].collect()]
    assert set(mixed) <= kept and 0.6 * len(kept) < len(mixed) < 1.4 * len(kept)


def test_ids_of_every_copy(stages):
    library, sha256 = Tokenizer.from_file(BYTE_BPE), lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in stages[4].collect():
        own = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(own), sha256(",".join(map(str, own))), sha256(r.text or "")))
    assert sorted(tuple(r) for r in stages[5].collect()) == sorted(want)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(stages[5].collect())


def test_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    folder = as_table(tmp_path, spark, documents(spark, extra=CLASHING), labels=labels)
    assert corpus_pipeline.run(spark, folder).count() > 0
    folder = as_table(tmp_path / "none", spark, documents(spark, []), labels=labels)
    assert corpus_pipeline.run(spark, folder).count() == 0
