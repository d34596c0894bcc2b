"""Token ids, fingerprints, prefix BPE, toxicity and near duplicates, against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import CLASHING, documents, near_groups, rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cityweave.llm import binary_ids, merkle, near_dedup, prefix_bpe, toxicity
from cityweave.llm.components import components
from cityweave.llm.queries import BYTE_BPE, WORD_BPE

TEXTS = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\tabcdeeghinorst'.,!09AÉ<|>")), max_size=80)


@pytest.fixture(scope="module")
def byte_encoder():
    return prefix_bpe.PrefixEncoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_prefixes_give_the_merges_ids(byte_encoder, text):
    own, library = byte_encoder
    want = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == want
    assert own.decode(np.array(want, dtype=np.int64)) == library.decode(want, skip_special_tokens=False) == text


def test_prefixes_on_long_words_and_vocabulary(byte_encoder):
    own, library = byte_encoder
    rng = random.Random(5)
    texts = ["a" * 999, "ab" * 500, "x<|endoftext|><|endoftext|> y", " " * 50 + "a", "don't we'll I'M"]
    texts += ["".join(own.bytes_of[rng.randrange(50_000)].decode(errors="ignore") for _ in range(9)) for _ in range(1500)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text).tolist() == want.ids


def test_encode_then_decode_documents(spark):
    docs = documents(spark, extra=CLASHING)
    encoded = prefix_bpe.encode(docs, BYTE_BPE)
    back = prefix_bpe.decode(encoded, BYTE_BPE)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t, *_ in rows())


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_by_word_gives_the_whole_texts_ids(text):
    own = binary_ids.words(WORD_BPE)
    assert own.encode([text])[0].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24])))
def test_packed_numbers(numbers):
    ranks = np.array(numbers, dtype=np.uint32)
    control, data = binary_ids.pack(ranks)
    assert len(control) == -(-len(numbers) // 4)
    assert binary_ids.unpack(control, data, len(numbers)).tolist() == numbers


@pytest.mark.parametrize("block", [1, 50, binary_ids.BLOCK])
def test_blocks(spark, block):
    library = Tokenizer.from_file(WORD_BPE)
    blocks, ranked = binary_ids.write(documents(spark, extra=CLASHING), WORD_BPE, block=block)
    out = binary_ids.read(blocks, ranked).collect()
    order = lambda i: (i is not None, i or 0)
    got = sorted(((order(r.doc_id), r.start, r.n_tokens, bytes(r.ids)) for r in out), key=lambda r: r[1:3])
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    start = 0
    for _, at, n, ids in got:
        assert at == start and len(ids) == 4 * n and ids[-4:] == b"\1\0\0\0"
        start += n
    want = sorted((order(i), np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()) for i, t, *_ in rows())
    assert sorted((i, ids) for i, _, _, ids in got) == want
    assert len(ranked) == len(set(ranked)) == len({x for _, ids in want for x in np.frombuffer(ids, "<u4").tolist()})


def test_crc32_in_ids_order(spark, sf_dir):
    from cityweave.llm.queries import token_ids

    library = Tokenizer.from_file(WORD_BPE)
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    out = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_ids(spark, sf_dir).collect()}
    start = 0
    for i, text in docs:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert out[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_fingerprints_locate_edits():
    rng = random.Random(3)
    for _ in range(40):
        paragraphs = [words(rng, rng.randrange(1, 60)) for _ in range(rng.randrange(1, 12))]
        at = rng.randrange(len(paragraphs))
        changed = [*paragraphs[:at], "edited " + paragraphs[at], *paragraphs[at + 1 :]]
        a, b = (p.written for p in merkle.prints(["\n".join(paragraphs), "\n".join(changed)]))
        assert merkle.edited_paragraphs(a, b) == [at] and merkle.edited_paragraphs(a, a) == []
        assert 0 < merkle.likeness(a, b) < 1 and merkle.likeness(a, a) == 1


def test_fingerprints_do_not_depend_on_neighbours():
    texts = [t or "" for _, t, *_ in rows()] + ["\n", "\n\n", "a\n", "\na"]
    alone = [merkle.prints([t])[0].written for t in texts]
    assert [p.written for p in merkle.prints(texts)] == alone
    assert len(set(alone)) == len(set(texts))


def test_edited(spark):
    data = [(i, t, lang, s) for i, t, lang, s in rows() if i is not None and i != 6]
    docs = documents(spark, data, extra=CLASHING).repartition(3)
    out = {r.doc_id: r for r in merkle.edited(docs).collect()}
    order = sorted((i, t or "") for i, t, *_ in data)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, then, changed = (p.written for p in merkle.prints([text, following, edited]))
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (own, changed)
        assert (r.near_edited, r.near_next) == (merkle.likeness(own, changed), merkle.likeness(own, then))
    plain = {r.doc_id: r.fingerprint for r in merkle.fingerprints(docs).collect()}
    assert plain == {i: r.fingerprint for i, r in out.items()}


def test_a_single_document_follows_itself(spark):
    r = merkle.edited(documents(spark, [(5, "abcd", "en", "a")])).first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(8)
    data, labels = [], []
    for i in range(700):
        own, toxic = words(rng, rng.randrange(5, 80)).split(), i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                own.insert(rng.randrange(len(own)), rng.choice(["blockhead", "nitwit", "dunderkopf" + words(rng, 1)]))
        data.append((i, " ".join(own), "en", "a"))
        labels.append((i, int(toxic)))
    return documents(spark, data), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity_on_rows_held_out(spark, insults):
    docs, labels, truth = insults
    model = toxicity.fit(docs, labels)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped).rules == model.rules
    out = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    for disguised in ("bl0ckh3ad", "b.l.o.c.k.h.e.a.d", "n i t w i t", "blooockheeead", "N1TW1T!!", "dund3rkopfabc"):
        assert model.score(f"some words {disguised} more words") >= 0.7, disguised
    for clean in ("2024", "a b", "1.5.7", "", "some words"):
        assert model.score(clean) < 0.7
    kept = toxicity.drop_toxic(docs.withColumn("score", F.lit("own")), labels)
    assert kept.columns == [*docs.columns, "score"] and kept.count() == sum(not r.predicted for r in out)


def test_words_set_apart_beside_others_and_doubled_letters(spark, insults):
    docs, labels, _ = insults
    model = toxicity.fit(docs, labels)
    spaced = ["a n i t w i t", "n i t w i t n i t w i t", "n  i  t  w  i  t", "n\ti\tt\tw\ti\tt", "n\ni\nt\nw\ni\nt"]
    for disguised in (*spaced, "nittwit", "niitwit", "bblockhead"):
        assert model.score(f"some words {disguised} more words") >= 0.7, disguised
    for clean in ("a b", "a b c", "a  b\tc\nd", "some wwords", "b l o o m"):
        assert model.score(clean) < 0.7, clean
    costs = model.costs
    assert {"stup", "stupid"} <= toxicity.hidden("a s t u p i d", costs) and "idio" in toxicity.hidden("a i d d i o t", costs)
    assert not toxicity.hidden("plain", costs) and toxicity.hidden("a b c", costs) <= {"abc "}


def test_rare_rules_of_a_rich_vocabulary_are_kept(spark):
    """6,000 words that stand in three toxic documents come before a burst that rests on one."""
    digits = lambda n: "".join("abcdefghij"[int(d)] for d in f"{n:04}")
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic, others = ids[:13], ids[13:]
    common = " ".join("q" + digits(n) for n in range(6000))
    data = [(i, common, "en", "a") for i in toxic[:12]] + [(toxic[12], " ".join("zwack" + digits(n) for n in range(9)), "en", "a")]
    data += [(i, "some words", "en", "a") for i in others]
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, data), labels)
    assert any(rule.startswith("zwac") for rule in model.rules) and model.score("a zwackkkk") >= 0.7


def test_rules_are_chosen_as_one_by_one():
    rng = random.Random(6)
    for _ in range(50):
        found = {f"w{n} ": toxicity.Candidate(frozenset(rng.sample(range(30), rng.randrange(1, 9))), rng.randrange(1, 40), rng.choice([0.0, 0.0, 0.3])) for n in range(40)}
        good, left, want = {k: c for k, c in found.items() if c.good}, set(range(30)), []
        while True:
            new = {k: len(c.documents & left) for k, c in good.items()}
            good = {k: c for k, c in good.items() if new[k] >= (1 if c.bursts else toxicity.LEAST_NEW)}
            if not left or not good:
                break
            want.append(min(good, key=lambda k: (good[k].others - new[k], -good[k].words, len(k), k)))
            left -= good.pop(want[-1]).documents
        assert list(toxicity.choose(found, set(range(30))))[: len(want)] == want


def test_no_labels(spark):
    docs = documents(spark, extra=CLASHING)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}


def _family(rng, size, edits, length=150):
    base = words(rng, length).split()
    out = []
    for _ in range(size):
        own = base[:]
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(length)] = words(rng, 1)
        out.append(" ".join(own))
    return out


def test_near_groups(spark, monkeypatch):
    rng = random.Random(2)
    texts = [*_family(rng, 70, 9), *_family(rng, 30, 6, 40), *_family(rng, 20, 4, 9), *[words(rng, rng.randrange(1, 50)) for _ in range(60)]]
    shared = words(rng, 80)
    texts += [f"{words(rng, 60)} {shared}" for _ in range(40)]
    rng.shuffle(texts)
    data = [*enumerate(texts), (900, None), (901, ""), (902, " \t"), (903, "one Two"), (904, "ONE two"), (905, texts[0]), (905, texts[0])]
    want = near_groups(data)
    docs = documents(spark, [(i, t, "en", "a") for i, t in data], extra=CLASHING).repartition(4)
    for block in (near_dedup.BLOCK, 16):  # families of one block and of several
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        out = near_dedup.find_components(docs).collect()
        assert len(out) == len(data)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    kept = near_dedup.drop_near(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}
    assert 0 < sum(i == c for i, (_, c) in want.items()) < len(want)


@pytest.mark.parametrize("block", [7, near_dedup.BUCKET_BLOCK])
def test_close_members_of_a_crowded_bucket_are_one_family(spark, monkeypatch, block):
    """Documents of frequent lines crowd a bucket; its centre is far from two that are near each other, or near one of them only."""
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", block)
    rng = np.random.default_rng(4)
    crowd = rng.integers(0, 256, (60, near_dedup.BINS), dtype=np.uint8)
    changed = lambda marks, bins: np.where(np.isin(np.arange(near_dedup.BINS), bins), marks + 1, marks).astype(np.uint8)
    rest = rng.integers(0, 256, (20, near_dedup.BINS), dtype=np.uint8)
    far = [x for marks in rest for x in (marks, changed(marks, np.arange(29)))]  # 163 of 192 bins agree
    near = changed(crowd[0], np.arange(70))  # 122 of 192 with the centre, in its family
    beyond = changed(near, np.arange(70, 110))  # 82 of 192 with the centre, 152 with the one before
    marks = [*crowd, *far, near, beyond]
    # All share bucket 1; the crowd shares another, and its first one a third with a document, so that it is the centre.
    data = [(k, 100, [1, *([2] if k < 60 else []), *([3] if k in (0, 200) else [])], bytes(m)) for k, m in enumerate(marks)]
    data.append((200, 100, [3], bytes(rng.integers(0, 256, near_dedup.BINS, dtype=np.uint8))))
    classes = spark.createDataFrame(data, "id long, n_shingles long, buckets array<long>, marks binary")
    found = {r.id: r.family for r in near_dedup.families(classes, near_dedup.star_edges(classes)).collect()}
    assert found == {0: 0, 100: 0, 101: 0} | {k: k // 2 * 2 for k in range(60, 100)}


def test_similarity_is_compared_exactly():
    left, right = [np.arange(20, dtype=np.uint64)], [np.arange(3, 20, dtype=np.uint64), np.arange(4, 20, dtype=np.uint64)]
    assert near_dedup._similar(left, right, 85).tolist() == [[True, False]]  # 17 of 20 and 16 of 20


def test_shingles_are_those_of_the_words():
    texts = [t or "" for _, t, *_ in rows()]
    from cases import shingles

    found = near_dedup.shingle_sets(texts)
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    assert [near_dedup.shingle_sets([t])[0].tolist() for t in texts] == [s.tolist() for s in found]


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 130)] + [(500, k) for k in range(200, 260)] + [(1, 1), (9, 8), (8, 7)]
    out = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert {out[k] for k in range(100, 131)} == {100} and {out[k] for k in range(200, 260)} | {out[500]} == {200}
    assert (out[1], out[7], out[8], out[9]) == (1, 7, 7, 7)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_tokenizer_files_are_where_the_queries_look():
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE


def test_near_candidates_take_one_python_process_per_task(spark):
    """A filter on the agreement, as in ``families``, doesn't work it out a second time."""
    both = spark.createDataFrame([(bytes(near_dedup.BINS), bytes(near_dedup.BINS))], "marks_a binary, marks_b binary")
    near = both.select(near_dedup._agreement("marks_a", "marks_b").alias("agreement")).where(F.col("agreement") >= near_dedup.FAMILY)
    assert near._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert near.collect()[0].agreement == 1.0


def test_idle_processes_hold_no_encoder(spark):
    """What a task leaves in a Python process, which later stages' tasks find again."""

    def held(batches):
        from cityweave.llm import prefix_bpe

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([prefix_bpe.encoder.cache_info().currsize] * batch.num_rows, pa.int32())], ["held"])

    docs = spark.createDataFrame([(n, "an idle process") for n in range(8)], "doc_id bigint, text string").repartition(4)
    encoded = prefix_bpe.encode(docs, BYTE_BPE).localCheckpoint()
    prefix_bpe.decode(encoded, BYTE_BPE).collect()
    assert len(prefix_bpe.round_trip(docs, BYTE_BPE).collect()) == 8
    assert {r.held for r in spark.range(0, 64, 1, 8).mapInArrow(held, "held int").collect()} == {0}
