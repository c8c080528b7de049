"""The pipeline and its operators on planted rows: long strings, labels of one class, clashing columns, every stage."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridmend.llm import mixing, queries, repair, secret_scan, toxicity, url_filter

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("_id", "_hash", "_words", "_text_hash", "_row", "_found", "_gaps", "_toxic", "_document", "document", "words", "size", "taken", "first", "toxic", "score", "text_hash")
CLEAN = "the river runs past old stone houses while people walk home slowly under warm evening light and talk about bread fields rain music friends".split()
RUDE = "you utter vilest scumlord grotface hate everybody scumlords vile grotfaced filthmonger".split()


def sentence(rnd, words, n):
    return " ".join(rnd.choice(words) for _ in range(n))


def planted():
    """Clean, toxic, near-copied, secret-bearing, empty and very long documents of several sources; and labels of some."""
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 6 == 0
        rows.append((i, sentence(rnd, RUDE if toxic else CLEAN, 40) + f" number{i}", "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    base = [w + str(rnd.randrange(1000)) for w in (CLEAN * 5)[:100]]
    for i in range(300, 320):  # near copies: one word of a hundred differs
        rows.append((i, " ".join([*base[:50], f"x{i}", *base[51:]]), "en", "s0", 0))
    rows += [(400, None, None, None, None), (401, "", "en", "s1", 0), (402, 'calm words api_key = "Zx9Qw7Er5Ty3Ui1Op" end', "en", "s1", 1), (403, "y" * 200_000, "en", "s2", 1), (None, "a lone text", "en", "s2", 1)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("planted"))
    rows, labels = planted()
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def with_clashes(docs):
    return docs.withColumns({name: F.lit(i) for i, name in enumerate(CLASHING)})


def test_every_stage_does_its_work_and_keeps_columns_of_any_name(spark, folder):
    docs = with_clashes(spark.read.parquet(f"{folder}/documents.parquet"))
    rows, _ = planted()
    toxic, copies = {i for i in range(300) if i % 6 == 0}, set(range(301, 320))
    texts = {r[0]: r[1] for r in rows}
    secret = texts[402].replace("Zx9Qw7Er5Ty3Ui1Op", secret_scan.MASK)
    gone = {"toxicity": toxic, "near_duplicates": copies, "secret_scan": set()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        found = out.collect()
        assert {tuple(r[c] for c in CLASHING) for r in found} == {tuple(range(len(CLASHING)))}, name
        if name in gone:
            assert {r.doc_id for r in found} == set(texts) - gone[name] and len(found) == len(texts) - len(gone[name]), name
        changed = {r.doc_id for r in found if r.text != texts[r.doc_id]}
        assert changed == ({402} if name == "secret_scan" else set()), name
        assert name != "secret_scan" or {r.text for r in found if r.doc_id == 402} == {secret}
    assert corpus_pipeline.pack_sequences(spark, docs, folder).count() >= docs.count()


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_the_whole_pipeline(spark, folder):
    """Every kept document is whole, none is rejected or a copy, and sequences have no gap."""
    out = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in out}
    assert not kept & {i for i in range(300) if i % 6 == 0} and kept & set(range(300, 320)) <= {300} and {400, 401} <= kept
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        pieces.sort()
        ends = [sum(n for _, n in pieces[:i]) for i in range(len(pieces) + 1)]
        assert [at for at, _ in pieces] == ends[:-1] and ends[-1] <= 4096


def test_labels_of_one_class_reject_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for some in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(docs, some)
        assert not model.usable and toxicity.score(docs, model).where("score != 0").isEmpty()


def test_toxicity_of_the_planted_documents(spark, folder):
    scored = queries.op3_toxicity(spark, folder).collect()
    assert len(scored) == 325 and all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    held = [r for r in scored if r.held_out and r.doc_id < 300]
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert held and right >= 0.95 * len(held)


def test_words_of_any_length_take_time_in_proportion():
    model = toxicity.Model(np.random.default_rng(1).normal(size=toxicity.BUCKETS), np.ones(4))
    rnd = random.Random(2)
    blob = "".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(1_000_000))
    start = time.time()
    assert np.isfinite(model.word_scores([blob, "short", "\ud800" + "x" * 50])).all()
    assert time.time() - start < 10


def test_long_candidates_and_urls_take_time_in_proportion(spark):
    rnd = random.Random(3)
    blob = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400_000))
    rows = [(1, f"image data {blob} end"), (2, "plain words only")]
    start = time.time()
    found = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.length) for r in found if r.length > 1000] == [(1, 11, 400_000)]
    assert time.time() - start < 60
    url = "https://example.net/" + "ä1é" * 33_000
    start = time.time()
    got = url_filter.judge(spark.createDataFrame([(1, url), (2, "https://a.org/x"), (3, "https://b.com/de/y")], "page_id long, url string")).collect()
    assert {r.page_id: r.verdict for r in got}[2] == "allow" and len(got) == 3
    assert time.time() - start < 60


def test_grams_are_the_characters_with_those_before(spark):
    url = "aß😀b"
    row = spark.createDataFrame([(url,), (None,)], "u string").select(url_filter.grams(F.col("u"), 2).alias("g")).collect()
    padded = url_filter.START * 2 + url + url_filter.END
    assert row[0].g == [padded[i : i + 3] for i in range(len(url) + 1)] and row[1].g == [url_filter.START * 2 + url_filter.END]
