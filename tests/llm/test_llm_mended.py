"""Dense secrets, labels of one kind, the compression score by hand."""

import random
import string

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import quality, secrets, toxicity
from tidewater.llm.common import HashBits

WORDS = ["water", "stone", "river", "under", "garden", "people", "morning", "yellow", "between", "simple", "window", "carry", "letter", "often"]


def _prose(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


@pytest.mark.parametrize("n", [300, 3000])
def test_a_key_in_every_document_is_found(spark, n):
    """The null leaves keys out, so their number doesn't hide them, at any size of the corpus."""
    rng = random.Random(n)
    rows = []
    for i in range(n):
        words = _prose(rng, 150)
        words.insert(rng.randrange(150), "".join(rng.choices(string.ascii_letters + string.digits, k=48)))
        rows.append((i, " ".join(words)))
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select(
        F.size(F.filter("spans", lambda s: s["kind"] == "random")).alias("n")).collect()
    assert sum(r["n"] >= 1 for r in got) >= 0.95 * n and sum(r["n"] for r in got) <= 1.02 * n


def test_known_keys_don_t_hide_others(spark):
    """Five SHA-1 sums in every document (base spans) and a random key in a tenth of them."""
    rng = random.Random(9)
    rows = []
    for i in range(600):
        words = _prose(rng, 150) + ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(5)]
        rng.shuffle(words)
        if i % 10 == 0:
            words.insert(3, "".join(rng.choices(string.ascii_letters + string.digits, k=48)))
        rows.append((i, " ".join(words)))
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", F.size(F.filter("spans", lambda s: s["kind"] == "random")).alias("n")).collect()
    assert sum(r["n"] > 0 for r in got if r["doc_id"] % 10 == 0) >= 57 and sum(r["n"] > 0 for r in got if r["doc_id"] % 10) <= 6


def test_text_outside_spans():
    assert secrets.outside("abcdef", []) == "abcdef"
    assert secrets.outside("abcdefghij", [(6, 8), (1, 3), (2, 4), (2, 3)]) == "a ef ij"
    assert secrets.outside("abc", [(0, 3)]) == ""


@pytest.mark.parametrize("kind", [0, 1, None])
def test_labels_of_one_kind_drop_nothing(spark, tmp_path, kind):
    docs = spark.createDataFrame([(i, f"some text number {i} you idiot", 1, "x") for i in range(40)], "doc_id long, text string, score int, terms string")
    labels = spark.createDataFrame([(i, kind) for i in range(30) if kind is not None], "doc_id long, toxic int").withColumn("quality", F.col("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.toxicity_stage(spark, docs, str(tmp_path)).count() == 40
    scores = {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(scores) == 1 and max(scores) <= 0.5
    scores = {r["score"] for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert len(scores) == 1 and 0 < min(scores) < 1


def test_compression_scores_by_hand(spark):
    """Model and scores against a plain computation; of an id's several texts the least trains."""
    rng = random.Random(3)
    good = [" ".join(_prose(rng, 200)) for _ in range(60)]
    bad = ["".join(rng.choices("qxzj 0123", k=900)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(3, "zzz a later text of the same id"), (None, good[0]), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    for _ in range(2):
        assert quality.fit(docs.repartition(3), labels) == model
    trained = [quality._dictionary([t for i, t in enumerate(part) if i % 3 != 2]) for part in (good, bad)]
    assert (model.good, model.bad) == tuple(trained)

    def size(text, raw):
        params = zstandard.ZstdCompressionParameters.from_level(quality.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == quality.DICT_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
        packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind), compression_params=params)
        data = text.encode()
        return sum(len(packer.compress(data[i:i + quality.BLOCK])) for i in range(0, len(data), quality.BLOCK))
    for r in quality.score(docs, model).join(docs, "doc_id").collect():
        if r["text"]:
            g, b = size(r["text"], model.good), size(r["text"], model.bad)
            if r["doc_id"] != 3:
                assert r["difference"] == pytest.approx((b - g) / (b + g), abs=0.02)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((scored[i] > 0.5) == (i < 60) for i in range(120) if i != 3)


@pytest.mark.parametrize("n", [1000, 3_000_000])
def test_bitmaps_grow_with_their_members(spark, n):
    members = spark.range(n).select(F.xxhash64("id").alias("h"))
    bits = HashBits.of(members, "h")
    assert bits.test(np.array([r["h"] for r in members.limit(5000).collect()]).view(np.uint64)).all()
    others = np.array([r["h"] for r in spark.range(n, n + 20_000).select(F.xxhash64("id").alias("h")).collect()]).view(np.uint64)
    assert bits.test(others).mean() < 0.1
