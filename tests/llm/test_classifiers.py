"""Language, quality rules and toxicity."""

from __future__ import annotations

import re
import tracemalloc
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventlake.llm import language, quality, toxicity
from eventlake.llm.queries import QUERIES
from eventlake.llm.text import blocks
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_quality_counts_match_a_plain_count(documents):
    texts = [t for _, t in documents] + [None, "", " \n\x0b a\x0c", "a b c a b c a", "x\ny\nx\n\nx", "é " * 9]
    found = quality._batch_counts(pa.array(texts))
    assert found[:, :5].tolist() == [plain_counts(t) for t in texts]


def test_trees_are_monotone_in_constrained_features():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 2] < 0.5) ^ (x[:, 0] > 0.8) ^ (rng.random(3000) < 0.1)).astype(float)
    model = quality.fit_trees(x, y)
    grid = np.repeat(x[:50], 40, axis=0)
    grid[:, 2] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(model.score(grid).reshape(50, 40), axis=1) <= 1e-12).all()
    assert model.score(x[y == 1]).mean() > model.score(x[y == 0]).mean() + 0.2


def test_quality_query(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, SF).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        row, counts = rows[doc_id], plain_counts(text)
        assert [row[c] for c in quality.COUNTS[:5]] == counts
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row["kept"] and row["base_failed"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect()
    passed = {q: np.mean([rows[r["doc_id"]]["score"] >= 0.5 for r in labels if r["quality"] == q]) for q in (0, 1)}
    assert passed[1] > 0.97 and passed[0] < 0.05


def test_quality_edge_rows(edge, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train_quality(edge, none)
    rows = quality.quality_rules(edge, model).collect()
    assert len(rows) == edge.count()
    assert all(r["base_failed"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert quality.quality_rules(nothing, model).count() == 0


def test_language_of_held_out_documents(spark, documents):
    rows = QUERIES["op1_language"](spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(documents) and 0.25 < len(held) / len(rows) < 0.42
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_windows_cover_whole_texts():
    text = "ab" * 700 + "é"
    block = next(blocks(pa.array([text, "", "x"])))
    cut, row, weight = language.windows(block)
    whole = b"".join(c[:w].tobytes() for c, r, w in zip(cut, row, weight, strict=True) if r == 0)
    assert whole.decode() == text
    assert row.tolist() == [0] * 6 + [2]


def test_language_edge_rows(edge, nothing):
    net = language.train_language(edge)
    rows = language.identify_language(edge, net).collect()
    assert [r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (None, 4, 5, 6, 7)} == {"en"}
    assert language.identify_language(edge.withColumn("text", F.lit("12 !")), net).select("lang_pred").distinct().collect()[0][0] == "und"
    empty = language.train_language(nothing)
    assert {r["lang_pred"] for r in language.identify_language(edge, empty).collect()} == {"und"}


def test_noisy_or_finds_the_offending_sentence(spark):
    clean = ["the sun is up. a bird sings here. we go home now."] * 30 + ["rain fell at noon. the road was wet."] * 30
    toxic = ["the sun is up. you are a vile toad today. we go home now."] * 20
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + toxic)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") >= 60).cast("int").alias("toxic"))
    model = toxicity.train_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    for r in rows:
        assert r["predicted"] == (r["doc_id"] >= 60)
        assert ["vile toad" in s["sentence"] for s in r["spans"]] == [True] * (r["doc_id"] >= 60)
    span = next(r for r in rows if r["doc_id"] == 70)["spans"][0]
    assert toxic[10].encode()[span["start"]:span["end"]].decode() == span["sentence"]
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.drop_toxic(docs, model).count() == 60


def test_the_driver_holds_the_features_once_while_it_fits(spark, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 5000), k -> concat('w', pmod(xxhash64(id, k), 20000), if(k % 10 = 0, '.', ''))))").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    monkeypatch.setattr(toxicity, "fit_noisy_or", partial(toxicity.fit_noisy_or, steps=2))
    tracemalloc.start()
    try:
        model = toxicity.train_toxicity(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    features = 400 * 5000 * 3
    assert -20 < model.bias < 0  # it was fitted
    assert peak < 12 * features  # of 4 bytes each, besides a piece of a million at a time


def test_toxicity_edge_rows(edge, nothing, spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (1, None), (7, 0)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(edge, labels)
    rows = toxicity.score_toxicity(edge, model).collect()
    assert len(rows) == edge.count()
    assert all(r["score"] == 0 and not r["spans"] for r in rows if r["doc_id"] in (1, 2, 3))
    unlearned = toxicity.train_toxicity(nothing, labels)
    assert toxicity.drop_toxic(edge, unlearned).count() == edge.count()
    assert toxicity.drop_toxic(nothing, model).count() == 0


def test_every_language_is_learned(spark):
    rows = [(k, f"zq{k:03d} text of language {k}", f"x{k:03d}") for k in range(300)]
    net = language.train_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert list(net.languages) == [f"x{k:03d}" for k in range(300)]
