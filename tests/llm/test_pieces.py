from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from eventlake.llm import pieces, queries
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = "ab  cde▁\t\n\0é漢字🙂 ſthe ing…\x1c  "


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_agenda_equals_the_library(library):
    model = pieces.PieceModel.opened(PATH)
    for text in random_texts(1500):
        own = model.merge(f" {text}".replace(" ", "▁")) if text else []
        assert own == library.encode(text), text


def test_decoding_of_any_ids_equals_the_library(library):
    model, rng = pieces.PieceModel.opened(PATH), random.Random(5)
    rows = [[rng.randrange(32000) if rng.random() < 0.4 else rng.randrange(259) for _ in range(rng.randrange(12))] for _ in range(1500)]
    data, sizes = model.decode(np.array([i for r in rows for i in r], np.int64), np.array([len(r) for r in rows], np.int64))
    ends = np.cumsum(sizes)
    assert [bytes(data[e - n:e]).decode() for e, n in zip(ends, sizes, strict=True)] == [library.decode(r) for r in rows]


def test_whole_texts_equal_the_library(spark, edge, nothing, library):
    texts = [*random_texts(200, 9), "x" * 3000, "漢" * 5000, "word " * 40_000, " ", "  a", "▁▁ b", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge.select("doc_id", "text"))
    found = pieces.encode_pieces(rows.repartition(3), decoded=True, block_bytes=4096).collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, [*library.encode(r["text"] or ""), 2]) for r in rows.collect())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, list(r["ids"])) for r in found) == want
    by_text = {i: t for i, t in enumerate(texts) if i > 10}
    for r in found:
        if r["doc_id"] in by_text:
            assert r["decoded"] == library.decode(list(r["ids"])) == (by_text[r["doc_id"]] or "").replace("▁", " ")
    again = pieces.decode_pieces(spark.createDataFrame([(r["doc_id"], list(r["ids"])) for r in found] + [(-1, None)], "doc_id long, ids array<int>"))
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in again.collect()) == sorted([*((r["doc_id"] or 0, r["decoded"]) for r in found), (-1, "")])
    assert pieces.encode_pieces(nothing, decoded=True).count() == 0
    assert [list(r["ids"]) for r in pieces.encode_pieces(nothing.union(edge.where("doc_id = 2")), end_id=None).collect()] == [[]]


def test_bounded_memory_of_chunks(library, monkeypatch):
    """Chunks are forgotten and met again without a change of the result."""
    import pyarrow as pa

    monkeypatch.setattr(pieces, "_KEPT_CHUNKS", 40)
    model = pieces.PieceModel(PATH)
    texts = random_texts(300, 11)
    out = []
    for block in pieces.blocks(pa.array([f" {t}".replace("▁", " ") if t else "" for t in texts]), 300):
        ids, n = model.encode_block(block, True)
        out.extend(x.tolist() for x in np.split(ids, np.cumsum(n)[:-1]))
    assert out == [library.encode(t) for t in texts]


def test_a_wrong_merge_fails_the_check():
    model = pieces.PieceModel(PATH)
    model.cost = {p: -c for p, c in model.cost.items()}
    with pytest.raises(ValueError, match="the library has"):
        model._new([" everything", " internationalization"], True)


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = queries.op12_pieces(spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = [*library.encode(docs[r["doc_id"]]), 2]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
