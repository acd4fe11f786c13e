"""Mixing, decontamination, fixity, backoff scores, token ids and repeated passages."""

from __future__ import annotations

import gzip
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import decontam, fixity, linededup, mixing, ngrams, packing, tokens
from eventlake.llm.queries import QUERIES, SQL
from eventlake.llm.tables import remainder
from tests.llm.conftest import PROSE, SF, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


# Mixing

def test_targets_are_shared_again_until_none_is_above():
    sizes, weights = [10, 1000, 5, 400, 0], (5, 2, 1)
    total, found = 1.5 * sum(sizes), mixing.targets([10, 1000, 5, 400, 0], 1.5 * 1415)
    weight, left, open_ = [5, 2, 1, 5, 2], total, set(range(5))
    expected = [0.0] * 5
    while open_:
        level = left / sum(weight[k] for k in open_)
        above = {k for k in open_ if level * weight[k] > 2 * sizes[k]}
        for k in above or open_:
            expected[k] = min(2 * sizes[k], level * weight[k])
        left -= sum(expected[k] for k in above)
        open_ = open_ - above if above else set()
    assert np.allclose(found, expected) and weights == mixing.WEIGHTS
    assert np.isclose(sum(found), total)


def test_tree_splits_quotas_exactly():
    quotas = np.array([130, 7, 0, 64])
    leaves = list(mixing.split_quotas(quotas, 7, 3, 0, 7))
    assert [shard for shard, _, _ in leaves] == list(range(7))
    assert np.array_equal(sum(n for _, _, n in leaves), quotas)
    sizes = [int(n.sum()) for _, _, n in leaves]
    assert max(sizes) - min(sizes) <= 1
    upto = np.zeros(4, int)
    for _, begin, n in leaves:
        assert np.array_equal(begin, upto)
        upto += n
    again = [x for low in (0, 4) for x in mixing.split_quotas(quotas, 7, 3, low, min(low + 4, 7))]
    assert all(np.array_equal(a[2], b[2]) for a, b in zip(leaves, again, strict=True))


def test_mixing_query(spark, documents):
    rows = QUERIES["op3_mixing"](spark, SF).collect()
    sources = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SF}/documents.parquet'").fetchall())
    size = {i: len(WORD.findall(t or "")) for i, t in documents}
    assert {r["doc_id"]: r["size"] for r in rows} == size
    by_source, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        by_source[sources[r["doc_id"]]] += r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * len(r["shards"])
    names = sorted(by_source)
    wanted = dict(zip(names, mixing.targets([by_source[s] for s in names], 1.5 * sum(size.values())), strict=True))
    for r in rows:
        assert r["source_size"] == by_source[sources[r["doc_id"]]]
        assert math.isclose(r["target"], wanted[sources[r["doc_id"]]])
    assert all(abs(taken[s] - wanted[s]) < 0.03 * wanted[s] for s in names)
    again = {r["doc_id"]: (r["taken"], r["shards"]) for r in QUERIES["op3_mixing"](spark, SF).collect()}
    assert again == {r["doc_id"]: (r["taken"], r["shards"]) for r in rows}


def test_mixing_over_many_blocks_and_shards(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 13)), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.draw(mixing.sized(docs), block_words=150, shard_blocks=8).select("row.source", "size", "target", F.size("shards").alias("k"), "shards").collect()
    taken, target, shards = Counter(), {}, Counter()
    for r in found:
        taken[r["source"]] += r["size"] * r["k"]
        target[r["source"]] = r["target"]
        shards.update(r["shards"])
        assert r["k"] <= 2
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    assert len(shards) > 10 and max(shards.values()) < 4 * min(shards.values())


def test_mixing_edge_rows(edge, nothing):
    assert mixing.mixed(edge).columns == edge.columns
    rows = mixing.draw(mixing.sized(edge)).select("row.doc_id", "size", "source", "shards").collect()
    assert len(rows) == edge.count() and all(r["size"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert mixing.mixed(nothing).count() == 0


# Decontamination

def test_leaks_query_finds_all_items_held_whole(spark):
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontam"](spark, SF).collect()}
    held = duckdb.sql(f"SELECT doc_id, item_id FROM '{SF}/documents.parquet' d JOIN '{SF}/benchmark.parquet' b ON contains(d.text, b.text)").fetchall()
    assert found == set(held)


def test_pruned_retrieval_equals_scoring_everything():
    rng = np.random.default_rng(7)
    parts = [(k, rng.integers(2, 60, rng.integers(6, 30)).astype(np.uint64), 3) for k in range(100)]
    frequency = Counter(int(x) for _, h, _ in parts for x in set(h.tolist()))
    index = decontam.build_index(parts, frequency, 100, float(np.mean([len(h) for _, h, _ in parts])))
    passages = [np.unique(rng.integers(0, len(index.vocabulary), 25)) for _ in range(80)]
    passage, term = np.repeat(np.arange(80), [len(p) for p in passages]), np.concatenate(passages)
    impact = np.zeros((len(index.vocabulary), len(parts)))
    for t in range(len(index.vocabulary)):
        for e in range(index.block_first[t], index.block_first[t + 1]):
            span = slice(index.posting_first[e], index.posting_first[e + 1])
            impact[t, index.part[span]] = index.impact[span]
    for threshold in (0.3, 0.5, 0.7):
        scores = np.stack([impact[p].sum(0) for p in passages])
        got = {(int(p), int(k)) for p, k, _ in zip(*decontam.retrieve(index, passage, term, 80, threshold), strict=True)}
        assert got == set(zip(*(x.tolist() for x in np.nonzero(scores >= threshold)), strict=True))


def test_leaks_need_question_and_answer(spark, edge, nothing):
    item = "Which river runs through the old town of marl near the salt hills? It is the winding river ossel."
    question, answer = item.split("? ")
    filler = " ".join(f"f{k}" for k in range(300))
    docs = spark.createDataFrame([
        (1, f"{filler} {item.upper()} {filler}"), (2, f"{filler} {question}? {filler}"), (3, f"{filler} {answer}"),
        (4, f"{question} or so? well. {answer} {filler}"), (5, None), (6, "")], "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "two words"), (None, item)], "item_id long, text string")
    rows = decontam.find_leaks(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(d, i) for d in (1, 4) for i in (10, None)}
    grouped = decontam.find_leaks(docs, items, group_bytes=50).collect()
    assert sorted(map(str, grouped)) == sorted(map(str, rows))
    assert sorted(r["doc_id"] for r in decontam.drop_leaks(docs, items).collect()) == [2, 3, 5, 6]
    assert decontam.drop_leaks(edge, items).columns == edge.columns
    assert decontam.drop_leaks(edge, items.limit(0)).count() == edge.count()
    assert decontam.find_leaks(nothing, items).count() == 0


# Fixity

def test_fixity_query_equals_sql(spark):
    found = QUERIES["op6_fixity"](spark, SF).toPandas().sort_values("page_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    assert found.equals(con.sql(SQL["op6_fixity"]).df().sort_values("page_id").reset_index(drop=True)[list(found.columns)])


def test_audit_locates_each_kind_of_damage(spark, shared):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k}\r\n\r\n{'x' * (k % 50)}</p>") for k in range(900)] + [(None, None, None)],
                                  "page_id long, url string, html string")
    fixity.write_archive(pages, shared, records_per_file=150)
    files = fixity.stored_files(spark, shared).collect()
    a = spark.createDataFrame([(f["path"], gzip.decompress(f["content"])) for f in files], "path string, content binary")
    expected = fixity.stored(fixity.hash_archive(a), "nodes")
    leaves = expected.where("level = 0").collect()
    assert len(leaves) == 901 and {r["record_id"] for r in leaves} == {*range(900), None}
    assert fixity.locate_corruption(expected, expected).count() == 0
    broken = {}
    for f in files:
        data = bytearray(gzip.decompress(f["content"]))
        if b"page:77>" in data:
            data[data.index(b"<p>77")] ^= 4
        if b"page:300>" in data:  # a header that can't be read
            data[data.index(b"urn:page:300>") - 40] = 0
        broken[f["path"]] = bytes(data)
    last = max(broken, key=lambda p: b"page:600>" in broken[p])
    cut = broken[last].rindex(b"WARC/1.1\r\nWARC-Type")
    lost = int(broken[last][cut:].split(b"urn:page:")[1].split(b">")[0])
    broken[last] = broken[last][:cut]  # truncated
    found = fixity.hash_archive(spark.createDataFrame(list(broken.items()), "path string, content binary"))
    rows = fixity.locate_corruption(expected, fixity.stored(found, "nodes")).collect()
    by_state = defaultdict(set)
    for r in rows:
        by_state[r["state"]].add(r["record_id"])
    assert by_state["corrupt"] >= {77, 300} and by_state["missing"] == {lost} and not by_state["extra"]
    assert len(by_state["corrupt"]) <= 3
    fewer = a.where(F.col("path") != last)
    gone = fixity.locate_corruption(expected, fixity.stored(fixity.hash_archive(fewer), "nodes")).collect()
    assert {r["state"] for r in gone} == {"missing"} and 600 in {r["record_id"] for r in gone}


def test_fixity_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert fixity.audited(none, 5, 1).count() == 0


# Backoff automaton

def test_scores_match_a_dictionary_model(spark, documents):
    rows = QUERIES["op8_ngrams"](spark, SF).collect()
    texts = {i: WORD.findall(lowered(t)) + ["<end>"] for i, t in documents}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for i in train for w in texts[i])
    n, v = sum(count.values()), len(count)
    states = {w for w in count if count[w] >= max(1.0, n * ngrams.STATE_SHARE)}
    pairs, context = Counter(), {**count, "<begin>": len(train)}
    for i in train:
        for a, b in zip(["<begin>", *texts[i]], texts[i], strict=False):
            if b in states and (a in states or a == "<begin>"):
                pairs[a, b] += 1
    pairs = {k: c for k, c in pairs.items() if c >= ngrams.LEAST_PAIR}
    mass = Counter()
    for (a, _), c in pairs.items():
        mass[a] += c - ngrams.DISCOUNT
    assert len(rows) == len(texts)
    for r in rows:
        base = score = 0.0
        for a, b in zip(["<begin>", *texts[r["doc_id"]]], texts[r["doc_id"]], strict=False):
            p = (count[b] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            if a in states or a == "<begin>":
                p *= 1 - mass[a] / context[a]
                p += (pairs[a, b] - ngrams.DISCOUNT) / context[a] if (a, b) in pairs else 0
            score += math.log10(p)
        known = sum(count[w] > 0 for w in texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(texts[r["doc_id"]]), known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_edge_rows(edge, nothing):
    rows = ngrams.score_texts(edge, remainder("doc_id", 10) != 0).collect()
    assert len(rows) == edge.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    unseen = ngrams.score_texts(edge, F.lit(False)).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in unseen} == {(0, 0, 0.0)}
    assert ngrams.score_texts(nothing, F.lit(True)).count() == 0


def test_rare_words_are_states_in_a_large_corpus(spark):
    """Each count is far below one of 100,000 training tokens, and some bigrams stand once only."""
    texts = [(k, " ".join(["filler"] * 3999)) for k in range(100)] + [(1000, "rare pair"), (1001, "rare pair"), (1002, "rare thing"), (2000, "rare pair")]
    rows = ngrams.score_texts(spark.createDataFrame(texts, "doc_id long, text string"), F.col("doc_id") < 2000)
    score = {r["doc_id"]: r["score"] for r in rows.collect()}
    n, v, begun, d = 100 * 4000 + 9, 5, 103, ngrams.DISCOUNT
    arc = lambda pair, state, follow, word: (pair - d) / state + d * follow / state * (word + 0.1) / (n + 0.1 * (v + 1))
    assert math.isclose(score[2000], math.log10(arc(3, begun, 2, 3)) + math.log10(arc(2, 3, 2, 2)) + math.log10(arc(2, 2, 1, begun)), rel_tol=1e-9)
    assert math.isclose(score[1002], math.log10(arc(3, begun, 2, 3)) + math.log10(arc(1, 3, 2, 1)) + math.log10(arc(1, 1, 1, begun)), rel_tol=1e-9)


# Token ids

@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("most", [0, 1, 50_000, 2**32 - 1])
def test_packing_round_trip(n, most):
    values = np.random.default_rng(n).integers(0, most, n, dtype=np.uint32, endpoint=True)
    values[::97] = 2**32 - 1
    segment = packing.encode(values)
    assert np.array_equal(packing.decode(segment), values)
    assert np.array_equal(packing.decode(segment, 1, 3), values[256:768])


def test_packing_stores_outliers_apart():
    values = np.full(2560, 1000, np.uint32) + np.arange(2560, dtype=np.uint32) % 16
    plain = len(packing.encode(values))
    values[::256] = 2**31
    assert len(packing.encode(values)) < plain + 10 * 8


def test_token_files_hold_the_tokenizers_ids(spark, documents, edge, shared):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a  b", " lead it's we'll 12 345", "x <|endoftext|> y z", "tail  ", "　  x  y", "\u0085 q w", "é è\r\n ü"]
    docs = spark.createDataFrame(documents[:150] + [(10_000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string").union(edge.select("doc_id", "text"))
    ordered = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = [], 0
    for doc_id, text in ordered:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    tokens.write_tokens(docs, shared, segment_ids=3000, block_bytes=20_000)
    rows = tokens.read_documents(spark, shared).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == Counter(expected)
    upto = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == upto
        upto += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == [d for d, _ in ordered]
    assert spark.read.parquet(shared).count() > 10


def test_token_files_of_an_empty_table(nothing):
    assert tokens.tokenized(nothing).count() == 0


# Repeated passages

PASSAGE = " ".join(f"Sentence number {k} tells of a thing called {k * 7919 % 101} in {k} words." for k in range(8))


def test_planted_passages_are_found_and_cut(spark):
    rng = np.random.default_rng(4)

    def own(n):
        return " ".join(f"Q{rng.integers(10**9)} r{rng.integers(10**9)} s{rng.integers(10**9)}." for _ in range(n))

    texts = [(k, f"{own(5)} {PASSAGE} {own(4)}") for k in range(1, 8)]
    texts += [(20, f"{own(5)}\n{PASSAGE}\n{own(5)}"), (30, own(30)), (31, f"{own(3)} Licensed to all. {own(3)}"), (32, f"{own(3)} Licensed to all. {own(3)}")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = linededup.repeated_passages(docs)
    rows = found.collect()
    whole, first = dict(texts), rows[0]["first_doc_id"]
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, 20} - {first}
    for r in rows:
        assert r["first_doc_id"] == first
        assert whole[r["doc_id"]].encode()[r["start"]:r["end"]].decode() == PASSAGE
    kept = {r["doc_id"]: r["text"] for r in linededup.remove_passages(docs, found).collect()}
    assert kept[first] == whole[first] and kept[30] == whole[30]
    assert all(("Sentence" in kept[k]) == (k == first) for k in (1, 2, 3, 4, 5, 6, 7, 20))


def test_passages_of_the_corpus(spark, documents):
    """Passages are cut where they say; of copies of a whole text all but one are found whole."""
    rows = QUERIES["op10_passages"](spark, SF).collect()
    texts = dict(documents)
    same = defaultdict(list)
    for i, t in documents:
        same[t].append(i)
    found = {r["doc_id"]: r for r in rows}
    for t, ids in same.items():
        parts = re.split(r"(?<=[.!?])\s|\n", t)
        if len(ids) > 1 and len(WORD.findall(t)) >= 60 and len(parts) > 6 and len(parts) == len(set(parts)):
            whole = [i for i in ids if i in found and found[i]["removed_words"] >= 0.9 * len(WORD.findall(t))]
            assert len(whole) >= len(ids) - 1
    for r in rows[:200]:
        for p in r["passages"]:
            cut = texts[r["doc_id"]].encode()[p["start"]:p["end"]].decode()
            assert len(WORD.findall(cut)) == p["n_words"] >= 30 and p["n_lines"] >= 2
            assert p["first_doc_id"] in texts


def test_passages_edge_rows(edge, nothing):
    found = linededup.repeated_passages(edge)
    assert linededup.remove_passages(edge, found).columns == edge.columns
    assert linededup.remove_passages(edge, found).count() == edge.count()
    assert found.where("doc_id in (1, 2, 3, 6, 7)").count() == 0
    assert linededup.repeated_passages(nothing).count() == 0
    assert PROSE in {r["text"] for r in linededup.remove_passages(edge, found).collect()}


def test_shared_runs_of_any_number_of_lines_are_found(spark, tmp_path):
    """Whole lines with 30 words in full, 50 words within a line but for their ends, however many lines."""
    rng = np.random.default_rng(8)
    names = lambda n: [f"w{x}" for x in rng.integers(10**9, size=n)]
    own = lambda n: " ".join(f"{' '.join(names(7))}." for _ in range(n))
    planted, texts = {}, []
    for k in range(60):
        n_lines, within = k % 6 + 1, k >= 48
        shared = " ".join(names(50)) if within else " ".join(f"{' '.join(names(-(-(30 + k % 5) // n_lines)))}." for _ in range(n_lines))
        edge = (lambda: " ".join(names(20))) if within else (lambda: own(4))
        planted |= {2 * k: shared, 2 * k + 1: shared}
        texts += [(2 * k, f"{edge()} {shared} {edge()}"), (2 * k + 1, f"{edge()} {shared} {edge()}")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op10_passages"](spark, str(tmp_path)).collect()}
    assert sorted(i // 2 for i in rows) == list(range(60))
    for i, r in rows.items():
        [p] = r["passages"]
        cut = dict(texts)[i].encode()[p["start"]:p["end"]].decode()
        assert p["first_doc_id"] == i ^ 1 and (cut == planted[i] if i < 96 else cut in planted[i] and p["n_words"] >= 30)


def test_every_shared_run_of_fifty_words_in_a_table_is_found(spark):
    """Against brute force: of all places of 50 words, but for one, a passage covers the middle."""
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    passages = {r["doc_id"]: [(p["start"], p["end"]) for p in r["passages"]] for r in QUERIES["op10_passages"](spark, SMALL).collect()}
    places = defaultdict(set)
    for i, t in texts.items():
        raw = (t or "").encode()
        bounds = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        for k in range(len(bounds) - 49):
            places[raw[bounds[k][0]:bounds[k + 49][1]]].add((i, bounds[k + 24][0]))
    shared = [x for x in places.values() if len({i for i, _ in x}) > 1]
    assert shared
    for x in shared:
        missed = {i for i, at in x if not any(a <= at < b for a, b in passages.get(i, []))}
        assert len(missed) <= 1
