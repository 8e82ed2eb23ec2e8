"""SimHash, nearest neighbours, BM25 and toxicity against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import AWKWARD, documents, roots, words
from pyspark.sql import functions as F

from mentionflow.llm import bm25_search, components, curve_search, simhash, toxicity


def plain_fingerprint(text, size=4):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[at : at + size]), 42) for at in range(max(1, len(found) - size + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_rows():
    base = words(5, 400)
    rows = [(doc_id, text) for doc_id, text in AWKWARD if doc_id != 6]
    for at in range(60):
        copy = list(base)
        copy[at * 5 % 400] = f"edit{at}"
        rows.append((100 + at, " ".join(copy)))
    return rows


@pytest.mark.parametrize("tile", [4096, 3])
def test_simhash_components(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash.link_close, "__defaults__", (tile,))
    rows = near_rows()
    got = {(row.doc_id, row.code): row.component_id for row in simhash.near_duplicates(documents(spark, rows)).collect()}
    codes = [plain_fingerprint(text) for _, text in rows]
    found = roots(len(rows), lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 4)
    for at, (doc_id, _) in enumerate(rows):
        signed = codes[at] - (1 << 64) if codes[at] >> 63 else codes[at]
        members = [rows[other][0] for other in range(len(rows)) if found[other] == found[at]]
        assert got[doc_id, signed] == min((one for one in members if one is not None), default=None)
    assert simhash.near_duplicates(documents(spark, []), 4).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(at, at + 1) for at in range(40)] + [(100, other) for other in range(101, 160)] + [(7, 7)]
    got = {row.node: row.root for row in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {at: 0 for at in range(1, 41)} | {at: 100 for at in range(101, 160)}


@pytest.mark.parametrize("tile", [4096, 3])
def test_keep_one_of_each_group(spark, tile, monkeypatch):
    """All names the operator uses inside stand as columns of the input, and come out as they went in."""
    monkeypatch.setattr(simhash.link_close, "__defaults__", (tile,))
    rows = near_rows() + [(900, " ".join(words(5, 400)).replace("a", "q")), (None, None), (901, "no letters here"), (901, "no letters here")]
    own = ["row", "id", "code", "text_hash", "kept_id", "kept_hash", "copy", "first", "root", "node"]
    docs = documents(spark, rows).select("*", *[F.lit(name).alias(name) for name in own])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert all(row[name] == name for row in found for name in own)
    codes = [plain_fingerprint(text) for _, text in rows]
    groups = roots(len(rows), lambda a, b: (codes[a] ^ codes[b]).bit_count() <= 4)
    want = [min((rows[at][0] for at in range(len(rows)) if groups[at] == group and rows[at][0] is not None), default=None) for group in set(groups)]
    assert sorted(map(str, want)) == sorted(str(row.doc_id) for row in found)
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_links_of_a_hot_node_are_split(spark):
    """The largest task of a star's joins stays bounded: both sides are plain shuffles that adaptive execution may split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = spark.range(1, 3000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
        got = components.components(links)
        assert got.count() == 2999 and got.select("root").distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plain_nearest(vectors, at, most=10):
    far = [(math.sqrt(sum((a - b) ** 2 for a, b in zip(vectors[at][1], other[1]))), other[0], row) for row, other in enumerate(vectors) if row != at]
    return sorted(far)[:most]


def test_curve_search(spark):
    draw = np.random.default_rng(4)
    vectors = [(at, [float(x) for x in draw.normal(size=16).astype("f4")]) for at in range(3000)]
    vectors += [(5000, vectors[0][1]), (5001, vectors[0][1]), (5001, vectors[0][1])]
    bad = [(600, None), (700, [0.0] * 16), (800, [float("nan")] * 16), (900, [1.0, None] + [1.0] * 14), (1000, [float("inf")] * 16), (1100, [1.0, 2.0]), (None, [1.0] * 16)]
    vectors = [row for row in vectors if row[0] not in {one for one, _ in bad}]
    frame = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    rows = curve_search.search(frame).collect()
    asked = [at for at, (vec_id, _) in enumerate(vectors) if vec_id % 100 == 0]
    by = {}
    for row in rows:
        by.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    assert set(by) == {vectors[at][0] for at in asked}
    hits = 0
    for at in asked:
        best = plain_nearest(vectors, at)
        got = sorted(by[vectors[at][0]])
        assert [rank for rank, _, _ in got] == list(range(1, 11))
        hits += len({(vec_id, round(far, 9)) for _, vec_id, far in got} & {(vec_id, round(far, 9)) for far, vec_id, _ in best})
    assert hits >= 0.9 * 10 * len(asked)
    assert [vec_id for _, vec_id, far in sorted(by[0]) if far == 0] == [5000, 5001, 5001]


def skewed(kind):
    """12,000 vectors: plain, a third in one tight group, a third exact copies of one, or one vector very far away."""
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(12_000, 64))
    if kind == "tight":
        vectors[::3] = draw.normal(size=64) + 1e-4 * draw.normal(size=(4000, 64))
    elif kind == "copies":
        vectors[::3] = vectors[0]
    elif kind == "far":
        vectors[7] *= 1e5
        vectors[8] = 1e200
    return vectors


@pytest.mark.parametrize("kind", ["plain", "tight", "copies", "far"])
def test_curve_search_on_skewed_vectors(spark, kind):
    vectors = skewed(kind)
    frame = spark.createDataFrame(((at, row.tolist()) for at, row in enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {}
    for row in curve_search.search(frame, 200).collect():
        got.setdefault(row.query_id, {})[row.vec_id] = row.score
    hits = {True: [], False: []}
    for at in range(0, 12_000, 200):
        far = np.sqrt(((vectors - vectors[at]) ** 2).sum(1))
        far[at] = np.inf
        best = np.lexsort((np.arange(len(far)), far))[:10]
        assert len(got[at]) == 10 and all(np.isclose(score, far[one]) for one, score in got[at].items())
        hits[at % 3 == 0].append(len(set(best.tolist()) & set(got[at])))
    assert all(np.mean(found) >= 9 for found in hits.values()), {key: np.mean(found) for key, found in hits.items()}


def test_curve_search_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(row["rank"], row.vec_id) for row in sorted(curve_search.search(few).collect(), key=lambda row: row["rank"])] == [(1, 2), (2, 1)]
    assert curve_search.search(few.limit(0)).count() == 0


def test_hilbert_neighbours_touch():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    path = cells[np.argsort(curve_search.hilbert_keys(cells, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("shard", [7, 16384])
def test_bm25_equals_scoring_every_document(spark, shard, monkeypatch):
    monkeypatch.setattr(bm25_search, "QUERY_ROWS", 40)
    pool = words(9, 60)
    rows = [(at, " ".join(pool[(at * at + step * (at % 7 + 1)) % 60] for step in range(3 + at % 25))) for at in range(120)]
    rows += [(200, rows[50][1]), (201, rows[50][1]), (250, None), (300, ""), (350, "Zzz unknown"), (None, pool[0])]
    docs = documents(spark, rows)
    got = {}
    for row in bm25_search.search(docs, docs.filter("doc_id % 50 = 0"), 5, shard, 4).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.doc_id, row.score))
    held = [(doc_id, Counter((text or "").lower().split())) for doc_id, text in rows if doc_id is not None]
    mean = sum(own.total() for _, own in held) / len(held)
    df = Counter(term for _, own in held for term in own)
    for query_id, asked in held:
        if query_id % 50:
            continue
        scored = []
        for doc_id, own in held:
            score = sum(
                times * math.log(1 + (len(held) - df[term] + 0.5) / (df[term] + 0.5)) * own[term] * 2.2 / (own[term] + 1.2 * (0.25 + 0.75 * own.total() / mean))
                for term, times in asked.items()
                if term in own
            )
            if doc_id != query_id and score > 0:
                scored.append((-round(score, 8), doc_id))
        want = [(at + 1, doc_id, -score) for at, (score, doc_id) in enumerate(sorted(scored)[:5])]
        assert [one[:2] for one in sorted(got.get(query_id, []))] == [one[:2] for one in want]
        assert np.allclose([one[2] for one in sorted(got.get(query_id, []))], [one[2] for one in want])
    assert bm25_search.search(docs.limit(0), docs.limit(0)).count() == 0


@pytest.mark.parametrize("times", [20_000, 70_000])
def test_bm25_tells_scores_apart_that_single_precision_does_not(times):
    """Common terms are kept in single precision and as counts; what is returned has the exact scores, in their order."""
    held = [times + at * 7 % 40 for at in range(40)]
    texts = ["much " * n + "other " * (times + 50 - n) for n in held]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], ["doc_id", "text"])
    shard = bm25_search.Shard(next(bm25_search._shards(iter([batch]))).to_pylist()[0], times + 50, 8)
    assert (shard.common >= 0).all() and shard.common_impacts.nbytes + shard.common_counts.nbytes <= 8 * 40 * len(shard.terms)
    term = bm25_search._terms("much")[0]
    impacts = np.array([1000.0 * n * 2.2 / (n + 1.2) for n in held])
    want = np.argsort(-np.round(impacts, 8), kind="stable")[:10]
    assert len(set(np.round(impacts, 8))) == 40 and len(set(impacts.astype(np.float32))) < 20
    for floor in (0.0, float(impacts[want[-1]])):
        [(_, ids, scores)] = shard.best([(0, -1, term, np.array([1000.0]))], np.array([floor]), 10)
        assert ids.tolist() == want.tolist() and np.allclose(scores, impacts[want], rtol=0, atol=1e-8)


def test_bm25_opens_only_blocks_that_reach_the_floor(spark, monkeypatch):
    """Four vocabularies: a query's own blocks are opened, most of the others are not, and the answers are the same."""
    sizes = {"shard_size": 200, "block_size": 8}
    draw = random.Random(1)
    tongues = [words(40 + at, 60) for at in range(4)]
    rows = [(at, " ".join(draw.choices(tongues[at % 4], k=80))) for at in range(800)]
    docs = documents(spark, rows)
    answers = bm25_search.shard_answers(docs, docs.filter("doc_id % 20 = 0"), 5, **sizes)
    opened, asked = answers.agg(F.sum("opened"), F.sum("asked")).first()
    assert 0 < opened < 0.5 * asked
    pruned = sorted(tuple(row) for row in bm25_search.search(docs, docs.filter("doc_id % 20 = 0"), 5, **sizes).collect())
    monkeypatch.setattr(bm25_search, "_floors", lambda index, block, *_: np.zeros(len(np.unique(block[0]))))
    assert pruned == sorted(tuple(row) for row in bm25_search.search(docs, docs.filter("doc_id % 20 = 0"), 5, **sizes).collect())


@pytest.mark.parametrize("text", ["", "_", "A_b c1\x00D\x1ce\x7f-f\tf", "ÄÖÜ ß_Straße naïve A", "é·b — “q” ½ x²", "İI ıi K", "e\u0301 e\u200bz", "中文 字_x", "😀 a😀b", "\xa0a\xa0B\x85c", "ΣΑΣ ςσ"])
def test_bm25_words_of_any_script(text):
    """Words are cut as the pattern does it, whichever way a text takes, and hashed as UTF-8."""
    counts = Counter(re.findall(r"[^\W_]+", text.lower()))
    terms, times, length = bm25_search._terms(text)
    want = sorted((xxhash.xxh64_intdigest(word) - (1 << 63), n) for word, n in counts.items())
    assert list(zip(terms.tolist(), times.tolist())) == want and length == counts.total()


def _bm25_shard(rows, mean, block):
    batch = pa.RecordBatch.from_arrays([pa.array([at for at, _ in rows]), pa.array([text for _, text in rows])], ["doc_id", "text"])
    return bm25_search.Shard(next(bm25_search._shards(iter([batch]), len(rows), block)).to_pylist()[0], mean, block)


def test_bm25_keeps_rows_for_the_common_terms_of_each_block():
    """Texts of four vocabularies come mixed; a block is of one of them, and keeps no rows for the terms of the others."""
    draw = random.Random(4)
    tongues = [words(60 + at, 40) for at in range(4)]
    shard = _bm25_shard([(at, " ".join(draw.choices(tongues[at % 4], k=80))) for at in range(400)], 80, 100)
    for low, high in zip(shard.cuts, shard.cuts[1:]):
        assert len({at % 4 for at in shard.ids[low:high].tolist()}) == 1
    assert shard.common_impacts.size <= 400 * 40


@pytest.mark.parametrize(("share", "block"), [(2, 6), (2, 40), (1, 6), (1000, 6), (14, 300)])
@pytest.mark.parametrize("raised", [False, True])
def test_bm25_shard_adds_up_common_and_rare_terms(share, block, raised, monkeypatch):
    """Whatever terms are common and blocks open, a shard's answers are those of scoring every document of it."""
    monkeypatch.setattr(bm25_search, "COMMON_SHARE", share)
    draw = random.Random(share + block)
    tongues = [words(70 + at, 90) for at in range(3)]
    rows = [(at, " ".join(tongues[at % 3][min(int(draw.expovariate(0.06)), 89)] for _ in range(draw.choice([1, 4, 30, 200])))) for at in range(240)]
    rows += [(500 + at, rows[at][1]) for at in range(12)]
    shard = _bm25_shard(rows, 50, block)
    held = {at: Counter(text.split()) for at, text in rows}
    queries, want = [], []
    for at in range(0, 240, 7):
        weights = {int(bm25_search._terms(term)[0][0]): times * (1 + len(term) / 7) for term, times in held[at].items()}
        scores = []
        for other, own in held.items():
            norm = 1.2 * (0.25 + 0.75 * own.total() / 50)
            score = sum(times * (1 + len(term) / 7) * own[term] * 2.2 / (own[term] + norm) for term, times in held[at].items() if term in own)
            if other != at and score > 0:
                scores.append((-round(score, 8), other))
        want.append(sorted(scores)[:5])
        queries.append((at, at, np.array(sorted(weights)), np.array([weights[term] for term in sorted(weights)])))
    floors = np.array([-best[-1][0] if raised and len(best) == 5 else 0.0 for best in want])
    got = {at: (ids.tolist(), scores) for at, ids, scores in shard.best(queries, floors, 5)}
    for (at, *_), best in zip(queries, want):
        ids, scores = got.get(at, ([], []))
        assert ids == [other for _, other in best] and np.allclose(scores, [-score for score, _ in best], rtol=0, atol=2e-8)


def test_bm25_floors_come_from_as_many_shards_as_there_are_tasks(spark, monkeypatch):
    """Not every shard is made ready for the floors, however many there are; the answers are those without any floor."""
    docs = documents(spark, [(at, " ".join(words(at % 50, 6) + words(900 + at, 3))) for at in range(600)]).repartition(3)
    asked = []
    plain = bm25_search._floors
    monkeypatch.setattr(bm25_search, "_floors", lambda index, block, keys, *rest: asked.append(len(keys)) or plain(index, block, keys, *rest))
    got = bm25_search.search(docs, docs.filter("doc_id % 50 = 0"), 5, 10, 4).collect()
    assert asked and max(asked) <= 2 * spark.sparkContext.defaultParallelism < 60
    monkeypatch.setattr(bm25_search, "_floors", lambda index, block, *_: np.zeros(len(np.unique(block[0]))))
    assert sorted(got) == sorted(bm25_search.search(docs, docs.filter("doc_id % 50 = 0"), 5, 10, 4).collect())


def toxic_table(spark):
    rows, labels = list(AWKWARD), [(1, 0), (None, 1), (4, None), (5, 7)]
    for at in range(200):
        text = words(1000 + at, 80)
        if at % 4 == 0:
            text[at % 80] = ("scoundrel", "Blockhead!", "nitwit")[at % 3]
            text[(at + 9) % 80] = "knave"
        rows.append((2000 + at, " ".join(text)))
        if at % 10 != 9:
            labels.append((2000 + at, int(at % 4 == 0)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in rows)
    judged = [row for row in rows if row.doc_id and row.doc_id >= 2000 and row.held_out]
    assert judged and sum(row.predicted == int((row.doc_id - 2000) % 4 == 0) for row in judged) >= 0.95 * len(judged)
    assert {row.doc_id for row in rows for at in row.evidence_ids if at == row.doc_id and row.held_out} == set()
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not row.predicted for row in rows)
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert {row.score for row in toxicity.score_toxicity(docs.limit(5), labels.limit(0)).collect()} == {0.0}


def test_nearest_examples_equal_brute_force(spark):
    docs, labels = toxic_table(spark)
    index = toxicity.Index(toxicity.examples(docs, labels))
    table = np.zeros((len(index.ids), len(index.vocabulary)))
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row, doc_id in enumerate(index.ids.tolist()):
        terms, weights = index.vector(texts[doc_id])
        table[row, terms] = weights
    assert len(index.vocabulary) > 0
    for text in texts.values():
        terms, weights = index.vector(text)
        cosines = table[:, terms] @ weights if len(terms) else np.zeros(len(table))
        want = sorted((-cosine, at) for at, cosine in enumerate(cosines.tolist()) if cosine > 0)[:15]
        assert np.allclose([-low for low, _ in want], [cosine for cosine, _ in index.nearest(terms, weights, 15)] if len(terms) else [])
