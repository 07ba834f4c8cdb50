"""Embedding links against brute force, the pipeline on planted cases, and the columns of all queries."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from filingstrata.llm import ngram_lm, neighbours, queries

SF = "/root/testdata/sf0.001"


def test_vector_links_are_exact(spark):
    rng = np.random.default_rng(7)
    rows, centres = [], rng.normal(size=(12, 24))
    for k in range(500):
        centre = centres[k % 12] if k < 300 else rng.normal(size=24)
        vector = centre + rng.normal(size=24) * (0.02 if k % 5 else 0.3)
        rows.append((k, [float(x) for x in vector], k % 2 if k % 11 else None))
    rows += [(600 + k, rows[1][1], 1) for k in range(40)] + [(700, [2 * x for x in rows[1][1]], 1), (1, rows[1][1], 1)]
    odd = [None, [0.0] * 24, [1.0, None], [float("nan")] * 24, [float("inf")] * 24, [], [1e300, 1e300], [1e300, 1e300]]
    rows += [(800 + k, v, 1) for k, v in enumerate(odd)] + [(None, rows[1][1], 1)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, a string").repartition(4)
    found = neighbours.near_duplicates(vectors).collect()
    assert len(found) == len(rows)
    fit = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1] and 0 < np.abs(r[1]).max() < np.inf]
    unit = [np.array(r[1]) / np.abs(r[1]).max() for r in fit]
    unit = [x / np.linalg.norm(x) for x in unit]
    link = np.array([[len(x) == len(y) and a[2] == b[2] and float(x @ y) >= 0.93 for y, b in zip(unit, fit)] for x, a in zip(unit, fit)])
    reach = np.linalg.matrix_power(link.astype(float) + np.eye(len(fit)), 1) > 0
    for _ in range(10):
        reach = (reach.astype(float) @ reach.astype(float)) > 0
    ids = np.array([r[0] for r in fit])
    expected = {r[0]: (link[k].sum() - 1, ids[reach[k]].min()) for k, r in enumerate(fit)}
    for r in found:
        n, root = expected.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (n, root, r.vec_id is not None and r.vec_id == root), r


def _dense_and_pairs(rng, dense, pairs):
    """A dense group, lone pairs and vectors alone, as (vec_id, embedding, label)."""
    near = lambda centre, noise: [float(x) for x in centre + rng.normal(size=32) * noise]
    centre, rows = rng.normal(size=32), []
    rows += [near(centre, 0.03) for _ in range(dense)]
    for _ in range(pairs):
        mate = rng.normal(size=32)
        rows += [near(mate, 0.02), near(mate, 0.02)]
    rows += [near(np.zeros(32), 1.0) for _ in range(dense)]
    return [(k, v, 1) for k, v in enumerate(rows)]


def test_a_dense_group_does_not_hide_lost_pairs(spark):
    rows = _dense_and_pairs(np.random.default_rng(3), 300, 100)
    points = neighbours.unit_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    points = points.select(F.col("vec_id").alias("a"), "label", "v", F.lit(1).alias("copies"))
    pairs = [(300 + 2 * k, 301 + 2 * k) for k in range(100)]
    found = [(k, 0) for k in range(300)] + [(x, a) for a, b in pairs for x in (a, b)]
    roots = spark.createDataFrame(found, "node long, root long")
    assert neighbours.audit(points, roots, 0.93) == 1.0
    lost = roots.where("root = 0 or root % 10 <> 0")  # one pair in five
    assert 0.7 < neighbours.audit(points, lost, 0.93) < 0.9


def test_lone_pairs_beside_a_dense_group_are_found(spark):
    rows = _dense_and_pairs(np.random.default_rng(4), 900, 100)
    found = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    links = {r.vec_id: r.n_links for r in found}
    lone = sum(links[900 + 2 * k] == 1 == links[901 + 2 * k] for k in range(100))
    assert lone >= 99 and all(r.audited_recall >= 0.99 for r in found)
    assert all(links[k] >= 890 for k in range(900))


def test_no_vectors(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents with a toxic one, a near copy, a repeated passage and a leak among clean ones."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    folder = str(tmp_path_factory.mktemp("planted"))
    item, passage, twin = " ".join(text(20)), text(80), text(120)
    bad = lambda k: k < 160 and k % 4 == 0
    rows = [(k, " ".join(text(100) + (["vile"] if bad(k) else [])), "en", f"s{k % 3}", 0) for k in range(240)]
    rows += [
        (1000, " ".join(twin), "en", "s1", 0), (1001, " ".join([*twin[:-1], "other"]), "en", "s2", 0),
        (1002, " ".join(text(60) + passage), "en", "s1", 0), (1003, " ".join(text(30) + passage + text(30)), "en", None, 0),
        (1004, " ".join(text(40)) + " " + item.upper() + " x", "en", "s1", 0), (1005, "so VILE, " + " ".join(text(30)), "en", "s1", 0),
        (1006, None, None, None, None), (1007, "", "en", "s1", 0), (None, "no id here", "en", "s1", 0), (1000, " ".join(twin), "en", "s1", 0),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(bad(k))) for k in range(200)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict((r[0], r[1]) for r in rows), passage


def test_pipeline_on_planted_cases(spark, planted):
    folder, texts, passage = planted
    got = corpus_pipeline.run(spark, folder).collect()
    left = {r.doc_id: r for r in got}
    assert len(got) == len(left)  # of the repeated row one stays
    gone = {k for k in range(160) if k % 4 == 0} | {1001, 1004, 1005}
    assert set(left) == set(texts) - gone
    assert left[1002].text == texts[1002]
    assert left[1003].text.split() == [w for w in texts[1003].split() if w not in passage] or len(left[1003].text.split()) == 60
    assert all(left[k].text == texts[k] for k in left if k != 1003)
    assert {"mix_slot", "mix_position", "mix_share"} <= set(got[0].asDict())


def test_stages_keep_the_columns(spark, planted):
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "mixing"]
    for _, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs.limit(0), folder).columns == docs.columns
        assert apply(spark, docs.limit(0), folder).count() == 0


COLUMNS = {
    "op1_decontamination": "doc_id item_id distance budget offset length",
    "op2_toxicity": "doc_id held_out score predicted spans",
    "op3_substring_dedup": "doc_id start n_words source_id source_start source_words identity",
    "op4_url_filter": "page_id host path rule verdict score",
    "op5_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score perplexity",
    "op6_ngram_jaccard_join": "doc_id n_shingles component_id",
    "op7_embedding_near_dedup": "vec_id n_links component_id kept audited_recall",
    "op8_source_mixing": "doc_id source lang n_chars mix_share mix_block mix_slot mix_position mix_complete",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op13_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_over_whole_tables(spark, name):
    result = queries.QUERIES[name](spark, SF)
    assert result.columns == COLUMNS[name].split()
    whole = {"op4": ("pages", 50), "op7": ("embeddings", 500)}.get(name.split("_")[0], ("documents", 200))[1]
    count = result.count()
    assert 0 < count if name[:4] in ("op1_", "op3_") else count == whole


def test_scores_are_of_trigrams(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = lambda rows: {r.doc_id: round(r.score, 6) for r in rows.where("score is not null").collect()}
    got = scores(queries.op5_lm_scoring(spark, SF))
    assert got == scores(ngram_lm.score_corpus(docs, 3)) != scores(ngram_lm.score_corpus(docs, 2))
