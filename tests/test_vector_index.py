"""The index of cells, names with a fall-back to vectors, ranking by text and by structure."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from biblioscope.operators import similarity as S
from biblioscope.operators import vector_index as I


def brute(rows, asked, k):
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in asked:
        s = x @ x[ids.index(q)]
        out[q] = [ids[j] for j in sorted(range(len(ids)), key=lambda j: (-round(s[j], 9), ids[j])) if ids[j] != q][:k]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    return {i: [float(np.float32(v)) for v in base[i % 40] + 0.4 * rng.standard_normal(16)] for i in range(1200)}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "id bigint, embedding array<float>, cell int")


def test_recall_and_exactness(spark, vectors, monkeypatch):
    dirt = [(None, [1.0] * 16), (5000, None), (5001, [0.0] * 16), (5002, [1.0] * 3), (5003, [float("nan")] * 16), (7, vectors[7])]
    df = frame(spark, [*vectors.items(), *dirt])
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 5)
    monkeypatch.setattr(I, "PART_ROWS", 50)  # cells in several parts
    for probes, least in ((16, 1.0), (4, 0.9)):
        got: dict = {}
        for r in I.search(df, df.where("id % 20 = 0"), 5, dim=16, cells=16, probes=probes).orderBy("query_id", "similarity").collect():
            got.setdefault(r.query_id, set()).add(r.id)
        assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
        assert sum(len(got[q] & set(v)) for q, v in want.items()) >= least * 5 * len(want)


def test_empty_sides(spark, vectors):
    df = frame(spark, list(vectors.items())[:30])
    assert I.search(df.limit(0), df, 5, dim=16).count() == 0 and I.search(df, df.limit(0), 5, dim=16).count() == 0
    assert I.search(df.limit(1), df.limit(1), 5, dim=16).count() == 0


def test_names_then_vectors(spark):
    names = spark.createDataFrame([("aspirin", "D1"), ("asa", "D1"), ("asa", "D0"), ("ibuprofen", "D2")], "key string, entity_id string")
    vectors = spark.createDataFrame([("D1", [1.0, 0.0, 0.0]), ("D2", [0.0, 1.0, 0.0])], "id string, embedding array<float>")
    mentions = spark.createDataFrame([("m1", " Aspirin ", [0.0, 1.0, 0.0]), ("m2", "asa", None), ("m3", "aspirn", [0.9, 0.1, 0.0]), ("m4", "water", [0.0, 0.0, 1.0]), ("m5", None, None)], "id string, name string, embedding array<float>")
    got = {r.id: (r.entity_id, r.by) for r in I.resolve_names(mentions, names, vectors, dim=3, cells=2, probes=2).collect()}
    assert got == {"m1": ("D1", "name"), "m2": ("D0", "name"), "m3": ("D1", "vector"), "m4": (None, "none"), "m5": (None, "none")}


def test_text_search_equals_a_loop(spark):
    texts = {1: "The gene raises the risk, the RISK of disease.", 2: "A drug lowers risk", 3: "nothing here", 4: "", 5: "gene gene gene"}
    df = spark.createDataFrame([*texts.items(), (6, None)], "id int, text string")
    words = {i: Counter(re.findall(r"[^\W_]+", t.lower())) for i, t in texts.items()}
    idf = {w: math.log(1 + 5 / sum(w in c for c in words.values())) for c in words.values() for w in c}
    asked = Counter("gene risk unknown".split())
    weight = {w: n * idf.get(w, math.log(6)) for w, n in asked.items()}
    norm = lambda x: math.sqrt(sum(v * v for v in x))
    want = {i: sum(n * idf[w] * weight.get(w, 0) for w, n in c.items()) / (norm(n * idf[w] for w, n in c.items()) * norm(weight.values())) for i, c in words.items() if any(w in weight for w in c)}
    got = {r.id: r.similarity for r in S.text_search(df, "Gene risk unknown").collect()}
    assert got == pytest.approx(want) and set(got) == {1, 2, 5}
    assert S.text_search(df.limit(0), "gene").count() == 0 and S.text_search(df, "unknown").count() == 0


def test_hybrid_ranks_by_both(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.8, 0.6]), ("c", [0.0, 1.0]), ("d", None)], "id string, embedding array<float>")
    structure = spark.createDataFrame([("b", 0.5), ("c", 1.0)], "id string, structural double")
    got = [(r.id, round(r.score, 6)) for r in S.hybrid(vectors, [1.0, 0.0], structure, 3).collect()]
    assert got == [("b", 0.71), ("a", 0.7), ("c", 0.3)]
    assert [r.id for r in S.hybrid(vectors, [1.0, 0.0], structure, 1, share=0.0).collect()] == ["c"]


def test_vectors_of_triples(spark):
    vectors = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 3.0]), ("z", [0.0, 0.0])], "id string, embedding array<float>")
    triples = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "z"), ("a", None)], "subject_id string, object_id string")
    assert [list(r.embedding) for r in S.triple_vectors(triples, vectors).collect()] == [[1.0, 0.0, 0.0, 1.0]]
