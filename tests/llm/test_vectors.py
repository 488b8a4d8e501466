"""Most similar vectors: recall against brute force, classes of copies, dirt."""

import numpy as np

from biblioscope.llm import vectors


def brute(rows, k=5, least=0.9):
    good = {}
    for key, v in rows:
        if key is None or v is None or len(v) != 64 or any(x is None for x in v):
            continue
        x = np.array(v, dtype=float)
        if np.isfinite(x).all() and x.any():
            good[key] = x / np.linalg.norm(x)
    keys = sorted(good)
    x = np.stack([good[i] for i in keys])
    s = np.round(x @ x.T, 12)
    out = set()
    for i in range(len(keys)):
        order = sorted((j for j in range(len(keys)) if j != i), key=lambda j: (-s[i, j], keys[j]))[:k]
        out |= {tuple(sorted((keys[i], keys[j]))) for j in order if s[i, j] >= least}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "id string, embedding array<float>, vec int")


def test_recall_and_precision(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((900, 64))
    near = base[:150] + 0.25 * rng.standard_normal((150, 64))
    closer = base[:60] * 3 + 0.6 * rng.standard_normal((60, 64))
    rows = [(f"v{i:04}", [float(np.float32(x)) for x in v]) for i, v in enumerate(np.concatenate([base, near, closer]))]
    rows += rows[:20] + [("null", None), ("zero", [0.0] * 64), ("short", [1.0] * 32), ("nan", [float("nan")] * 64), ("inf", [float("inf")] + [1.0] * 63), (None, [1.0] * 64)]
    got = {(r.id_a, r.id_b) for r in vectors.similar_pairs({"a": frame(spark, rows), "b": frame(spark, [])}).collect()}
    want = brute(rows)
    assert len(want) > 200
    assert len(got & want) >= 0.98 * len(want) and got <= want


def test_spaces_stay_apart_and_copies_are_linked_to_the_lowest(spark):
    rng = np.random.default_rng(2)
    v = [float(np.float32(x)) for x in rng.standard_normal(64)]
    others = [(f"o{i}", [float(np.float32(x)) for x in rng.standard_normal(64)]) for i in range(100)]
    rows = [(f"c{i:02}", v) for i in range(30)] + others
    got = {(r.space, r.id_a, r.id_b) for r in vectors.similar_pairs({"a": frame(spark, rows), "b": frame(spark, [("c00", v), ("zz", v)])}).collect()}
    assert {(a, b) for s, a, b in got if s == "a"} == brute(rows)
    assert {(a, b) for s, a, b in got if s == "b"} == {("c00", "zz")}
    assert len(got) < 30 * 6 + 2


def test_nothing(spark):
    assert vectors.similar_pairs({"a": frame(spark, [])}).count() == 0
    assert vectors.similar_pairs({"a": frame(spark, [("one", [1.0] * 64)])}).count() == 0


def test_chunks_of_a_crowded_cell_find_all(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(64)
    rows = [(f"v{i:03}", [float(np.float32(x)) for x in base + 0.1 * rng.standard_normal(64)]) for i in range(200)]
    whole = {(r.id_a, r.id_b) for r in vectors.similar_pairs({"a": frame(spark, rows)}).collect()}
    monkeypatch.setattr(vectors, "CELL_ROWS", 40)
    assert {(r.id_a, r.id_b) for r in vectors.similar_pairs({"a": frame(spark, rows)}).collect()} == whole


def test_widest_search_is_exact(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((60, 64))
    x = np.concatenate([base[i % 60][None] + 0.33 * rng.standard_normal((1, 64)) for i in range(300)])
    rows = [(f"v{i:03}", [float(np.float32(y)) for y in v]) for i, v in enumerate(x)]
    want, got = brute(rows), {}
    for name, more in (("exact", {"words": 1, "radius": vectors.SUB, "most_bits": vectors.WORD}), ("one", {"words": 1}), ("three", {})):
        got[name] = {(r.id_a, r.id_b) for r in vectors.similar_pairs({"a": frame(spark, rows)}, **more).collect()}
    assert got["exact"] == want and len(want) > 200
    assert len(got["one"] & want) <= len(got["three"] & want) and len(got["three"] & want) >= 0.99 * len(want)


def test_sample_is_bounded_and_repeats_count_once(spark, monkeypatch):
    """A key in a third of all rows does not swell the sample."""
    monkeypatch.setattr(vectors, "FIT_ROWS", 50)
    taken = []
    monkeypatch.setattr(vectors.np.linalg, "eigh", lambda m, f=np.linalg.eigh: taken.append(m) or f(m))
    seen = []
    stack = np.stack
    monkeypatch.setattr(vectors.np, "stack", lambda x, *a: seen.append(len(x)) or stack(x, *a))
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS id", "transform(sequence(1, 64), x -> cast(if(id % 3 = 0, x, sin(id * x)) AS float)) AS vec")
    vectors.learn_rotations(df, 1)
    assert taken and 20 <= seen[0] <= 90
