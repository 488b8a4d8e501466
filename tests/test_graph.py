"""The fluent query, joins, rules, summaries and streams on small graphs."""

import pytest
from pyspark.sql import functions as F

from biblioscope.operators import aggregates, joins, lookup, rules, similarity
from biblioscope.streaming import events

ENTITIES = [("C1", "disease", "Breast Cancer", "onc", '{"stage": "2"}'), ("G1", "gene", "BRCA1", None, None), ("D1", "drug", "Olaparib", None, '{"fda": true}'), ("D2", "drug", "100%_drug", None, None), ("S1", "symptom", "Pain", None, None)]
TRIPLES = [("D1", "treats", "C1", 0.95, ["P1", "P2"], 2), ("D2", "treats", "C1", 0.5, ["P2"], 1), ("G1", "increases_risk", "C1", 0.9, ["P1"], 1), ("C1", "causes", "S1", 0.7, [], 0), ("S1", "associated_with", "C1", 0.2, [], 0), ("D2", None, "C1", 0.1, [], 0), ("G1", "binds_to", "D2", 0.5, [], 0), ("D2", "contraindicated_for", "C1", 0.6, ["P3"], 1)]
EVIDENCE = [("D1", "treats", "C1", "P1", "rct", 0.9, 100), ("D1", "treats", "C1", "P2", "cohort", 0.5, 10), ("D2", "treats", "C1", "P2", "review", 0.5, None)]


@pytest.fixture(scope="module")
def graph(spark):
    e = spark.createDataFrame(ENTITIES, "entity_id string, entity_type string, name string, category string, p string").withColumn("properties", F.parse_json("p")).drop("p")
    r = spark.createDataFrame(TRIPLES, "subject_id string, predicate string, object_id string, confidence double, source_papers array<string>, evidence_count bigint")
    v = spark.createDataFrame(EVIDENCE, "subject_id string, predicate string, object_id string, paper_id string, study_type string, confidence double, sample_size bigint")
    return {"entities": e, "relationships": r, "evidence": v}


def ids(df, column="entity_id"):
    return [r[column] for r in df.collect()]


def test_fluent_query(graph):
    q = lookup.GraphQuery(graph)
    assert ids(q.entities("drug").order_by("name").frame()) == ["D2", "D1"]
    assert ids(q.entities().filter(stage="2").frame()) == ["C1"] and ids(q.entities().filter(name="x").filter(name="BRCA1").frame()) == ["G1"]
    assert ids(q.relationships("TREATS", min_confidence=0.8).frame(), "subject_id") == ["D1"]
    assert ids(q.relationships("treats").with_evidence("review").frame(), "subject_id") == ["D2"]
    assert q.relationships().frame().count() == 7 and q.relationships(predicate="").frame().count() == 7
    assert ids(q.relationships().order_by("confidence", descending=True).limit(2).frame(), "subject_id") == ["D1", "G1"]
    assert [r.path for r in q.traverse("G1", ["BINDS_TO:drug", "treats:disease", "causes"]).frame().collect()] == [["G1", "D2", "C1", "S1"]]
    with pytest.raises(ValueError):
        q.frame()


def test_search_and_results(graph, spark):
    vectors = spark.createDataFrame([("C1", [1.0, 0.0]), ("D1", [0.9, 0.1]), ("G1", [0.0, 1.0])], "id string, embedding array<float>")
    q = lookup.GraphQuery({**graph, "vectors": vectors, "embed": lambda text: [1.0, 0.0] if text == "cancer" else [0.0, 1.0]})
    assert ids(q.semantic_search("cancer").frame()) == ["C1", "D1"] and ids(q.semantic_search([0.0, 1.0], threshold=0.0, k=1).frame()) == ["G1"]
    assert ids(q.semantic_search("cancer", "drug").frame()) == ["D1"] and ids(q.semantic_search("x", "drug").frame()) == []
    found = q.semantic_search("cancer").limit(1).execute()
    assert found.query_time_ms is None and found.count == 1 and found.query_time_ms > 0
    assert [r["entity_id"] for r in found.results] == ["C1"] and found.to_dataframe().columns == ["entity_id", "similarity"]
    assert '"entity_id":"C1"' in found.to_json().first().value
    assert "Scan" in q.entities("drug").to_sql() and "Plan" in found.query_sql


def test_quantiles_equal_numpy(spark):
    import random

    import numpy as np

    rng = random.Random(4)
    for values in ([rng.choice([0.5, 0.9, rng.random()]) for _ in range(999)], [3.0], [1.0, 2.0], [7.0] * 50, [rng.gauss(0, 1e6) for _ in range(400)] + [1e12]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        for bins in (10_000, 3):
            got = aggregates.quantiles(df, [0.0, 0.25, 0.5, 0.75, 1.0], bins)
            assert list(got.values()) == pytest.approx(np.percentile(values, [0, 25, 50, 75, 100]).tolist())
    empty = aggregates.describe(spark.createDataFrame([], "x double"), "x").first()
    assert empty.n == 0 and empty.p50 is None


def test_co_occurrence_in_blocks(spark):
    import random

    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"p{i % 40}", f"e{rng.randrange(30)}", i, rng.choice([0.8, 0.9, 1.0])) for i in range(300)]
    want = sorted((p, a, b, min(c, d)) for p, a, i, c in rows for q, b, j, d in rows if p == q and i < j and a != b and min(c, d) >= 0.9)
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "paper_id string, entity_id string, pos int, confidence double, x int, n int")
    for block in (1000, 7, 1):
        assert sorted(tuple(r) for r in joins.co_occurrence(df, block=block).collect()) == want


def test_claims_are_traced_to_edges(spark):
    claims = spark.createDataFrame([("P", 0, "a", "treats", "b"), ("P", 1, "a", "causes", "c"), ("Q", 0, "a", "treats", "b")], "paper_id string, pos bigint, subject_id string, predicate string, object_id string")
    evidence = spark.createDataFrame([("P", 0, 30, 0.01, 0.6)], "paper_id string, pos bigint, sample_size bigint, p_value double, confidence double")
    edges = spark.createDataFrame([("e1", ("a",), ("b",), ("P",), 0.9), ("e1", ("a",), ("b",), ("P",), 0.9), ("e2", ("a",), ("b",), ("P",), float("nan")), ("e3", ("x",), ("b",), ("Q",), 0.9)], "id string, subject struct<id:string>, object struct<id:string>, provenance struct<source_id:string>, confidence double")
    got = {(r.paper_id, r.pos): (r.sample_size, r.strength, r.n_edges, r.best_edge) for r in joins.audit(claims, evidence, edges).collect()}
    assert got == {("P", 0): (30, 0.6, 2, 0.9), ("P", 1): (None, None, 0, None), ("Q", 0): (None, None, 0, None)}


def test_lookups(graph, spark):
    e = graph["entities"]
    assert ids(lookup.by_id(e, "entity_id", "")) == [] and ids(lookup.by_id(e, "entity_id", None)) == [] and ids(lookup.by_id(e, "entity_id", "G1")) == ["G1"]
    assert ids(lookup.name_search(e, "%_")) == ["D2"] and ids(lookup.name_search(e, "BREAST", "gene")) == []
    assert [ids(lookup.page(e, ["entity_id"], *a)) for a in ((2, 1), (0, 0), (2, 9), (None, 3))] == [["D1", "D2"], [], [], ["G1", "S1"]]
    r = graph["relationships"]
    assert lookup.known_predicates(r, ["treats"]).count() == 2
    for bad in (r, r.where("predicate = 'causes'")):
        with pytest.raises(Exception, match="predicate"):
            lookup.known_predicates(bad, ["treats"], strict=True).collect()


def test_joins(graph):
    e, r, v = graph["entities"], graph["relationships"], graph["evidence"]
    assert [(x.drug, x.evidence_count) for x in joins.find_treatments(e, r, v, "breast", 5).collect()] == [("Olaparib", 2), ("100%_drug", 1)]
    assert joins.find_treatments(e, r, v, "no such", 5).count() == 0
    assert sorted((x.entity_id, x.predicate, x.other_id) for x in joins.related(e, r, "cancer", "gene").collect()) == [("C1", "increases_risk", "G1")]
    paths = sorted(tuple(x.path) for x in joins.reachable(r, "D1", 3).collect())
    assert paths == [("D1", "C1"), ("D1", "C1", "S1")]
    assert [(x.subject_id, x.n_for, x.n_against) for x in joins.contradictions(r, "treats", "contraindicated_for").collect()] == [("D2", 1, 1)]
    assert joins.resolved_only(r, e.where("entity_id <> 'S1'")).count() == 6


def test_summaries(graph, spark):
    stats = aggregates.graph_statistics(graph["evidence"].select("paper_id").distinct(), graph["entities"], graph["relationships"], graph["evidence"]).first()
    assert stats.total_entities == 5 and stats.entities_by["drug"] == 2 and stats.relationships_by["treats"] == 2 and stats.papers_with_relationships == 2
    d = aggregates.describe(spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (float("nan"),)], "x double"), "x").first()
    assert (d.n, d.mean, d.p50, d.max) == (3, 2.333333, 2.0, 4.0)
    h = {r.bin: r.n for r in aggregates.histogram(spark.createDataFrame([(float(x),) for x in range(11)], "x double"), "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert aggregates.histogram(spark.createDataFrame([], "x double"), "x").count() == 0
    w = {r.subject_id: r.weighted_confidence for r in aggregates.evidence_by_triple(graph["evidence"]).collect()}
    assert w["D1"] == pytest.approx((0.9 + 0.8 * 0.5) / 1.8, abs=1e-6)


def test_rules(spark, graph):
    pairs = [("drug", "disease"), ("drug", "drug"), ("gene", "drug"), ("gene", "gene"), ("protein", "pathway")]
    got = [r.v for r in spark.createDataFrame(pairs, "a string, b string").select(rules.valid_predicates(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got == [["treats", "prevents", "manages", "contraindicated_for"], ["interacts_with"], ["associated_with"], [], ["participates_in"]]
    bad = spark.createDataFrame([("A", "treats", "A", 0.5), (None, "x", " ", 1.5), ("A", "causes", "B", float("nan"))], "subject_id string, predicate string, object_id string, confidence double")
    assert [r.faults for r in rules.checked_relationships(bad).collect()] == [["self"], ["predicate", "confidence", "subject", "object"], ["confidence"]]
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, seq int, v string")
    new = spark.createDataFrame([("a", 2, None), ("c", 2, "z")], "k string, seq int, v string")
    assert sorted((r.k, r.v) for r in rules.upsert(old, new, ["k"], "seq").collect()) == [("a", None), ("b", "y"), ("c", "z")]


def test_similarity(spark):
    v = spark.createDataFrame([("D1", [1.0, 0.0, 0.0]), ("G1", [0.0, 1.0, 0.0]), ("R1", [0.7071, 0.7071, 0.0]), ("Z", [0.0, 0.0, 0.0]), ("N", None), ("S", [1.0])], "id string, embedding array<double>")
    got = [(r.id, round(r.similarity, 4)) for r in similarity.nearest(v, [0.7, 0.7, 0.0], 3, 0.5).collect()]
    assert got == [("R1", 1.0), ("D1", 0.7071), ("G1", 0.7071)]
    assert similarity.nearest_to(v, "nobody").count() == 0 and [r.id for r in similarity.nearest_to(v, "R1", 1).collect()] == ["D1"]


def test_stream_equals_batch(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=7 * i), i % 3, "ab"[i % 2], float(i), "{}") for i in range(200)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    src = tmp_path / "in"
    for k in range(4):
        spark.createDataFrame(rows[k * 50 : k * 50 + 50], schema).coalesce(1).write.mode("append").parquet(str(src))
    seen = {}
    stream = events.windowed(events.event_stream(spark, str(src), "*.parquet"), late="10 days")
    events.run_to_end(stream, str(tmp_path / "cp"), lambda df, n: seen.update({(r.start, r.event_type): (r.n, r.total) for r in df.collect()}))
    batch = events.windowed(spark.read.schema(schema).parquet(str(src)).withColumn("ts", F.col("ts").cast("timestamp")))
    assert seen == {(r.start, r.event_type): (r.n, r.total) for r in batch.collect()} and len(seen) > 20
