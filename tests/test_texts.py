"""Text expressions and extraction, against the published rules worked out by hand or in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from biblioscope.functions import text as T
from biblioscope.operators import extraction as X


def one(spark, expr, *texts):
    return [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(expr(F.col("t")).alias("x")).collect()]


def test_numbers_in_prose(spark):
    assert one(spark, T.sample_size, "(n = 302)", "302 patients", "many patients", "N=7 of 12 cases", None) == [302, 302, None, 7, None]
    assert one(spark, T.percentage, "59%", "12 of 30", "3/0", "4 / 8", "") == [0.59, 0.4, None, 0.5, None]
    assert one(spark, T.p_value, "p < 0.001", "P=1", "p-value = .04", "p") == [0.001, 1.0, 0.04, None]


def test_strength_counts_zero_as_missing(spark):
    df = spark.createDataFrame([(302, 0.001), (1000, 0.0005), (5, 0.2), (0, 0.0), (None, None)], "n bigint, p double")
    assert [round(r.s, 6) for r in df.select(T.evidence_strength(F.col("n"), F.col("p")).alias("s")).collect()] == [0.7, 0.9, 0.3, 0.5, 0.5]


def paragraphs(spark, *texts, section="abstract"):
    return spark.createDataFrame([(f"p{i}", "P", section, t, "en") for i, t in enumerate(texts)], "paragraph_id string, paper_id string, section string, text string, lang string")


def test_claims(spark):
    df = paragraphs(spark, "Aspirin treats headaches effectively.", "Metformin treats diabetes well. BRCA1 is associated with breast cancer.", "This is a simple sentence without any medical relationships.", "Drug treats flu.", "", None)
    got = [(r.paragraph_id if "paragraph_id" in r else r.subject_id, r.predicate, round(r.confidence, 6)) for r in X.claims(df).orderBy("subject_id").collect()]
    assert got == [("PLACEHOLDER_SUBJECT_p0_claim_0", "treats", 0.8), ("PLACEHOLDER_SUBJECT_p1_claim_0", "treats", 0.8), ("PLACEHOLDER_SUBJECT_p1_claim_1", "associated_with", 0.8)]
    assert [round(r.c, 6) for r in spark.createDataFrame([(s,) for s in ("results", "methods", "discussion")], "s string").select(X.claim_confidence(F.col("s")).alias("c")).collect()] == [0.8, 0.6, 0.7]


def test_a_repeated_sentence_as_published(spark):
    text = "Aspirin treats headaches effectively. Aspirin treats headaches effectively. Drug A treats disease B too. Aspirin treats headaches effectively."
    assert X.claims(paragraphs(spark, text)).count() == 4
    assert X.claims(paragraphs(spark, text), as_read=True).count() == 3


def test_evidence_and_the_splitter(spark):
    rows = {r.paragraph_id: r for r in X.evidence(paragraphs(spark, "Of 150 patients, p < 0.001.", "nothing here", "p < 0", "n = 0 and 0%", "rate 5%", section=None)).collect()}
    assert set(rows) == {"p0", "p4"} and rows["p0"].confidence == pytest.approx(0.7) and rows["p0"].section == "results" and rows["p4"].sample_size is None
    assert one(spark, T.sentences, "A p < 0.001! Ok? end") == [["A p < 0", "001", "Ok", "end"]]


def packed(paras, size):
    chunks, current, length = [], [], 0
    for p in paras:
        if length + len(p) > size and current:
            chunks.append("\n\n".join(current))
            current, length = [p], len(p)
        else:
            current.append(p)
            length += len(p) + 2
    return chunks + ["\n\n".join(current)] if current else chunks


def test_packing_equals_a_loop(spark):
    rng = random.Random(8)
    cases = [["x" * rng.randrange(0, 40) for _ in range(rng.randrange(0, 12))] for _ in range(200)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, p array<string>")
    got = {r.i: r.c for r in df.select("i", X.packed(F.col("p"), 50).alias("c")).collect()}
    assert all(got[i] == packed(c, 50) for i, c in enumerate(cases))
    assert one(spark, lambda t: X.slices(t, 4), "abcdefghij", "", "abcd") == [["abcd", "efgh", "ij"], [], ["abcd"]]


def test_mentions(spark):
    rows = [("P", i, n, c) for i, (n, c) in enumerate([(" Type 2 Diabetes ", 0.9), ("type 2 diabetes", 0.95), ("##ing", 0.99), ("the", 0.99), ("ab", 0.99), ("Flu", 0.5), (None, 0.9), ("Gout", None)])]
    df = spark.createDataFrame(rows, "paper_id string, pos int, name string, confidence double")
    clean = X.clean_mentions(df)
    assert [r.name for r in clean.orderBy("pos").collect()] == ["Type 2 Diabetes", "type 2 diabetes"]
    assert [r.pos for r in X.first_mentions(clean).collect()] == [0]
    entity = X.entities_from_mentions(clean.withColumn("seq", F.col("pos"))).collect()
    assert [(e.entity_id, e.name, e.synonyms, e.n) for e in entity] == [("DISEASE:type_2_diabetes", "Type 2 Diabetes", ["type 2 diabetes"], 2)]


def test_resolution_and_ontologies(spark):
    m = spark.createDataFrame([("P", 1, "a", "C1", 0.8), ("P", 2, "b", None, 0.8)], "paper_id string, pos int, name string, hint string, confidence double")
    got = {r.pos: (r.entity_id[:5], r.confidence) for r in X.resolve_mentions(m, spark.createDataFrame([("C1",)], "entity_id string")).collect()}
    assert got == {1: ("C1", 0.8), 2: ("prov:", 0.4)}
    ids = spark.createDataFrame([("C0006142", "disease"), ("HGNC:1100", "gene"), ("P38398", "protein"), ("X1", "disease")], "i string, t string")
    assert [r.m for r in ids.select(T.ontology_of(F.col("i"), F.col("t")).alias("m")).collect()] == [{"umls": "C0006142"}, {"hgnc": "HGNC:1100"}, {"uniprot": "P38398"}, {}]


def test_json_in_an_answer(spark):
    got = one(spark, lambda c: F.to_json(T.json_part(c)), 'Sure: [{"a": 1}] done', 'See {"b": [1, 2]}.', "nothing", "[broken", None)
    assert got == ['[{"a":1}]', '{"b":[1,2]}', None, None, None]


def test_dictionary_and_pairs(spark):
    p = paragraphs(spark, "Renal Sarcoma type 2 is treated by drug-x daily in all. No names in this longer sentence.")
    index = spark.createDataFrame([("renal sarcoma type 2", "C1"), ("Drug-X", "D1"), ("sarcoma", "C9"), ("", "E"), (None, "N")], "key string, entity_id string")
    found = {(r.pos, r.n_words, r.entity_id) for r in X.dictionary_mentions(p, index).collect()}
    assert found == {(0, 4, "C1"), (1, 1, "C9"), (7, 1, "D1")}
    names = spark.createDataFrame([("p0", "C1", "renal sarcoma type 2", 0), ("p0", "D1", "drug-x", 7)], "paragraph_id string, entity_id string, name string, pos int")
    got = [(r.predicate, r.subject_id, r.object_id) for r in X.paired_claims(X.all_claims(p), names.drop("name"), names.select("entity_id", "name")).collect()]
    assert got == [("treats", "C1", "D1")]


def test_hash_vector_is_a_digest(spark):
    import hashlib

    raw = [b / 255 for b in hashlib.sha256(b"brca1").digest()[:8]]
    norm = sum(x * x for x in raw) ** 0.5
    assert one(spark, lambda c: T.hash_vector(c, 8), "BRCA1")[0] == pytest.approx([x / norm for x in raw])


def test_packed_chunks_equal_a_loop(spark):
    rows = [(f"P{i % 3}", f"q{i:03}", "x" * ((i * 37) % 90)) for i in range(200)] + [("P0", "q999", None), (None, "q1000", "y"), ("long", "q0", "z" * 500)]
    want = {}
    for paper in {r[0] for r in rows if r[0]}:
        chunks, length = [], 0
        for _, _, t in sorted(r for r in rows if r[0] == paper and r[2] is not None):
            if chunks and length + len(t) > 150:
                chunks.append([t])
                length = len(t)
            else:
                chunks = chunks or [[]]
                chunks[-1].append(t)
                length += len(t) + 2
        want.update({(paper, i): "\n\n".join(c) for i, c in enumerate(chunks)})
    df = spark.createDataFrame([(*r, 5) for r in rows], "paper_id string, paragraph_id string, text string, no int")
    assert {(r.paper_id, r.no): r.text for r in X.packed_chunks(df, 150).collect()} == want
    assert X.packed_chunks(df.limit(0)).count() == 0


def test_evidence_is_appended_to_triples(spark):
    kind = "array<struct<sample_size:bigint,p_value:double,confidence:double,text_span:string>>"
    df = spark.createDataFrame([("a", ["n = 40, p = 0.003", "n = 9"], [(1, 0.5, 0.1, "old")]), ("b", ["nothing"], []), ("c", [], [])], f"subject_id string, evidence array<string>, items {kind}")
    got = {r.subject_id: [tuple(i) for i in r["items"]] for r in X.with_found_evidence(df).collect()}
    assert got["b"] == got["c"] == [] and got["a"][0] == (1, 0.5, 0.1, "old") and got["a"][1][:2] == (40, 0.003) and len(got["a"]) == 2


def test_dictionary_of_any_size_gives_the_same(spark, monkeypatch):
    text = spark.createDataFrame([("p", "Renal cell sarcoma and renal failure; sarcoma.")], "paragraph_id string, text string")
    index = spark.createDataFrame([("renal cell sarcoma", "A"), ("sarcoma", "B"), ("renal failure", "C"), ("absent", "D")], "key string, entity_id string")
    want = {(0, 3, "A"), (2, 1, "B"), (4, 2, "C"), (6, 1, "B")}
    for most in (200_000, 3, 0):
        monkeypatch.setattr(X, "MOST_BROADCAST", most)
        assert {(r.pos, r.n_words, r.entity_id) for r in X.dictionary_mentions(text, index).collect()} == want
