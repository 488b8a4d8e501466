"""Nested records: every form of the listed terms, the related tables, and the edge cases."""

import json

import pytest

from biblioscope.operators import nested

TERMS = ["Neoplasms, Acute", " Two  words ", None, "", "Same", "Same"]
PLAIN = [(0, "Neoplasms, Acute"), (1, "Two words"), (2, "Same"), (3, "Same")]


def record(terms, pipeline):
    return {"paper_id": "P", "metadata": {"study_type": None, "mesh_terms": terms}, "extraction_provenance": {"extraction_pipeline": pipeline}}


def found(spark, payloads):
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "rec_id bigint, payload string, path string")
    out = {}
    for r in nested.mesh_terms(df).collect():
        out.setdefault(r.rec_id, []).append((r.term_no, r.mesh_term, r.pipeline_name))
    return {k: sorted(v) for k, v in out.items()}


def test_every_form_gives_the_same_terms(spark):
    forms = [
        TERMS,
        [{"term": t, "qualifiers": ["q"]} for t in TERMS],
        [{"name": t, "major": True} for t in TERMS],
        [{"descriptor": t} for t in TERMS],
        {"items": [{"descriptor": {"name": t, "ui": "D1"}} for t in TERMS]},
        {str(i): t for i, t in enumerate(TERMS)},
        [TERMS[:2], [], TERMS[2:]],
        json.dumps(TERMS),
        "Neoplasms, Acute; Two  words;; Same ;Same",
        "Neoplasms, Acute | Two words | Same|Same",
    ]
    got = found(spark, [json.dumps(record(f, {"name": " pipe "})) for f in forms])
    assert got == {i: [(n, t, "pipe") for n, t in PLAIN] for i in range(len(forms))}


def test_wrappings_and_pipelines(spark):
    base = record(["A", "B"], {"name": "p"})
    text = json.dumps(base)
    moved = dict(base, metadata=json.dumps(base["metadata"]), extraction_provenance=json.dumps(base["extraction_provenance"]))
    payloads = [text, "﻿" + text, json.dumps(text), f"[{text}]", json.dumps({"type": "paper", "data": base}), json.dumps({"record": base, "schema": "2"}), json.dumps(moved)]
    payloads += [json.dumps(record(["A", "B"], p)) for p in ("p", [{"name": "p"}])]
    got = found(spark, payloads)
    assert all(got[i] == [(0, "A", "p"), (1, "B", "p")] for i in range(len(payloads)))
    for nameless in (None, {"name": " "}, {}, []):
        assert found(spark, [json.dumps(record(["A"], nameless))]) == {0: [(0, "A", "")]}


def test_unreadable_null_and_empty(spark):
    assert found(spark, [None, "", "not found", "null", '{"metadata":{"mesh_terms":["A"', "3", '"x"', json.dumps(record(None, None)), json.dumps({"metadata": None})]) == {}
    assert found(spark, []) == {}


def test_many_terms_keep_their_order(spark):
    terms = [f"t{i}" for i in range(5000)]
    got = found(spark, [json.dumps(record({str(i): t for i, t in enumerate(terms)}, {"name": "p"}))])
    assert [t for _, t, _ in got[0]] == terms


def test_related_tables_keep_the_link(spark):
    payload = json.dumps({"id": "P", "rels": [{"s": "a", "tags": ["x", "y"]}, {"s": None}, {"o": 2.5, "tags": []}]})
    triples = nested.path_triples(spark.createDataFrame([(7, payload)], "k bigint, j string"), "k", "j")
    groups = {(r.ancestor, r.path): (r.n_values, r.n_null) for r in nested.path_groups(triples).collect()}
    assert groups == {("", "id"): (1, 0), ("rels[]", "rels[].s"): (2, 1), ("rels[]", "rels[].o"): (1, 0), ("rels[].tags[]", "rels[].tags[]"): (2, 0)}
    rels = {tuple(r.ordinals): (r.s, r.o) for r in nested.related_table(triples, "rels[]", {"s": "s", "o": "o"}).collect()}
    assert rels == {(0,): ("a", None), (1,): (None, None), (2,): (None, "2.5")}
    tags = {tuple(r.ordinals): r.tag for r in nested.related_table(triples, "rels[].tags[]", {"tag": ""}).collect()}
    assert tags == {(0, 0): "x", (0, 1): "y"}
    top = nested.related_table(triples, "", {"id": "id"}).collect()
    assert [(r.key, list(r.ordinals), r.id) for r in top] == [(7, [], "P")]


def test_deep_records_are_read(spark):
    """Depths at which a recursive reader fails, around, beside and above what is wanted."""
    deep = "[" * 50_000 + "]" * 50_000
    objects = '{"a":' * 30_000 + "1" + "}" * 30_000
    base = json.dumps(record(["A"], {"name": "p"}))
    inner = base
    for _ in range(40):
        inner = '{"record":' + inner + "}"
    payloads = [base[:-1] + f',"x":{deep}' + "}", base[:-1] + f',"x":{objects}' + "}", inner, "[" * 20_000 + base + "]" * 20_000, base[:-1] + f',"x":{deep[:-1]}' + "}"]
    got = found(spark, payloads)
    assert got == {i: [(0, "A", "p")] for i in range(4)}
    df = spark.createDataFrame([(i, p) for i, p in enumerate([*payloads, None, "", "3", '"x"', "[1, 2]"])], "k bigint, j string")
    assert sorted(r.key for r in nested.unreadable(df, "k", "j").collect()) == [4, 5, 6, 7, 8]
    levels = nested.path_triples(spark.createDataFrame([(1, "[" * 2000 + "]" * 2000)], "k bigint, j string"), "k", "j")
    assert levels.count() == 1  # lists of one are opened down to the last
    levels = nested.path_triples(spark.createDataFrame([(1, '{"a":' + "[" * 2000 + "]" * 2000 + "}")], "k bigint, j string"), "k", "j")
    assert levels.count() == 2000  # the record, and 1,999 elements that are arrays


def test_empty_elements_keep_their_rows(spark):
    payload = json.dumps({"rels": [{}, {"tags": []}, {"tags": [{"t": 1}, {}]}, [], None], "empty": [], "none": {}, "note": "[12]", "more": '{"s": 1}'})
    triples = nested.path_triples(spark.createDataFrame([(7, payload)], "k bigint, j string"), "k", "j", text_at=("more",))
    rels = {tuple(r.ordinals): r.s for r in nested.related_table(triples, "rels[]", {"s": "s"}).collect()}
    assert rels == {(i,): None for i in range(5)}
    tags = {tuple(r.ordinals): r.t for r in nested.related_table(triples, "rels[].tags[]", {"t": "t"}).collect()}
    assert tags == {(2, 0): "1", (2, 1): None}
    assert {t[:1] for t in tags} <= set(rels)
    rows = {(r.path, r.kind, r.value) for r in triples.collect()}
    assert {("empty", "array", None), ("none", "object", None), ("note", "string", "[12]"), ("more.s", "number", "1")} <= rows
    every = nested.element_rows(triples, {"t": nested.F.col("path").endswith(".t")})
    assert {(r.ancestor, tuple(r.ordinals)) for r in every.collect()} == {("", ())} | {("rels[]", (i,)) for i in range(5)} | {("rels[].tags[]", (2, i)) for i in range(2)}


def test_repeated_keys_and_records(spark):
    payload = '{"metadata": {"mesh_terms": ["A"], "mesh_terms": ["B", "C"]}}'
    df = spark.createDataFrame([(1, payload), (1, payload), (2, "  " + payload + " \n")], "rec_id bigint, payload string")
    assert sorted((r.rec_id, r.term_no, r.mesh_term) for r in nested.mesh_terms(df).collect()) == [(1, 0, "B"), (1, 1, "C"), (2, 0, "B"), (2, 1, "C")]
    for bad in ("{'a': 1}", '{"a" 1}', '{"a": 1,}', "[1 2]", '{"a": 01}', '{"a": "\n"}', "{}x", "[", '{"a"', ""):
        with pytest.raises(ValueError):
            nested.events(bad)
