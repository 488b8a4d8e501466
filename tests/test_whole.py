"""Queries over whole tables, against loops in plain Python: nothing of the input may be left out."""

import os
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from biblioscope.operators.extraction import CLAIM_PATTERNS, dictionary_mentions, places

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def rows(table, *columns):
    return list(zip(*(pq.read_table(f"{DATA}/{table}.parquet", columns=[c])[c].to_pylist() for c in columns), strict=True))


def test_two_hops_start_at_every_gene(spark):
    customer = dict(rows("orders", "o_orderkey", "o_custkey"))
    binds, treats = set(), defaultdict(set)
    for order, part, supplier, flag in rows("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"):
        binds.add((supplier, part))
        if flag == "R" and order in customer:
            treats[part].add(customer[order])
    want = Counter((f"GENE:{s}", f"DRUG:{p}", f"DISEASE:{c}") for s, p in binds for c in treats[p])
    got = Counter(tuple(r) for r in entry.queries()["j8_two_hops"](spark, DATA).select("start", "middle", "end").collect())
    assert got == want and len({s for s, _, _ in got}) > 2


VALUE = r"\s*[<>=]\s*(0?\.\d+|[01](?:\.\d+)?)"


def texts():
    return [r for r in rows("documents", "paragraph_id", "lang", "text") if r[2] is not None]


def first(text, *tries):
    for pattern, number in tries:
        m = re.search(pattern, text)
        if m and (x := number(m)) is not None:
            return x


def size(t):
    return first(t, (r"(?i)\bn\s*=\s*(\d+)", lambda m: int(m[1])), (r"(?i)\b(\d+)\s+(?:samples|patients|subjects|nodes|lymph nodes|individuals|cases)", lambda m: int(m[1])))


def rate(t):
    return first(t, (r"(\d+(?:\.\d+)?)\s*%", lambda m: float(m[1]) / 100), (r"(\d+)\s*(?:/|of)\s*(\d+)", lambda m: int(m[1]) / int(m[2]) if int(m[2]) else None))


def p_value(t):
    return first(t, (r"(?i)\bp" + VALUE, lambda m: float(m[1])), (r"(?i)p\s*-\s*value" + VALUE, lambda m: float(m[1])))


def stated():
    """(paragraph_id, no, sentence, predicates) of the sentences that state any."""
    out = []
    for key, _, text in texts():
        for no, sentence in enumerate(x.strip() for x in re.split(r"[.!?]+", text)):
            found = [p for p, patterns in CLAIM_PATTERNS.items() if any(re.search("(?i)" + x, sentence) for x in patterns)]
            if len(sentence) >= 20 and found:
                out.append((key, no, sentence, found))
    return out


@pytest.mark.parametrize("name, column, read", [("c5_sample_sizes", "n", size), ("c6_rates", "rate", rate), ("c7_p_values", "p", p_value)])
def test_numbers_are_read_in_every_language(spark, name, column, read):
    want = sorted((key, x) for key, _, text in texts() if (x := read(text)) is not None)
    got = sorted((r["paragraph_id"], r[column]) for r in entry.queries()[name](spark, DATA).collect())
    assert [k for k, _ in got] == [k for k, _ in want] and [x for _, x in got] == pytest.approx([x for _, x in want], abs=1e-6)
    assert {k for k, _ in got} & {key for key, lang, _ in texts() if lang != "en"}


def test_evidence_of_every_language(spark):
    want = sorted((key, size(t), p_value(t)) for key, _, t in texts() if size(t) or rate(t) or p_value(t))
    got = sorted((r.paragraph_id, r.sample_size, r.p_value) for r in entry.queries()["c9_evidence"](spark, DATA).collect())
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want]


def test_claims_of_every_language(spark):
    queries, want = entry.queries(), stated()
    assert Counter(tuple(r) for r in queries["c4_all_claims"](spark, DATA).select("paragraph_id", "no", "predicate").collect()) == Counter((k, no, p) for k, no, _, ps in want for p in ps)
    assert Counter((r.text_span, r.predicate) for r in queries["c1_claims"](spark, DATA).collect()) == Counter((s, ps[0]) for _, _, s, ps in want)
    last, as_read = {}, Counter()
    for key, _, sentence, found in want:
        if found[0] == "causes" or last.get(key) != sentence:
            as_read[found[0]] += 1
            last[key] = sentence
    assert {r.predicate: r.n for r in queries["c1_claims_as_read"](spark, DATA).collect()} == as_read


def words(text):
    return re.findall(r"(?:[^\W_]|-)+", text.lower())


def dictionary():
    """The keys of each reference entity in lower case: name, synonyms and abbreviations."""
    keys = defaultdict(set)
    for entity, name, synonyms, short in rows("reference_entities", "entity_id", "name", "synonyms", "abbreviations"):
        keys[entity] |= {k.lower() for k in (name, *(synonyms or ()), *(short or ())) if k and words(k)}
    return keys


def mentioned():
    """(paragraph_id, pos, n_words, entity_id) of every run of words that is a key."""
    runs = defaultdict(set)
    for entity, keys in dictionary().items():
        for k in keys:
            runs[tuple(words(k))].add(entity)
    out, most = Counter(), max(map(len, runs))
    for key, _, text in texts():
        w = words(text)
        for i in range(len(w)):
            for n in range(1, min(most, len(w) - i) + 1):
                for entity in runs.get(tuple(w[i : i + n]), ()):
                    out[key, i, n, entity] += 1
    return out


def test_mentions_by_synonym(spark):
    got = Counter(tuple(r) for r in entry.queries()["e1_dictionary_mentions"](spark, DATA).select("paragraph_id", "pos", "n_words", "entity_id").collect())
    assert got == mentioned()


def test_pairs_by_synonym(spark):
    keys, named = dictionary(), defaultdict(set)
    for key, _, _, entity in mentioned():
        named[key].add(entity)
    want = Counter()
    for key, no, sentence, found in stated():
        ids = sorted(e for e in named[key] if any(k in sentence.lower() for k in keys[e]))
        if len(ids) > 1:
            want.update((key, no, p, *ids[:2]) for p in found)
    got = Counter(tuple(r) for r in entry.queries()["j14_paired_claims"](spark, DATA).select("paragraph_id", "no", "predicate", "subject_id", "object_id").collect())
    assert got == want and want


def test_long_keys_are_found(spark):
    text = spark.createDataFrame([("p0", "It is acute left lower lobe type two renal sarcoma, they say.")], "paragraph_id string, text string")
    index = spark.createDataFrame([("acute left lower lobe type two renal sarcoma", "C1"), ("sarcoma", "C2"), ("acute left", "C3")], "key string, entity_id string")
    assert {(r.pos, r.n_words, r.entity_id) for r in dictionary_mentions(text, index).collect()} == {(2, 8, "C1"), (9, 1, "C2"), (2, 2, "C3")}


def test_contexts_of_every_mention(spark):
    want = Counter((key, t[max(m.start() - 50, 0) : m.end() + 50]) for key, _, t in texts() for m in re.finditer("disease", t))
    got = Counter(tuple(r) for r in entry.queries()["c13_contexts"](spark, DATA).select("paragraph_id", "context").collect())
    assert got == want and max(Counter(k for k, _ in got.elements()).values()) > 1


def test_places_of_a_word(spark):
    found = spark.createDataFrame([(0, "a.ba.b"), (1, "xa.b é𝒳a.b."), (2, "aab"), (3, ""), (4, None)], "i int, t string").orderBy("i").select(places(F.col("t"), "a.b").alias("x")).collect()
    assert [r.x for r in found] == [[0, 3], [1, 7], [], [], None]
