"""Mixtures against their targets, names against their entries."""

import math
import os

import pytest

from biblioscope.llm import canonical, mixture

RANKS = mixture.RANKS


def test_poisson_below_a_cap_has_the_wanted_mean():
    for wanted, cap in [(0.1, 1), (0.9, 1), (1.7, 2), (3.5, 8), (0.0, 4), (4.0, 4), (900.5, 5000), (1e6, 10**9)]:
        sure, steps = mixture.poisson_steps(wanted, cap)
        assert sure + len(steps) <= cap and steps == sorted(steps) and len(steps) < 200_000
        assert math.isclose(sure + sum(1 - s for s in steps), wanted, rel_tol=1e-9, abs_tol=1e-9)  # E[X] = sum P(X > n)


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_shares_caps_and_order(spark):
    rows = [(i, f"word{i} " * (20 + i % 7), ["Big-Source", " big_source ", "big source"][i % 3], 0) for i in range(3000)]
    rows += [(10_000 + i, f"small {i} " * 10, "small", 0) for i in range(300)]
    rows += [(20_000, "text", None, 0), (20_001, "text", " ", 0), (20_002, "text", "unasked", 0), (20_003, None, "small", 0), (20_004, "", "small", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, tokens int")
    targets = spark.createDataFrame([("big_source", 0.5, 1), ("small", 0.3, 4), ("absent", 0.2, 3), (None, 0.5, 1), ("bad", -1.0, 1), ("none", 0.4, 0)], "source string, target_share double, max_repeats int")
    shares = {r.source: r for r in mixture.shares_reached(docs, targets).collect()}
    assert abs(shares["big_source"].share_reached - 0.625) < 0.05 and abs(shares["small"].share_reached - 0.375) < 0.05
    assert shares["big_source"].share_of_present == pytest.approx(0.625) and shares["absent"].tokens == 0
    assert shares["unasked"].uses == 0 and shares[""].records == 2 and shares["small"].most_uses <= 4 and shares["big_source"].most_uses == 1
    mixed = mixture.mixture(docs, targets).collect()
    assert [r.place for r in mixed] == sorted(r.place for r in mixed)
    assert sum(r.tokens for r in mixed) == sum(r.tokens_used for r in shares.values())
    assert len({(r.key, r.copy_no) for r in mixed}) == len(mixed) and {r.name for r in mixed} == {"big_source", "small"}
    again = mixture.mixture(docs.repartition(7), targets).collect()
    assert sorted(again) == sorted(mixed)
    assert mixture.mixture(docs.limit(0), targets).count() == 0 and mixture.mixture(docs, targets.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_every_source_of_very_many_is_planned(spark):
    """More targets than a broadcast takes, most of them without documents."""
    docs = spark.range(12_000).selectExpr("id AS doc_id", "'one two three' AS text", "concat('s', id) AS source")
    targets = spark.range(30_000).selectExpr("concat('s', id) AS source", "1e-4D AS target_share", "2 AS max_repeats")
    weighed = mixture.cut(mixture.weigh(docs))
    planned = mixture.plan(weighed, targets)
    assert planned.count() == 12_000 and planned.where("sure = 2").count() == 12_000
    assert mixture.replicate(weighed, planned).groupBy().sum("copies").first()[0] == 24_000


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_uses_equal_a_loop(spark):
    """Uses of every record from its hashed number and the Poisson distribution, in plain Python."""
    docs = spark.createDataFrame([(i, "tok " * (1 + i % 5), "ab"[i % 2]) for i in range(400)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.25, 3), ("b", 0.75, 5)], "source string, target_share double, max_repeats int")
    units = {r.doc_id: r.u for r in docs.select("doc_id", mixture.unit(mixture.F.col("doc_id"), 42).alias("u")).collect()}
    tokens = {i: mixture.count_tokens("tok " * (1 + i % 5)) for i in range(400)}
    held = {s: sum(t for i, t in tokens.items() if "ab"[i % 2] == s) for s in "ab"}
    size = min(3 * held["a"] / 0.25, 5 * held["b"] / 0.75)
    want = {}
    for s, share, cap in (("a", 0.25, 3), ("b", 0.75, 5)):
        mean, rate = min(cap, size * share / held[s]), 0.0
        if mean < cap:
            below = lambda r: sum(min(n, cap) * math.exp(-r) * r**n / math.factorial(n) for n in range(60))
            lo, hi = 0.0, 50.0
            for _ in range(80):
                rate = (lo + hi) / 2
                lo, hi = (rate, hi) if below(rate) < mean else (lo, rate)
        for i in (i for i in range(400) if "ab"[i % 2] == s):
            n, total = 0, math.exp(-rate)
            while n < cap and (mean == cap or units[i] >= total):
                n += 1
                total += math.exp(-rate) * rate**n / math.factorial(n)
            want[i] = n
    weighed = mixture.weigh(docs)
    got = {r.key: r.copies for r in mixture.replicate(weighed, mixture.plan(weighed, targets)).collect()}
    assert got == {i: n for i, n in want.items() if n}


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_long_texts_are_counted_whole():
    encode = mixture._encoding(RANKS).encode_ordinary
    for text in (" " * 200_000 + "abc", "ab" + " " * 200_000, "x " + "\n" * 60_000 + " y  z", "a" * 300_000, "q" + " \n" * 40_000 + "end it", "word " * 50_000):
        assert mixture.count_tokens(text) == len(encode(text))
    assert mixture.count_tokens("a" + " " * 3_000_000 + "b") > 1  # too long for the split pattern


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_token_counts_of_odd_texts(spark):
    texts = [None, "", "a", "<|endoftext|>", "x" * 100_000, " " * 50_000, "漢字" * 2000, "one two three"]
    got = [r.n for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", mixture.token_count(mixture.F.col("t")).alias("n")).orderBy("i").collect()]
    assert got[0] == got[1] == 0 and got[2] == 1 and got[7] == 3 and min(got[3:]) > 0


REFERENCE = [
    ("C1", "Renal broxitoid sarcoma type 1", ["Juflograg disease type 1"], ["MDHJ-1"]),
    ("C2", "Renal broxitoid sarcoma type 2", ["Juflograg disease type 2"], ["MDHJ-2"]),
    ("G1", "KLGK2", ["nimgrit binding factor 2"], ["KLGK2"]),
    ("G2", "KLGK3", ["nimgrit binding factor 3"], ["KLGK3"]),
    ("D1", "Vrucizhavprazole", ["Jugligat XR", "KVN-2693"], []),
    ("P1", "Yeskkrav antigen alpha", [], ["LNPLQ"]),
    ("P2", "Yeskkrav antigen beta", None, None),
    ("E1", "Plodisal edema", [], []),
]
SAME = {
    "C1": ["renal BROXITOID sarcoma type 1", "Sarcoma, Renal broxitoid type I", "Renal  broxitoid\tsarcoma type 1, NOS", "Renal brxoitoid sarcoma type 1", "MDHJ1", "mdhj-1 patients", "Renal broxitoid sarcoma type 1 (MDHJ-1)", "Ｊｕｆｌｏｇｒａｇ disease type 1", "Renalbroxitoidsarcomatype1", "Ren­al-broxitoid-sarcorna type 1", "RenalBroxitoid Sarcoma Type 1", "Rena1 broxitoid sarcoma type 1"],
    "G1": ["klgk2", "KLGK2 expression", "the KLGK-2 gene", "nimgrit bindng factor 2", '"KLGK2 (human)"', "hnimgrit binding factor 2"],
    "D1": ["Vrucizhavprazole 20 mg", "vrucizhavprazole hydrochlor", "Vrucizhavpraz.", "Jugligat XR tablets", "KVN 2693"],
    "P1": ["Yeskkrav antigen α", "alpha, Yeskkrav antigen", "yeskkravantigenalpha", "LNPLQ level"],
    "E1": ["Plodisal oedema", "plodisal edemas"],
}
OTHER = ["Renal broxitoid sarcoma type 3", "Renal broxitoid sarcoma", "Cardiac broxitoid sarcoma type 1", "Renal broxitoid edema type 1", "KLGK4", "KLGQ2", "nimgrit binding factor", "Yeskkrav antigen gamma", "Yeskkrav antigen", "Jugligat", "95% CI", "patients", "disease", "type 1", "123", "-", "LNPLR", "Renal broxitoid sarcoma type 1 (MDHJ-2)", "Mammary plodisal edema"]


def test_names(spark):
    reference = spark.createDataFrame([(i, "t", n, s, a, "src") for i, n, s, a in REFERENCE], "entity_id string, type string, name string, synonyms array<string>, abbreviations array<string>, source string")
    want = {f"{r}/{n}": (n, r) for r, names in SAME.items() for n in names} | {f"x/{n}": (n, canonical.UNMATCHED) for n in OTHER}
    rows = [(k, n, "clash") for k, (n, _) in want.items()]
    rows += rows[:3] + [("blank", "  ", ""), ("null", None, ""), (None, "KLGK2", ""), ("long", "word " * 3000, "")]
    df = spark.createDataFrame(rows, "entity_id string, name string, ref_id string")
    found = canonical.resolve(df, reference).collect()
    got = {r.entity_id: r.ref_id for r in found}
    assert len(found) == len(got) == len(want) + 1 and got.pop("long") == canonical.UNMATCHED
    assert {k: v for k, v in got.items() if v != want[k][1]} == {}
    assert canonical.resolve(df.limit(0), reference).count() == 0
    assert {r.ref_id for r in canonical.resolve(df, reference.limit(0)).collect()} == {canonical.UNMATCHED}


def test_scores_are_cosines_of_both_sides(spark):
    reference = spark.createDataFrame([(i, "t", n, s, a, "src") for i, n, s, a in REFERENCE], "entity_id string, type string, name string, synonyms array<string>, abbreviations array<string>, source string")
    names = ["Plodisal edema", "plodisal EDEMA", "Plodisal edema, NOS", "Plodisal oedema", "Plodisal oedema patients"]
    got = {r.name: r.score for r in canonical.canonical(spark.createDataFrame([(n,) for n in names], "name string"), reference).collect()}
    assert set(got) == set(names)
    assert got["Plodisal edema"] == got["plodisal EDEMA"] and 0.9 < got["Plodisal edema"] <= 1.0
    assert got["Plodisal edema, NOS"] < got["Plodisal edema"] and got["Plodisal oedema patients"] < got["Plodisal oedema"] < 1.0


def test_one_word_in_most_names(spark):
    """Names that share their rarest word with many forms are spread over tasks; none is lost."""
    reference = spark.createDataFrame([(f"R{i}", f"sarcoidosis type {i}") for i in range(60)], "entity_id string, name string").selectExpr("entity_id", "'t' AS type", "name", "cast(null AS array<string>) AS synonyms", "cast(null AS array<string>) AS abbreviations", "'s' AS source")
    names = spark.createDataFrame([(f"e{i}", f"sarcoidosi{'s' * (i % 2)} type {i % 80}") for i in range(400)], "entity_id string, name string")
    got = {r.entity_id: r.ref_id for r in canonical.resolve(names, reference).collect()}
    assert got == {f"e{i}": f"R{i % 80}" if i % 80 < 60 else canonical.UNMATCHED for i in range(400)}
