"""Shared spans and leaked passages, against brute force."""

import random
import string
from collections import defaultdict

import numpy as np

from biblioscope.llm import leaks, spans


def some_text(rng, n):
    return "".join(rng.choice(string.ascii_lowercase + "    é漢") for _ in range(n))


def shared_brute(docs, least):
    own = defaultdict(set)
    cover = {}
    for i, t in docs:
        if t is not None:
            for p in range(len(t) - least + 1):
                own[t[p : p + least]].add(i)
    pairs = {(a, b) for s in own.values() for a in s for b in s if a < b}
    for i, t in docs:
        if t is not None:
            mask = np.zeros(len(t), bool)
            for p in range(len(t) - least + 1):
                if len(own[t[p : p + least]]) > 1:
                    mask[p : p + least] = True
            cover[i] = int(mask.sum())
    return pairs, cover


def corpus():
    rng = random.Random(11)
    block, other = some_text(rng, 430), some_text(rng, 900)
    docs = [(i, some_text(rng, rng.randrange(0, 1500))) for i in range(20)]
    docs += [(30, block), (31, "ab" + block + "cd"), (32, some_text(rng, 300) + block[:400]), (33, block[:399] + "#"), (34, block[31:] + some_text(rng, 50))]
    docs += [(40, other), (41, other), (42, other[:450] + some_text(rng, 100) + other[450:]), (43, some_text(rng, 200) + other[100:700])]
    docs += [(50, None), (51, ""), (52, "x"), (53, "a" * 3000), (54, "b" + "a" * 450), (55, "ab" * 700), (56, "c" + "ab" * 250), (57, "a" * 399)]
    docs += [(60, block + "!" + block), (61, some_text(rng, 20_000) + other + some_text(rng, 20_000))]
    return docs


def test_shared_spans_equal_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, i int, hash string")
    pairs, cover = shared_brute(docs, 400)
    got = [(r.doc_a, r.doc_b) for r in spans.sharing_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs and len(pairs) > 10
    part = {r.doc: r for r in spans.shared_part(df).collect()}
    assert {k: r.shared_chars for k, r in part.items()} == cover
    assert part[40].n_copies == part[41].n_copies == 2 and part[40].class_id == part[41].class_id == 40 and part[40].share == 1.0


def test_blocks_and_parts_of_long_texts_change_nothing(spark, monkeypatch):
    text = corpus()[-1][1]
    whole = spans._seeds_of_text(text, 280, 121)
    monkeypatch.setattr(spans, "BLOCK", 700)
    values, *_ = spans._seeds_of_text(text, 280, 121)
    assert set(whole[0].tolist()) <= set(values.tolist()) and len(values) < 1.2 * len(whole[0])
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(3000)) + " " + ITEM + " end")], "doc_id bigint, text string")
    monkeypatch.setattr(leaks, "SHARD_WORDS", 500)
    got = {(r.word_from, r.word_to) for r in leaks.leaked_passages(df, spark.createDataFrame([(5, ITEM)], "item_id bigint, text string")).collect()}
    assert got == {(3000, 3000 + len(ITEM.split()))}


def test_hot_seeds_and_classes_are_paired_in_blocks(spark, monkeypatch):
    """A run that most texts hold, and a class of many copies, with blocks of four and with one block."""
    rng = random.Random(6)
    block = some_text(rng, 420)
    docs = [(i, some_text(rng, 40 + i) + block + some_text(rng, 30)) for i in range(25)] + [(100 + i, block + "copy") for i in range(19)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for size in (4, 256):
        monkeypatch.setattr(spans, "PAIR_BLOCK", size)
        got = [(r.doc_a, r.doc_b) for r in spans.sharing_pairs(df).collect()]
        assert len(got) == len(set(got)) == 44 * 43 // 2 and set(got) == shared_brute(docs, 400)[0]


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert spans.sharing_pairs(df).count() == 0 and spans.shared_part(df).count() == 0


def test_winnowing_meets_its_guarantee():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**63, 5000).astype(np.uint64)
    chosen = set(spans.winnow(h, 50).tolist())
    assert all(any(p in chosen for p in range(s, s + 50)) for s in range(len(h) - 49))
    assert len(chosen) < 5000 * 3 / 51


def test_chains_follow_one_diagonal():
    a = np.array([0, 100, 200, 900, 50])
    b = np.array([1000, 1100, 1200, 10, 5000])
    found = spans.chains(a, b, 60)
    assert (0, 260, 1000, 1260) in found and (900, 960, 10, 70) in found


ITEM = "which of the following best explains why the older patients in a small village cohort never showed any fever after the second dose of verimab although their siblings did within nine days"


def test_leaks(spark):
    words = ITEM.split()
    rng = random.Random(2)
    filler = lambda n: " ".join("w" + "".join(rng.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(n))
    edited = list(words)
    edited[8], edited[20] = "younger", "third"
    odd = ITEM.upper().replace("COHORT", "co­hort").replace("VILLAGE", "<b>Vil</b>lage").replace("OLDER", "ol der").replace(" ANY FEVER", "&nbsp;any-fever")
    docs = [
        (1, filler(300) + " " + ITEM + " " + filler(300), True),
        (2, filler(30) + " " + " ".join(edited) + "!", True),
        (3, odd, True),
        (4, filler(10) + " ".join(words[: int(len(words) * 0.7)]) + " " + filler(40), True),
        (5, " ".join(words[:12]) + " " + filler(80), False),
        (6, " ".join(words[:10]) + " " + filler(200) + " " + " ".join(words[10:20]) + " " + filler(200) + " " + " ".join(words[20:]), False),
        (7, " ".join(reversed(words)), False),
        (8, filler(50), False),
        (9, " ".join(words[:15]) + " as we said before " + " ".join(words[15:]), True),
        (10, filler(5000) + " " + ITEM, True),
        (11, ITEM.replace("village cohort", "villagecohort"), True),
    ]
    rows = [(i, t, "clash") for i, t, _ in docs] + [(20, None, ""), (21, "", ""), (22, " .,; ", ""), (None, ITEM, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(100, ITEM), (100, ITEM), (101, "something else entirely that nobody wrote anywhere in these documents at all today"), (102, None), (None, ITEM), (103, "")], "item_id bigint, text string")
    passages = leaks.leaked_passages(df, items)
    got = {(r.doc_id, r.item_id) for r in passages.collect()}
    assert got == {(i, 100) for i, _, leak in docs if leak}
    spans_ = {r.doc_id: (r.word_from, r.word_to, list(r["items"])) for r in leaks.removal_spans(passages).collect()}
    assert spans_[1] == (300, 300 + len(words), [100])
    assert leaks.leaked_passages(df.limit(0), items).count() == 0 and leaks.leaked_passages(df, items.limit(0)).count() == 0


def passage_by_matrix(item, text):
    """The whole matrix of scores, traced back: a diagonal step before a missing word before an additional one."""
    score = np.zeros((len(item) + 1, len(text) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            score[i, j] = max(0, score[i - 1, j - 1] + (2 if item[i - 1] == text[j - 1] else -1), score[i - 1, j] - 1, score[i, j - 1] - 1)
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    equal, end = 0, int(j)
    while i > 0 and j > 0 and score[i, j] > 0:
        same = item[i - 1] == text[j - 1]
        if score[i, j] == score[i - 1, j - 1] + (2 if same else -1):
            equal, i, j = equal + bool(same), i - 1, j - 1
        elif score[i, j] == score[i - 1, j] - 1:
            i -= 1
        else:
            j -= 1
    return equal, int(j), end


def test_alignment_equals_the_whole_matrix():
    rng = np.random.default_rng(9)
    for _ in range(300):
        item = rng.integers(1, 6, rng.integers(1, 15))
        text = rng.integers(0, 6, rng.integers(1, 30))
        if rng.random() < 0.5:
            at = rng.integers(0, len(text))
            text = np.concatenate([text[:at], item, text[at:]])
        assert leaks._passage(item, text) == passage_by_matrix(item, text)
    long = rng.integers(1, 1000, 20_000)
    assert leaks._passage(long, np.concatenate([long[:500] * 0, long, long[:500] * 0])) == (20_000, 500, 20_500)


def test_items_in_groups_and_long_markup(spark):
    rng = random.Random(12)
    texts = {i: " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(6)) for _ in range(30)) for i in range(40)}
    items = spark.createDataFrame(list(texts.items()), "item_id bigint, text string")
    docs = [(100 + i, f"start {t} end") for i, t in texts.items()]
    words = texts[0].split()
    docs += [(200, " ".join(words[:15]) + f'<a title="{"x y " * 500}">' + " ".join(words[15:])), (201, " ".join(words[:9]) + " p < 0.05 " + " ".join(words[9:]) + " and x > 3")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = {(100 + i, i) for i in texts} | {(200, 0), (201, 0)}
    for at_once in (100_000, 7):
        assert {(r.doc_id, r.item_id) for r in leaks.leaked_passages(df, items, items_at_once=at_once).collect()} == want


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 6, 4000)
    text[1000:1400] = text[2000:2400]
    index = leaks.FMIndex(text, 6)
    for _ in range(200):
        p = rng.integers(1, 6, 3)
        lo, hi = index.search(p[None, :])
        want = [i for i in range(len(text) - 2) if (text[i : i + 3] == p).all()]
        assert hi[0] - lo[0] == len(want)
        assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want
