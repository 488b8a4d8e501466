"""Names with swapped letters, also over the borders of the parts that a word is found by."""

import itertools

from biblioscope.llm import canonical


def swap(word, i):
    return word[:i] + word[i + 1] + word[i] + word[i + 2 :]


def test_every_two_edits_share_a_key():
    for word in ("bridosk", "trolaneximab", "zedevbaemoryx"):
        known = set(canonical.vocabulary_keys(word))
        swaps = [swap(word, i) for i in range(len(word) - 1)]
        once = [*swaps, *(word[:i] + word[i + 1 :] for i in range(len(word))), *(word[:i] + "q" + word[i:] for i in range(len(word) + 1)), *(word[:i] + "q" + word[i + 1 :] for i in range(len(word)))]
        twice = {swap(w, i) for w in once for i in range(len(w) - 1)}
        assert [t for t in twice if canonical.edits(t, word, 2) <= 2 and not known & set(canonical.token_keys(t))] == []


def test_two_swaps_are_repaired(spark):
    word = "trolaneximab"
    names = [swap(swap(word, i), j) for i, j in itertools.combinations(range(1, len(word) - 1), 2) if j > i + 1]
    reference = spark.createDataFrame([("D1", word, [], []), ("D2", "covudrelisen", [], [])], "entity_id string, name string, synonyms array<string>, abbreviations array<string>")
    got = {r.name: r.ref_id for r in canonical.canonical(spark.createDataFrame([(n,) for n in names], "name string"), reference).collect()}
    assert got == dict.fromkeys(names, "D1")
