"""Free-entered names led to the entries of a reference list.

Names are reduced to tokens; each different token is joined to the reference vocabulary by edit distance (a join
on segments: of two words within two edits, one of three parts of the one stands nearly unmoved in the other).
Forms of the reference (names, synonyms, abbreviations) are indexed by their rarest token, so every form that a
name's repaired tokens can make up is a candidate. Candidates are ranked by soft TF-IDF: the cosine of the two weighted
sets of tokens, where the tokens of a name weigh by how few names have them, those of a form by how few forms do, and two that are alike count
by their likeness. One is accepted only if every token of the form is found
in the name, and nothing that bears a meaning is left over. Everything else is reported as unmatched.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioscope.session import cut

UNMATCHED = "UNMATCHED"
#: Words that dress a name up without changing what it denotes.
DRESSING = frozenset("the patient patients expression mrna human gene genes nos disorder finding tablet tablets hydrochloride inn level levels".split())
#: What a tag in brackets says of the kind of thing a name is.
TAGS = ("disorder", "finding", "disease", "procedure", "symptom", "substance", "product", "human", "inn")
TAG = re.compile(r"[\(\[]\s*([^\W\d_]+)\s*[\)\]]")
#: Units that make the number before them a dose.
UNITS = frozenset("mg g ml mcg".split())
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "κ": "kappa", "ε": "epsilon", "λ": "lambda", "ω": "omega", "μ": "mu", "σ": "sigma", "τ": "tau", "θ": "theta", "ζ": "zeta", "η": "eta"}
ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}
INVISIBLE = re.compile("[­​‌‍⁠﻿]")
CAMEL = re.compile(r"(?<=[a-z]{3})(?=[A-Z][a-z]{2})")
PIECE = re.compile(r"[^\W_]+")
PARTS = re.compile(r"\d+|[^\W\d_]+")
OCR = str.maketrans("015", "ols")
MOST_EDITS = 2
#: Words below this length are compared exactly.
SHORTEST = 5
#: Parts into which the names are put where they meet keys and forms, so that no key or anchor is one task's alone.
SALTS = 8
#: Tokens in more than 1/HOT_SHARE of the names get their weight by a broadcast; there are at most HOT_SHARE times the
#: tokens of a name of them.
HOT_SHARE = 10_000


def bare(text: str) -> str:
    """One spelling of letters: no invisible characters, compatibility forms, accents or Greek letters."""
    text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    text = "".join(f" {GREEK[c.lower()]} " if c.lower() in GREEK else c for c in text)
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c))


def _untagged(tag: re.Match) -> str:
    """Nothing for a tag that says what kind of thing is meant, however it is spelled; else what was there."""
    word = tag[1].casefold()
    return " " if any(word == t or (len(t) >= 7 and edits(word, t, 2) <= 2) for t in TAGS) else tag[0]


def tokens_of(text: str) -> list[str]:
    """Tokens in order: letters and digits apart where a number ends a code; Roman numerals as numbers. Digits
    within a word, or one look-alike digit at the end of a long one, stay: they are misread letters."""
    out: list[str] = []
    for piece in PIECE.findall(CAMEL.sub(" ", TAG.sub(_untagged, bare(text)))):
        piece = piece.casefold()
        parts = PARTS.findall(piece)
        if len(parts) > 1 and not (parts[0].isalpha() and parts[-1].isalpha()) and not re.fullmatch(r"[^\W\d]{5,}[015]", piece):
            tail = []
            while len(parts) > 1 and parts[-1].isdigit():  # a word may hold misread digits before its number
                tail.insert(0, parts.pop())
                if parts and parts[-1].isalpha() and len(parts) > 1:
                    break
            out += ["".join(parts), *tail]
        else:
            out.append(piece)
    return [ROMAN.get(t, t) if len(out) > 1 else t for t in out]


def folded(token: str) -> str:
    """A token as one sees it: misread digits as letters, 'rn' as 'm', 'i' as 'l', 'vv' as 'w'."""
    return token.translate(OCR).replace("rn", "m").replace("vv", "w").replace("i", "l")


def edits(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance; most + 1 where it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


@lru_cache(maxsize=1 << 16)
def likeness(token: str, word: str, code: bool, ends: bool) -> float:
    """1 for equal tokens, less for edited or cut-off ones, 0 for others. Numbers and codes agree in full."""
    if token == word:
        return 1.0
    if code or word.isdigit() or token.isdigit() or len(word) < SHORTEST:
        return 0.0
    most = MOST_EDITS if len(word) >= 7 else 1
    seen = folded(token)
    d = min(edits(token, word, most), edits(seen, folded(word), most) + 0.5 * (seen != folded(word)))
    if d > most and token[-1:] == "s":  # a plural
        d = edits(token[:-1], word, most)
    if token[:1] == "h" and token[1:] == word:
        d = 0.5
    if d <= most and len(token) >= 4:
        return 1.0 - d / len(word)
    if ends and len(token) >= 4 and len(word) - len(token) <= 6 and word.startswith(token):
        return 0.8 * len(token) / len(word) + 0.1
    return 0.0


@lru_cache(maxsize=1 << 16)
def _is_dressing(token: str, ends: bool) -> bool:
    return token in DRESSING or (len(token) >= 6 and any(edits(token, w, 1) <= 1 or (ends and w.startswith(token)) for w in DRESSING if len(w) >= 6))


def _undosed(tokens: list[str]) -> list[str]:
    out = []
    for t in tokens:
        if t in UNITS and out and out[-1].isdigit():
            out.pop()
        else:
            out.append(t)
    return out


def _score(name: list[str], known: set[str], form: list[str], codes: list[bool], weights: list[float], also: set[str], weigh: Callable[[str], float]) -> float:
    """Soft TF-IDF cosine of a name and a form if the name can be a way of writing the form, else 0.

    What is left of the name has to be dressing, or another form of the same entry (as ``also`` has it)."""
    free = list(range(len(name)))
    dot = mine = 0.0
    for w in sorted(range(len(form)), key=lambda k: -weights[k]):
        best, at = 0.0, -1
        for k in free:
            if name[k] == form[w]:
                best, at = 1.0, k
                break
            if name[k] in known:
                continue  # a word of the vocabulary means itself
            s = likeness(name[k], form[w], codes[w], k in (0, len(name) - 1))
            if s > best:
                best, at = s, k
        if at < 0:
            return 0.0
        free.remove(at)
        dot += weights[w] * weigh(name[at]) * best
        mine += weights[w] ** 2
    left = [k for k in free if not _is_dressing(name[k], k == len(name) - 1)]
    if left and "".join(name[k] for k in left) not in also:
        return 0.0
    return dot / math.sqrt(mine * sum(weigh(t) ** 2 for t in name))


def agreement(name: list[str], known: set[str], form: list[str], codes: list[bool], weights: list[float], also: set[str], own: dict[str, float]) -> float:
    """How well a name's tokens make up a form, under any of the ways its words may be parted.

    ``own`` has the weights of the name's tokens; words that only come of parting it weigh as the rarest do."""
    name = _undosed(name)
    rarest = max(own.values(), default=1.0)
    weigh = lambda t: own.get(t, rarest)
    best = _score(name, known, form, codes, weights, also, weigh)
    if best:
        return best
    ways = []
    for k, t in enumerate(name):
        if m := re.fullmatch(r"([^\W\d]{5,})([015])", t):  # the digit at the end may be a number after all
            ways.append([*name[:k], m[1], m[2], *name[k + 1 :]])
        if len(t) == 4 and t.isalpha() and k + 1 < len(name) and name[k + 1] in "015":  # or a misread letter
            ways.append([*name[:k], t + name[k + 1], *name[k + 2 :]])
        for w in form:  # two words run together
            if len(t) >= len(w) + 2 and len(w) >= 4 and t not in known:
                if t.startswith(w):
                    ways.append([*name[:k], w, t[len(w) :], *name[k + 1 :]])
                elif t.endswith(w):
                    ways.append([*name[:k], t[: -len(w)], w, *name[k + 1 :]])
        if k + 1 < len(name) and (t not in known or name[k + 1] not in known) and not t.isdigit() and not name[k + 1].isdigit():
            ways.append([*name[:k], t + name[k + 1], *name[k + 2 :]])
    best = max((0.98 * _score(w, known, form, codes, weights, also, weigh) for w in ways), default=0.0)
    if not best and len(form) > 1 and len(name) < len(form):  # all words run together
        whole, run = "".join(form), "".join(t for k, t in enumerate(name) if not _is_dressing(t, k == len(name) - 1) or t in form)
        number = re.search(r"\d*$", whole)[0]
        if len(whole) >= 8 and run.endswith(number):
            n = len(number)
            # no word of the form may be missing: cut off is at most the end of the last one
            if abs(len(run) - len(whole)) <= 1 or (len(name) == 1 and len(run) >= len(whole) - len(form[-1]) + 3):
                best = 0.95 * likeness(run[: len(run) - n], whole[: len(whole) - n], False, not n)
    return best


def _segments(word: str) -> list[tuple[int, str]]:
    """Three parts of a word, with their places."""
    n = len(word)
    a, b = n // 3, 2 * n // 3
    return [(0, word[:a]), (a, word[a:b]), (b, word[b:])]


def vocabulary_keys(word: str) -> list[str]:
    """What a word of the vocabulary is found by: its parts, itself, and what remains of it when cut off."""
    keys = [f"={word}"]
    if len(word) >= SHORTEST and not word.isdigit():
        keys += [f"{len(word)}/{i}/{s}" for i, (_, s) in enumerate(_segments(word))]
        f = folded(word)
        keys += [f"f{f}"] + [f"<{word[:n]}" for n in range(max(4, len(word) - 6), len(word))]
    return keys


def token_keys(token: str, single: bool = True) -> list[str]:
    """What a token of a name asks for: itself; parts of words of about its length; words it may be cut from, or, for a
    ``single`` token (not two of them put together), that it starts or ends with."""
    keys = {f"={token}", f"f{folded(token)}", f"<{token}"}
    n = len(token)
    if n >= SHORTEST - 1 and not token.isdigit():
        for length in range(max(SHORTEST, n - MOST_EDITS), n + MOST_EDITS + 1):
            a, b = length // 3, 2 * length // 3
            for i, (start, stop) in enumerate(((0, a), (a, b), (b, length))):
                # moved by at most MOST_EDITS from its place, counted from the start and, but for a plural's end, from the end
                for at in range(max(0, start - MOST_EDITS, start + n - length - MOST_EDITS - 1), min(n - (stop - start), start + MOST_EDITS, start + n - length + MOST_EDITS) + 1):
                    end = at + stop - start
                    left, right = token[at - 1 : at], token[end : end + 1]
                    keys.add(f"{length}/{i}/{token[at:end]}")
                    # a swap over a border of the part is taken back
                    if left:
                        keys.add(f"{length}/{i}/{left}{token[at + 1 : end]}")
                    if right:
                        keys.add(f"{length}/{i}/{token[at : end - 1]}{right}")
        if single and n >= 8:
            keys.update(f"={token[:k]}" for k in range(4, n - 1))
            keys.update(f"={token[k:]}" for k in range(2, n - 3))
    return sorted(keys)


def _with_list(df: DataFrame, column: str, new: str, fn, kind: str) -> DataFrame:
    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(fn)

    return df.withColumn(new, run(column))


def reference_forms(reference: DataFrame) -> DataFrame:
    """(ref_id, form, tokens, codes, weights, anchor): every form of every entry, with the rarest of its tokens.

    Null and blank forms give none. ``codes`` marks tokens that are written in capitals throughout."""
    lists = [F.array("name"), F.coalesce("synonyms", F.array().cast("array<string>")), F.coalesce("abbreviations", F.array().cast("array<string>"))]
    forms = reference.where("entity_id IS NOT NULL").select(F.col("entity_id").alias("ref_id"), F.explode(F.concat(*lists)).alias("form")).where("trim(form) <> ''").distinct()
    coded = _with_list(forms, "form", "tokens", tokens_of, "array<string>").where(F.size("tokens") > 0)
    capital = _with_list(coded, "form", "capitals", lambda t: [x.casefold() for x in re.findall(r"[^\W\d_]+", bare(t)) if x.isupper()], "array<string>")
    entry = capital.withColumn("codes", F.transform("tokens", lambda t: F.array_contains("capitals", t))).drop("capitals")
    token = entry.select("form", F.explode(F.array_distinct("tokens")).alias("token")).distinct()
    counts = token.groupBy("token").agg(F.count("*").alias("df"))
    total = entry.count()
    also = entry.groupBy("ref_id").agg(F.collect_set(F.array_join("tokens", "")).alias("also"))
    per_form = token.join(counts, "token").groupBy("form").agg(F.map_from_entries(F.collect_list(F.struct("token", F.log(F.lit(1.0 + total) / F.col("df")))) ).alias("idf"), F.min(F.struct("df", "token")).getField("token").alias("anchor"))
    return entry.join(per_form, "form").join(also, "ref_id").withColumn("weights", F.transform("tokens", lambda t: F.element_at("idf", t))).drop("idf")


def _token_weights(parted: DataFrame) -> DataFrame:
    """(name, own): the weights of each name's tokens, log(1 + names / names with the token)."""
    total = parted.count()
    each = parted.select("name", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = each.groupBy("token").agg(F.log(F.lit(1.0) + F.lit(total) / F.count("*")).alias("weight"), F.count("*").alias("n"))
    hot = counts.where(F.col("n") > total // HOT_SHARE).select("token", F.col("weight").alias("known"))
    marked = each.join(F.broadcast(hot), "token", "left")
    rest = marked.where("known IS NULL").select("name", "token").join(counts.select("token", "weight"), "token")
    every = marked.where("known IS NOT NULL").select("name", "token", F.col("known").alias("weight")).unionByName(rest)
    return every.groupBy("name").agg(F.collect_list(F.struct("token", "weight")).alias("own"))


def canonical(names: DataFrame, reference: DataFrame) -> DataFrame:
    """(name, ref_id, score) of every different name that denotes an entry; null and blank names give no row.

    ``names`` has a column ``name``. Numbers and codes have to agree in every letter and digit, and so has every
    word of the reference vocabulary; other words may have up to MOST_EDITS edits. Of equally good entries none
    is chosen: such a name is left out, like those that denote nothing. A name that is repeated counts once.
    """
    different = names.select("name").where(F.col("name").isNotNull() & (F.regexp_replace("name", r"(?U)\s+", "") != "")).distinct()
    # work per row is long against its bytes: partitions by number, which are not
    # merged for being small (nor dropped, as those by the column that was just grouped would be)
    spark = names.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parted = cut(_with_list(different.repartition(tasks, F.xxhash64("name")), "name", "tokens", tokens_of, "array<string>"))
    forms = cut(reference_forms(reference))
    run_together = F.array_join("form_tokens", "")
    entries = forms.select("anchor", "form", "ref_id", F.col("tokens").alias("form_tokens"), "codes", "weights", "also")
    # a form is also found by its words run together
    anchors = entries.unionByName(entries.where(F.size("form_tokens") > 1).withColumn("anchor", run_together))
    words = forms.select(F.explode("tokens").alias("word")).union(anchors.select("anchor")).distinct()
    # tokens of names, and neighbours that may be one word
    neighbours = F.transform(F.sequence(F.lit(0), F.size("tokens") - 2), lambda i: F.concat(F.get("tokens", i), F.get("tokens", i + 1)))
    marked = lambda c, single: F.transform(c, lambda t: F.struct(t.alias("token"), F.lit(single).alias("single")))
    paired = F.when(F.size("tokens") > 1, neighbours).otherwise(F.array().cast("array<string>"))
    asked_as = parted.select("name", F.explode(F.array_distinct(F.concat(marked(F.col("tokens"), True), marked(paired, False)))).alias("t")).select("name", "t.token", "t.single")
    asked = asked_as.select("name", "token").distinct()
    exact = forms.select(F.explode("tokens").alias("token")).distinct()
    # a word of the vocabulary means itself, so only the others are to be repaired
    tokens = asked_as.groupBy("token").agg(F.max("single").alias("single")).join(exact, "token", "left_anti").repartition(tasks, F.xxhash64("token"))
    index = _with_list(words, "word", "keys", vocabulary_keys, "array<string>").select("word", F.explode("keys").alias("key"))

    @F.pandas_udf("array<string>")
    def asks(token: pd.Series, single: pd.Series) -> pd.Series:
        return pd.Series([token_keys(t, s) for t, s in zip(token, single)], dtype=object)

    probes = tokens.select("token", F.explode(asks("token", "single")).alias("key"))
    distance = F.levenshtein("token", "word", 2 * MOST_EDITS)
    near = (distance >= 0) & (distance <= MOST_EDITS + 1)
    # two swaps are four edits there, but keep the letters; a plural may have one more. Letters are costly to sort, so only
    # pairs at that distance are.
    letters = lambda c: F.array_sort(F.split(c, ""))
    longer = F.length("token") - F.length("word")
    swapped = (distance > MOST_EDITS + 1) & F.when(longer == 0, letters(F.col("token")) == letters(F.col("word"))).when(longer == 1, letters(F.col("token")) == letters(F.concat("word", F.lit("s")))).otherwise(F.lit(False))
    cut_off = F.col("word").startswith(F.col("token")) | F.col("token").startswith(F.col("word")) | F.col("token").endswith(F.col("word"))
    # both sides are longer than their estimates, which know nothing of the keys of a token: no broadcast
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    met = probes.withColumn("salt", salt("token")).join(index.select("*", salts).hint("merge"), ["key", "salt"]).where(F.col("key").startswith("f") | cut_off | near | swapped)
    repaired = cut(met.select("token", "word").union(exact.select("token", F.col("token").alias("word"))).distinct())
    known = asked.join(exact, "token").groupBy("name").agg(F.collect_set("token").alias("known"))
    meant = asked.join(repaired.hint("merge"), "token").select("name", F.col("word").alias("anchor")).distinct()
    of_names = parted.join(known.hint("merge"), "name", "left").join(_token_weights(parted).hint("merge"), "name", "left")
    reached = meant.withColumn("salt", salt("name")).join(anchors.select("*", salts).hint("merge"), ["anchor", "salt"]).drop("salt", "anchor")
    candidates = reached.join(of_names.hint("merge"), "name").repartition(tasks, F.xxhash64("name", "form"))

    @F.pandas_udf("double")
    def scored(tokens: pd.Series, known: pd.Series, own: pd.Series, form: pd.Series, codes: pd.Series, weights: pd.Series, also: pd.Series) -> pd.Series:
        rows = zip(tokens, known, own, form, codes, weights, also)
        return pd.Series([agreement(list(t), set(k) if k is not None else set(), list(f), list(c), list(w), set(a), {x["token"]: x["weight"] for x in o}) for t, k, o, f, c, w, a in rows], dtype="float64")

    ranked = candidates.withColumn("score", scored("tokens", "known", "own", "form_tokens", "codes", "weights", "also")).where("score > 0")
    per_entry = ranked.groupBy("name", "ref_id").agg(F.max("score").alias("score"))
    best = per_entry.withColumn("place", F.rank().over(Window.partitionBy("name").orderBy(F.desc(F.round("score", 9))))).where("place = 1")
    return best.groupBy("name").agg(F.count("*").alias("n"), F.min("ref_id").alias("ref_id"), F.max("score").alias("score")).where("n = 1").select("name", "ref_id", "score")


def resolve(entities: DataFrame, reference: DataFrame) -> DataFrame:
    """(entity_id, ref_id): one row for every entity with a name; UNMATCHED where it denotes no entry.

    Of several names of one entity the least by code point counts; rows without an id are left out."""
    named = entities.where(F.col("entity_id").isNotNull() & F.col("name").isNotNull() & (F.regexp_replace("name", r"(?U)\s+", "") != "")).groupBy("entity_id").agg(F.min("name").alias("name"))
    return named.join(canonical(named, reference), "name", "left").select("entity_id", F.coalesce("ref_id", F.lit(UNMATCHED)).alias("ref_id"))
