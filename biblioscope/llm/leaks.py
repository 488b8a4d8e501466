"""Evaluation passages that stand in training text.

The words of the evaluation items (a stated set, of fixed size) are the alphabet; every other word is one
symbol that no phrase holds. Each shard of documents becomes an FM-index: the order of its suffixes, the
Burrows-Wheeler transform of that order, a wavelet tree over the transform for ranks, and suffix positions
sampled along the text. All phrases of the items are searched
backward at once; their occurrences are located by walking to the next sampled position. Places of one item
that lie together in a document are then aligned word by word, which decides; passages are merged into spans.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a searched phrase. An item's passage of 60 % with an edit in every few words keeps several of them.
PHRASE = 3
SAMPLE_EVERY = 16
#: Share of an item's words that its phrases must cover before a passage is aligned.
SEEDED = 0.4
#: Share of a passage's words that must be the item's.
DENSE = 0.6
#: Evaluation items that one pass searches for.
ITEMS_AT_ONCE = 100_000
#: Words of one shard's index.
SHARD_WORDS = 1_000_000
#: Markup of any length; a '<' before anything else (as in 'p < 0.05') is none.
TAG = re.compile(r"<[A-Za-z/!?][^<>]*>")
SOFT = re.compile("[­​‌‍⁠﻿]")
#: A hyphen at the end of a line joins the parts of a word.
BROKEN = re.compile(r"(?<=\w)[-‐]\s*\n\s*(?=\w)")
WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Words without regard to case, accents, punctuation, spacing and markup."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", SOFT.sub("", text))
        text = "".join(c for c in text if not unicodedata.combining(c))
    return WORD.findall(BROKEN.sub("", text).casefold())


class Phrases:
    """The items' vocabulary and their phrases, made once from the stated set and sent to every task.

    Symbol 0 is the end of a document and any word that no item has: a break that no phrase crosses."""

    def __init__(self, items: list[tuple[int, str]]):
        words = {i: words_of(t) for i, t in items}
        words = {i: w for i, w in words.items() if w}
        vocabulary = sorted({x for w in words.values() for x in w})
        self.symbol = {x: n + 1 for n, x in enumerate(vocabulary)}
        self.size = len(vocabulary) + 1
        self.coded = {i: np.array([self.symbol[x] for x in w]) for i, w in words.items()}
        self.halves: dict[str, tuple[int, int]] = {}
        for w in words.values():
            for x, y in zip(w, w[1:]):
                self.halves.setdefault(x + y, (self.symbol[x], self.symbol[y]))
        where: dict[tuple, list[tuple[int, int]]] = {}
        for i, c in self.coded.items():
            for p in range(max(1, len(c) - PHRASE + 1)):
                where.setdefault(tuple(c[p : p + PHRASE].tolist()), []).append((i, p))
        self.patterns = np.full((len(where), PHRASE), -1, np.int64)
        for r, phrase in enumerate(where):
            self.patterns[r, PHRASE - len(phrase) :] = phrase
        # every item and place of a phrase, flat
        self.times = np.array([len(w) for w in where.values()], np.int64)
        self.first = np.cumsum(self.times) - self.times
        self.item = np.array([i for w in where.values() for i, _ in w], np.int64)
        self.place = np.array([p for w in where.values() for _, p in w], np.int64)

    def symbols(self, words: list[str]) -> list[int]:
        """Symbols of a document's words. A word that no item has is tried together with its neighbours, and as
        two words run together, so that odd spacing hides nothing."""
        get = self.symbol.get
        codes = [get(w, 0) for w in words]
        changed, n = False, len(words)
        for i, c in enumerate(codes):
            if c:
                continue
            word = words[i]
            if word in self.halves:
                codes[i] = self.halves[word]
                changed = True
            elif i + 1 < n and (joined := get(word + words[i + 1])):
                codes[i], codes[i + 1] = joined, None
                changed = True
            elif i and codes[i - 1].__class__ is int and (joined := get(words[i - 1] + word)):
                codes[i - 1], codes[i] = joined, None
                changed = True
        if not changed:
            return codes
        return [x for c in codes if c is not None for x in (c if c.__class__ is tuple else (c,))]


class WaveletTree:
    """Ranks of any symbol in a sequence, by one bit vector for each bit of the symbols (stable partitions)."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = bits
        x = sequence
        for b in range(bits - 1, -1, -1):
            bit = (x >> b) & 1
            ones = np.zeros(len(x) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(x) - int(ones[-1])
            self.levels.append((ones, zeros))
            x = np.concatenate([x[bit == 0], x[bit == 1]])

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        lo, hi = np.zeros_like(upto), upto.copy()
        for level, (ones, zeros) in enumerate(self.levels):
            one = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return hi - lo

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol, lo, hi = np.zeros_like(at), np.zeros_like(at), at.copy()
        for ones, zeros in self.levels:
            one = ones[hi + 1] > ones[hi]
            lo1, hi1 = ones[lo], ones[hi]
            symbol = symbol * 2 + one
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return symbol, hi - lo


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Suffixes in order, every break (0) being a symbol of its own that is less than all others and than the
    breaks after it. One sort by the first symbols that fit a word, then doubling for suffixes still equal."""
    n, per = len(text), max(1, 64 // bits)
    key = np.zeros(n, np.uint64)
    live = np.ones(n, bool)
    for j in range(per):
        symbol = np.zeros(n, np.uint64)
        symbol[: n - j] = text[j:]
        symbol[~live] = 0
        live &= symbol > 0
        key = (key << np.uint64(bits)) | symbol
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    start = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    group = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    size = np.diff(np.concatenate([np.flatnonzero(start), [n]]))
    # a group that met its break is settled by place; others go on while they have more than one suffix
    open_ = (np.repeat(size, size) > 1) & live[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.where(open_, group, np.arange(n))
    depth = per
    at = np.flatnonzero(open_)
    while len(at):
        suffix = order[at]
        beyond = rank[np.minimum(suffix + depth, n - 1)]
        resort = np.lexsort((suffix, beyond, rank[suffix]))
        suffix, beyond, mine = suffix[resort], beyond[resort], rank[suffix][resort]
        order[at] = suffix
        new = np.concatenate([[True], (mine[1:] != mine[:-1]) | (beyond[1:] != beyond[:-1])])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        size = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]]))
        rank[suffix] = at[lead]
        open_ = np.repeat(size, size) > 1
        at = at[open_]
        depth *= 2
    return order


class FMIndex:
    """Full-text index of one shard: counts and finds any pattern of words that holds no break."""

    def __init__(self, text: np.ndarray, size: int):
        bits = max(1, int(size - 1).bit_length())
        order = suffix_order(text, bits)
        self.n = len(text)
        self.tree = WaveletTree(text[order - 1], bits)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        # sampled positions: those after a break, where a walk must end, and some of the others
        kept = (text[order - 1] == 0) | (order % SAMPLE_EVERY == 0) | (order == 0)
        self.kept = kept
        self.kept_before = np.cumsum(kept) - kept
        self.places = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each row of ``patterns``; -1 pads short ones at the front."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((patterns[:, j] >= 0) & (lo < hi))
            c = patterns[live, j]
            lo[live], hi[live] = self.less[c] + self.tree.rank(c, lo[live]), self.less[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: each walks back through the text to a sampled position."""
        found, walk, at, back = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(walk):
            here = self.kept[at]
            found[walk[here]] = self.places[self.kept_before[at[here]]] + back
            walk, at = walk[~here], at[~here]
            symbol, rank = self.tree.access(at)
            at = self.less[symbol] + rank
            back += 1
        return found


def _passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of an item's words with a stretch of text: (equal words, from, to).

    An equal word scores 2, a differing one -1, a missing or an additional one -1. One row of scores is held, with the
    place where each cell's alignment begins and its equal words, so memory grows with the stretch alone."""
    m = len(text)
    steps = np.arange(m + 1)
    score, start, equal = np.zeros(m + 1, np.int64), steps.copy(), np.zeros(m + 1, np.int64)
    diagonal, began, same = np.empty(m + 1, np.int64), steps.copy(), np.zeros(m + 1, np.int64)
    best = (0, 0, 0, 0)
    for word in item.tolist():
        hit = text == word
        diagonal[0] = -1
        diagonal[1:] = score[:-1] + np.where(hit, 2, -1)
        up = score - 1
        turn = up > diagonal
        began[1:], same[1:] = start[:-1], equal[:-1] + hit
        row = np.maximum(np.where(turn, up, diagonal), 0)
        began, same = np.where(turn, start, began), np.where(turn, equal, same)
        fresh = row == 0
        began[fresh], same[fresh] = steps[fresh], 0
        # an additional word costs 1: a running maximum of score + place, which says from where it comes
        run = np.maximum.accumulate(((row + steps) << 32) | steps)
        source = run & 0xFFFFFFFF
        score, start, equal = (run >> 32) - steps, began[source], same[source]
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(equal[top]), int(start[top]), top)
    return best[1:]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then those of starts[1], ..."""
    return np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _leaks_of_shard(text: np.ndarray, bounds: np.ndarray, phrases: Phrases, part: float) -> list[tuple[int, int, int, int, int]]:
    """(document of the shard, item, equal words, from, to) of every passage in one shard."""
    # of breaks side by side the index holds the first
    held = np.flatnonzero((text > 0) | (np.concatenate([[1], text[:-1]]) > 0))
    index = FMIndex(text[held], phrases.size)
    lo, hi = index.search(phrases.patterns)
    hit = np.flatnonzero(hi > lo)
    counts = hi[hit] - lo[hit]
    at = held[index.locate(_spread(lo[hit], counts))]
    which = np.repeat(hit, counts)
    entry = _spread(phrases.first[which], phrases.times[which])
    at = np.repeat(at, phrases.times[which])
    item, place = phrases.item[entry], phrases.place[entry]
    doc = np.searchsorted(bounds, at, side="right") - 1
    order = np.lexsort((at, item, doc))
    at, item, place, doc = at[order], item[order], place[order], doc[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])[: len(at)]
    group = np.cumsum(new) - 1
    # phrases of one passage lie within about the item's length, give or take the edits
    length = np.array([len(phrases.coded[i]) for i in item.tolist()], np.int64) if len(at) else at
    span = (1.4 * length).astype(np.int64) + 2
    least = np.clip((SEEDED * length).astype(np.int64), 1, length)
    lane = np.int64(2 * len(text) + 4)
    end = np.searchsorted(group * lane + at, group * lane + at + span)
    found: list[tuple[int, int, int, int, int]] = []
    passed, tried, last = 0, -1, -1
    for begin in np.flatnonzero(end - np.arange(len(at)) + PHRASE - 1 >= least).tolist():
        stop, n = int(end[begin]), int(length[begin])
        if group[begin] != last:
            passed, tried, last = 0, -1, int(group[begin])
        # a window that ends where one before it did lies within that one
        if at[begin] < passed or stop == tried:
            continue
        if len(np.unique(place[begin:stop, None] + np.arange(PHRASE))) < least[begin]:
            continue
        d, words = int(doc[begin]), phrases.coded[int(item[begin])]
        left = max(int(bounds[d]), int(at[begin]) - n // 2, passed)
        right = min(int(bounds[d + 1]) - 1, int(at[stop - 1]) + n)
        tried = stop
        if np.isin(words, text[left:right]).sum() < part * n:
            continue
        equal, f, t = _passage(words, text[left:right])
        if equal >= part * n and equal >= DENSE * (t - f):
            found.append((d, int(item[begin]), equal, left + f, left + t))
            passed = left + t
    return found


def leaked_passages(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", part: float = 0.6, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """(doc_id, item_id, words_equal, n_words, word_from, word_to): every passage of a document that holds at
    least ``part`` of an item's words in nearly its order.

    ``items`` is a stated set; its words go to every task. Of more than ``items_at_once`` each group of about so many is
    searched in a pass of its own. Null and empty texts,
    on either side, give nothing; of items with one id the greatest text counts. Documents are read whole; one
    longer than a shard is parted with an overlap, where a passage may come out twice. Repeated documents each
    have their rows. Words are counted
    in the normalised text (from inclusive, to exclusive).
    """
    named = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").groupBy("i").agg(F.max("t").alias("t"))
    groups = max(1, -(-named.count() // items_at_once))
    passes = [_search(docs, named.where(F.pmod(F.xxhash64("i"), F.lit(groups)) == g), doc_id, doc_text, part) for g in range(groups)]
    return reduce(DataFrame.unionByName, passes)


def _search(docs: DataFrame, named: DataFrame, doc_id: str, doc_text: str, part: float) -> DataFrame:
    """The passages of one group of items (i, t)."""
    known = Phrases([(r["i"], r["t"]) for r in named.collect()])
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    phrases = docs.sparkSession.sparkContext.broadcast(known)
    names = ["doc_id", "item_id", "words_equal", "n_words", "word_from", "word_to"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = phrases.value

        overlap = 4 * max((len(c) for c in known.coded.values()), default=0)

        def shard(ids: list[tuple[int, int]], parts: list[list[int]]) -> pd.DataFrame:
            bounds = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
            text = np.fromiter((x for p in parts for x in (*p, 0)), np.int64, int(bounds[-1]))
            rows = {(ids[d][0], i, n, len(known.coded[i]), f - int(bounds[d]) + ids[d][1], t - int(bounds[d]) + ids[d][1]) for d, i, n, f, t in _leaks_of_shard(text, bounds, known, part)}
            return pd.DataFrame(sorted(rows), columns=names).astype("int64")

        ids, parts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch["doc_id"], batch["text"]):
                symbols = known.symbols(words_of(t))
                # a text longer than a shard is parted; the parts share more words than a passage can have
                for at in range(0, max(1, len(symbols) - overlap), SHARD_WORDS):
                    part_ = symbols[at : at + SHARD_WORDS + overlap]
                    if any(part_):
                        ids.append((i, at))
                        parts.append(part_)
                        size += len(part_) + 1
                    if size >= SHARD_WORDS:
                        yield shard(ids, parts)
                        ids, parts, size = [], [], 0
        if ids:
            yield shard(ids, parts)

    if not len(known.patterns):
        source = source.where(F.lit(False))
    return source.mapInPandas(run, ", ".join(f"{n} bigint" for n in names))


def removal_spans(passages: DataFrame) -> DataFrame:
    """(doc_id, word_from, word_to, items): passages of a document that touch or overlap, merged."""
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("word_from", "word_to", "item_id"))),
        F.array().cast("array<struct<word_from:bigint,word_to:bigint,items:array<bigint>>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["word_from"] <= F.try_element_at(done, F.lit(-1))["word_to"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(F.try_element_at(done, F.lit(-1))["word_from"].alias("word_from"), F.greatest(F.try_element_at(done, F.lit(-1))["word_to"], x["word_to"]).alias("word_to"), F.array_sort(F.array_union(F.try_element_at(done, F.lit(-1))["items"], F.array(x["item_id"]))).alias("items"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["word_from"].alias("word_from"), x["word_to"].alias("word_to"), F.array(x["item_id"]).alias("items"))))),
    )
    return passages.groupBy("doc_id").agg(merged.alias("spans")).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.word_from", "s.word_to", "s.items")
