"""Deeply nested records as related flat tables.

``path_triples`` reads every record event by event into (path, ordinals, value) rows. A path is the chain of
object keys with ``[]`` for an array; ``ordinals`` holds the place taken in each of those arrays. Paths that share
a repeated ancestor belong to one table; ``element_rows`` pivots every group into one row for each element of its
ancestor, and ``related_table`` gives the table of one ancestor. Rows keep the record's key and the ordinals, so a
child row is joined to its parent by (key, prefix of the ordinals).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Objects that only wrap a record, by the key that holds the record.
WRAPPERS = ("record", "data")
#: Rows of a parsed batch, and characters of their paths, before they leave the task.
ROWS_AT_ONCE, CHARS_AT_ONCE = 50_000, 16_000_000

TRIPLE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("ordinals", T.ArrayType(T.IntegerType())),
        T.StructField("seq", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

#: One token of JSON text: a mark, a string without escapes, the start of another string, or a bare word.
TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|"([^"\\\x00-\x1f]*)"|(")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity))')
END = re.compile(r"[ \t\n\r]*\Z")
OBJECT, ARRAY, CLOSE, KEY, STRING, WORD = range(6)
KINDS = {"true": "boolean", "false": "boolean", "null": "null"}


def events(text: str) -> list[tuple]:
    """The events of one JSON text in order: (OBJECT | ARRAY, number of events up to its end), (CLOSE,), (KEY, name),
    (STRING, value), (WORD, value), and (None,) for what does not count.

    Nothing recurs, so any depth is read. An object whose keys are all numbers is the array it stands for, and of
    repeated keys the last counts. ValueError for anything that is no JSON text."""
    out: list[tuple] = []
    stack: list[tuple[bool, int, list[tuple[str, int]]]] = []  # (is an object, its event, its keys with their events)
    at, match, wants_value, wants_key, may_close = 0, TOKEN.match, True, False, False
    while wants_value or wants_key or stack:
        m = match(text, at)
        if m is None:
            raise ValueError(f"no JSON at {at}")
        at, which = m.end(), m.lastindex
        if which == 1:
            mark = m[1]
            if mark in "{[":
                if not wants_value:
                    raise ValueError(f"no JSON at {at}")
                is_object = mark == "{"
                stack.append((is_object, len(out), []))
                out.append(())
                wants_value, wants_key, may_close = not is_object, is_object, True
                continue
            if mark in "}]":
                if not stack or stack[-1][0] != (mark == "}") or not (may_close or not (wants_value or wants_key)):
                    raise ValueError(f"no JSON at {at}")
                is_object, start, keys = stack.pop()
                out.append((CLOSE,))
                if len(keys) > 1 and len({k for k, _ in keys}) < len(keys):
                    _drop_repeated(out, keys)
                numbered = bool(keys) and all(k.isdigit() for k, _ in keys)
                out[start] = (OBJECT if is_object and not numbered else ARRAY, len(out) - start)
                wants_value = wants_key = may_close = False
            elif mark == "," and stack and not (wants_value or wants_key):
                wants_value, wants_key, may_close = not stack[-1][0], stack[-1][0], False
                continue
            else:
                raise ValueError(f"no JSON at {at}")
        else:
            if which == 2:
                code, value = STRING, m[2]
            elif which == 3:
                code = STRING
                value, at = scanstring(text, at)
            else:
                code, value = WORD, m[4]
            if wants_key:
                m = match(text, at)
                if code != STRING or m is None or m[1] != ":":
                    raise ValueError(f"no JSON at {at}")
                at = m.end()
                stack[-1][2].append((value, len(out)))
                out.append((KEY, value))
                wants_value, wants_key, may_close = True, False, False
                continue
            if not wants_value:
                raise ValueError(f"no JSON at {at}")
            out.append((code, value))
            wants_value = may_close = False
    if END.match(text, at) is None:
        raise ValueError(f"no JSON at {at}")
    return out


def _drop_repeated(out: list[tuple], keys: list[tuple[str, int]]) -> None:
    """Takes out the events of a key that comes again in its object."""
    last = {k: i for i, (k, _) in enumerate(keys)}
    for i, (k, start) in enumerate(keys[:-1]):
        if last[k] != i:
            for j in range(start, keys[i + 1][1]):
                out[j] = (None,)
    keys[:] = [kv for i, kv in enumerate(keys) if last[kv[0]] == i]


def _after(found: list[tuple], i: int) -> int:
    """The place after the value that begins at ``i``."""
    return i + found[i][1] if found[i][0] in (OBJECT, ARRAY) else i + 1


def _opened(found: list[tuple]) -> tuple[list[tuple], int]:
    """The events of a record and where it begins, without what may enclose it, in any number of layers: JSON text in
    a string, a list of one, a wrapping object. A text that is no JSON is a ValueError; within an object it wraps nothing."""
    i = 0
    while True:
        code = found[i][0]
        if code == STRING:
            found, i = events(found[i][1].lstrip("\ufeff")), 0
        elif code == ARRAY and found[i + 1][0] not in (KEY, CLOSE) and found[_after(found, i + 1)][0] == CLOSE:
            i += 1
        elif code == OBJECT:
            held, j = {}, i + 1
            while found[j][0] != CLOSE:
                if found[j][0] == KEY:
                    held[found[j][1]] = j + 1
                    j = _after(found, j + 1)
                else:
                    j += 1
            inner = next((held[k] for k in WRAPPERS if k in held and found[held[k]][0] in (OBJECT, STRING)), None)
            if "metadata" in held or inner is None:
                return found, i
            if found[inner][0] == STRING and (text := _events_or_none(found[inner][1].lstrip("\ufeff"))) is None:
                return found, i
            found, i = (text, 0) if found[inner][0] == STRING else (found, inner)
        else:
            return found, i


def _triples(found: list[tuple], at: int, under: tuple[str, ...], text_at: frozenset[str]) -> Iterator[tuple]:
    """(path, ordinals, kind, value) of a record's leaves and structure, in stored order.

    Besides the leaves every element of an array that is itself an object or array has a row, and so has an object or
    array without content, and the record as a whole: so no element is lost for having no leaf of its own."""
    parts: list[str] = []  # the path, joined only where it is needed
    ordinals: list[int] = []
    frames: list[list] = []  # [is an array, next ordinal, has a part, everything below is wanted]
    name, i = "", at
    while True:
        code = found[i][0]
        if code == KEY or code is None:
            name, i = found[i][-1], i + 1
            continue
        if code == CLOSE:
            closed = frames.pop()
            i += 1
        else:
            listed = bool(frames) and frames[-1][0]
            if listed:
                ordinals.append(frames[-1][1])
                frames[-1][1] += 1
            if frames:
                parts.append("[]" if listed else f".{name}" if parts else name)
            wanted, all_below, path = True, not under or (bool(frames) and frames[-1][3]), None
            if frames and not all_below:
                path = "".join(parts)
                all_below = any(path == u or path.startswith((u + ".", u + "[")) for u in under)
                wanted = all_below or any(u.startswith((path + ".", path + "[")) for u in under)
            opened = False
            if not wanted:
                i = _after(found, i)
            elif code == STRING and text_at and found[i][1][:1] in ("{", "[") and "".join(parts) in text_at and (inner := _events_or_none(found[i][1])):
                found[i : i + 1] = inner  # the text takes the place of its string
                if listed:
                    ordinals.pop()
                    frames[-1][1] -= 1
                if frames:
                    parts.pop()
                continue
            elif code == OBJECT or code == ARRAY:
                if listed or not frames or found[i + 1][0] == CLOSE:
                    yield "".join(parts), list(ordinals), "object" if code == OBJECT else "array", None
                frames.append([code == ARRAY, 0, bool(frames), all_below])
                opened, i = True, i + 1
            else:
                value = found[i][1]
                kind = "string" if code == STRING else KINDS.get(value, "number")
                yield path or "".join(parts), list(ordinals), kind, None if kind == "null" else value
                i += 1
            if opened:
                continue
            closed = [False, 0, bool(frames)]
        if frames and frames[-1][0]:
            ordinals.pop()
        if closed[2]:
            parts.pop()
        if not frames:
            return


def _events_or_none(text: str) -> list[tuple] | None:
    try:
        return events(text)
    except ValueError:
        return None


def path_triples(df: DataFrame, key: str, payload: str, under: tuple[str, ...] = (), text_at: tuple[str, ...] = ()) -> DataFrame:
    """(key, path, ordinals, seq, kind, value) of the leaves and the structure of every readable record.

    ``seq`` counts the rows of a record in stored order. ``kind`` is string, number, boolean or null for a leaf, and
    object or array for structure: the record itself (path ''), each element of an array that is one, and empty ones.
    With ``under`` only paths on or below those given come out. A text at a path of ``text_at`` that holds JSON is read in
    its place; everywhere else text is text. Records that are null, empty or no JSON give no row (``unreadable`` has
    them), and so do scalars, which have no path. A byte-order mark, JSON text within a string, a list of one record
    and the wrapping objects in WRAPPERS are opened, in any number of layers. Records may be nested to any depth. Other
    columns of ``df`` are ignored, so their names cannot clash.
    """
    source = df.select(F.col(key).alias("key"), F.col(payload).cast("string").alias("payload")).where(F.col("payload").isNotNull())
    schema = T.StructType([T.StructField("key", source.schema["key"].dataType), *TRIPLE.fields])
    texts = frozenset(text_at)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            chars = 0
            for k, text in zip(batch["key"], batch["payload"]):
                try:
                    record, at = _opened(events(text.lstrip("\ufeff")))
                except ValueError:
                    continue
                if record[at][0] not in (OBJECT, ARRAY):
                    continue
                for i, (p, o, kind, v) in enumerate(_triples(record, at, under, texts)):
                    rows.append((k, p, o, i, kind, v))
                    chars += len(p)
                    if len(rows) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
                        yield pd.DataFrame(rows, columns=schema.names)
                        rows, chars = [], 0
            yield pd.DataFrame(rows, columns=schema.names)

    return source.mapInPandas(parse, schema)


def unreadable(df: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, n_chars) of the records that give no rows: null (n_chars null), empty, no JSON, or no object or array."""
    source = df.select(F.col(key).alias("key"), F.col(payload).cast("string").alias("payload"))

    @F.pandas_udf("boolean")
    def fails(payloads: pd.Series) -> pd.Series:
        def bad(text: str | None) -> bool:
            try:
                record, at = _opened(events((text or "").lstrip("\ufeff")))
            except ValueError:
                return True
            return record[at][0] not in (OBJECT, ARRAY)

        return payloads.map(bad)

    return source.where(fails("payload")).select("key", F.length("payload").cast("long").alias("n_chars"))


def repeated_ancestor(path: Column) -> Column:
    """The longest prefix of a path that ends in an array; '' for what stands once in a record."""
    return F.regexp_extract(path, r"^(.*\[\])", 1)


def path_groups(triples: DataFrame) -> DataFrame:
    """The tables a set of records falls into: each repeated ancestor with its paths and their numbers of leaves."""
    leaves = triples.where(~F.col("kind").isin("object", "array"))
    return leaves.groupBy(repeated_ancestor(F.col("path")).alias("ancestor"), "path").agg(
        F.count("*").alias("n_values"), F.count_if(F.col("kind") == "null").alias("n_null")
    )


def element_rows(triples: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(key, ancestor, ordinals, seq, columns): every group of paths pivoted, a row for each element of its ancestor.

    ``columns`` maps names to tests on ``path`` and ``kind``; of the values of an element that fit, the first in stored
    order is taken. ``seq`` is the place of the element's first row. All groups take one shuffle, and none if the
    triples are parted by ``key``."""
    first = lambda test: F.min_by(F.when(test, F.col("value")), F.when(test, F.col("seq")))
    grouped = triples.groupBy("key", repeated_ancestor(F.col("path")).alias("ancestor"), "ordinals")
    return grouped.agg(F.min("seq").alias("seq"), *[first(test).alias(n) for n, test in columns.items()])


def related_table(triples: DataFrame, ancestor: str, columns: dict[str, str]) -> DataFrame:
    """One flat table: a row for each element of ``ancestor`` ('' for the record), pivoted from its paths.

    ``columns`` maps column names to paths below the ancestor ('' is the element itself). The result has
    ``key``, ``ordinals`` (the link to the parent: all but the last entry) and the named columns; where a path
    occurs twice in an element the first in stored order is taken. An element without any of the columns has a row
    of nulls. Only the wanted paths are shuffled.
    """
    paths = {name: f"{ancestor}.{p}".lstrip(".") if p else ancestor for name, p in columns.items()}
    wanted = triples.where(F.col("path").isin(ancestor, *paths.values()))
    return element_rows(wanted, {n: (F.col("path") == p) & ~F.col("kind").isin("object", "array") for n, p in paths.items()}).select("key", "ordinals", *columns)


def squeeze(text: Column) -> Column:
    """Without white space at the ends, and with one space for each run of it."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\u200b\ufeff]+", " "))


MESH, PIPELINE = "metadata.mesh_terms", "extraction_provenance.extraction_pipeline"
#: Parts of a paper record that some writers store as JSON text.
PAPER_TEXTS = ("metadata", MESH, "extraction_provenance", PIPELINE)
#: Keys under which a term stands in its object.
TERM_KEYS = ("term", "name", "descriptor", "label", "heading", "value")


def mesh_terms(df: DataFrame, key: str = "rec_id", payload: str = "payload") -> DataFrame:
    """(key, term_no, mesh_term, pipeline_name): one row per term of every readable paper record.

    The paths of the terms and of the pipeline are grouped by their repeated ancestor, and each group is pivoted to
    one row for each element; the rows of a record are then put in stored order. ``pipeline_name`` is the first non-blank name
    of the record's extraction pipeline, '' if it has none. Empty input gives an empty result; rows with one key are
    taken as one record, of which the first value of each place counts. Terms are read in any of these forms: texts,
    objects with the text under one of TERM_KEYS (or a chain of them), lists of lists, an object of numbered entries,
    an object that lists them as ``items``, one text with separators, or JSON text of any of these.
    """
    triples = path_triples(df, key, payload, under=(MESH, PIPELINE), text_at=PAPER_TEXTS)
    path, leaf = F.col("path"), ~F.col("kind").isin("object", "array", "null")
    keys = "|".join(TERM_KEYS)
    is_term = leaf & path.rlike(rf"^metadata\.mesh_terms(\.items)?(\[\])*(\.({keys})(\.({keys}))*)?$")
    is_name = (F.col("kind") == "string") & path.rlike(r"^extraction_provenance\.extraction_pipeline(\[\])*(\.name)?$") & (squeeze(F.col("value")) != "")
    # a record's rows come from one task and meet again by its key: the pivot and the order need no further shuffle
    elements = element_rows(triples.where(is_term | is_name).repartition("key"), {"term": is_term, "pipeline": is_name})
    one = elements.groupBy("key").agg(
        F.array_sort(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("seq", "ordinals", "term")))).alias("terms"),
        F.min_by(squeeze(F.col("pipeline")), F.when(F.col("pipeline").isNotNull(), F.col("seq"))).alias("pipeline_name"),
    )
    texts = F.flatten(F.transform("terms", lambda t: F.transform(F.split(t["term"], "[;|]"), squeeze)))
    return one.select(
        F.col("key").alias(key),
        F.posexplode(F.filter(texts, lambda x: x != "")).alias("no", "mesh_term"),
        F.coalesce("pipeline_name", F.lit("")).alias("pipeline_name"),
    ).select(key, F.col("no").cast("long").alias("term_no"), "mesh_term", "pipeline_name")
