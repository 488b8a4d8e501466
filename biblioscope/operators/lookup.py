"""Point look-ups, filters, projections, order and pages, and a fluent query over them."""

from __future__ import annotations

import contextlib
import io
import time
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_id(df: DataFrame, key: str, value: str | None) -> DataFrame:
    """The rows with a key; none for a missing or empty one."""
    return df.where(F.col(key) == value) if value else df.where(F.lit(False))


def by_ontology_id(entities: DataFrame, entity_type: str, value: str, key: str = "entity_id") -> DataFrame:
    """The first entity of a type with an ontology id."""
    return entities.where((F.col("type") == entity_type) & (F.col(key) == value)).orderBy(key).limit(1)


def synonym_index(entities: DataFrame) -> DataFrame:
    """(key, entity_id, kind): every name, synonym and abbreviation in lower case."""
    none = F.array().cast("array<string>")
    kinds = [("name", F.array("name"))] + [(k, F.coalesce(c, none)) for k, c in (("synonym", "synonyms"), ("abbreviation", "abbreviations")) if c in entities.columns]

    def of_kind(kind: str, forms: Column) -> Column:
        return F.transform(forms, lambda x: F.struct(F.lower(x).alias("key"), F.lit(kind).alias("kind")))

    listed = F.flatten(F.array(*[of_kind(k, c) for k, c in kinds]))
    return entities.select("entity_id", F.explode(listed).alias("x")).select("x.key", "entity_id", "x.kind").where("key IS NOT NULL").distinct()


def matching(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows equal to every given value; a column of the table is taken, else a key of its ``properties``."""

    def test(name: str, value: object) -> Column:
        if name in df.columns:
            return F.col(name) == value
        return F.variant_get("properties", f"$.{name}", "string") == str(value)

    return df.where(reduce(lambda a, b: a & b, (test(k, v) for k, v in wanted.items()), F.lit(True)))


def find_relationships(relationships: DataFrame, subject_id: str | None = None, predicate: str | None = None, object_id: str | None = None, min_confidence: float | None = None, limit: int | None = None) -> DataFrame:
    """Triples by any of their parts. None and '' stand for anything; rows without a predicate are left out."""
    test = F.col("predicate").isNotNull()
    for name, value in (("subject_id", subject_id), ("predicate", predicate.lower() if predicate else None), ("object_id", object_id)):
        if value:
            test &= F.col(name) == value
    if min_confidence is not None:
        test &= F.col("confidence") >= float(min_confidence)
    found = relationships.where(test)
    return found if limit is None else found.orderBy("subject_id", "predicate", "object_id").limit(limit)


def name_search(entities: DataFrame, query: str, entity_type: str | None = None, limit: int | None = None) -> DataFrame:
    """Entities whose name holds a text, without regard to case; '%' and '_' mean themselves."""
    found = entities.where(F.contains(F.lower("name"), F.lit(query.lower())))
    if entity_type:
        found = found.where(F.col("entity_type") == entity_type)
    return found if limit is None else found.orderBy("entity_id").limit(limit)


def with_evidence(relationships: DataFrame, evidence: DataFrame, study_types: list[str]) -> DataFrame:
    """Triples with an item of evidence from one of the study types."""
    return relationships.join(evidence.where(F.col("study_type").isin(study_types)).select("subject_id", "predicate", "object_id"), ["subject_id", "predicate", "object_id"], "left_semi")


def known_predicates(relationships: DataFrame, known: list[str], strict: bool = False) -> DataFrame:
    """Rows whose predicate is known; in strict mode a row without or with another one is an error."""
    if not strict:
        return relationships.where(F.col("predicate").isin(known))
    checked = F.when(F.col("predicate").isNull(), F.raise_error(F.lit("NULL predicate"))).when(~F.col("predicate").isin(known), F.raise_error(F.concat(F.lit("unknown predicate "), F.col("predicate")))).otherwise(F.col("predicate"))
    return relationships.withColumn("predicate", checked)


def page(df: DataFrame, order: list, limit: int | None, offset: int = 0) -> DataFrame:
    """``limit`` rows after ``offset`` in an explicit order; None is all, 0 none."""
    ordered = df.orderBy(*order).offset(offset)
    return ordered if limit is None else ordered.limit(limit)


@dataclass(frozen=True)
class GraphQuery:
    """A query under construction; every method gives a new one, ``frame`` the DataFrame.

    ``tables`` holds the DataFrames entities, relationships and, for evidence, evidence; for a semantic search vectors
    (id, embedding), and ``embed``, a function from a text to its vector, where texts are asked for.
    """

    tables: dict
    kind: str | None = None
    wanted: tuple = ()
    part: tuple = ()
    order: tuple = ()
    most: int | None = None
    study_types: tuple = ()
    path: tuple = ()

    def entities(self, entity_type: str | None = None) -> "GraphQuery":
        return replace(self, kind="entities", part=(("entity_type", entity_type),) if entity_type else ())

    def relationships(self, predicate: str | None = None, subject_id: str | None = None, object_id: str | None = None, min_confidence: float | None = None) -> "GraphQuery":
        return replace(self, kind="relationships", part=tuple({"predicate": predicate, "subject_id": subject_id, "object_id": object_id, "min_confidence": min_confidence}.items()))

    def traverse(self, start: str, path: list[str]) -> "GraphQuery":
        """Steps are 'PREDICATE:type' or 'PREDICATE'."""
        return replace(self, kind="traverse", part=(("start", start),), path=tuple(path))

    def semantic_search(self, query: str | list[float], entity_type: str | None = None, k: int = 10, threshold: float | None = 0.7) -> "GraphQuery":
        """Entities by similarity to a vector, or to a text if the tables have ``embed``."""
        vector = self.tables["embed"](query) if isinstance(query, str) else query
        return replace(self, kind="semantic", part=(("entity_type", entity_type), ("query", list(vector)), ("k", k), ("threshold", threshold)))

    def filter(self, **wanted: object) -> "GraphQuery":
        return replace(self, wanted=tuple({**dict(self.wanted), **wanted}.items()))

    def with_evidence(self, *study_types: str) -> "GraphQuery":
        return replace(self, study_types=study_types)

    def order_by(self, column: str, descending: bool = False) -> "GraphQuery":
        return replace(self, order=(column, descending))

    def limit(self, n: int) -> "GraphQuery":
        return replace(self, most=n)

    def frame(self) -> DataFrame:
        if self.kind == "entities":
            df, keys = matching(self.tables["entities"], **dict(self.part), **dict(self.wanted)), ["entity_id"]
        elif self.kind == "relationships":
            df, keys = matching(find_relationships(self.tables["relationships"], **dict(self.part)), **dict(self.wanted)), ["subject_id", "predicate", "object_id"]
            if self.study_types:
                df = with_evidence(df, self.tables["evidence"], list(self.study_types))
        elif self.kind == "traverse":
            from biblioscope.operators.joins import traverse

            df, keys = traverse(self.tables["relationships"], self.tables["entities"], dict(self.part)["start"], list(self.path)), ["path"]
        elif self.kind == "semantic":
            from biblioscope.operators.similarity import nearest

            part = dict(self.part)
            wanted = {**({"entity_type": part["entity_type"]} if part["entity_type"] else {}), **dict(self.wanted)}
            vectors = self.tables["vectors"]
            if wanted:
                keep = matching(self.tables["entities"], **wanted).select(F.col("entity_id").alias("id")).distinct()
                vectors = vectors.join(keep, "id", "left_semi")
            df = nearest(vectors, part["query"], part["k"], part["threshold"]).withColumnRenamed("id", "entity_id")
            return df if self.most is None else df.limit(self.most)
        else:
            raise ValueError("no entities, relationships, traversal or search were asked for")
        if self.order or self.most is not None:
            first = [F.desc(self.order[0]) if self.order[1] else F.asc(self.order[0])] if self.order else []
            df = df.orderBy(*first, *keys)
        return df if self.most is None else df.limit(self.most)

    def to_sql(self) -> str:
        """How the query will be run, as text; nothing is run."""
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            self.frame().explain("formatted")
        return text.getvalue()

    def execute(self) -> "GraphResult":
        return GraphResult(self.frame(), self.to_sql())


class GraphResult:
    """The result of a query: a DataFrame that is run when its rows or their number are asked for."""

    def __init__(self, frame: DataFrame, plan: str):
        self._frame, self.query_sql = frame, plan
        self._count: int | None = None
        self.query_time_ms: float | None = None

    @property
    def count(self) -> int:
        """The number of rows, counted once; the time it took is ``query_time_ms``."""
        if self._count is None:
            began = time.perf_counter()
            self._count = self._frame.count()
            self.query_time_ms = (time.perf_counter() - began) * 1000
        return self._count

    @property
    def results(self) -> Iterator[dict]:
        """The rows one by one; they come to the driver by partitions, not as a whole."""
        return (r.asDict(recursive=True) for r in self._frame.toLocalIterator())

    def to_dataframe(self) -> DataFrame:
        return self._frame

    def to_json(self) -> DataFrame:
        """(value): one JSON text for each row."""
        return self._frame.select(F.to_json(F.struct("*")).alias("value"))
