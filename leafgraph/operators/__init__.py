"""Operators: a table of documents in, a relation of the document model out.

``tokens(documents)``, ``instances(documents)``, ``heading_violations(documents)`` and so on: one function for each
relation in ``leafgraph.plans.relations``, all with the same shape.  ``classify`` and ``analyse`` combine several.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafgraph.config import Config
from leafgraph.operators import counts, sweeps
from leafgraph.operators.parser import parse_documents
from leafgraph.plans.dialect import SPARK, Spark
from leafgraph.plans.relations import RELATIONS, closure, compile_sql, uses
from leafgraph.plans.rules import LAYER_TYPES
from leafgraph.session import append, materialised, staged_path, unstage


#: Relations that a plan which reads them several times writes out once.
SHARED = ("nodes", "tokens", "marks", "emphasis", "instances", "parents", "components", "component_tokens", "nesting_depth", "coverage_stats", "token_cover")

#: Relations that a pass over the texts stands for, by what the pass reads besides.
SWEPT = {"token_counts": (), "component_tokens": ("components",), "token_owner": ("components",), "token_cover": ("components",)}


#: Relations that need most of the model: what is written for it would be many times the texts, so this relation, and these of
#: its columns, are worked out for one slice of the documents after another, and the rest is made of that.
SLICED = {
    "step_gates": ("step_gates", ("*",)),
    "first_failures": ("step_gates", ("*",)),
    "token_owner": ("components", ("doc_id", "inst_ix", "char_start", "char_end", "component_id")),
    "validation_report": ("validation_report", ("*",)),
}

#: Of these, the ones that a pass over whole documents counts, unless ids are missing or repeated.
COUNTED = ("step_gates", "first_failures", "validation_report")

#: Characters of a slice.
SLICE_CHARS = 1 << 26

Unit = Callable[[DataFrame], DataFrame]

_WHOLE_NUMBERS = ("bigint", "int", "smallint", "tinyint")


class StepError(ValueError):
    """Some documents are stopped at a step."""


class _Plans:
    """The relations of one table of documents.  With ``share``, what several of ``names`` read is written once."""

    def __init__(
        self, documents: DataFrame, names: Iterable[str], share: bool, config: Config | None, given: Mapping[str, DataFrame], units: Mapping[str, Unit]
    ) -> None:
        self.spark, self.frames = documents.sparkSession, {"documents": documents.select("doc_id", "text")}
        self.given: dict[str, str] = {}
        self.dialect = Spark(config, {*given, *units}, given) if config or given or units else SPARK
        if unknown := (set(given) | set(units)) - set(RELATIONS):
            raise KeyError(f"no relations {', '.join(sorted(unknown))}")
        for n, frame in given.items():
            self._give(n, frame, False)
        names = list(names)
        needed = [n for n in RELATIONS if any(n in closure(name, self.dialect) for name in names)]
        if "node_tree" in needed and "node_tree" not in self.given and "node_tree" not in units:
            self._give("node_tree", parse_documents(self.frames["documents"]), share and sum(uses(n, "node_tree", self.dialect) for n in names) > 1)
        for n in needed:
            if n in units:
                self._give(n, units[n](self.frames["documents"] if n == "node_tree" else self._own(n)), share)
            elif share and n in SHARED and n not in self.given and sum(uses(name, n, self.dialect) for name in names if name != n) > 1:
                self._give(n, self._own(n), True)
            elif self._is_swept(n):
                self._give(n, self._own(n), False)

    def _is_swept(self, name: str) -> bool:
        return name in SWEPT and name not in self.given and RELATIONS[name](self.dialect).startswith("select * from swept")

    def _own(self, name: str) -> DataFrame:
        """What the library has for a relation."""
        if self._is_swept(name):
            return getattr(sweeps, name)(self.frames["documents"], *(self.plan(n) for n in SWEPT[name]))
        return self.plan(name)

    def _give(self, name: str, frame: DataFrame, write: bool) -> None:
        self.frames[name] = materialised(frame, name, lean=True) if write else frame
        self.given[name] = f"select * from ::{name}::"

    def drop(self) -> None:
        """Delete what was written.  Frames of these plans can't be used afterwards."""
        for frame in self.frames.values():
            unstage(frame)

    def plan(self, name: str) -> DataFrame:
        if name in self.given:
            return self.frames[name]
        sql = compile_sql(name, self.dialect, "select * from ::documents::", self.given)
        used = {n: frame for n, frame in self.frames.items() if f"::{n}::" in sql}
        return self.spark.sql(_escaped(sql, used), **used)


def relation(
    name: str,
    documents: DataFrame,
    share: bool = True,
    config: Config | None = None,
    given: Mapping[str, DataFrame] | None = None,
    units: Mapping[str, Unit] | None = None,
) -> DataFrame:
    """A relation over ``documents(doc_id, text)``.

    A common subplan would be run again for each of its readers.  With ``share`` the relations of ``SHARED`` that the plan
    reads more than once are written to the shared folder first and read from there; without, the result is one lazy plan.
    ``config`` has the settings.  ``given`` replaces relations by tables, such as ``nesting`` and ``nesting_rules`` by rules of
    one's own or ``block_vectors`` by the vectors of a model.  ``units`` puts a function behind a relation, which gets it and
    returns what is read in its place (``node_tree`` gets the documents: another parser); so a detector is added with
    ``units={"instances": lambda found: found.unionByName(...)}``.
    """
    if name not in RELATIONS:
        raise KeyError(f"no relation {name!r}; there are {', '.join(sorted(RELATIONS))}")
    if share and name in COUNTED and not given and not units and dict(documents.dtypes)["doc_id"] in _WHOLE_NUMBERS:
        return _counted(name, documents, config)
    if share and name in SLICED and not given and not units:
        return _sliced(name, documents, config, {})
    return _Plans(documents, [name], share, config, given or {}, units or {}).plan(name)


def _sliced(name: str, documents: DataFrame, config: Config | None, units: Mapping[str, Unit]) -> DataFrame:
    given: dict[str, DataFrame] = {}
    if (slices := _slices(documents)) > 1:
        whole, columns = SLICED[name]
        given, units = {whole: _by_slices(whole, columns, documents, slices, config, units)}, {}
        if whole == name:
            return given[name]
    return _Plans(documents, [name], True, config, given, units).plan(name)


def _counted(name: str, documents: DataFrame, config: Config | None) -> DataFrame:
    """A relation of ``COUNTED``.  Documents without an id, or with one that others have too, go through the relations."""
    counted = materialised(counts.document_counts(documents), SLICED[name][0], lean=True)
    odd = counted.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id is null or n > 1").select(F.col("doc_id").alias("odd_id"))
    is_odd, rest = F.col("doc_id").eqNullSafe(F.col("odd_id")), None
    if not odd.isEmpty():
        # gates count rows of tokens there; of the token checks, passes say what the rows' order leaves open
        units = {} if name == "validation_report" else {"tokens": lambda found: found}
        rest = _sliced(name, documents.join(odd, is_odd, "left_semi"), config, units)
        counted = counted.join(odd, is_odd, "left_anti")
    counted = counted.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
    if name == "validation_report":
        found = counts.validation_report(counted, (config or Config()).tokenization.include_whitespace)
    else:
        found = counts.step_gates(counted)
        if name == "first_failures":
            found = _Plans(documents, [name], True, config, {"step_gates": found}, {}).plan(name)
    return found if rest is None else found.unionByName(rest)


def _slices(documents: DataFrame) -> int:
    chars = documents.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    return -(-chars // SLICE_CHARS)


def _by_slices(name: str, columns: Iterable[str], documents: DataFrame, slices: int, config: Config | None, units: Mapping[str, Unit]) -> DataFrame:
    """A relation of all documents, of which a slice by document at a time is worked out; what that wrote is deleted before the next."""
    spark = documents.sparkSession
    path = staged_path(spark, name)
    for k in range(slices):
        plans = _Plans(documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(slices)) == k), [name], True, config, {}, units)
        found = plans.plan(name).select(*columns)
        append(found, path)
        plans.drop()
    return spark.read.schema(found.schema).parquet(path)


def nesting_tables(spark: SparkSession, rules_of: Mapping[str, tuple[Iterable[str], int]], leaves: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Nesting rules ``{parent: (children, max depth)}`` as the tables that ``given`` takes."""
    pairs = [(p, c) for p, (children, _) in rules_of.items() for c in children]
    depths = [(p, depth, False) for p, (_, depth) in rules_of.items()] + [(leaf, 0, True) for leaf in leaves]
    return {
        "nesting": spark.createDataFrame(pairs, "parent_type string, child_type string"),
        "nesting_rules": spark.createDataFrame(depths, "layer_type string, max_depth int, is_leaf boolean"),
    }


def node_by_id(documents: DataFrame, component_id: str) -> DataFrame:
    """The components with an id, one a document: the first in document order."""
    found = relation("components", documents).where(F.col("component_id") == component_id)
    return found.groupBy("doc_id").agg(F.min_by(F.struct("*"), "inst_ix").alias("c")).select("c.*")


def _escaped(sql: str, frames: Iterable[str]) -> str:
    """Braces of patterns are no parameters; the names of frames are."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in frames:
        sql = sql.replace(f"::{name}::", f"{{{name}}}")
    return sql


def _operator(name: str) -> Callable[[DataFrame], DataFrame]:
    def run(documents: DataFrame) -> DataFrame:
        return relation(name, documents)

    run.__name__, run.__doc__ = name, f"The relation ``{name}`` of a table of documents."
    return run


globals().update({name: _operator(name) for name in RELATIONS})


def classify(documents: DataFrame, layer_types: list[str] | None = None, config: Config | None = None) -> DataFrame:
    """Instances of the given layer types, by default those of the settings, and by default of these all."""
    if layer_types is None and config is not None and config.topology.layer_types_to_detect is not None:
        layer_types = list(config.topology.layer_types_to_detect)
    unknown = set(layer_types or ()) - set(LAYER_TYPES)
    if unknown:
        raise ValueError(f"unknown layer types: {', '.join(sorted(unknown))}")
    found = relation("instances", documents, config=config)
    return found if layer_types is None else found.where(F.col("layer_type").isin(list(layer_types)))


def analyse(
    documents: DataFrame,
    strict: bool = False,
    config: Config | None = None,
    given: Mapping[str, DataFrame] | None = None,
    units: Mapping[str, Unit] | None = None,
) -> dict[str, DataFrame]:
    """The whole model of a table of documents, by relation name.  What several relations read is written out once.

    ``strict`` raises at the first step that stops a document, as ``first_failures`` says, and if a critical check fails.
    """
    if strict and (bad := check_schema(documents)):
        raise StepError(f"V1.0: {bad}")
    if strict and documents.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")).limit(1).count():
        raise StepError("some documents are blank")
    plans = _Plans(documents, RELATIONS, True, config, given or {}, units or {})
    out = {name: plans.plan(name) for name in RELATIONS}
    if strict:
        stopped = out["first_failures"].groupBy("step_ix", "step").agg(F.count("*").alias("n")).orderBy("step_ix").first()
        if stopped:
            raise StepError(f"{stopped['n']} documents are stopped at {stopped['step']}")
        if out["validation_report"].where("not critical_passed").limit(1).count():
            raise StepError("some documents fail a critical check")
    return out


def check_schema(documents: DataFrame) -> str | None:
    """What is wrong with the shape of a table of documents (check V1.0), or nothing."""
    kinds = dict(documents.dtypes)
    wanted = {"doc_id": _WHOLE_NUMBERS, "text": ("string",)}
    return next((f"column {c} is {kinds.get(c, 'missing')}" for c, allowed in wanted.items() if kinds.get(c) not in allowed), None)


__all__ = ["StepError", "analyse", "check_schema", "classify", "closure", "nesting_tables", "node_by_id", "relation", *RELATIONS]
