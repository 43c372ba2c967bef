"""What a query may do, judged by its analysed plan before anything of it runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Groups of built-in functions that only compute on their arguments. Left out are the miscellaneous ones (Java
# calls, file names, users, versions), generators, table functions and readers of embedded formats.
FUNCTION_GROUPS = (
    "agg_funcs", "array_funcs", "bitwise_funcs", "collection_funcs", "conditional_funcs", "conversion_funcs", "datetime_funcs",
    "hash_funcs", "lambda_funcs", "map_funcs", "math_funcs", "predicate_funcs", "string_funcs", "struct_funcs", "window_funcs",
)
# Expressions that the language itself makes, and the operators that a query may be made of.
SYNTAX = (
    "Alias", "AttributeReference", "OuterReference", "Literal", "Cast", "SortOrder", "AggregateExpression", "WindowExpression",
    "WindowSpecDefinition", "SpecifiedWindowFrame", "UnboundedPreceding$", "UnboundedFollowing$", "CurrentRow$",
    "UnspecifiedFrame$", "ScalarSubquery", "Exists", "ListQuery", "InSubquery", "GetStructField", "GetArrayItem", "GetMapValue",
    "CreateNamedStruct", "CaseWhen", "If", "In", "LambdaFunction", "NamedLambdaVariable", "Contains", "StartsWith", "EndsWith",
    "LikeAll", "LikeAny", "NotLikeAll", "NotLikeAny", "PivotFirst",
)
OPERATORS = (
    "Project", "Filter", "Aggregate", "Join", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Distinct", "Deduplicate", "Union",
    "Intersect", "Except", "SubqueryAlias", "View", "WithCTE", "CTERelationDef", "CTERelationRef", "Window", "Expand", "Pivot",
    "LocalRelation", "OneRowRelation", "LogicalRelation", "ResolvedHint", "Unpivot",
)
_NO_ROWS = ("LocalRelation", "OneRowRelation", "CTERelationRef")


def _all(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _name(node) -> str:
    return node.getClass().getName()


def _short(node) -> str:
    return _name(node).rpartition(".")[2]


@lru_cache
def _functions(application: str) -> tuple[frozenset[str], frozenset[str]]:
    """(names, classes) of the built-in functions of the allowed groups."""
    spark = SparkSession.active()
    registry = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    names, classes = set(), set()
    for identifier in _all(registry.listFunction().toSeq()):
        info = registry.lookupFunction(identifier).get()
        if info.getGroup() in FUNCTION_GROUPS:
            names.add(identifier.funcName())
            classes.add(info.getClassName())
    return frozenset(names), frozenset(classes)


def allowed_functions(spark: SparkSession) -> frozenset[str]:
    return _functions(spark.sparkContext.applicationId)[0]


def _analysed(df: DataFrame):
    return df._jdf.queryExecution().analyzed()


def _folders(leaf) -> set[str]:
    """Files or folders that a leaf of a plan reads; a leaf that reads anything else is its own class name."""
    if _short(leaf) != "LogicalRelation" or not hasattr(leaf.relation(), "location"):
        return {_name(leaf)}
    return {p.toString() for p in _all(leaf.relation().location().rootPaths())}


def _walk(plan) -> Iterator[tuple[str, object]]:
    """Every operator and expression of a plan with its kind, those of subqueries and of common tables too."""
    waiting = [("operator", plan)]
    while waiting:
        kind, node = waiting.pop()
        yield kind, node
        if kind == "operator":
            waiting += [("operator", c) for c in _all(node.children())]
            waiting += [("operator", c) for c in _all(node.innerChildren()) if hasattr(c, "innerChildren") and _is_plan(c)]
            waiting += [("expression", e) for e in _all(node.expressions())]
            continue
        if _short(node) in ("ScalarSubquery", "Exists", "ListQuery"):
            waiting.append(("operator", node.plan()))
        # what a function is replaced by is Spark's own; its arguments are the query's
        arguments = node.parameters() if _is_replaced(node) else node.children()
        waiting += [("expression", e) for e in _all(arguments)]


@lru_cache
def _class(name: str):
    return SparkSession.active()._jvm.java.lang.Class.forName(name)


def _is_plan(node) -> bool:
    return _class("org.apache.spark.sql.catalyst.plans.logical.LogicalPlan").isInstance(node)


def _is_replaced(node) -> bool:
    return _class("org.apache.spark.sql.catalyst.expressions.InheritAnalysisRules").isInstance(node)


def inspected(df: DataFrame) -> tuple[set[str], set[str]]:
    """(what is on no list, what the leaves read) of the analysed plan, which is walked with its subqueries and common tables."""
    classes = _functions(df.sparkSession.sparkContext.applicationId)[1]
    strange, read = set(), set()
    for kind, node in _walk(_analysed(df)):
        name = _name(node)
        short = name.rpartition(".")[2]
        if kind == "expression":
            if name not in classes and short not in SYNTAX:
                strange.add(f"function {node.prettyName()}")
            continue
        if short.rstrip("$") not in OPERATORS:
            strange.add(f"operator {short}")
        if short.rstrip("$") not in _NO_ROWS and node.children().isEmpty():
            read |= _folders(node)
    return strange, read


def sources(df: DataFrame) -> set[str]:
    """The files and folders that the frame reads."""
    return inspected(df)[1]


def objections(df: DataFrame, readable: Iterable[str]) -> list[str]:
    """Why the frame goes beyond reading ``readable`` (see :func:`sources`) and computing with allowed functions.

    Every operator, expression and source must be on a list; what is on none is refused, so functions of any language that
    users define, Java calls, generators, table functions, commands and foreign files or tables are. Nothing of it runs.
    """
    strange, read = inspected(df)
    return sorted(strange | {f"source {s}" for s in read - set(readable)})


def restrict_functions(session: SparkSession) -> None:
    """Take all but the allowed functions and every table function out of a session of its own, so SQL can't name them."""
    allowed = allowed_functions(session)
    state = session._jsparkSession.sessionState()
    for registry, keep in ((state.functionRegistry(), allowed), (state.tableFunctionRegistry(), frozenset())):
        for identifier in _all(registry.listFunction().toSeq()):
            if identifier.funcName() not in keep:
                registry.dropFunction(identifier)


def is_query(session: SparkSession, text: str) -> bool:
    """Whether the text parses to a query: commands run while they are analysed, so they must be told apart before."""
    plan = session._jsparkSession.sessionState().sqlParser().parsePlan(text)
    return not any(_class("org.apache.spark.sql.catalyst.plans.logical.Command").isInstance(node) or _short(node).startswith("Insert")
                   for node in _nodes(plan))


def _nodes(plan) -> Iterator[object]:
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += _all(node.children())
