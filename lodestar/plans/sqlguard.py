"""Read-only ad-hoc SQL.

A statement is admitted when Spark parses it as the body of a view -- i.e.
it is a query -- checked with ``EXPLAIN CREATE TEMPORARY VIEW ... AS <text>``,
which parses and plans without creating anything.  This refuses writes that
start with another word (``WITH ... INSERT``, ``/* */ INSERT``,
``FROM ... INSERT``), several statements, ``SET`` and blank text.  The nodes of
the analysed plan decide the rest: script transformations (shell commands) and
calls of JVM methods by name are refused wherever they stand, whatever the text
looks like.  So do its relations: files named by their path are refused, and,
given a list of published names, every table and view that is not on it; what
lies inside a published view is the publisher's choice.  ``SHOW``/``DESCRIBE`` statements are admitted through a separate
short allow-list, ``EXPLAIN`` when its query is admitted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

_VIEW = "__lodestar_guard_probe"
_COMMENT = re.compile(r"\s*(?:--[^\n]*(?:\n|\Z)|/\*.*?\*/)", re.S)
_ALLOWED_META = re.compile(r"\s*(SHOW|DESCRIBE|DESC)\s", re.IGNORECASE)
_EXPLAIN = re.compile(r"\s*EXPLAIN\s+(?:(?:EXTENDED|FORMATTED|COST|CODEGEN)\s+)?", re.IGNORECASE)
# Plan nodes and expressions that run code outside Spark SQL.
DENIED_NODES = frozenset({"ScriptTransformation", "ScriptInputOutputSchema", "CallMethodViaReflection", "TryReflect"})


class UnsafeSQLError(ValueError):
    """The text is not a single read-only query."""


def _strip(text: str) -> str:
    t = text.strip()
    while t.endswith(";"):
        t = t[:-1].rstrip()
    return t


def _without_leading_comments(text: str) -> str:
    while m := _COMMENT.match(text):
        text = text[m.end():]
    return text


def _node_names(value) -> set[str]:
    """Class names of all nodes in a plan's JSON, expressions and subqueries included."""
    found, todo = set(), [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if isinstance(x.get("class"), str):
                found.add(x["class"].rpartition(".")[2])
            todo.extend(x.values())
        elif isinstance(x, list):
            todo.extend(x)
    return found


# Leaves of a plan that read nothing stored.
_MADE = frozenset({"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"})


def _seq(jvm_seq) -> list:
    return [jvm_seq.apply(i) for i in range(jvm_seq.size())]


def _name(identifier) -> str:
    """A catalog identifier as ``table`` or ``database.table``, the session's own database left out."""
    parts = identifier.unquotedString().lower().split(".")
    return ".".join(parts[1:] if parts[0] == "spark_catalog" else parts).removeprefix("default.")


def relations(spark: SparkSession, query: str) -> set[str]:
    """Names of the tables and views that a query reads, its subqueries included; a nameless one (a file path) as its plan node in brackets."""
    found, todo = set(), [spark.sql(query)._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        kind, children = node.nodeName(), _seq(node.children())
        if kind == "View":
            found.add(_name(node.desc().identifier()))
            continue
        todo += children + _seq(node.subqueries())
        if children or kind in _MADE:
            continue
        table = node.catalogTable() if kind == "LogicalRelation" else None
        if table is not None and table.isDefined():
            found.add(_name(table.get().identifier()))
        elif kind == "HiveTableRelation":
            found.add(_name(node.tableMeta().identifier()))
        else:
            found.add(f"[{kind}]")
    return found


def _check_relations(spark: SparkSession, query: str, published: Collection[str] | None) -> None:
    read = relations(spark, query)
    allowed = None if published is None else {n.lower().removeprefix("default.") for n in published}
    refused = sorted(n for n in read if n.startswith("[") or allowed is not None and n not in allowed)
    if refused:
        raise UnsafeSQLError(f"not published: {refused}")


def _check_query(spark: SparkSession, query: str) -> None:
    try:
        plan = spark.sql(f"EXPLAIN EXTENDED CREATE OR REPLACE TEMPORARY VIEW {_VIEW} AS {query}").collect()
    except Exception as e:  # parse or analysis error: not a query
        raise UnsafeSQLError(f"not a read-only query: {str(e).splitlines()[0][:200]}") from e
    text_plan = " ".join(r[0] for r in plan).lower()
    if "error occurred during query planning" in text_plan or "parseexception" in text_plan:
        raise UnsafeSQLError("not a read-only query")
    analysed = spark.sql(query)._jdf.queryExecution().analyzed()  # a query: analysed, not run
    denied = _node_names(json.loads(analysed.toJSON())) & DENIED_NODES
    if denied:
        raise UnsafeSQLError(f"not allowed in read-only SQL: {sorted(denied)}")


def check_read_only(spark: SparkSession, text: str, published: Collection[str] | None = None) -> str:
    """Return the statement without trailing ';' or raise ``UnsafeSQLError``.

    ``published``: the only tables and views that a query may name; without it
    all of the catalog, but no files.
    """
    if text is None or not text.strip():
        raise UnsafeSQLError("empty statement")
    q = _strip(_without_leading_comments(text))
    if not q:
        raise UnsafeSQLError("empty statement")
    if _ALLOWED_META.match(q) and ";" not in q:
        return q
    explained = _EXPLAIN.match(q)
    query = _without_leading_comments(q[explained.end():]) if explained else q
    _check_query(spark, query)
    _check_relations(spark, query, published)
    return q


def read_only_sql(spark: SparkSession, text: str, limit: int | None = None,
                  published: Collection[str] | None = None) -> DataFrame:
    q = check_read_only(spark, text, published)
    df = spark.sql(q)
    return df.limit(limit) if limit else df
