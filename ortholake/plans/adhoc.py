"""Guarded ad-hoc SQL over the catalogue views.

The statement is analysed in a session of its own that holds the catalogue's views and no other temporary ones, and
it runs only if nothing speaks against it: no data-changing word (the studied app's list); a query, no
command or other statement; and, in the resolved plan with its subqueries, no relation but those
views (so no file path and no table of the session's databases) and no call of Java methods. What counts is the plan that
would run, not the statement's text, so quoting, comments and names of common table expressions
change nothing. ``{{ limit }}`` becomes 100 and ``?`` placeholders become NULL; at
most ``max_rows`` rows are returned, and every row tells in ``truncated`` whether there were more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ortholake.catalog import Catalog

# Words refused in ad-hoc statements, the template limit and the row cap.
FORBIDDEN_WORDS = ["CREATE", "DROP", "ALTER", "INSERT", "UPDATE", "DELETE", "TRUNCATE", "VACUUM"]
TEMPLATE_LIMIT = 100
MAX_ROWS = 1000
#: Plan nodes without children that hold no data of others: values and ranges written in the statement, references to its own expressions.
OWN_LEAVES = {"LocalRelation", "OneRowRelation", "Range", "CTERelationRef", "UnionLoopRef", "EmptyRelation"}


class RefusedQuery(ValueError):
    pass


def prepare(sql: str) -> str:
    upper = sql.upper()
    for w in FORBIDDEN_WORDS:
        if w in upper:
            raise RefusedQuery(f"statement contains {w}")
    sql = re.sub(r"\{\{\s*limit\s*\}\}", str(TEMPLATE_LIMIT), sql)
    return sql.replace("?", "NULL")


def _items(seq) -> Iterator:
    for i in range(seq.length()):
        yield seq.apply(i)


def _name(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _kinds(node) -> set[str]:
    """Simple names of the node's class and all that it extends."""
    out, todo = set(), [node.getClass()]
    while todo:
        c = todo.pop()
        out.add(c.getSimpleName())
        todo += [*c.getInterfaces(), *([c.getSuperclass()] if c.getSuperclass() is not None else [])]
    return out


def isolated_session(cat: Catalog) -> SparkSession:
    """A session with the catalogue's views, the caller's settings and no temporary views of others."""
    own = cat.spark.newSession()
    for k, v in cat.spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    of_rows = cat.spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows
    for name in cat.names:
        of_rows(own._jsparkSession, cat[name]._jdf.logicalPlan()).createOrReplaceTempView(name)
    return own


def _refuse_expression(e) -> None:
    if _name(e) in ("CallMethodViaReflection", "TryReflect", "StaticInvoke", "Invoke"):
        raise RefusedQuery("calls of Java methods are not allowed")
    for child in _items(e.children()):
        _refuse_expression(child)


def _walk(node, views: set[str]) -> None:
    """Refuse a resolved plan that reaches beyond the views."""
    if _name(node) == "View":
        if not node.isTempView() or node.desc().identifier().table().lower() not in views:
            raise RefusedQuery(f"relation {node.desc().identifier().table()} is not a catalogue view")
        return                                                 # what a view reads is the catalogue's
    if "Command" in _kinds(node):
        raise RefusedQuery(f"statement is no query ({node.nodeName()})")
    children = list(_items(node.children()))
    inner = list(_items(node.subqueries()))
    if not children and not inner and _name(node) not in OWN_LEAVES:
        raise RefusedQuery(f"relation {node.nodeName()} is not a catalogue view")
    for e in _items(node.expressions()):
        _refuse_expression(e)
    for other in [*children, *inner, *[p for p in _items(node.innerChildren()) if "LogicalPlan" in _kinds(p)]]:
        _walk(other, views)


def check(session: SparkSession, sql: str, views: list[str]) -> None:
    """Refuse, before anything runs, what is not a plain query over ``views``. ``session``: see
    ``isolated_session``; nothing but the views can be named in it without leaving a trace in the plan."""
    state = session._jsparkSession.sessionState()
    plan = state.sqlParser().parsePlan(sql)
    if _kinds(plan) & {"Command", "ParsedStatement", "CompoundBody"}:
        raise RefusedQuery(f"statement is no query ({plan.nodeName()})")
    try:
        resolved = state.analyzer().execute(plan)
        state.analyzer().checkAnalysis(resolved)
    except AnalysisException as e:
        raise RefusedQuery(str(e)) from e
    _walk(resolved, {v.lower() for v in views})


def _checked(cat: Catalog, sql: str) -> DataFrame:
    session, text = isolated_session(cat), prepare(sql)
    check(session, text, cat.names)
    return session.sql(text)


def guarded_sql(cat: Catalog, sql: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` rows of the statement, with ``truncated``. The statement runs once: of at
    most ``max_rows`` + 1 rows, the window counts all and keeps the first ones in their order."""
    rows = _checked(cat, sql).limit(max_rows + 1)
    cols = rows.columns
    some = Window.orderBy("_place")
    rows = rows.toDF(*[f"c{i}" for i in range(len(cols))]).withColumn("_place", F.monotonically_increasing_id())
    rows = rows.withColumn("_rank", F.row_number().over(some)).withColumn("_all", F.count(F.lit(1)).over(Window.partitionBy()))
    return rows.filter(F.col("_rank") <= max_rows).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)], (F.col("_all") > max_rows).alias("truncated"))


def guarded_sql_result(cat: Catalog, sql: str, max_rows: int = MAX_ROWS) -> tuple[list, bool]:
    """The rows on the driver (``max_rows`` at most) and the flag."""
    rows = _checked(cat, sql).limit(max_rows + 1).collect()
    return rows[:max_rows], len(rows) > max_rows
