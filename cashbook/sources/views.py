"""View replay (S14) and the ``_`` placeholder function (U-1).

Source views are recreated in the warehouse after all tables are in place.
Views may depend on each other in any listing order: each text is parsed once,
the relations its unresolved plan names give the dependencies among the
views, and the views are created in topological order, one attempt each.  A
view in a cycle, or behind a view that failed, fails with that as its reason.
Views are created with ``CREATE OR REPLACE`` -- never a cascading drop, which
would silently delete views made earlier in the run.

The source prints reserved, mixed-case and non-ASCII names in double quotes,
so the texts are read with double quotes as identifiers.  In a warehouse with
a namespace, schemas are given its prefix where the parser found them to be
schemas: in the names of relations and functions, and in columns that are
qualified by such a relation.  Aliases, texts and comments are left alone.

Source views call ``_(text)``, an identity stub for translated labels; it is
created as a persistent SQL function (persistent views may only call
persistent functions) in ``public`` and in the current schema, so both
qualified and unqualified calls resolve.
"""

from __future__ import annotations

import logging
import re
from collections import deque
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import SparkSession

from cashbook.sources.warehouse import Warehouse, qualified, quote_ident

log = logging.getLogger(__name__)


@dataclass
class ViewReport:
    created: list[tuple[str, str]] = field(default_factory=list)
    missing_sql: list[tuple[str, str]] = field(default_factory=list)
    failed: dict[tuple[str, str], str] = field(default_factory=dict)
    attempts: int = 0


def ensure_placeholder_function(spark: SparkSession, schema: str = "public") -> None:
    """U-1: ``_(x STRING) RETURNS STRING`` returning its argument."""
    targets = [schema]
    current = spark.catalog.currentDatabase()
    if current != schema:
        targets.append(current)
    for s in targets:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_ident(s)}")
        spark.sql(f"CREATE OR REPLACE FUNCTION {quote_ident(s)}.`_`(x STRING) "
                  "RETURNS STRING DETERMINISTIC RETURN x")


def _drop_table_of_same_name(spark: SparkSession, schema: str, name: str) -> None:
    """An object that was a table in an earlier run and is a view now.

    Warehouse tables are external (their files live in versioned folders), so
    dropping the catalogue entry removes no data.
    """
    qn = qualified(schema, name)
    if spark.catalog.tableExists(qn) and spark.catalog.getTable(qn).tableType not in (
            "VIEW", "TEMPORARY"):
        spark.sql(f"DROP TABLE {qn}")


@dataclass
class ParsedView:
    """What the parser finds in a view's text: names with the place of their first part."""
    text: str
    relations: list[tuple[int, list[str]]] = field(default_factory=list)
    functions: list[tuple[int, list[str]]] = field(default_factory=list)
    columns: list[tuple[int, list[str]]] = field(default_factory=list)
    ctes: set[str] = field(default_factory=set)


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def parse_view(spark: SparkSession, sql: str) -> ParsedView:
    """Names in the unresolved plan of ``sql``; a text that does not parse raises ``ParseException``."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    view = ParsedView(sql)
    todo = [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        found, names = {"UnresolvedRelation": (view.relations, "multipartIdentifier"),
                        "UnresolvedFunction": (view.functions, "nameParts"),
                        "UnresolvedAttribute": (view.columns, "nameParts")}.get(kind, (None, None))
        start = node.origin().startIndex()
        if found is not None and start.isDefined():
            found.append((start.get(), _items(getattr(node, names)())))
        elif kind == "UnresolvedStar" and start.isDefined() and node.target().isDefined():
            view.columns.append((start.get(), _items(node.target().get()) + ["*"]))
        elif kind == "UnresolvedWith":
            view.ctes |= {_items(r.productIterator().toSeq())[0].lower() for r in _items(node.cteRelations())}
        todo += _items(node.children()) + _items(node.innerChildren())     # the latter: subqueries and CTEs
        if "expressions" in dir(node):
            todo += _items(node.expressions())
    return view


_FIRST_PART = re.compile(r'"(?:[^"]|"")*"|`(?:[^`]|``)*`|[^\s."`]+')


def in_namespace(view: ParsedView, schemas: set[str], prefix: str) -> str:
    """The view's text with ``prefix`` before each of ``schemas`` that stands for a schema."""
    known = {tuple(x.lower() for x in name) for _, name in view.relations if len(name) == 2}
    places = [at for at, name in view.relations + view.functions if len(name) == 2 and name[0].lower() in schemas]
    places += [at for at, name in view.columns if len(name) > 2 and name[0].lower() in schemas
               and (name[0].lower(), name[1].lower()) in known]
    text = view.text
    for at in sorted(set(places), reverse=True):
        first = _FIRST_PART.match(text, at)
        name = first.group()
        name = name[1:-1] if name[0] in "\"`" else name
        text = text[:at] + quote_ident(prefix + name) + text[first.end():]
    return text


@contextmanager
def _double_quoted_identifiers(spark: SparkSession):
    conf = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def creation_order(needs: dict[str, set[str]]) -> tuple[list[str], set[str]]:
    """Keys after all they need, otherwise in the given order, and those that need themselves through others."""
    waiting = {key: set(n) & set(needs) for key, n in needs.items()}
    needed_by: dict[str, list[str]] = {}
    for key, n in waiting.items():
        for other in n:
            needed_by.setdefault(other, []).append(key)
    ready = deque(key for key, n in waiting.items() if not n)
    order = []
    while ready:
        key = ready.popleft()
        order.append(key)
        for other in needed_by.get(key, []):
            waiting[other].discard(key)
            if not waiting[other]:
                ready.append(other)
    return order, set(needs) - set(order)


def replay_views(spark: SparkSession, views: list[tuple[str, str, str | None]],
                 placeholder_schema: str = "public", warehouse: Warehouse | None = None) -> ViewReport:
    """Create ``views`` = [(schema, name, spark_sql_text)] in dependency order.

    With a ``warehouse`` they go to its schemas; the report has their own names.
    """
    prefix = f"{warehouse.namespace}_" if warehouse is not None and warehouse.namespace else ""
    schemas = {v[0].lower() for v in views} | {s.lower() for s in _schemas_of(warehouse)} if prefix else set()
    with _double_quoted_identifiers(spark):
        return _replay(spark, views, placeholder_schema, schemas, prefix)


def _schemas_of(warehouse: Warehouse) -> list[str]:
    cut = len(warehouse.namespace) + 1
    return [d.name[cut:] for d in warehouse.spark.catalog.listDatabases(f"{warehouse.namespace}_*")]


def _replay(spark: SparkSession, views: list[tuple[str, str, str | None]], placeholder_schema: str,
            schemas: set[str], prefix: str) -> ViewReport:
    ensure_placeholder_function(spark, prefix + placeholder_schema)
    rep = ViewReport()
    parsed: dict[str, tuple[str, str, ParsedView]] = {}
    for schema, name, sql in views:
        if not sql:
            log.warning("no definition for view %s.%s; skipped", schema, name)
            rep.missing_sql.append((schema, name))
            continue
        try:
            parsed[f"{schema}.{name}".lower()] = (schema, name, parse_view(spark, sql))
        except ParseException as e:
            rep.failed[(schema, name)] = str(e).strip().split("\n")[0]
    by_name: dict[str, list[str]] = {}
    for key in parsed:
        by_name.setdefault(key.split(".", 1)[1], []).append(key)

    needs: dict[str, set[str]] = {}
    for key, (_, _, view) in parsed.items():
        needs[key] = set()
        for _, relation in view.relations:
            other = ".".join(x.lower() for x in relation[-2:])
            if len(relation) == 1 and other not in view.ctes and len(by_name.get(other, [])) == 1:
                other = by_name[other][0]              # unqualified reference to a view
            needs[key].add(other)
    order, cyclic = creation_order(needs)
    for key in sorted(cyclic):
        rep.failed[parsed[key][:2]] = "in a cycle of views, or needs one: " + ", ".join(sorted(needs[key] & cyclic))
    for key in order:
        schema, name, view = parsed[key]
        gone = [f"{s}.{n}" for s, n in rep.failed if f"{s}.{n}".lower() in needs[key]]
        if gone:
            rep.failed[(schema, name)] = "needs views that failed: " + ", ".join(gone)
            continue
        rep.attempts += 1
        target = prefix + schema
        try:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_ident(target)}")
            _drop_table_of_same_name(spark, target, name)
            spark.sql(f"CREATE OR REPLACE VIEW {qualified(target, name)} AS {in_namespace(view, schemas, prefix)}")
        except AnalysisException as e:
            rep.failed[(schema, name)] = str(e).split("\n")[0]
            continue
        rep.created.append((schema, name))
    return rep
