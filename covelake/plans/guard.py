"""Read-only SQL: the statement is parsed by Spark, its plan checked node by node, and the result capped.

Only this module reaches into Spark's parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Plan nodes a query may consist of.
ALLOWED = {
    "Project", "Filter", "Aggregate", "Join", "Sort", "Distinct", "GlobalLimit", "LocalLimit", "Offset", "Union", "Intersect", "Except", "SubqueryAlias", "UnresolvedSubqueryColumnAliases", "UnresolvedRelation",
    "UnresolvedInlineTable", "UnresolvedHaving", "With", "UnresolvedWith", "OneRowRelation", "WithWindowDefinition", "Window", "LateralJoin", "Pivot", "Unpivot", "Generate", "LocalRelation", "Range",
}
#: Groups of Spark's own functions that a query may use. Left out is misc_funcs, which reaches outside the tables.
GROUPS = {
    "agg_funcs", "array_funcs", "bitwise_funcs", "collection_funcs", "conditional_funcs", "conversion_funcs", "csv_funcs", "datetime_funcs", "generator_funcs", "hash_funcs", "json_funcs", "lambda_funcs",
    "map_funcs", "math_funcs", "operator_funcs", "predicate_funcs", "string_funcs", "struct_funcs", "url_funcs", "variant_funcs", "window_funcs", "xml_funcs",
}
#: Members of these groups that differ from run to run.
FORBIDDEN = {"now", "current_timestamp", "current_date", "curdate", "current_time", "localtimestamp", "current_timezone", "unix_timestamp", "rand", "random", "randn", "randstr", "uniform", "uuid", "shuffle", "sample"}
#: Functions of the language itself, which the registry may not hold.
PLAIN = {"and", "or", "not", "in", "between", "case", "when", "exists", "struct", "named_struct"}


class Refused(ValueError):
    """The statement isn't a plain query of the allowed tables."""


def _seq(jseq):
    return [jseq.apply(i) for i in range(jseq.size())]


def _parts(jnode) -> str:
    return ".".join(_seq(jnode.multipartIdentifier()))


def _parsed(spark: SparkSession, sql: str):
    try:
        return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";"))
    except Exception as e:  # the parser's own error, for example of a second statement
        raise Refused(f"not one readable query: {str(e).splitlines()[0][:200]}") from None


def check(spark: SparkSession, sql: str, tables: set[str]) -> None:
    """Raises Refused unless ``sql`` is one SELECT or set operation over ``tables``."""
    plan = _parsed(spark, sql)
    ctes: set[str] = set()
    todo, relations = [plan], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName().removesuffix("$")
        if name not in ALLOWED:
            raise Refused(f"{name} is not allowed")
        if name == "UnresolvedRelation":
            relations.append(_parts(node))
        if name == "UnresolvedWith":
            for pair in _seq(node.cteRelations()):
                ctes.add(pair._1().lower())
                todo.append(pair._2())
        todo += _seq(node.children())
        todo += _seq(node.subqueries())
        for e in _seq(node.expressions()):
            _expression(spark, e)
    allowed = {t.lower() for t in tables} | ctes
    for r in relations:
        if r.lower() not in allowed:
            raise Refused(f"table {r} is not allowed")


def _expression(spark: SparkSession, e) -> None:
    name = e.getClass().getSimpleName()
    if name == "UnresolvedFunction":
        f = ".".join(_seq(e.nameParts())).lower()
        if f not in PLAIN and (f in FORBIDDEN or _group(spark, f) not in GROUPS):
            raise Refused(f"function {f} is not allowed")
    elif name.startswith("Current") or name in ("Now", "LocalTimestamp"):  # written without brackets
        raise Refused(f"{name} is not allowed")
    elif name == "UnresolvedAttribute" and ".".join(_seq(e.nameParts())).lower() in FORBIDDEN:
        raise Refused(f"{'.'.join(_seq(e.nameParts()))} is not allowed")
    for plan in ([e.plan()] if hasattr(e, "plan") and name in ("ScalarSubquery", "Exists", "ListQuery") else []):
        for x in _seq(plan.expressions()):
            _expression(spark, x)
    for x in _seq(e.children()):
        _expression(spark, x)


def _group(spark: SparkSession, function: str) -> str | None:
    """The registry's group of one of Spark's own functions; null for all others."""
    jvm = spark._jvm
    try:
        info = spark._jsparkSession.sessionState().catalog().lookupFunctionInfo(jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(function))
    except Exception:  # not a function
        return None
    return info.getGroup() if info.getClassName().startswith("org.apache.spark.sql.catalyst.") else None


def capped(spark: SparkSession, sql: str, rows: int) -> int:
    """The row cap of a query: its own outer LIMIT, as parsed, if that is lower."""
    node = _parsed(spark, sql)
    while node.getClass().getSimpleName() == "UnresolvedWith":
        node = node.child()
    if node.getClass().getSimpleName() != "GlobalLimit":
        return rows
    limit = node.limitExpr().toString()
    return min(rows, int(limit)) if limit.isdigit() else rows


def run(spark: SparkSession, sql: str, tables: set[str], rows: int = 200) -> DataFrame:
    """The checked query's first ``rows`` rows."""
    check(spark, sql, tables)
    return spark.sql(sql.strip().rstrip(";")).limit(capped(spark, sql, rows))
