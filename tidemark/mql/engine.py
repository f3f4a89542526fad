"""Checked syntax trees as DataFrame operations; Catalyst does the rest."""

from __future__ import annotations

import difflib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.mql.errors import MqlSemanticError
from tidemark.mql.language import Query, parse
from tidemark.mql.metrics import METRICS, SQL_TYPES, Metric

SOURCE = "market"
_KINDS = {"s": "text", "i": "number", "f": "number", "b": "truth value"}
_COMPARE = {"=": Column.__eq__, "!=": Column.__ne__, "<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def market_schema() -> T.StructType:
    """All columns that queries can reach, each once."""
    columns = {m.column: m.kind for m in METRICS.values()}
    return T.StructType([T.StructField(c, T._parse_datatype_string(SQL_TYPES[k])) for c, k in columns.items()])


def metric(node: tuple, filtering: bool = False) -> Metric:
    _, name, position = node
    found = METRICS.get(name)
    if found is None:
        near = difflib.get_close_matches(name, METRICS, n=3, cutoff=0.6)
        raise MqlSemanticError(f"unknown metric {name!r}" + (f". Did you mean: {', '.join(near)}?" if near else ""), position)
    if filtering and not found.filterable:
        raise MqlSemanticError(f"metric {name!r} can be selected but not used in WHERE or ORDER BY", position)
    return found


def _kind(node: tuple) -> str | None:
    """Kind of an operand; None for NULL, which goes with anything."""
    if node[0] == "name":
        return _KINDS[metric(node, True).kind]
    return None if node[1] is None else "truth value" if isinstance(node[1], bool) else "number" if isinstance(node[1], float) else "text"


def _same_kind(*nodes: tuple) -> None:
    kinds = {k for n in nodes if (k := _kind(n))}
    if len(kinds) > 1:
        raise MqlSemanticError(f"cannot compare {' with '.join(sorted(kinds))}", nodes[0][2])


def _operands(*nodes: tuple) -> list[Column]:
    """Columns and literals; whole numbers beside whole metrics stay whole, so that no cast keeps the test from the files."""
    whole = all(metric(n, True).kind == "i" if n[0] == "name" else n[1] is None or isinstance(n[1], float) and n[1].is_integer() and abs(n[1]) < 2**53 for n in nodes)
    return [F.col(f"`{metric(n, True).column}`") if n[0] == "name" else F.lit(int(n[1]) if whole and n[1] is not None else n[1]) for n in nodes]


def condition(node: tuple) -> Column:
    """A condition as a column, in SQL's three-valued logic."""
    match node:
        case ("or", left, right):
            return condition(left) | condition(right)
        case ("and", left, right):
            return condition(left) & condition(right)
        case ("not", inner):
            return ~condition(inner)
        case ("null", operand, negated):
            (found,) = _operands(operand)
            return found.isNotNull() if negated else found.isNull()
        case ("in", operand, values, negated):
            _same_kind(operand, *values)
            found, *listed = _operands(operand, *values)
            found = found.isin(*listed)
        case ("between", operand, low, high, negated):
            _same_kind(operand, low, high)
            found, low, high = _operands(operand, low, high)
            found = found.between(low, high)
        case ("compare", sign, left, right):
            _same_kind(left, right)
            return _COMPARE[sign](*_operands(left, right))
    return ~found if negated else found


def _names(node) -> Iterator[tuple]:
    """All names in a condition."""
    if isinstance(node, tuple):
        if node and node[0] == "name":
            yield node
        else:
            for part in node:
                yield from _names(part)
    elif isinstance(node, list):
        for part in node:
            yield from _names(part)


@dataclass(frozen=True)
class Plan:
    """A checked query: output names and metrics, the condition, the order."""

    select: tuple[tuple[str, Metric], ...]
    where: Column | None
    order: tuple[tuple[Metric, bool], ...]
    limit: int | None
    columns: frozenset[str]  # all that is read, by the names of columns


def check(query: Query) -> Plan:
    if query.source[1].lower() != SOURCE:
        raise MqlSemanticError(f"unknown source {query.source[1]!r}; the only source is {SOURCE!r}", query.source[2])
    if query.select is None:
        select = tuple((m.name, m) for m in METRICS.values() if not m.name.endswith(("_ref", "note")))
    else:
        select = tuple((alias or name[1], metric(name)) for name, alias in query.select)
    twice = sorted(n for n, count in Counter(n for n, _ in select).items() if count > 1)
    if twice:
        raise MqlSemanticError(f"output names used more than once: {', '.join(twice)}")
    order = tuple((metric(name, True), down) for name, down in query.order)
    read = {m.column for _, m in select} | {m.column for m, _ in order} | {metric(n, True).column for n in _names(query.where)}
    return Plan(select, None if query.where is None else condition(query.where), order, query.limit, frozenset(read))


class Engine:
    """Runs queries over one market: a table, or a function that makes one with the columns that a query names."""

    def __init__(self, market: DataFrame | Callable[[list[str]], DataFrame]):
        self.market = market

    @classmethod
    def of_paths(cls, spark: SparkSession, paths: list[str]) -> Engine:
        if not paths:
            raise MqlSemanticError("no market files to query")
        return cls(spark.read.schema(market_schema()).parquet(*paths))

    def run(self, text: str) -> DataFrame:
        plan = check(parse(text))
        market = self.market if isinstance(self.market, DataFrame) else self.market(sorted(plan.columns))
        out = market if plan.where is None else market.filter(plan.where)
        if plan.order:
            out = out.orderBy(*[getattr(F.col(f"`{m.column}`"), "desc_nulls_last" if down else "asc_nulls_last")() for m, down in plan.order])
        if plan.limit is not None:
            out = out.limit(plan.limit)
        return out.select(*[F.col(f"`{m.column}`").alias(name) for name, m in plan.select])

    def explain(self, text: str) -> dict[str, str]:
        """The text, its tree, the checked query and Spark's plans."""
        tree = parse(text)
        plan = check(tree)
        return {"text": text, "tree": repr(tree), "checked": repr(plan), "plan": self.run(text)._jdf.queryExecution().toString()}


def run_query(market: DataFrame, text: str) -> DataFrame:
    return Engine(market).run(text)
