"""The small query language: SELECT, WHERE, ORDER BY and LIMIT over one table of market states."""

from tidemark.mql.engine import Engine, run_query
from tidemark.mql.errors import MqlError, MqlSemanticError, MqlSyntaxError

__all__ = ["Engine", "MqlError", "MqlSemanticError", "MqlSyntaxError", "run_query"]
