"""Query registry (``QUERIES``) and DuckDB oracle statements (``ORACLE``)."""

from . import oracle_label, oracle_misc, oracle_trade  # noqa: F401  (register their statements)
from .catalog import QUERIES
from .oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
