"""SQL counterparts of the registered queries, for DuckDB over the driver's tables.

Texts may use ``raw_<table>`` and ``silver_<table>`` as tables; ``with_tables``
puts their definitions in front as common table expressions.
"""

from oracles.base import with_tables
from oracles.marts import MART_SQL
from oracles.operators import OPERATOR_SQL
from oracles.warehouse import WAREHOUSE_SQL

ORACLES: dict[str, str] = {
    name: with_tables(text) for part in (OPERATOR_SQL, WAREHOUSE_SQL, MART_SQL) for name, text in part.items()
}
