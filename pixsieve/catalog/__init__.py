from pixsieve.catalog.oracle import ORACLE_SQL
from pixsieve.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
