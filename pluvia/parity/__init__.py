"""The operators applied to the relational test tables, with the SQL that must give the same rows."""

from .oracle import ORACLE
from .queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
