"""Independent SQL statements (DuckDB) that state what every registered query returns."""

from oracle.statements import statements

__all__ = ["statements"]
