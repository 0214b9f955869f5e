"""Operators for preparing training text: ten operators, their queries and the SQL that must agree."""
