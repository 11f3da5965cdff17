"""Training-data operators. Nothing else in the library imports this package.

Each operator module keeps a general interface; ``queries`` holds the thin
``opN_<name>`` queries and ``oracle_sql`` their DuckDB twins.
"""
