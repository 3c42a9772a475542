"""Training-data operators: dedup, joins, packing, scans, token files and
counts, quality scoring and benchmark decontamination.

Nothing else in the library imports this package; ``queries.py`` holds the
registered queries and ``oracle.py`` their DuckDB SQL.
"""
