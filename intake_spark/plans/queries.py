"""The registered queries, with the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from . import corpus, intake, judging, records

QUERIES = {**intake.QUERIES, **judging.QUERIES, **records.QUERIES, **corpus.QUERIES}
SQL = {**intake.SQL, **judging.SQL, **records.SQL, **corpus.SQL}
