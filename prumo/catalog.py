"""Registry of the queries outside the training-data subpackage."""

from __future__ import annotations

from prumo.plans import given, ingest, live, mixed, monitor, pages, records, seen, state, stored, texts, vacancies

QUERIES: dict = {**records.QUERIES, **texts.QUERIES, **state.QUERIES, **ingest.QUERIES, **pages.QUERIES, **live.QUERIES, **seen.QUERIES, **monitor.QUERIES, **stored.QUERIES, **mixed.QUERIES, **given.QUERIES, **vacancies.QUERIES}
ORACLE_SQL: dict = {**records.ORACLE_SQL, **texts.ORACLE_SQL, **state.ORACLE_SQL, **ingest.ORACLE_SQL, **pages.ORACLE_SQL, **live.ORACLE_SQL, **seen.ORACLE_SQL, **monitor.ORACLE_SQL, **stored.ORACLE_SQL, **mixed.ORACLE_SQL, **given.ORACLE_SQL, **vacancies.ORACLE_SQL}
