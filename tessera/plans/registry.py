"""All queries of the library by name, with their DuckDB SQL."""

from tessera.plans import annotations, distributions, plain, quality, similar, sources, streams, tables, texts  # noqa: F401
from tessera.plans.base import ORACLE_SQL, QUERIES  # noqa: F401
