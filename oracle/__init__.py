"""The registered queries once more, as DuckDB SQL over the same tables.

Written apart from the Spark code, from the definitions: shared parts are CTEs.
"""

from __future__ import annotations

from oracle.counts import COUNT_QUERIES
from oracle.events import EVENT_QUERIES
from oracle.serving import SERVING_QUERIES


def oracle_sql() -> dict[str, str]:
    return {**EVENT_QUERIES, **COUNT_QUERIES, **SERVING_QUERIES}
