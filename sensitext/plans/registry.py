"""All registered queries and their SQL twins."""

from __future__ import annotations

from sensitext.plans import (
    encoding_queries,
    io_queries,
    kind_queries,
    metric_queries,
    model_queries,
    prep_queries,
    scoring_queries,
    trained_checks,
)

_CHECKED = (
    prep_queries,
    encoding_queries,
    scoring_queries,
    metric_queries,
    io_queries,
    kind_queries,
    trained_checks,
)

QUERIES = {k: q for m in (*_CHECKED, model_queries) for k, q in m.QUERIES.items()}
ORACLE = {k: sql for m in _CHECKED for k, sql in m.ORACLE.items()}
