"""All registered queries of this part: the ten operators and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from starloom.llm.queries import QUERIES as OPERATOR_QUERIES
from starloom.llm.queries import SQL as OPERATOR_SQL

QUERIES = OPERATOR_QUERIES | {"pipeline": corpus_pipeline.run}
SQL = OPERATOR_SQL | (
    {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
)
