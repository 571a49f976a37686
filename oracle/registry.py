"""All comparison SQL by query name."""

from __future__ import annotations

from oracle.block_sql import BLOCK_SQL
from oracle.measure_sql import MEASURE_SQL, REPORT_SQL
from oracle.question_sql import QUESTION_SQL
from oracle.star_sql import with_star


def all_sql() -> dict[str, str]:
    bodies = {**QUESTION_SQL, **MEASURE_SQL, **REPORT_SQL, **BLOCK_SQL}
    return {name: with_star(body) for name, body in bodies.items()}
