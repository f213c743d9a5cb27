"""All core queries by name and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

from ledgerlake.plans import alignment, checks, collection, copies, merges, quality, selection, texts, units  # noqa: F401
from ledgerlake.plans.catalog import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return {
        "p1_found": units.p1_found,
        "p1_amounts": units.p1_amounts,
        "p3_found": copies.p3_found,
        "p3_differences": copies.differences,
        "p5_found": quality.p5_found,
        "p5_profile": quality.p5_profile,
        **QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {"p5_found": quality.P5_FOUND, **ORACLES}
