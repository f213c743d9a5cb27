"""Every query that SQL can express gives the rows of its SQL; all others run."""

from __future__ import annotations

import pytest

from ledgerlake.plans import registry
from tests.compare import normal, oracle_rows
from tests.conftest import DATA

FOLDER = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(*oracle_rows(registry.oracle_sql()[name], FOLDER))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, FOLDER).count() >= 0


def test_entry_needs_no_corpus_package(spark):
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["regle", "n_total", "n_evaluables", "n_ok", "taux_pct"]
