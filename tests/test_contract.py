"""Every query of the driver contract against its SQL equivalent."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tools.compare import oracle_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    from rankweave.plans.table_oracles import ORACLES
    from rankweave.plans.table_queries import QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_sql(spark, name):
    got = spark_rows(contract.queries()[name](spark, FOLDER))
    assert got == oracle_rows(FOLDER, contract.oracle_sql()[name])
    assert got[1]


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["doc", "score"]
    assert result.count() > 0


@pytest.mark.parametrize("missing", ["public_tokenizers", "rankweave.llm", "corpus_pipeline"])
def test_the_entry_works_without_the_optional_part(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as c; print(len(c.queries()), 'pipeline' in c.queries())"
    root = Path(__file__).resolve().parent.parent
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    from rankweave.plans.table_queries import QUERIES

    assert int(out[0]) >= len(QUERIES) and out[1] == "False"
