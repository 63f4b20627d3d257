"""Every registered query against its SQL on the smallest tables."""

import re
from pathlib import Path

import pytest

from __spark_entry__ import entry
from talusflow.plans import all_checks, all_queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
CHECKS = all_checks()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, duck, name):
    got = all_queries()[name](spark, SF).toPandas()
    if name in CHECKS:
        assert differences(got, duck.sql(CHECKS[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry_is_the_flagship(spark):
    df = entry(spark)
    assert df.columns == ["event_id", "label", "features", "n_features"] and df.count() > 0


def test_every_query_has_sql():
    assert set(all_queries()) == set(CHECKS)


def test_library_has_no_python_udf_and_no_hidden_collect():
    package = Path(__file__).resolve().parent.parent / "talusflow"
    for path in package.rglob("*.py"):
        if path.parent.name == "llm":  # an optional part with its own rules
            continue
        text = path.read_text()
        assert not re.search(r"\budf\(|pandas_udf|toPandas|applyInPandas|crossJoin|localCheckpoint",
                             text), path
