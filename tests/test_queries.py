"""Every registered query of the library runs on the smallest tables."""

import re

import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.mark.parametrize("name", NAMES)
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SMALL)
    df.write.format("noop").mode("overwrite").save()
    assert len(df.columns) == len(set(df.columns)) > 0
