import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from oracle_check import compare  # noqa: E402

from strata.schemas import MOVIE_ANALYTICS  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_query_has_oracle():
    own = {k for k in entry_mod.queries() if not k.startswith("op") and k != "pipeline"}
    assert own == set(entry_mod.oracle_sql())


def test_entry_schema(spark):
    df = entry_mod.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in MOVIE_ANALYTICS]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, list(entry_mod.oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] is not True}
    assert not bad


def test_each_application_has_its_own_scratch_database():
    from strata.session import scratch_database_name

    names = {scratch_database_name(i) for i in ("app-1", "app-2", "local-17")}
    assert names == {"strata_scratch_app_1", "strata_scratch_app_2", "strata_scratch_local_17"}
