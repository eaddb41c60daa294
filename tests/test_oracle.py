"""The correctness gate in miniature: every registered query against its
DuckDB oracle on the smallest tables."""
import os
import re
import sys


from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))


def test_every_query_matches_its_oracle(spark):
    from check_oracle import compare
    import __spark_entry__ as E
    # every query of the package itself has SQL; training-data operators (where present) have tests of their own
    other = {k for k in E.queries() if k == "pipeline" or re.match(r"op\d+_", k)}
    assert set(E.queries()) - set(E.oracle_sql()) <= other
    assert set(E.oracle_sql()) <= set(E.queries())
    res = compare(spark, SF_SMALL, sorted(E.oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["minute_bucket", "lang", "posts_in_minute", "rolling_hr_avg",
                          "is_spiking"]
    assert df.count() > 0
