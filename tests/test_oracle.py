"""Every registered query against its DuckDB SQL at sf0.01 (the driver's
correctness gate), plus the smoke entry at sf0.001."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare  # noqa: E402

from conftest import SF01  # noqa: E402
from tidemark.plans.showcase import QUERIES  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "page_uid", "data_uid"]


def test_every_query_has_oracle_or_reason():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle(spark):
    rep = compare(spark, SF01, names=list(QUERIES))
    bad = {k: v for k, v in rep.items()
           if v.get("error") or not v.get("values_match") or not v.get("columns_match")}
    assert not bad, bad
