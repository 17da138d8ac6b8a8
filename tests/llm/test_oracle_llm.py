"""Every query of the subpackage against its SQL on whole tables; the others must run and keep all rows."""

import os

import pytest
from oracle import connect, difference

from labtables.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op1_quality", "op2_minhash", "op4_sentencepiece", "op5_token_counts", "op8_toxicity",
                                  "op11_quality_rules"])
def test_one_row_a_document(spark, con, name):
    n = con.execute("SELECT count(*) FROM documents").fetchall()[0][0]
    assert QUERIES[name](spark, SF_DIR).select("doc_id").distinct().count() == n


def test_each_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
