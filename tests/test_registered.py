"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as contract
from fieldgrant.registered import ORACLES, QUERIES
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_ORACLE = {"landing_inventory", "file_fingerprints"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert differences(df, duck, contract.oracle_sql()[name]) == []


def test_only_file_listings_have_no_oracle():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE
    assert not set(contract.oracle_sql()) - set(contract.queries())


def test_file_listings(spark):
    import hashlib
    import pathlib

    files = {p.name: p.read_bytes() for p in pathlib.Path(SF_DIR).glob("*.parquet")}
    listed = contract.queries()["landing_inventory"](spark, SF_DIR).collect()
    assert {(r.file_name, r.length) for r in listed} == {(n, len(b)) for n, b in files.items()}
    digests = contract.queries()["file_fingerprints"](spark, SF_DIR).collect()
    assert {(r.file_name, r.fingerprint) for r in digests} == {
        (n, hashlib.md5(b).hexdigest()) for n, b in files.items()
    }


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == [
        "beneficiary", "total_eagf_income_support", "total_eafrd_income_support", "grand_total_public_payout"
    ]
    assert len(df.columns) == 39 and df.columns[-1] == "other_rural_development"
    assert df.count() > 0
