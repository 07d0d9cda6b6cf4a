"""Every query that has SQL equals it on the driver's tables; all are deterministic and typed as stated."""

import os

import pytest

from ledgerline.llm.oracle import ORACLE
from ledgerline.llm.registry import QUERIES
from tests.compare import duck, rows_of_duck, rows_of_spark, types_of_duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPARK_TYPE = {"VARCHAR": "string", "INTEGER": "int", "HUGEINT": "bigint"}
CONTRACT = {
    "op3_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op5_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op8_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op9_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    connection = duck(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    names, got = rows_of_spark(df)
    expected_names, expected = rows_of_duck(connection, ORACLE[name])
    assert names == expected_names
    assert got == expected
    types = {c: SPARK_TYPE.get(t, t.lower()) for c, t in types_of_duck(connection, ORACLE[name]).items()}
    assert types == dict(df.dtypes)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_types_of_the_others(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert dict(df.dtypes) == CONTRACT[name]
    assert df.count() > 0


def test_every_query_is_covered():
    assert set(QUERIES) == set(ORACLE) | set(CONTRACT)
