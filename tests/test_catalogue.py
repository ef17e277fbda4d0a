"""Every registered query gives the rows of its SQL, over whole tables."""

import pytest

import catalogue
from compare import differences
from conftest import SF_DIR

REGISTERED = catalogue.registered()


@pytest.mark.parametrize("key", REGISTERED)
def test_query_equals_sql(spark, duck, key):
    query, sql = REGISTERED[key]
    assert differences(query(spark, SF_DIR), duck, sql) == []
