import pytest
from oracle import assert_same

from tesserine.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    assert_same(registry.queries()[name](spark, sf_dir), sf_dir, registry.oracle_sql()[name])
