import pytest

from ledgerline.llm.queries import ORACLES, QUERIES
from tests.conftest import SF001
from tests.oracle_util import canon, collected, duck


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_its_sql(spark, key):
    assert canon(collected(QUERIES[key](spark, SF001))) == canon(duck(SF001).execute(ORACLES[key]).df())
