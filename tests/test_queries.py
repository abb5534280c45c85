"""Every registered query against its SQL on the smallest given tables."""

import oracle
import pytest

from dayline.plans import registry

SF = "/root/testdata/sf0.001"
PLANS = registry.plans()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(spark, con, name):
    plan, sql = PLANS[name]
    rows, message, _ = oracle.compare(spark, con, SF, plan, sql)
    assert message is None
    assert rows > 0 or name in {"pf6_level_insights"}
