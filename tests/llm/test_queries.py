"""Every query of the subpackage plans no all-pairs join and leaves nothing cached."""

import pytest

from onsetlake.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_plan_and_cache(spark, name):
    df = registry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
