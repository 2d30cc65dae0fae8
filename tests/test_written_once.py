"""Jobs that read their input several times derive it once."""

import pytest

from claimlake import registry
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["dq_check_report", "dq_quality_report", "dq_profile_running", "role_report_billing_manager", "mart_payer_mix"])
def test_the_driver_tables_are_not_in_the_plan(spark, name):
    plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "l_orderkey" not in plan and "claimant_id" in plan
