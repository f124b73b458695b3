"""The operators address columns through Roles, so other request-like tables work unchanged."""

from collections import Counter

import pytest

from reqlens.operators import quality as Q
from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.plans import analyses as A
from reqlens.roles import Roles
from reqlens.sources.testdata import CATEGORY_SPELLING, raw_requests
from tests.conftest import SF001

RENAMES = {
    "unique_key": "ticket_id",
    "created_date": "opened_at",
    "closed_date": "resolved_at",
    "resolution_updated": "last_update",
    "complaint_type": "issue",
    "borough": "site",
    "agency": "team",
    "agency_name": "team_name",
    "status": "state",
}
ROLES = Roles(
    key="ticket_id", created="opened_at", closed="resolved_at", resolution_updated="last_update", status="state",
    category="issue", region="site", handler="team", handler_name="team_name", invalid_flag="bad_order",
)


@pytest.fixture(scope="module")
def frames(spark):
    raw = raw_requests(spark, SF001)
    default = transform_requests(clean_requests(raw, spelling=CATEGORY_SPELLING))
    other_raw = raw.withColumnsRenamed(RENAMES)
    other = transform_requests(clean_requests(other_raw, spelling=CATEGORY_SPELLING, roles=ROLES), roles=ROLES)
    return raw, other_raw, default, other


def test_analyses_with_other_roles(frames):
    _, _, default, other = frames
    for fn in (A.top_categories_by_region, A.handler_workload_speed, A.category_resolution_by_region,
               A.peak_hour_by_category):
        kwargs = {"min_resolved": 1} if fn is A.category_resolution_by_region else {}
        got = Counter(tuple(r) for r in fn(other, roles=ROLES, **kwargs).collect())
        want = Counter(tuple(r) for r in fn(default, **kwargs).collect())
        assert got == want, fn.__name__


def test_quality_with_other_roles(frames):
    raw, other_raw, _, _ = frames
    assert Q.invalid_date_rows(other_raw, roles=ROLES).count() == Q.invalid_date_rows(raw).count()
    assert (Q.handler_name_consistency(other_raw, roles=ROLES).count()
            == Q.handler_name_consistency(raw).count())


def test_parameters(frames):
    _, _, default, _ = frames
    weekend = {r.request_day_of_week: r.day_type for r in A.weekday_pattern(default, weekend=("Friday",)).collect()}
    assert weekend["Friday"] == "Weekend" and weekend.get("Sunday", "Weekday") == "Weekday"
    assert A.sample_features(default, n=3).count() == 3
    top1 = A.top_categories_by_region(default, top_n=1).collect()
    assert all(r.complaint_rank == 1 for r in top1)


def test_pipeline_with_other_roles(spark, frames, tmp_path):
    from reqlens.plans.pipeline import profile_stage, run_pipeline

    raw, other_raw, _, _ = frames
    res = run_pipeline(spark, other_raw, str(tmp_path / "o"), spelling=CATEGORY_SPELLING, roles=ROLES)
    for name, df in res.analyses.items():
        assert df.count() >= 0, name
    assert all(df.count() >= 0 for df in profile_stage(spark, other_raw, str(tmp_path / "prof"), ROLES).values())
