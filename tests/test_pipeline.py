"""The shared detection pass and the refreshed snapshots change no result."""

import pytest

from auditlens.plans.pipeline import SecurityPipeline
from tools.audit_fixture import audit_table, tags_fixture
from audit_rows import SF_SMALL, bag
from test_plans import _explain, _scans

LAYERS = ["a1", "a2", "a3", "a4", "a5", "a6", "a7", "a8", "a9", "r_fl", "r_de", "r_aa", "r_wa",
          "r_sg", "r_uc", "r_as", "c1", "c2", "c3"]
CALLS = ["q%d" % i for i in range(1, 19)] + ["l1", "l2", "l3", "l4", "l5", "l6"]


@pytest.fixture(scope="module")
def pipelines(spark):
    audit = audit_table(spark, SF_SMALL)
    tags = tags_fixture(spark, SF_SMALL)
    separate = SecurityPipeline(audit, tags, shared_scan=False)
    shared = SecurityPipeline(audit, tags, as_of=separate.as_of)
    refreshed = SecurityPipeline(audit, tags, as_of=separate.as_of).refresh()
    return separate, shared, refreshed


def _frame(p, name):
    return getattr(p, name)() if name in CALLS else getattr(p, name)


@pytest.mark.parametrize("name", LAYERS + CALLS)
def test_shared_and_refreshed_equal_separate_scans(pipelines, name):
    separate, shared, refreshed = pipelines
    expected = bag(_frame(separate, name))
    assert bag(_frame(shared, name)) == expected
    assert bag(_frame(refreshed, name)) == expected


def test_shared_pass_is_one_audit_scan(pipelines):
    from auditlens.plans.shared_scan import CANDIDATE_COLUMNS
    _, shared, _ = pipelines
    assert shared.candidates.columns == list(CANDIDATE_COLUMNS)
    text = _explain(shared.candidates)
    assert _scans(text) == 2  # the look-back of all rules, and the older days of D6 alone
    assert text.count("GreaterThanOrEqual(event_time,") == 2 and "LessThan(event_time," in text


def test_reports_after_refresh_do_not_scan_the_audit(pipelines, spark):
    _, _, refreshed = pipelines
    text = _explain(refreshed.q9())
    assert "auditlens-fixture" not in text


def test_materialize_with_reliable_checkpoints_and_snapshots(spark):
    audit = audit_table(spark, SF_SMALL)
    tags = tags_fixture(spark, SF_SMALL)
    plain = SecurityPipeline(audit, tags)
    ck = SecurityPipeline(audit, tags, as_of=plain.as_of).materialize(names=("d2", "r_de"))
    snap = SecurityPipeline(audit, tags, as_of=plain.as_of).materialize(names=("d2",), how="snapshot")
    assert bag(ck.d2) == bag(plain.d2) == bag(snap.d2)
    assert bag(ck.r_de) == bag(plain.r_de)
    assert "auditlens-fixture" not in _explain(ck.d2)


def test_alert_windows_wider_than_the_lookback(spark):
    import copy
    from auditlens.sources.rules import load_rules
    rules = copy.deepcopy(load_rules())
    for alert in rules["alerts"]:
        if alert["name"] in ("failed_login_alert", "account_admin_assignment"):
            alert["time_interval"] = "long"                  # 720 h, wider than the 168 h look-back
    audit = audit_table(spark, SF_SMALL)
    tags = tags_fixture(spark, SF_SMALL)
    separate = SecurityPipeline(audit, tags, rules=rules, shared_scan=False)
    refreshed = SecurityPipeline(audit, tags, as_of=separate.as_of, rules=rules).refresh()
    expected = bag(separate.l6())
    assert bag(refreshed.l6()) == expected
    from auditlens.plans.shared_scan import detection_candidates
    table = detection_candidates(audit, hours=None)
    fed = SecurityPipeline(audit, tags, as_of=separate.as_of, rules=rules, detections=table)
    assert bag(fed.l6()) == expected
