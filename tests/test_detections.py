"""Detection operators on hand-written audit rows (the traps of SURVEY section 2)."""

from auditlens.operators import detections as D
from audit_rows import AS_OF, audit_row, bag


def test_d1_failed_logins_null_status_and_username_fallback(make_audit, empty_tags):
    audit = make_audit([
        audit_row(action="login", status=401, email="a@x", ip="1.1.1.1"),
        audit_row(action="login", status=None, email="b@x"),               # NULL status: not a failure
        audit_row(action="login", status=200, email="c@x"),               # success
        audit_row(action="login", status=403, params={"user": "d@x"}),    # e-mail missing: request user
        audit_row(action="create", status=401, email="e@x"),              # not a login
    ])
    rows = D.auth_events(audit).orderBy("username").collect()
    assert [r.username for r in rows] == ["a@x", "d@x"]
    assert rows[0].source_ip == "1.1.1.1" and rows[0].response_code == 401


def test_d8_status_rules_differ_between_branches(make_audit):
    audit = make_audit([
        audit_row(service="databrickssql", action="downloadQueryResult", status=None,
                  params={"queryId": "q1"}, email="a@x"),
        audit_row(service="databrickssql", action="downloadQueryResult", status=500,
                  params={"queryId": "q2"}, email="a@x"),
        audit_row(service="dashboards", action="triggerDashboardSnapshot", status=None,
                  params={"dashboard_id": "d1"}, email="a@x"),
        audit_row(service="dashboards", action="triggerDashboardSnapshot", status=200,
                  params={"dashboard_id": "d2"}, email="a@x"),
        audit_row(t_hours_ago=200, service="filesystem", action="filesGet", status=200,
                  params={"path": "/old"}, email="a@x"),                     # outside 168 h
        audit_row(service="notebook", action="downloadLargeResults", status=200,
                  params={"notebookFullPath": "/nb"}, run_by="svc"),
    ])
    got = {(r.source, r.artifact, r.actor) for r in D.data_export_detection(audit, AS_OF).collect()}
    assert got == {("databrickssql", "q1", "a@x"), ("dashboards", "d2", "a@x"), ("notebook", "/nb", "svc")}


def test_d8_single_scan_equals_union_of_branches(spark):
    from tools.audit_fixture import audit_fixture
    audit = audit_fixture(spark, "/root/testdata/sf0.001")
    from auditlens.sources.audit import resolve_as_of
    as_of = resolve_as_of(audit)
    one = D.data_export_detection(audit, as_of)
    parts = None
    for branch in D.EXPORT_BRANCHES:
        b = D.data_export_branch(audit, branch, as_of)
        parts = b if parts is None else parts.unionByName(b)
    assert bag(one) == bag(parts)


def _uc(changes, name="main.hr.t2", sec_type="TABLE", **kw):
    return audit_row(service="unityCatalog", action="updatePermissions", email="admin@x",
                     params={"changes": changes, "securable_full_name": name, "securable_type": sec_type}, **kw)


def test_d6_fanout_wildcard_malformed(spark, make_audit):
    tags = spark.createDataFrame(
        [("main", "hr", "t2", "pii_a"), ("main", "hr", "t2", "pii_b"), ("main", "x", "y", "public")],
        "catalog_name string, schema_name string, table_name string, tag_value string")
    audit = make_audit([
        # two elements, one matching: both come out, and twice (two pii tags)
        _uc('[{"principal":"p1","add":["ALL_PRIVILEGES"]},{"principal":"p2","add":["SELECT"]}]'),
        # '_' is a one-letter wildcard: ALLXPRIVILEGES matches %ALL_PRIVILEGES%
        _uc('[{"principal":"p3","add":["ALLXPRIVILEGES"]}]', name="main.pii.t9"),
        # malformed JSON matches the LIKE but explode drops it
        _uc('[{"principal":"p4","add":["OWNERSHIP"]', name="system"),
        # not sensitive: no pii, not system, not tagged
        _uc('[{"principal":"p5","add":["MANAGE"]}]', name="main.x.z"),
        # wrong securable type
        _uc('[{"principal":"p6","add":["MANAGE"]}]', name="system", sec_type="FUNCTION"),
    ])
    rows = D.uc_permission_escalations(audit, tags).collect()
    got = sorted((r.target_principal, r.permissions, r.securable_full_name) for r in rows)
    assert got == sorted([
        ("p1", '["ALL_PRIVILEGES"]', "main.hr.t2"), ("p1", '["ALL_PRIVILEGES"]', "main.hr.t2"),
        ("p2", '["SELECT"]', "main.hr.t2"), ("p2", '["SELECT"]', "main.hr.t2"),
        ("p3", '["ALLXPRIVILEGES"]', "main.pii.t9"),
    ])
    deduped = D.uc_permission_escalations(audit, tags, dedupe_tags=True).count()
    assert deduped == 3


def test_d6_join_is_chosen_by_size(spark, make_audit):
    tags = spark.createDataFrame([("main", "hr", "t2", "pii")],
                                 "catalog_name string, schema_name string, table_name string, tag_value string")
    audit = make_audit([_uc('[{"principal":"p1","add":["MANAGE"]}]')])
    small = D.uc_permission_escalations(audit, tags).count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        forced_shuffle = D.uc_permission_escalations(audit, tags)
        from test_plans import _explain
        assert "BroadcastHashJoin" not in _explain(forced_shuffle)
        assert small == forced_shuffle.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_d4_only_sensitive_groups(make_audit):
    audit = make_audit([
        audit_row(action="addPrincipalToGroup", params={"targetGroupName": "admins", "targetUserName": "u"}),
        audit_row(action="addPrincipalsToGroup", params={"targetGroupName": "analysts"}),
        audit_row(action="addPrincipalToGroup", params={}),
    ])
    assert [r.group_name for r in D.sensitive_group_additions(audit).collect()] == ["admins"]


def test_actor_falls_back_to_run_by(make_audit):
    audit = make_audit([audit_row(action="setAdmin", run_by="job-7", params={"targetUserName": "t"})])
    r = D.account_admin_assignments(audit).first()
    assert (r.actor, r.target_user, r.indicator, r.severity) == ("job-7", "t", "ACCOUNT_ADMIN_GRANTED", "Critical")


def test_changes_are_taken_apart_or_refused(spark, make_audit):
    """Each event gives D6 its rows or is refused with a reason, never both, never neither."""
    texts = {"good": '[{"principal":"p","add":["MANAGE"]}]', "two": '[{"principal":"p","add":["MANAGE"]},{"principal":"q"}]',
             "cut": '[{"principal":"p","add":["MANAGE"', "text": '"MANAGE"', "words": '["MANAGE"]', "plain": "MANAGE",
             "one": '{"principal":"p","add":["MANAGE"]}', "hidden": '[] -- MANAGE', "number": '[1, "OWNERSHIP"]'}
    rows = [audit_row(service="unityCatalog", action="updatePermissions", email=name, params={
        "securable_type": "TABLE", "securable_full_name": "m.pii.t", "changes": text}) for name, text in texts.items()]
    tags = spark.createDataFrame([], "catalog_name string, schema_name string, table_name string, tag_value string")
    kept = {r["actor"] for r in D.uc_permission_escalations(make_audit(rows), tags).collect()}
    refused = {r["actor"]: r["reason"] for r in D.uc_refused_changes(make_audit(rows), tags).collect()}
    assert kept | set(refused) == set(texts) and not kept & set(refused)
    assert {"good", "two"} <= kept
    assert {k: refused[k] for k in ("cut", "text", "words", "plain")} == {
        "cut": "malformed", "text": "not_an_array", "words": "unexpected_elements", "plain": "malformed"}
