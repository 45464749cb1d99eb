"""Property: the shared pass, split back into shapes, equals every detection run on its own."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auditlens.functions.exprs import since
from auditlens.operators import detections as D
from auditlens.plans import shared_scan as SS
from audit_rows import AS_OF, audit_row, bag

SERVICES = ["accounts", "unityCatalog", "databrickssql", "filesystem", "notebook", "dashboards", "clusters"]
ACTIONS = ["login", "setAdmin", "setAccountAdmin", "changeDatabricksWorkspaceAcl", "addPrincipalToGroup",
           "addPrincipalsToGroup", "changeDatabricksSqlAcl", "updatePermissions", "setSetting", "deleteSetting",
           "downloadQueryResult", "filesGet", "downloadLargeResults", "downloadPreviewResults",
           "triggerDashboardSnapshot", "create"]
CHANGES = ['[{"principal":"p1","add":["MANAGE"]}]', '[{"principal":"p2","add":["SELECT"]}]',
           '[{"principal":"p1","add":["OWNERSHIP"]},{"principal":"p3","add":["SELECT"]}]', "not json"]

row = st.builds(
    lambda hours, svc, act, status, email, run_by, ip, group, target, sec, sec_type, changes, key: audit_row(
        t_hours_ago=hours, service=svc, action=act, status=status, email=email, run_by=run_by, ip=ip,
        params={k: v for k, v in {
            "user": email, "targetGroupName": group, "targetUserName": target, "targetUserId": target,
            "aclPermissionSet": "acl", "securable_full_name": sec, "securable_type": sec_type,
            "changes": changes, "settingKeyName": key, "settingKeyTypeName": key, "settingValueForAudit": key,
            "queryId": target, "path": target, "notebookFullPath": target, "dashboard_id": target,
        }.items() if v is not None}),
    st.floats(0, 800), st.sampled_from(SERVICES), st.sampled_from(ACTIONS),
    st.sampled_from([None, 200, 401, 500]), st.sampled_from([None, "a@x", "b@x"]),
    st.sampled_from([None, "svc"]), st.sampled_from([None, "1.1.1.1", "2.2.2.2"]),
    st.sampled_from([None, "admins", "analysts", "security-admins"]), st.sampled_from([None, "t1", "t2"]),
    st.sampled_from([None, "main.pii.x", "system", "main.hr.t2", "main.a.b"]),
    st.sampled_from([None, "TABLE", "CATALOG", "FUNCTION"]), st.sampled_from([None] + CHANGES),
    st.sampled_from([None, "k1"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=30, max_size=120))
def test_shared_pass_equals_each_detection(spark, make_audit, rows):
    audit = make_audit(rows)
    tags = spark.createDataFrame([("main", "hr", "t2", "pii_a"), ("main", "hr", "t2", "pii_b")],
                                 "catalog_name string, schema_name string, table_name string, tag_value string")
    split = SS.windowed_detections(SS.detection_candidates(audit, AS_OF, 168, 720), tags)
    direct = {
        "d1": since(D.auth_events(audit), AS_OF, 168),
        "d2": since(D.account_admin_assignments(audit), AS_OF, 168),
        "d3": since(D.workspace_acl_assignments(audit), AS_OF, 168),
        "d4": since(D.sensitive_group_additions(audit), AS_OF, 168),
        "d6": since(D.uc_permission_escalations(audit, tags), AS_OF, 720),
        "d7": since(D.account_setting_changes(audit), AS_OF, 168),
        "d8": D.data_export_detection(audit, AS_OF, 168),
    }
    for name, frame in direct.items():
        assert bag(split[name].select(*frame.columns)) == bag(frame), name
