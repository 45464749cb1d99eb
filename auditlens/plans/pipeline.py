"""The whole detection job as one object: every layer is a lazy DataFrame.

``SecurityPipeline(audit, tags)`` resolves ``as_of`` once and exposes each
operator output as an attribute (``d1`` .. ``q18``). Nothing runs until a
frame is used.

With ``shared_scan=True`` (the default) the windowed layers (summaries,
assessments, posture, reports, alert metrics) do not read the audit log
per rule: one pass tags every windowed detection row
(``shared_scan.detection_candidates``) and the rules read that small
result. ``refresh()`` writes it, then every assessment (R-x), C1 and C3, as
parquet snapshots in the session's shared checkpoint folder; reports then
read those snapshots, so each summary group is scored once.
The unbounded detection views ``d1`` .. ``d8`` always read the audit log.

With ``detections=`` (a table a stream appends to with
``streaming.detections.stream_candidates``) the windowed layers read that
table instead: the periodic job does not scan the audit log at all, and
each audit row is tagged once, when it arrives.

With ``states=`` (``plans.incremental.DailyStates``) the summaries merge the
daily states that each batch of new rows left behind, instead of aggregating
the look-back again; all that follows builds on those.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.functions import scoring as S
from auditlens.operators import alert_states as LS
from auditlens.operators import alerts as L
from auditlens.operators import assess as R
from auditlens.operators import correlation as X
from auditlens.operators import detections as D
from auditlens.operators import posture as C
from auditlens.operators import reports as Q
from auditlens.operators import summaries as A
from auditlens.operators.memory import AssessmentMemory
from auditlens.functions.exprs import DatePartition, parse_as_of, since, time_type, ts_literal
from auditlens.plans import shared_scan as SS
from auditlens.plans.incremental import DailyStates
from auditlens.sources.audit import resolve_as_of
from auditlens.sources.sinks import prune_published, publish, published, register_views, snapshot, snapshot_root, write_version

LOOKBACK_HOURS = 168
UC_ALERT_HOURS = 720

# The view names the report SQL reads, and the layer behind each.
VIEW_NAMES = {
    "sec_v_auth_events": "d1",
    "sec_v_account_admin_assignments": "d2",
    "sec_v_workspace_acl_assignments": "d3",
    "sec_v_sensitive_group_additions": "d4",
    "sec_v_workspace_db_sql_acl_changes": "d5",
    "sec_v_uc_permission_escalations": "d6",
    "sec_v_account_setting_changes": "d7",
    "sec_mv_data_export_detection": "d8",
    "sec_mv_ai_failed_login_analysis": "r_fl_full",
    "sec_mv_ai_data_export_analysis": "r_de",
    "sec_v_ai_account_admin_analysis": "r_aa",
    "sec_v_ai_workspace_acl_analysis": "r_wa",
    "sec_v_ai_sensitive_group_analysis": "r_sg",
    "sec_v_ai_uc_permission_analysis": "r_uc",
    "sec_v_ai_account_setting_analysis": "r_as",
    "sec_mv_ai_privilege_escalation_consolidated": "c1",
    "sec_mv_ai_security_posture_summary": "c3",
}
#: Snapshots in the order of their dependence: every assessment once, then what is built from them.
SNAPSHOT_LAYERS = (("r_fl", "r_de", "r_aa", "r_wa", "r_sg", "r_uc", "r_as"), ("c1",), ("c3",))
SNAPSHOT_FRAMES = tuple(name for layer in SNAPSHOT_LAYERS for name in layer)


class SecurityPipeline:
    def __init__(self, audit: DataFrame, tags: DataFrame, as_of=None,
                 scorer: S.Scorer = S.default_scorer, lookback_hours: float = LOOKBACK_HOURS,
                 rules: dict | None = None, shared_scan: bool = True,
                 detections: DataFrame | None = None, date_partition: DatePartition | None = None,
                 states: DailyStates | None = None, memory: AssessmentMemory | None = None):
        self.audit = audit
        self.tags = tags
        self.memory = memory  # of assessments: only unseen prompts reach the scorer
        self.states = None if states is None else states.view()
        if self.states is not None:
            as_of = as_of or self.states.latest()
            detections = self.states.detections if detections is None else detections
        self.as_of = resolve_as_of(audit, as_of)
        self.scorer = scorer
        self.h = lookback_hours
        self.rules = rules
        self.shared = shared_scan or detections is not None
        self.detections = detections
        self.contract = date_partition  # the source's date column, if the caller declares it

    @property
    def spark(self):
        return self.audit.sparkSession

    # detections
    @cached_property
    def d1(self): return D.auth_events(self.audit)
    @cached_property
    def d2(self): return D.account_admin_assignments(self.audit)
    @cached_property
    def d3(self): return D.workspace_acl_assignments(self.audit)
    @cached_property
    def d4(self): return D.sensitive_group_additions(self.audit)
    @cached_property
    def d5(self): return D.workspace_db_sql_acl_changes(self.audit)
    @cached_property
    def d6(self): return D.uc_permission_escalations(self.audit, self.tags)
    @cached_property
    def d7(self): return D.account_setting_changes(self.audit)
    @cached_property
    def d8(self): return D.data_export_detection(self.audit, self.as_of)

    def d8_branch(self, branch: str) -> DataFrame:
        return D.data_export_branch(self.audit, branch, self.as_of)

    # windowed detections: one shared pass, or the views themselves
    @cached_property
    def rule_metrics(self): return L.rule_metrics(self.rules)

    @cached_property
    def uc_hours(self) -> float:
        return max([UC_ALERT_HOURS, self.h] + [hours for _, hours, m in self.rule_metrics if m.source == "d6"])

    @cached_property
    def candidates(self) -> DataFrame:
        if self.detections is not None:
            # a detections table kept by a stream (ST1): no audit scan at all
            return SS.within_windows(self.detections, self.as_of, self.h, self.uc_hours)
        return SS.detection_candidates(self.audit, self.as_of, self.h, self.uc_hours, contract=self.contract)

    @cached_property
    def _windowed(self) -> dict[str, DataFrame]:
        return {}

    def w(self, name: str) -> DataFrame:
        """A windowed detection: of the shared pass, or the view itself."""
        if name not in self._windowed:
            self._windowed[name] = SS.windowed_detection(name, self.candidates, self.tags) if self.shared else getattr(self, name)
        return self._windowed[name]

    # summaries: of the windowed events, or of daily states that are windowed already
    @cached_property
    def partial(self) -> dict[str, DataFrame]:
        return {}

    @property
    def measure(self) -> A.Measure: return A.EVENTS if self.states is None else A.PARTIAL

    @property
    def reach(self) -> float | None: return self.h if self.states is None else None

    def counted(self, name: str) -> DataFrame:
        if self.states is None:
            return self.w(name)
        if name not in self.partial:
            self.partial[name] = self.states.layer(name, self.as_of, self.h, self.tags)
        return self.partial[name]

    def _summary(self, build, layer: str, **more) -> DataFrame:
        return build(self.counted(layer), self.as_of, self.reach, measure=self.measure, **more)

    @cached_property
    def a1(self): return self._summary(A.failed_logins_by_ip, "d1")
    @cached_property
    def a2(self): return self._summary(A.failed_logins_by_user, "d1")
    @cached_property
    def a3(self): return self._summary(A.failed_login_patterns, "d1")
    @cached_property
    def a3_counts(self): return self._summary(A.failed_login_patterns, "d1", lists=False)
    @cached_property
    def a4(self): return self._summary(A.account_admin_activity, "d2")
    @cached_property
    def a5(self): return self._summary(A.workspace_acl_activity, "d3")
    @cached_property
    def a6(self): return self._summary(A.sensitive_group_activity, "d4")
    @cached_property
    def a7(self): return self._summary(A.uc_permission_activity, "d6")
    @cached_property
    def a8(self): return self._summary(A.account_setting_activity, "d7")
    @cached_property
    def a9(self): return A.export_activity(self.counted("d8"), self.measure)

    # assessments
    @cached_property
    def r_fl(self): return R.assess_failed_logins(self.a3_counts, self.scorer, self.memory)
    @property
    def r_fl_full(self):
        """R-FL with the lists of related entities and agents (built on request; no report reads them)."""
        return self.r_fl.join(self._summary(A.failed_login_lists, "d1"), ["detection_type", "entity_id"])
    @cached_property
    def r_de(self): return R.assess_data_exports(self.a9, self.scorer, self.memory)
    @cached_property
    def r_aa(self): return R.assess_account_admin(self.a4, self.scorer, self.memory)
    @cached_property
    def r_wa(self): return R.assess_workspace_acl(self.a5, self.scorer, self.memory)
    @cached_property
    def r_sg(self): return R.assess_sensitive_group(self.a6, self.scorer, self.memory)
    @cached_property
    def r_uc(self): return R.assess_uc_permission(self.a7, self.scorer, self.memory)
    @cached_property
    def r_as(self): return R.assess_account_setting(self.a8, self.scorer, self.memory)

    # consolidation and posture
    @cached_property
    def c1(self):
        return C.privilege_escalation_consolidated(self.r_aa, self.r_wa, self.r_sg, self.r_uc, self.r_as)
    @cached_property
    def c2(self):
        return C.posture_event_counts(self.counted("d1"), self.counted("d8"), self.c1, self.as_of, self.reach, self.measure)
    @cached_property
    def c3(self):
        scorer = None if self.scorer is S.default_scorer else self.scorer
        return C.posture_summary(self.c2, self.as_of, scorer)

    # reports
    def q1(self): return Q.q1_failed_login_actions(self.r_fl, self.as_of)
    def q2(self): return Q.q2_high_risk_exports(self.r_de, self.as_of)
    def q3(self): return Q.q3_critical_escalations(self.c1, self.as_of)
    def q4(self): return Q.q4_actor_frequency(self.c1, self.as_of)
    def q5(self): return Q.q5_posture_fields(self.c3)
    def q6(self): return Q.q6_export_risk_factors(self.r_de, self.as_of)
    def q7(self): return Q.q7_investigation_steps(self.c1, self.as_of)
    def q8(self): return Q.q8_strategic_recommendations(self.c3)
    def q9(self): return Q.q9_risk_level_counts(self.r_fl, self.r_de, self.c1, self.as_of)
    def q10(self): return Q.q10_high_frequency_actors(self.r_de, self.c1, self.as_of)
    def q11(self): return Q.q11_compliance_report(self.c1, self.as_of)
    def q12(self): return Q.q12_cross_correlation(self.r_fl, self.c1, self.as_of)
    def q13(self): return Q.q13_analysis_volume(self.r_fl, self.r_de, self.c1, self.as_of)
    def q14(self): return Q.q14_account_admin(self.r_aa, self.as_of)
    def q15(self): return Q.q15_workspace_acl(self.r_wa, self.as_of)
    def q16(self): return Q.q16_sensitive_group(self.r_sg, self.as_of)
    def q17(self): return Q.q17_uc_permission(self.r_uc, self.as_of)
    def q18(self): return Q.q18_account_setting(self.r_as, self.as_of)

    def actions_after_failed_logins(self, hours: int = 6, least: int = 1) -> DataFrame:
        """Privileged actions of the look-back soon after failed logins of the same user."""
        actions = X.privileged_actions({name: since(self.w(name), self.as_of, self.h) for name in X.PRIVILEGED})
        logins = since(self.w("d1"), self.as_of, self.h)
        return X.actions_after_failed_logins(logins, actions, hours, least)

    # alerts
    @cached_property
    def definitions_rows(self): return L.definition_rows(self.rules)
    @cached_property
    def definitions(self): return L.alert_definitions(self.spark, self.rules)

    def l1(self): return L.failed_login_alert(self.w("d1"), self.as_of)
    def l2(self): return L.account_admin_alert(self.w("d2"), self.as_of)
    def l3(self): return L.data_export_alert(self.w("d8"), self.as_of)
    def l4(self): return L.uc_permission_alert(self.w("d6"), self.as_of)
    def l5(self): return L.data_export_ai_alert(self.r_de)

    def metric_source(self, layer: str, hours: float) -> DataFrame:
        """A layer with at least ``hours`` of history for a rule's metric.

        The windowed rows where they reach back far enough (D8 is bounded by
        its own look-back in any case), else all history: the stream-kept
        detections table, or the view over the audit log.
        """
        if layer not in L.EVENT_LAYERS:
            return getattr(self if hours <= self.h else self.over(hours), layer)
        reach = {"d6": self.uc_hours, "d8": math.inf}.get(layer, self.h)
        if self.shared and layer in SS.WINDOWED and hours <= reach:
            return self.w(layer)
        if self.detections is not None and layer in SS.WINDOWED:
            return SS.windowed_detection(layer, self.detections, self.tags)
        return getattr(self, layer)

    def over(self, hours: float) -> "SecurityPipeline":
        """The job with another look-back (exports keep theirs, which belongs to D8)."""
        return SecurityPipeline(self.audit, self.tags, as_of=self.as_of, scorer=self.scorer, lookback_hours=hours, rules=self.rules,
                                shared_scan=self.shared, detections=self.detections, date_partition=self.contract, states=self.states,
                                memory=self.memory)

    def metrics(self) -> DataFrame:
        """Rows (name, value): every rule's metric over its own window."""
        return L.rule_values(self.metric_source, self.rule_metrics, self.as_of)

    def l6(self) -> DataFrame:
        return L.evaluate_alerts(self.metrics(), self.definitions, self.as_of)

    def at(self, as_of) -> "SecurityPipeline":
        """The job as it would have been at an earlier moment: later rows are not there."""
        moment = parse_as_of(as_of)

        def until(frame: DataFrame | None) -> DataFrame | None:
            return None if frame is None else frame.where(F.col("event_time") <= ts_literal(moment, time_type(frame)))

        return SecurityPipeline(until(self.audit), self.tags, as_of=moment, scorer=self.scorer, lookback_hours=self.h, rules=self.rules,
                                shared_scan=False, detections=until(self.detections), date_partition=self.contract, memory=self.memory)

    def every_event(self, layer: str) -> DataFrame:
        """An event layer over all history."""
        if self.detections is not None and layer in SS.WINDOWED:
            return SS.windowed_detection(layer, self.detections, self.tags)
        return D.data_export_detection(self.audit, hours=None) if layer == "d8" else getattr(self, layer)

    def evaluations(self, times) -> DataFrame:
        """L6 at several moments: a row for each rule and moment.

        Rules over events are counted for all moments in one scan of their layer; a rule over another layer has that
        layer built for each moment.
        """
        events = [m for m in self.rule_metrics if m[2].source in L.EVENT_LAYERS and m[2].time_column == "event_time"]
        others = [m for m in self.rule_metrics if m not in events]
        parts = [LS.event_values_at(lambda layer, _: self.every_event(layer), events, times)] if events else []
        for moment in map(parse_as_of, times) if others else ():
            then = self.at(moment)
            parts.append(L.rule_values(then.metric_source, others, moment).select("name", ts_literal(moment).alias("as_of"), "value"))
        return L.evaluate_over_time(reduce(DataFrame.unionByName, parts), self.definitions)

    def alert_states(self, times) -> DataFrame:
        """The rules' states, changes and due notifications at several moments, in order."""
        return LS.next_states(self.spark.createDataFrame([], LS.STATE_SCHEMA), self.evaluations(times), self.definitions)

    def register_views(self) -> list[str]:
        """Every layer as a temporary view under the names report SQL uses."""
        return register_views(self.spark, {view: getattr(self, name) for view, name in VIEW_NAMES.items()})

    # refresh: the job's materialised views
    def refresh(self, path: str | None = None, frames=SNAPSHOT_FRAMES) -> "SecurityPipeline":
        """Write the shared detection pass, then the report sources, as parquet snapshots.

        One audit scan in total (plus the ``as_of`` aggregate when not given).
        Later frames read the snapshots: a lost executor never re-runs the
        audit scan, and each report reads a few small files. With ``path`` all
        of them are published as one version when the last is written
        (``open``); a refresh that fails leaves the version before.
        """
        if not self.shared:
            raise ValueError("refresh() needs shared_scan=True")
        derived = [k for k in list(self.__dict__) if k in _DERIVED]
        for key in derived:
            del self.__dict__[key]
        base = snapshot_root(self.spark) if path is None else path.rstrip("/")
        folders: dict[str, str] = {}

        def put(name: str, frame: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
            folders[name] = write_version(frame, f"{base}/{name}", partition_by=partition_by)
            return self.spark.read.schema(frame.schema).parquet(folders[name])

        if self.states is None:
            # partitioned by rule: each detection shape reads its own folder only
            self.__dict__["candidates"] = put("detections", self.candidates, ["rule"])
        # frames are built here (lazily, one thread); the independent writes run as concurrent jobs
        layers = [[n for n in layer if n in frames] for layer in SNAPSHOT_LAYERS]
        for layer in filter(None, layers):
            built = {name: getattr(self, name) for name in layer}
            with ThreadPoolExecutor(max_workers=max(1, len(built))) as pool:
                done = {name: pool.submit(put, name, frame) for name, frame in built.items()}
            for name, future in done.items():
                self.__dict__[name] = future.result()
        if path is not None:
            schemas = {name: json.loads(self.__dict__["candidates" if name == "detections" else name].schema.json()) for name in folders}
            publish(self.spark, base, {"as_of": self.as_of.isoformat(sep=" "), "hours": self.h, "frames": folders, "schemas": schemas})
            prune_published(self.spark, base, lambda c: c["frames"].values())
        return self

    @classmethod
    def open(cls, audit: DataFrame, tags: DataFrame, path: str, **options) -> "SecurityPipeline":
        """The job as its last whole refresh into ``path`` left it: reports read that version, whatever is written meanwhile."""
        spark, base = audit.sparkSession, path.rstrip("/")
        content = published(spark, base)
        if content is None:
            raise ValueError(f"no refresh was published in {path}")
        job = cls(audit, tags, as_of=content["as_of"], lookback_hours=content["hours"], **options)
        for name, folder in content["frames"].items():
            schema = T.StructType.fromJson(content["schemas"][name])
            job.__dict__["candidates" if name == "detections" else name] = spark.read.schema(schema).parquet(folder)
        return job

    # lineage cuts
    def materialize(self, names=("d1", "d6", "d8", "r_fl", "r_de", "c1"), how: str = "checkpoint",
                    path: str | None = None) -> "SecurityPipeline":
        """Replace the named frames with materialised copies.

        ``how="checkpoint"`` uses reliable checkpoints in the session's
        checkpoint directory; ``how="snapshot"`` writes parquet (under
        ``path`` if given). Frames built later read the copies.
        """
        for name in names:
            frame = getattr(self, name)
            if how == "checkpoint":
                done = frame.checkpoint(eager=True)
            elif how == "snapshot":
                done = snapshot(frame, name, None if path is None else f"{path.rstrip('/')}/{name}")
            else:
                raise ValueError(f"unknown materialisation '{how}'")
            # cached_property values live in the instance dict: replace the cached frame
            self.__dict__[name] = done
        return self


_DERIVED = {
    "candidates", "_windowed", "partial", "a1", "a2", "a3", "a3_counts", "a4", "a5", "a6", "a7", "a8", "a9",
    "r_fl", "r_de", "r_aa", "r_wa", "r_sg", "r_uc", "r_as", "c1", "c2", "c3",
}
