"""R-FL .. R-AS: risk assessment of each summary row.

``assess_*(summary, scorer)`` returns the summary with one more column,
``ai_comprehensive_analysis`` (JSON text). The scorer sits above the
aggregate, so it runs once per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from auditlens.functions import scoring as S
from auditlens.functions.scoring import Family
from auditlens.operators.memory import AssessmentMemory

# The assessment families (what is counted, grading bands, the fields the scorer sees).
FAILED_LOGIN = Family(
    name="failed_login_analysis", count_col="failed_attempts",
    bands=(("HIGH", 10), ("MEDIUM", 3)), floor="LOW",
    extra_fields=S.RECOMMENDATION_FIELDS,
    prompt_fields=("detection_type", "entity_name", "failed_attempts", "unique_entities",
                   ("hours", "first_attempt", "last_attempt")),
    multiple_entities_col="unique_entities", span=("first_attempt", "last_attempt"),
    lists={"long_term_recommendations": S.LONG_TERM_RECOMMENDATIONS["failed_login_analysis"]},
)
DATA_EXPORT = Family(
    name="data_export_analysis", count_col="export_count",
    bands=(("HIGH", 5), ("MEDIUM", 1)), floor="LOW",
    extra_fields=S.RECOMMENDATION_FIELDS,
    prompt_fields=("actor", "source", "action_name", "artifact", "first_activity", "last_activity", "export_count"),
    lists={"long_term_recommendations": S.LONG_TERM_RECOMMENDATIONS["data_export_analysis"]},
)


def _escalation(name, count_col, bands, floor, fields, sensitive=False):
    return Family(
        name=name, count_col=count_col, bands=bands, floor=floor,
        extra_fields=S.ESCALATION_FIELDS, prompt_fields=fields, sensitive_target=sensitive,
        lists={"investigation_steps": S.INVESTIGATION_STEPS[name],
               "long_term_controls": S.LONG_TERM_CONTROLS[name]},
    )


_STANDARD = (("HIGH", 3), ("MEDIUM", 1))
_SPAN = ("first_activity", "last_activity")
ACCOUNT_ADMIN = _escalation(
    "account_admin_analysis", "admin_assignments_count", (("CRITICAL", 5), ("HIGH", 3)), "MEDIUM",
    ("actor", "target_user", "action_name", *_SPAN, "admin_assignments_count", "unique_targets"), sensitive=True)
WORKSPACE_ACL = _escalation(
    "workspace_acl_analysis", "acl_changes_count", _STANDARD, "LOW",
    ("actor", "target_user", "new_acl", "action_name", *_SPAN, "acl_changes_count", "unique_targets"))
SENSITIVE_GROUP = _escalation(
    "sensitive_group_analysis", "group_additions_count", _STANDARD, "LOW",
    ("actor", "target_user", "group_name", "action_name", *_SPAN, "group_additions_count", "unique_targets",
     "unique_groups"), sensitive=True)
UC_PERMISSION = _escalation(
    "uc_permission_analysis", "permission_changes_count", _STANDARD, "LOW",
    ("actor", "target_principal", "securable_full_name", "securable_type", "permissions", *_SPAN,
     "permission_changes_count", "unique_targets", "unique_securables"), sensitive=True)
ACCOUNT_SETTING = _escalation(
    "account_setting_analysis", "setting_changes_count", _STANDARD, "LOW",
    ("actor", "key_type", "key_name", "settings", "action_name", *_SPAN, "setting_changes_count", "unique_keys"))

FAMILIES = {f.name: f for f in (FAILED_LOGIN, DATA_EXPORT, ACCOUNT_ADMIN, WORKSPACE_ACL,
                                SENSITIVE_GROUP, UC_PERMISSION, ACCOUNT_SETTING)}


def assess(summary: DataFrame, family: Family, scorer: S.Scorer = S.default_scorer,
           keep_prompt: bool = False, memory: AssessmentMemory | None = None) -> DataFrame:
    """Add the assessment column to a summary (optionally keep the prompt for inspection).

    With a ``memory`` only prompts that it does not hold are scored, when this function is called.
    """
    text = S.prompt(family)
    if memory is not None:
        found = memory.assess(summary, family, scorer)
        return found.withColumn("prompt", text) if keep_prompt else found
    extra = [text.alias("prompt")] if keep_prompt else []
    return summary.select("*", scorer(family, text).alias(S.ANALYSIS_COLUMN), *extra)


def with_prompt(summary: DataFrame, family: Family) -> DataFrame:
    """The summary with its prompt text (what a model-backed scorer receives)."""
    return summary.select("*", S.prompt(family).alias("prompt"))


def assess_failed_logins(a3: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-FL over A3."""
    return assess(a3, FAILED_LOGIN, scorer, memory=memory)


def assess_data_exports(a9: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-DE over A9."""
    return assess(a9, DATA_EXPORT, scorer, memory=memory)


def assess_account_admin(a4: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-AA over A4."""
    return assess(a4, ACCOUNT_ADMIN, scorer, memory=memory)


def assess_workspace_acl(a5: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-WA over A5."""
    return assess(a5, WORKSPACE_ACL, scorer, memory=memory)


def assess_sensitive_group(a6: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-SG over A6."""
    return assess(a6, SENSITIVE_GROUP, scorer, memory=memory)


def assess_uc_permission(a7: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-UC over A7."""
    return assess(a7, UC_PERMISSION, scorer, memory=memory)


def assess_account_setting(a8: DataFrame, scorer=S.default_scorer, memory: AssessmentMemory | None = None) -> DataFrame:
    """R-AS over A8."""
    return assess(a8, ACCOUNT_SETTING, scorer, memory=memory)
