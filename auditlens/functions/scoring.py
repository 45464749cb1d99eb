"""Prompt column, response schema, pluggable scorer.

The assessment of a summary row is a JSON text column. The default scorer
is a set of Catalyst expressions (no Python per row) that grades the group
by its count. A user scorer (for example a model client) is plugged in as
an Arrow-batched pandas UDF over the prompt column. Either way the score is
computed once per summary group, after aggregation.

Contract kept from the source rules: any NULL field makes the prompt NULL,
and a NULL prompt gets a NULL assessment.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from auditlens.functions.exprs import hours_between

ANALYSIS_COLUMN = "ai_comprehensive_analysis"
POSTURE_COLUMN = "ai_security_posture_assessment"
LEVEL_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# Response fields per analysis kind (after risk_level, risk_factors, immediate_actions).
RECOMMENDATION_FIELDS = ("long_term_recommendations",)
ESCALATION_FIELDS = ("investigation_steps", "long_term_controls")
POSTURE_FIELDS = ("overall_risk_level", "key_risk_areas", "immediate_actions",
                  "strategic_recommendations", "compliance_considerations")

# The texts of the default scorer (ours, not a model's).
IMMEDIATE_ACTIONS = {
    "CRITICAL": ["Revoke the granted privilege", "Suspend the actor pending review", "Open an incident"],
    "HIGH": ["Review the activity with the actor", "Restrict access until reviewed"],
    "MEDIUM": ["Confirm the change was approved"],
    "LOW": ["No immediate action"],
}
LONG_TERM_RECOMMENDATIONS = {
    "failed_login_analysis": ["Enforce multi-factor authentication", "Rate-limit login attempts"],
    "data_export_analysis": ["Restrict bulk downloads to approved roles", "Label sensitive artifacts"],
}
INVESTIGATION_STEPS = {
    "account_admin_analysis": ["Check who approved the admin grant", "List actions of the new admin"],
    "workspace_acl_analysis": ["Compare the ACL with the access policy"],
    "sensitive_group_analysis": ["Check the membership request", "List actions of the new member"],
    "uc_permission_analysis": ["Check the data owner approved the grant", "List reads of the securable"],
    "account_setting_analysis": ["Compare the setting with the baseline"],
}
LONG_TERM_CONTROLS = {
    "account_admin_analysis": ["Require two-person approval for admin grants"],
    "workspace_acl_analysis": ["Manage workspace ACLs as code"],
    "sensitive_group_analysis": ["Review sensitive group membership monthly"],
    "uc_permission_analysis": ["Grant sensitive data through groups only"],
    "account_setting_analysis": ["Alert on changes to security settings"],
}
POSTURE_AREAS = ("failed_logins", "data_exports", "privilege_escalations")
POSTURE_RECOMMENDATIONS = {
    "failed_logins": "Enforce multi-factor authentication",
    "data_exports": "Restrict bulk export paths",
    "privilege_escalations": "Adopt just-in-time admin access",
}
POSTURE_COMPLIANCE = {
    None: "Retain audit evidence for review",
    "data_exports": "Record transfers of regulated data",
    "privilege_escalations": "Document privileged access changes",
}


@dataclass(frozen=True)
class Family:
    """One assessment family: what is counted, how it is graded, what it reports."""

    name: str
    count_col: str
    bands: tuple[tuple[str, int], ...]      # (level, count strictly above), first match wins
    floor: str                              # level when no band matches
    extra_fields: tuple[str, ...]
    prompt_fields: tuple = ()               # what the scorer is told: column names, or (label, from, to) for hours
    multiple_entities_col: str | None = None
    sensitive_target: bool = False
    span: tuple[str, str] = ("first_activity", "last_activity")
    lists: dict = field(default_factory=dict)

    @property
    def top_level(self) -> str:
        return self.bands[0][0]

    @property
    def levels(self) -> tuple[str, ...]:
        """The risk levels an answer may give, highest first."""
        return tuple(name for name, _ in self.bands) + (self.floor,)


def response_schema(fields) -> str:
    """R2: the structured response as a DDL schema (first field text, the rest text lists)."""
    first, *rest = fields
    return ", ".join([f"{first} STRING"] + [f"{name} ARRAY<STRING>" for name in rest])


def response_fields(family: Family) -> tuple[str, ...]:
    if family.name == "security_posture_summary":
        return POSTURE_FIELDS
    return ("risk_level", "risk_factors", "immediate_actions", *family.extra_fields)


def family_schema(family: Family) -> str:
    return response_schema(response_fields(family))


def parse_assessment(column: Column, family: Family) -> Column:
    """The assessment JSON as a struct of its response schema."""
    return F.from_json(column, family_schema(family))


def instruction(family: Family) -> str:
    """What the scorer is asked for, from the response schema."""
    level, *lists = response_fields(family)
    return (f"{family.name}: answer with one JSON object. {level} is one of {', '.join(family.levels)}; "
            f"{', '.join(lists)} are lists of short texts. Data: ")


def prompt(family: Family) -> Column:
    """Instruction and data as JSON text; NULL as soon as one field is NULL."""
    values = []
    for part in family.prompt_fields:
        if isinstance(part, tuple):
            label, start, end = part
            values.append(hours_between(F.col(start), F.col(end)).cast("string").alias(label))
        else:
            values.append(F.col(part).cast("string").alias(part))
    return prompt_of(family, values)


def prompt_of(family: Family, values: list[Column]) -> Column:
    known = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
    return F.when(known, F.concat(F.lit(instruction(family)), F.to_json(F.struct(*values))))


def risk_level(family: Family) -> Column:
    n = F.col(family.count_col)
    level = None
    for name, above in family.bands:
        level = F.when(n > above, F.lit(name)) if level is None else level.when(n > above, F.lit(name))
    return level.otherwise(F.lit(family.floor))


def _text_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _by_level(level: Column, table: dict) -> Column:
    out = None
    for name in LEVEL_ORDER:
        branch = _text_array(table[name])
        out = F.when(level == name, branch) if out is None else out.when(level == name, branch)
    return out


def risk_factors(family: Family, level: Column) -> Column:
    start, end = family.span
    flags = [F.when(level == family.top_level, F.lit("high_volume"))]
    if family.multiple_entities_col:
        flags.append(F.when(F.col(family.multiple_entities_col) > 1, F.lit("multiple_entities")))
    flags.append(F.when(hours_between(F.col(start), F.col(end)) >= 24, F.lit("sustained")))
    if family.sensitive_target:
        flags.append(F.lit("sensitive_target"))
    return F.array_compact(F.array(*flags))


def rule_assessment(family: Family) -> Column:
    """The default assessment as a struct (before JSON encoding)."""
    level = risk_level(family)
    fields = [
        level.alias("risk_level"),
        risk_factors(family, level).alias("risk_factors"),
        _by_level(level, IMMEDIATE_ACTIONS).alias("immediate_actions"),
    ]
    for name in family.extra_fields:
        fields.append(_text_array(family.lists[name]).alias(name))
    return F.struct(*fields)


Scorer = Callable[[Family, Column], Column]


def rule_scorer(family: Family, prompt_col: Column) -> Column:
    """R3 default: deterministic grading by count; NULL prompt -> NULL."""
    return F.when(prompt_col.isNotNull(), F.to_json(rule_assessment(family)))


def pandas_scorer(fn: Callable, conform: bool = True) -> Scorer:
    """Wrap ``fn(prompts: pandas.Series, family_name: str) -> pandas.Series`` of JSON text.

    The function runs in Arrow batches on the executors (one call per
    batch, not per row). NULL prompts are not sent; they stay NULL. With
    ``conform`` the answers are parsed with the family's response schema
    and written back, so unknown fields are dropped and types enforced.
    """
    def scorer(family: Family, prompt_col: Column) -> Column:
        name = family.name

        @F.pandas_udf(StringType())
        def _score(prompts: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(prompts), index=prompts.index, dtype=object)
            mask = prompts.notna()
            if mask.any():
                out[mask] = list(fn(prompts[mask], name))
            return out

        # a model need not answer twice alike: never duplicated or pushed through a filter by the optimizer
        raw = _score.asNondeterministic()(prompt_col)
        if not conform:
            return raw
        return F.to_json(parse_assessment(raw, family))  # NULL stays NULL; one reference, so one call

    return scorer


def default_scorer(family: Family, prompt_col: Column) -> Column:
    return rule_scorer(family, prompt_col)
