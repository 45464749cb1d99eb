"""A stand-in for a model client used by the scorer tests (no network)."""

import pandas as pd


def score(prompts: pd.Series, family: str) -> pd.Series:
    level = "HIGH" if family != "security_posture_summary" else None
    key = "risk_level" if level else "overall_risk_level"
    return prompts.map(lambda p: '{"%s":"%s","risk_factors":["len_%d"]}' % (key, level or "LOW", len(p)))
