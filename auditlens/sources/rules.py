"""The alert-rule catalogue.

Rules are data: a metric (a packaged id or a declaration) plus parameters
(window name, operator, threshold, schedule), never SQL text, so no template
formatting or quoting can break them; they are a list or keyed by name. The catalogue is a small configuration file read once on
the driver; the definitions built from it are a DataFrame (L7).
"""

from __future__ import annotations

import json
from importlib import resources
from pathlib import Path

from pyspark.sql import SparkSession

from auditlens.sources.sinks import read_text

DEFAULT_CRON = "0 0 10 1/7 * ?"


def load_rules(rules_file: str | Path | None = None, spark: SparkSession | None = None) -> dict:
    """Load the rule catalogue (JSON). Without a path, the packaged catalogue.

    With a session the file is read where Spark reads its tables (shared storage, any of its file systems): a job in
    cluster mode needs no copy on its driver's host.
    """
    if rules_file is None:
        text = resources.files("auditlens.sources").joinpath("alert_rules.json").read_text()
    elif spark is not None:
        text = read_text(spark, str(rules_file))
    else:
        text = Path(rules_file).read_text()
    rules = json.loads(text)
    for key in ("global", "time_intervals", "alerts"):
        if key not in rules:
            raise ValueError(f"rule catalogue lacks '{key}'")
    return rules


# Detection rule metadata (rule id, title, version, MITRE tactic, technique, detections).
DETECTION_RULES = [
    ("AUTH-001", "Failed login detection", "2.0.0", None, None, ["D1"]),
    ("AUTH-002", "Privilege escalation detection", "2.0.0", "TA0004 (Privilege Escalation)",
     "T1548 (Abuse Elevation Control Mechanism)", ["D2", "D3", "D4", "D5", "D6", "D7"]),
    ("DATA-001", "Large data export detection", "2.0.0", "TA0010 (Exfiltration)",
     "T1041 (Exfiltration Over C2 Channel)", ["D8"]),
]


def detection_rules(spark):
    """Rule metadata as a DataFrame, one row per (rule, detection); join on ``detection``."""
    from pyspark.sql import functions as F

    rules = spark.createDataFrame(
        DETECTION_RULES,
        "rule_id string, title string, version string, tactic string, technique string, "
        "detections array<string>")
    return rules.select("rule_id", "title", "version", "tactic", "technique",
                        F.explode("detections").alias("detection"))
