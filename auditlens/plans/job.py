"""The detection job: refresh, then write every report and the alert states.

    spark-submit -m auditlens.plans.job --audit <path|table> --tags <path|table> --out <folder>
        [--as-of TS] [--detections <path|table>] [--scorer module:function] [--rules FILE]

One audit pass (plus the ``as_of`` aggregate when no ``--as-of`` is given),
then small jobs over the snapshots. With ``--detections`` (the table the
streaming job keeps) the audit log is not scanned for the windowed layers.
``--scorer`` names ``fn(prompts: pandas.Series, family: str) -> pandas.Series``
(JSON answers), run in Arrow batches once per summary group.
Outputs are parquet tables under ``--out`` (a shared folder), overwritten
per run.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from auditlens.functions import scoring as S
from auditlens.plans.pipeline import SecurityPipeline
from auditlens.session import configure, ship_module
from auditlens.sources.audit import audit as open_source
from auditlens.sources.rules import load_rules

REPORTS = tuple(f"q{i}" for i in range(1, 19))


def load_scorer(spec: str | None, spark: SparkSession | None = None):
    """``module:function`` -> a pandas scorer (None: the default scorer).

    The module (or the package it lies in) is shipped to the executors, which
    unpickle the function by name.
    """
    if not spec:
        return S.default_scorer
    module, _, name = spec.partition(":")
    fn = getattr(importlib.import_module(module), name)
    ship_module(spark or SparkSession.getActiveSession(), module)
    return S.pandas_scorer(fn)


def run_job(spark: SparkSession, audit_source, tags_source, out: str, as_of=None,
            fmt: str = "parquet", detections_source=None, scorer=S.default_scorer, rules: dict | None = None) -> dict[str, str]:
    """Run the whole job; returns output name -> path. ``rules``: a catalogue (None: the packaged one)."""
    configure(spark)
    audit = open_source(audit_source, spark, fmt)
    tags = open_source(tags_source, spark, fmt)
    detections = None if detections_source is None else open_source(detections_source, spark, fmt)
    base = out.rstrip("/")
    job = SecurityPipeline(audit, tags, as_of=as_of, detections=detections, scorer=scorer, rules=rules).refresh(
        path=f"{base}/snapshots")
    written = {}
    for name in REPORTS + ("l6",):
        path = f"{base}/{name}"
        getattr(job, name)().write.mode("overwrite").format(fmt).save(path)
        written[name] = path
    return written


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--audit", required=True)
    parser.add_argument("--tags", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--as-of", default=None)
    parser.add_argument("--detections", default=None)
    parser.add_argument("--scorer", default=None, help="module:function of a pandas scorer")
    parser.add_argument("--rules", default=None, help="alert-rule catalogue (JSON), in any file system that Spark reads")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("auditlens-job").getOrCreate()
    for name, path in run_job(spark, args.audit, args.tags, args.out, args.as_of,
                              detections_source=args.detections,
                              scorer=load_scorer(args.scorer, spark),
                              rules=load_rules(args.rules, spark)).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
