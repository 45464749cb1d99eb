"""Assessments remembered by prompt, so that a scorer is asked only what it was not asked before.

A refresh builds the same prompt again for every group that has not changed.
The answers lie in a table, by family, version of the scorer and prompt; a
refresh sends the prompts that are not there (an anti-join), once each
however many groups share them, adds their answers, and gives every group
its answer by a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions import scoring as S
from auditlens.sources.sinks import prune_published, publish, published, write_version

SCHEMA = "family string, version string, prompt_hash string, prompt string, answer string"


class AssessmentMemory:
    """Answers of one version of a scorer, in a shared folder (``version``: another model, another memory)."""

    def __init__(self, spark: SparkSession, path: str, version: str = "1", most_parts: int = 20):
        self.spark, self.path, self.version, self.most_parts = spark, path.rstrip("/"), version, most_parts

    def _parts(self) -> list[str]:
        return (published(self.spark, self.path) or {"parts": []})["parts"]

    def _read(self, parts: list[str]) -> DataFrame:
        frames = [self.spark.read.schema(SCHEMA).parquet(p) for p in parts]
        return reduce(DataFrame.unionByName, frames, self.spark.createDataFrame([], SCHEMA))

    def answers(self) -> DataFrame:
        """Everything remembered, of all versions."""
        return self._read(self._parts())

    def assess(self, summary: DataFrame, family: S.Family, scorer: S.Scorer, column: str = S.ANALYSIS_COLUMN) -> DataFrame:
        """``summary`` with the assessment ``column``. Null prompts are not sent and stay null; a prompt whose answer is null is sent again the next time.

        Unseen prompts are scored and written at once; the result reads them from there.
        """
        asked = summary.withColumn("_prompt", S.prompt(family)).withColumn("_hash", F.sha2("_prompt", 256))
        parts = self._parts()

        def mine(frame: DataFrame) -> DataFrame:
            told = (F.col("family") == family.name) & (F.col("version") == self.version) & F.col("answer").isNotNull()
            return frame.where(told).select(F.col("prompt_hash").alias("_hash"), F.col("prompt").alias("_prompt"), F.col("answer").alias(column))

        known = mine(self._read(parts))
        unseen = asked.where("_prompt IS NOT NULL").join(known, ["_hash", "_prompt"], "left_anti").dropDuplicates(["_hash", "_prompt"])
        new = unseen.select(F.lit(family.name).alias("family"), F.lit(self.version).alias("version"), F.col("_hash").alias("prompt_hash"),
                            F.col("_prompt").alias("prompt"), scorer(family, F.col("_prompt")).alias("answer"))
        part = write_version(new, f"{self.path}/parts")
        told = self._read([part])
        every = [*parts, part]
        publish(self.spark, self.path, {"parts": every})
        if len(every) > self.most_parts:
            whole = write_version(self._read(every).where("answer IS NOT NULL"), f"{self.path}/parts")
            publish(self.spark, self.path, {"parts": [whole]})
            # results of the last assessments, which read their parts, stay readable
            prune_published(self.spark, self.path, lambda c: c["parts"], keep=2 * self.most_parts)
        answers = known.unionByName(mine(told))
        return asked.join(answers, ["_hash", "_prompt"], "left").select(*summary.columns, column)
