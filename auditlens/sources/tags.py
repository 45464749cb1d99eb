"""Sensitive-table lookup and the sensitive-group list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups whose membership changes count as sensitive.
SENSITIVE_GROUPS = ("admins", "account_admins", "metastore_admins", "security-admins")

# Fixed value: tag pattern marking a table as holding personal data.
PII_TAG_PATTERN = "%pii%"


#: Columns of a tag table that keeps its history: a tag holds from the first (null: always) until before the second (null: still).
VALIDITY = ("valid_from", "valid_to")


def has_validity(tags: DataFrame) -> bool:
    return set(VALIDITY) <= set(tags.columns)


def sensitive_tables(tags: DataFrame, dedupe: bool = False) -> DataFrame:
    """Full names of tables tagged as personal data (and when, if the tag table says so).

    One row per matching tag (a table with two such tags appears twice),
    unless ``dedupe``.
    """
    out = tags.filter(F.col("tag_value").like(PII_TAG_PATTERN)).select(
        F.concat(F.col("catalog_name"), F.lit("."), F.col("schema_name"), F.lit("."),
                 F.col("table_name")).alias("securable_full_name"), *(VALIDITY if has_validity(tags) else ()))
    return out.distinct() if dedupe else out


def with_tags(securables: DataFrame, tags: DataFrame, dedupe: bool = False) -> DataFrame:
    """Left join of rows that name a securable with the tags that held when they happened: ``_tagged_name``.

    Tags without validity hold at all times. A row is repeated for each of several matching tags. The join is on the
    name; the interval is a condition on top of it, so a table with a long history is no product with anything else.
    """
    tagged = sensitive_tables(tags, dedupe).withColumnsRenamed(
        {"securable_full_name": "_tagged_name", **{c: f"_{c}" for c in VALIDITY}})
    on = F.col("securable_full_name") == F.col("_tagged_name")
    if has_validity(tags):
        at, start, end = F.col("event_time"), F.col("_valid_from"), F.col("_valid_to")
        on = on & (start.isNull() | (at >= start)) & (end.isNull() | (at < end))
    return securables.join(tagged, on, "left").drop(*(f"_{c}" for c in VALIDITY))


def sensitive_groups(spark) -> DataFrame:
    """The sensitive-group list as a one-column relation."""
    return spark.createDataFrame([(g,) for g in SENSITIVE_GROUPS], "group_name string")
