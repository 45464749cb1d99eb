import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from auditlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8)


@pytest.fixture
def make_audit(spark):
    from audit_rows import TEST_SCHEMA

    def build(rows):
        return spark.createDataFrame(rows, TEST_SCHEMA)
    return build


@pytest.fixture
def empty_tags(spark):
    return spark.createDataFrame([], "catalog_name string, schema_name string, table_name string, tag_value string")
