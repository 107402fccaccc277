import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("GRIDMIX_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from gridmix.session import checkpoint_dir, get_spark
    s = get_spark("gridmix-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture
def db(spark, tmp_path):
    """A fresh database in the test's folder."""
    import uuid
    from gridmix.sources import sinks
    name = f"t_{uuid.uuid4().hex[:10]}"
    sinks.ensure_database(spark, name, str(tmp_path / name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")
