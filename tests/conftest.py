import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roaslens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="roaslens-tests")
    yield s


def engine_rows(spark, rows):
    """Engine frame from tuples (SUB, CH, DIV, PROD, Spend_c, Spend_p, Rev_c, Rev_p, Clk_c, Clk_p, Ord_c, Ord_p)."""
    from roaslens.schema import ENGINE_SCHEMA
    return spark.createDataFrame([tuple(r[:4]) + tuple(float(x) for x in r[4:]) for r in rows], ENGINE_SCHEMA)
