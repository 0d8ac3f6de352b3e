import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetwise.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="fleetwise-tests",
                      extra={"spark.driver.memory": "4g",
                                                    "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fleetwise-test-")})
    yield s


def timeline(spark, script, scale=1):
    """Scripted timeline: ('E', time, key, value) / ('W', time) -> DataFrame."""
    rows = []
    for i, r in enumerate(script):
        if r[0] == "E":
            rows.append((i, "E", r[1] * scale, r[2], r[3]))
        else:
            rows.append((i, "W", r[1] * scale, None, None))
    return spark.createDataFrame(rows, "seq bigint, kind string, time bigint, key bigint, value bigint")
