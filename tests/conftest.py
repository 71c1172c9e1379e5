import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from farsight.session import local_session
    s = local_session(4, shuffle_partitions=8)
    # tests compare with Python's md5 draws
    s.conf.set("farsight.draw.hash", "md5")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    yield s


def pts_df(spark, coords, start_id=0):
    rows = [(start_id + i, float(x), float(y)) for i, (x, y) in enumerate(coords)]
    return spark.createDataFrame(rows, "id long, x double, y double")


def items_df(spark, items):
    return spark.createDataFrame([(i, int(v)) for i, v in enumerate(items)], "pos long, item int")
