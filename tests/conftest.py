import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from cytoline.session import session

    extra = {"spark_sql_shuffle_partitions": "4", "spark_ui_enabled": "false", "spark_driver_memory": "4g"}
    spark = session("tests", "local[4]", **extra)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
