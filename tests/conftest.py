import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidewash.session import RECOMMENDED_CONF

    ckpt = tempfile.mkdtemp(prefix="tidewash-test-ckpt-")
    b = (SparkSession.builder.master("local[*]").appName("tidewash-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", ckpt))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
