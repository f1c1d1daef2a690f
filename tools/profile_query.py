"""Run one registered query with Spark's event log in a fresh scratch folder
and print the slowest stages.  usage: python tools/profile_query.py NAME [sf_dir]"""

import os
import subprocess
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    ev = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    from pyspark.sql import SparkSession

    from tidewash.queries import QUERIES
    from tidewash.session import RECOMMENDED_CONF

    b = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
         .config("spark.driver.memory", "16g").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", ev))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["group_count_sorted"](spark, sf).collect()
    t = time.time()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    print(f"{name}: {time.time() - t:.2f}s")
    spark.stop()
    subprocess.run([sys.executable, os.path.join(os.path.dirname(__file__), "stage_times.py"), ev, "12"])


if __name__ == "__main__":
    main()
