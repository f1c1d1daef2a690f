"""Resumable processing: skip what a progress log says is done, process the
rest, append results and progress, report statistics.

The progress log is JSON lines of keys; a restarted run reads it, so work
done before a failure is not repeated and appended results are not
duplicated (the anti-join is on the same key that is appended).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewash.operators.joins import resume_anti_join
from tidewash.sources.jsonl import read_jsonl_tolerant, write_jsonl


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def resume_run(work: DataFrame, key: str, process, results_path: str, progress_path: str,
               key_type: T.DataType = T.LongType()) -> DataFrame:
    """One run: process the work items whose key is not in the progress log.

    ``process`` maps the pending items to result rows (must keep ``key``); an
    item that it leaves out has failed, is not logged and comes again in the
    next run.  Results are appended first, then their keys to the progress log, so a
    crash between the two repeats at most that run's items, and the
    anti-join on the results' keys at the next start removes those.
    Returns this run's newly processed rows (materialised).
    """
    from tidewash.session import checkpoint_root

    spark = work.sparkSession
    schema = T.StructType([T.StructField(key, key_type)])
    done = None
    if _exists(spark, progress_path):
        done, _ = read_jsonl_tolerant(spark, progress_path, schema)
    if _exists(spark, results_path):
        in_results = spark.read.json(results_path, schema=schema).select(key)
        done = in_results if done is None else done.unionByName(in_results)
    pending = work if done is None else resume_anti_join(work, done, key)
    # snapshot the pending items before anything is appended: evaluated
    # lazily after the append, the anti-join would see them as done
    checkpoint_root(spark)
    pending = pending.checkpoint(eager=True)
    out = process(pending).checkpoint(eager=True)  # processed once: appended, logged and returned
    write_jsonl(out, results_path, mode="append")
    write_jsonl(out.select(key), progress_path, mode="append")
    return out


def run_statistics(rows: DataFrame, by: str, failed=None) -> DataFrame:
    """Counts per category plus ok / failed totals of one run."""
    failed = F.lit(False) if failed is None else failed
    return (rows.groupBy(F.coalesce(F.col(by), F.lit("unknown")).alias(by))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(~failed).alias("n_ok"),
                 F.count_if(failed).alias("n_failed")))
