"""Key joins used for resumable processing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.functions.common import names_of


def resume_anti_join(todo: DataFrame, done: DataFrame, key, done_key=None) -> DataFrame:
    """Work items whose key is not in the completed set.

    ``left_anti`` keeps null keys (they can never be "done").  No broadcast
    hint: the planner broadcasts the completed set only when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
    uses a sort-merge anti join; AQE re-decides from runtime sizes.
    """
    keys = names_of(key)
    dkeys = names_of(done_key) or keys
    d = done.select(*[F.col(dk).alias(k) for k, dk in zip(keys, dkeys)])
    if len(keys) == 1:
        cond = todo[keys[0]] == d[keys[0]]
    else:
        cond = None
        for k in keys:
            c = todo[k] == d[k]
            cond = c if cond is None else cond & c
    return todo.join(d, cond, "left_anti")
