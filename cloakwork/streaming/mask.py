"""Masking an unbounded input: a stream joined with the registry's current snapshot.

Each micro-batch is checked before it is written: a value without a mapping stops the query, and the batch is tried again when
the query restarts, so nothing unmasked gets out. Restarting also picks up a newer snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..errors import TransformError
from ..operators.keys import Digester
from ..operators.registry import Registry
from ..operators.transform import mask_table, missing_mappings
from ..plans.policy import Policy


def mask_stream(stream: DataFrame, columns: dict[str, str], registry: Registry, policy: Policy, digester: Digester, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write the masked stream as Parquet under `path`, a folder for each batch: a retried batch replaces what it left."""
    from functools import reduce

    from pyspark.sql import functions as F

    def write(batch: DataFrame, number: int) -> None:
        mappings = registry.frame()
        parts = []
        for c, g in columns.items():
            k = digester(g, policy.groups[g].normalization, policy.groups[g].allow_empty, False)(F.col(c))
            parts.append(batch.where(F.col(c).isNotNull()).select(F.lit(g).alias("group_id"), F.coalesce(k["digest"], F.lit("")).alias("source_hmac")))
        if not missing_mappings(reduce(DataFrame.unionByName, parts).distinct(), mappings).isEmpty():
            raise TransformError("a batch holds a value without a mapping")
        mask_table(batch, columns, mappings, policy, digester).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
