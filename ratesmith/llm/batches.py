"""The size of the Arrow batches that tasks hand to the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Spark's own bound is 64 MB a batch; the JVM and the worker each hold one, besides the operator's arrays.
BATCH_BYTES = 16 << 20
_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``BATCH_BYTES`` (a smaller setting stays)."""
    conf = df.sparkSession.conf
    text = str(conf.get(_KEY)).strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    size = int(text[:-1] if unit > 1 else text) * unit
    if size <= 0 or size > BATCH_BYTES:
        conf.set(_KEY, str(BATCH_BYTES))
    return df
