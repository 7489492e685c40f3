"""What the operators of this package share: batches of bounded size, words of a text, checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..lineage import work_path

#: Rows of one Arrow batch. Texts may be long, and Spark's own default of 10,000 rows bounds no bytes.
BATCH_ROWS = 512
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: A-Z lowered, digits, a-z and every byte of a non-ASCII character kept, all else a space. With bytes.split() this
#: yields the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lowered.
_ALNUM = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    return text.translate(_ALNUM).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text whose A-Z are lowered; bytes.lower() and bytes.split() touch ASCII only."""
    return text.lower().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow with batches short enough for long texts."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_CONF, "10000")) > BATCH_ROWS:
        conf.set(BATCH_CONF, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage ends here, and any executor can read it."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw(name: str):
    """A text column as UTF-8 bytes."""
    return F.col(name).cast("string").cast("binary").alias(name)


def key_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys of batches sorted by a numeric key without nulls; a run may span batches.

    A run is held whole, so the caller bounds it.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if held and k[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = k[a]
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Least-member links among numbered points."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        r = self.up[i]
        while (n := self.up[r]).tobytes() != r.tobytes():
            r = n
        return r

    def link(self, i: np.ndarray) -> None:
        """All of `i` belong together."""
        r = self.roots(i)
        least = r.min()
        self.up[r] = least
        self.up[i] = least
