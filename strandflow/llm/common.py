"""What several operators of this subpackage share: checkpoints, grouping of texts, hashing."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.session import checkpointed, shared_folder  # noqa: F401  also for the other modules

#: Bytes of text one group of documents holds on average; a Python task works on one group. From GROUP_FROM bytes on
#: groups grow with the square root of the corpus, up to GROUP_MOST times as large.
GROUP_BYTES, GROUP_FROM, GROUP_MOST = 2 << 20, 4 << 30, 8
#: Bytes of text that a task gets about, at most.
TASK_BYTES = 64 << 20
#: Bytes of text that are turned into numpy arrays together.
CHUNK_BYTES = 1 << 18


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A top-level column, whatever its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores behind them as it takes for ``df`` to have no such column."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts: one aggregate over the text column."""
    return docs.agg(F.sum(F.octet_length(quoted(text)).cast("long")).alias("n")).first()["n"] or 0


def group_bytes(total: int) -> int:
    return int(GROUP_BYTES * min(GROUP_MOST, max(1.0, math.sqrt(total / GROUP_FROM))))


def grouped(docs: DataFrame, doc_id: str, text: str, carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """(g, id, body[, rest]) with documents dealt to groups of about GROUP_BYTES by a hash of id and text, and all bytes.

    The same row always has the same g, so several passes over the texts can share one exchange. ``rest`` holds the
    columns ``carry``.
    """
    total = text_bytes(docs, text)
    groups = max(1, math.ceil(total / group_bytes(total)))
    body = F.coalesce(quoted(text), F.lit(""))
    g = F.pmod(F.xxhash64(quoted(doc_id), body), F.lit(groups)).cast("int")
    rest = [F.struct(*map(quoted, carry)).alias("rest")] if carry else []
    rows = docs.select(g.alias("g"), quoted(doc_id).alias("id"), body.cast("binary").alias("body"), *rest)
    tasks = math.ceil(total / TASK_BYTES)  # a task has a bounded share of the texts, however few the session asks for
    return rows.repartition(tasks, "g") if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows, total


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (the multiply and xor-shift of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def splitmix(seed: int, n: int) -> np.ndarray:
    """``n`` well-mixed 64-bit values of a seed."""
    return mix(np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Rolling:
    """Polynomial hashes modulo 2**64 of any run of a sequence, by prefix sums."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n + 1:
            size = max(n + 1, 2 * len(self.up))
            for name, factor in (("up", self.base), ("down", self.inverse)):
                out = np.ones(size, np.uint64)
                np.multiply.accumulate(np.concatenate([out[:1], np.full(size - 1, factor, np.uint64)]), out=out)
                setattr(self, name, out)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._powers(len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the values from ``start`` to ``end`` (exclusive), not yet finalised."""
        self._powers(len(prefix))
        return (prefix[end] - prefix[start]) * self.down[start]
