"""Which hashes occur more than once in the whole corpus, asked and answered in packed blobs.

A group of documents sends each of its hashes once, cut by value into buckets; one row holds all of a group's hashes for
one bucket. A bucket's task sorts what it got and answers each blob with one status byte per hash. So a hash that a
third of all rows hold reaches its bucket once a group, not once a row, and the answers are small.

A group's hashes are spread over all buckets, so the larger the corpus, the fewer share a row: never more rows than
hashes, and to keep them well below, groups grow with the corpus (``common.group_bytes``). Rows are
made and cut as whole arrays, without a step of Python for each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Hashes a bucket gets about, if none repeats.
BUCKET_KEYS = 100_000
ASKED = "b int, g int, keys binary, multi binary"
ANSWERED = "round int, g int, b int, status binary"
_ASKED = pa.schema([("b", pa.int32()), ("g", pa.int32()), ("keys", pa.binary()), ("multi", pa.binary())])
_ANSWERED = pa.schema([("round", pa.int32()), ("g", pa.int32()), ("b", pa.int32()), ("status", pa.binary())])


def buckets(expected_keys: float) -> int:
    return max(1, math.ceil(expected_keys / BUCKET_KEYS))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows of ``keys`` (n, width), whether each occurs twice or more, and each row's place among them."""
    if not len(keys):
        return keys, np.zeros(0, bool), np.zeros(0, np.int64)
    order = np.lexsort(keys.T[::-1]) if keys.shape[1] > 1 else np.argsort(keys[:, 0], kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[at], np.diff(np.append(at, len(keys))) > 1, place


def ask(g: int, keys: np.ndarray, multi: np.ndarray, n: int) -> pa.Table:
    """Rows for sorted distinct ``keys``, dealt evenly to ``n`` buckets by the upper 32 bits: one for each that gets any."""
    of = ((keys[:, 0] >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    at = np.flatnonzero(np.append(len(of) > 0, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    ends = np.append(at, len(of))
    blobs = [_blobs(keys, ends * keys.shape[1] * 8), _blobs(multi.astype(np.uint8), ends)]
    return pa.table([pa.array(of[at].astype(np.int32)), pa.array(np.full(len(at), g, np.int32)), *blobs], schema=_ASKED)


def _blobs(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``data`` cut at ``ends`` (bytes) into binary values, without a step for each: there may be as many as keys."""
    body = np.ascontiguousarray(data).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(body)])


def answers(table: pa.Table, round_: int, length: int) -> np.ndarray:
    """The status bytes of one round for a group, in the order of its sorted distinct keys."""
    of = [(b, s) for r, b, s in zip(*(table.column(c).to_pylist() for c in ("round", "b", "status"))) if r == round_]
    out = np.frombuffer(b"".join(s for _, s in sorted(of)), np.uint8)
    if len(out) != length:
        raise RuntimeError(f"round {round_}: {len(out)} answers for {length} hashes; were the texts not read alike?")
    return out


def _by_blob(table: pa.Table, width: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Blobs in the order of their groups: rows of a shuffle come in any order, and answers must not depend on it."""
    table = table.sort_by("g")
    gs, blobs, multis = (table.column(c).to_pylist() for c in ("g", "keys", "multi"))
    keys = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, width)
    sizes = np.array([len(m) for m in multis], np.int64)
    return gs, keys, np.frombuffer(b"".join(multis), np.uint8), sizes


def _reply(round_: int, b: int, gs: list[int], status: np.ndarray, sizes: np.ndarray) -> pa.Table:
    n = len(gs)
    cut = _blobs(status, np.concatenate([[0], np.cumsum(sizes)]))
    return pa.table([pa.array(np.full(n, round_, np.int32)), pa.array(gs, pa.int32()), pa.array(np.full(n, b, np.int32)), cut], schema=_ANSWERED)


def repeated_in(table: pa.Table, round_: int, width: int) -> pa.Table:
    """One bucket's answers for ``repeated``."""
    gs, keys, multi, sizes = _by_blob(table, width)
    _, twice, place = distinct(keys)
    status = (twice[place] | (np.bincount(place, multi, len(twice))[place] > 0)).astype(np.uint8)
    return _reply(round_, table.column("b")[0].as_py(), gs, status, sizes)


def repeated(asked: DataFrame, round_: int, width: int) -> DataFrame:
    """Answers 1 for each hash of ``width`` 64-bit words that two groups hold or one group holds twice, else 0."""

    def resolve(table: pa.Table) -> pa.Table:
        return repeated_in(table, round_, width)

    return asked.groupBy("b").applyInArrow(resolve, ANSWERED)


#: Answers of ``refined``.
NONE, ALL, SOME, ALL_AND_SHOW = 0, 1, 2, 3


def refined_in(table: pa.Table, round_: int) -> pa.Table:
    """One bucket's answers for ``refined``."""
    gs, keys, multi, sizes = _by_blob(table, 3)
    _, twice, whole = distinct(keys)
    again = (twice | (np.bincount(whole, multi, len(twice)) > 0))[whole] & keys[:, 1:].any(axis=1)
    _, twice, core = distinct(keys[:, :1])
    shared = (twice | (np.bincount(core, multi, len(twice)) > 0))[core]
    low, high = np.full(len(twice), len(keys)), np.full(len(twice), -1)
    np.minimum.at(low, core, whole)
    np.maximum.at(high, core, whole)
    mixed = (low != high)[core]
    first = np.zeros(len(keys), bool)
    first[np.unique(whole, return_index=True)[1]] = True
    status = np.where(~shared, NONE, np.where(again, np.where(mixed & first, ALL_AND_SHOW, ALL), SOME)).astype(np.uint8)
    return _reply(round_, table.column("b")[0].as_py(), gs, status, sizes)


def refined(asked: DataFrame, round_: int) -> DataFrame:
    """Answers for keys (core, whole, whole'): what is known of the members of a core bucket once it is sorted by whole.

    NONE: the core occurs once. ALL: the whole occurs again, and so does all that lies in it. SOME: the core occurs again
    and the whole doesn't, so each string in it is to be asked for. ALL_AND_SHOW: as ALL, and as another member of the
    core bucket has to ask, this group must ask too, for all members with the same whole. A whole of 0, 0 is none.
    """

    def resolve(table: pa.Table) -> pa.Table:
        return refined_in(table, round_)

    return asked.groupBy("b").applyInArrow(resolve, ANSWERED)
