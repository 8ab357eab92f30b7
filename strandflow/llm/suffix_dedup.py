"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere, by doubled hashes.

This replaces bucket-pointer refinement: no bucket is sorted on the identifiers of later offsets (see README).

Suffixes are put in buckets by their first Q bytes. A bucket of more depth is named by the bucket identifiers at later
offsets: depth 2Q at p by the identifiers of depth Q at p and p + Q, and so on, each level from the one just made. An
identifier is a mixed 64-bit name of the content, so it is the same in every task, and the levels are refined where the
text lies; what needs the whole corpus is only which identifiers occur again, asked by ``exchange``, where tasks sort
the identifiers. Three rounds narrow down the suffixes that stay in question:

1. the Q-byte bucket at the anchor of each window. The anchor is the position with the least Q-byte bucket in the
   window (leftmost of equals), so equal windows have equal anchors; about one position in 88 is one;
2. cells of STEP neighbouring windows that share an anchor: a bucket of the bytes common to all of them, split by the
   bucket of the bytes of all of them together. A cell whose whole string occurs again is settled;
3. in the other cells, the bucket at full depth of each single window, as a 128-bit name.

So the sets in question shrink as in the sequential algorithm, no task ever holds a bucket's members as pairs, and a
string that thousands of documents share costs each group of documents one entry.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandflow.llm import exchange
from strandflow.llm.common import CHUNK_BYTES, Rolling, grouped, mix, quoted, splitmix
from strandflow.llm.substring_dedup import ranked_rows

Q = 25
#: Length of the strings that are looked for: eight times Q, three doublings.
LENGTH = 200
STEP = 16
_WINDOW = LENGTH - Q + 1
_CORE = LENGTH - STEP + 1
_POSITION = np.uint64((1 << 31) - 1)
_LETTER = splitmix(11, 256)
_ROLL = Rolling(0x9E3779B97F4A7C15)
_ODD = splitmix(12, 8) | np.uint64(1)

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
#: What comes after the id.
RESULT = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("kept", T.BinaryType())]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by running minima from both ends of blocks of that width."""
    n = len(values)
    pad = -n % width
    rows = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _join(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """The identifier of a bucket pair: of a prefix and of the suffix at a later offset."""
    return mix(left * _ODD[2 * salt] + (right ^ (right >> np.uint64(32))) * _ODD[2 * salt + 1] + np.uint64(salt))


class Piece:
    """Whole documents, one after the other, or a stretch of a long one, with the windows that may start in them.

    Of a stretch the windows from ``start`` on count. If the document goes on (``more``), the last run of windows with
    one anchor is left to the next stretch, which begins at ``next``: no run is ever seen in two stretches.
    """

    def __init__(self, bodies: list[bytes], start: int = 0, more: bool = False):
        self.sizes = np.array([len(b) for b in bodies], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        self.runs = np.zeros((0, 3), np.int64)  # anchor, first and last window start
        n = len(self.data)
        if n < LENGTH:
            return
        valid = np.ones(n - LENGTH + 1, bool)
        valid[:start] = False
        for end in self.ends.tolist():  # no window runs past its document
            valid[max(0, end - LENGTH + 1 - (STEP if more else 0)) : end] = False
        if not valid.any():
            return
        prefix = _ROLL.prefix(_LETTER[self.data])
        self.first = mix((prefix[Q:] - prefix[:-Q]) * _ROLL.down[: n - Q + 1])  # the initial buckets
        packed = (self.first & ~_POSITION) | np.arange(len(self.first), dtype=np.uint64)
        anchor = (_sliding_min(packed, _WINDOW) & _POSITION).astype(np.int64)
        at = np.flatnonzero(valid)
        own = anchor[at]
        new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (np.diff(at) > 1)))
        self.runs = np.stack([own[new], at[new], at[np.append(new[1:], len(at)) - 1]], axis=1)
        if more:
            self.next = int(self.runs[-1, 1])
            self.runs = self.runs[:-1]

    def bucket(self, at: np.ndarray, depth: int, salt: int = 0) -> np.ndarray:
        """Identifiers at depth Q, 2Q, 4Q, 8Q of the suffixes ``at``, from those of half the depth at two offsets."""
        if depth == Q:
            return self.first[at]
        half = depth // 2
        return _join(self.bucket(at, half, salt), self.bucket(at + half, half, salt), salt)

    def anchors(self) -> np.ndarray:
        return self.bucket(self.runs[:, 0], Q)[:, None] if len(self.runs) else np.zeros((0, 1), np.uint64)

    def cells(self, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, last window start) of each cell of the runs ``kept``, and its (core, whole, whole') identifiers."""
        runs = self.runs[kept]
        if not len(runs):
            return np.zeros((0, 2), np.int64), np.zeros((0, 3), np.uint64)
        low, high = (runs[:, 0] - runs[:, 2]) // STEP, (runs[:, 0] - runs[:, 1]) // STEP
        count = high - low + 1
        run = np.repeat(np.arange(len(runs)), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[run]
        last = runs[run, 0] - STEP * k
        first = last - STEP + 1
        core = _join(_join(self.bucket(last, 4 * Q, 2), self.bucket(last + 4 * Q, 2 * Q, 2), 2), self.bucket(last + _CORE - 2 * Q, 2 * Q, 2), 2)
        inside = np.searchsorted(self.ends, runs[run, 1], side="right")  # the document
        whole = np.zeros((len(run), 2), np.uint64)
        fits = np.flatnonzero((first >= (self.ends - self.sizes)[inside]) & (last + LENGTH <= self.ends[inside]))
        for salt in (0, 1):
            whole[fits, salt] = _join(self.bucket(first[fits], LENGTH, salt), self.bucket(last[fits], LENGTH, salt), salt)
        span = np.stack([np.maximum(first, runs[run, 1]), np.minimum(last, runs[run, 2])], axis=1)
        return span, np.column_stack([core, whole])

    def windows(self, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each window start of ``spans`` and the 128-bit identifier of its bucket at full depth."""
        count = spans[:, 1] - spans[:, 0] + 1
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(spans[:, 0], count)
        if not len(at):
            return at, np.zeros((0, 2), np.uint64)
        return at, np.column_stack([self.bucket(at, LENGTH, salt) for salt in (0, 1)])


def _spread(flags: np.ndarray, parts: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(flags, np.cumsum([len(p) for p in parts])[:-1]) if parts else []


class Group:
    """The documents of one group, in an order that only the rows determine."""

    def __init__(self, table: pa.Table):
        self.g = table.column("g")[0].as_py()
        ids, bodies = table.column("id").to_pylist(), table.column("body").to_pylist()
        ranked = ranked_rows(ids, bodies)
        self.id_type = table.column("id").type
        self.ids, self.bodies = [ids[i] for i in ranked], [bodies[i] for i in ranked]
        self.rest = table.column("rest").take(pa.array(ranked, pa.int64())) if "rest" in table.column_names else None

    def pieces(self):
        """(documents, piece, where it begins in the document): of about CHUNK_BYTES, longer documents in stretches."""
        held: list[int] = []
        size = 0
        for i, body in enumerate(self.bodies):
            if held and size + len(body) > CHUNK_BYTES:
                yield held, Piece([self.bodies[k] for k in held]), 0
                held, size = [], 0
            if len(body) <= 2 * CHUNK_BYTES:
                held.append(i)
                size += len(body)
                continue
            start, more = 0, True
            while more:
                low, high = max(0, start - STEP), start + CHUNK_BYTES + LENGTH + 2 * STEP
                more = high < len(body)
                piece = Piece([body[low:high]], start - low, more)
                yield [i], piece, low
                start = low + piece.next if more else start
        if held:
            yield held, Piece([self.bodies[k] for k in held]), 0


def _keys(parts: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return exchange.distinct(np.concatenate(parts) if parts else np.zeros((0, width), np.uint64))


def refine(table: pa.Table, answered: pa.Table | None, rounds: int):
    """What a group asks after ``rounds`` answered rounds, or after all three the marks of each document's removed bytes."""
    group = Group(table)
    spread = list(group.pieces())
    work = [w for _, w, _ in spread]
    parts = [w.anchors() for w in work]
    keys, multi, place = _keys(parts, 1)
    if rounds == 0:
        return group, keys, multi
    alive = _spread(exchange.answers(answered, 1, len(keys))[place] > 0, parts)
    cells = [w.cells(a) for w, a in zip(work, alive)]
    parts = [c for _, c in cells]
    keys, multi, place = _keys(parts, 3)
    if rounds == 1:
        return group, keys, multi
    state = _spread(exchange.answers(answered, 2, len(keys))[place], parts)
    single = [w.windows(span[s >= exchange.SOME]) for w, (span, _), s in zip(work, cells, state)]
    parts = [names for _, names in single]
    keys, multi, place = _keys(parts, 2)
    if rounds == 2:
        return group, keys, multi
    again = _spread(exchange.answers(answered, 3, len(keys))[place] > 0, parts)
    gone: dict[int, np.ndarray] = {}
    for (docs, w, low), (span, _), s, (at, _), flag in zip(spread, cells, state, single, again):
        settled = span[(s == exchange.ALL) | (s == exchange.ALL_AND_SHOW)]
        step = np.zeros(len(w.data) + 1, np.int32)
        for starts, ends in ((settled[:, 0], settled[:, 1] + LENGTH), (at[flag], at[flag] + LENGTH)):
            np.add.at(step, starts, 1)
            np.add.at(step, ends, -1)
        cut = np.cumsum(step[:-1]) > 0
        for i, size, end in zip(docs, w.sizes, w.ends):
            mine = gone.setdefault(i, np.zeros(len(group.bodies[i]), bool))
            mine[low : low + size] |= cut[end - size : end]
    return group, gone, None


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, valid: bool = False) -> DataFrame:
    """One row (doc_id, n_bytes, n_removed, spans, kept) for each row of ``docs``, and ``rest`` with the columns ``carry``.

    A byte of a text (UTF-8, null as empty) is removed if a string of LENGTH bytes that covers it also starts at another
    place of any text; strings are judged on the input and never run across documents. ``spans`` holds the maximal
    removed runs, ``kept`` the other bytes. An empty table gives no rows; repeated rows count as documents of their own;
    other columns are ignored. A cut may split a character, so ``kept`` is binary; with ``valid`` it is without what is
    left of such characters.
    """
    dealt, total = grouped(docs, doc_id, text, carry)
    n = exchange.buckets(total / 60)

    def first(table: pa.Table) -> pa.Table:
        group, keys, multi = refine(table, None, 0)
        return exchange.ask(group.g, keys, multi, n)

    def later(rounds: int):
        def run(table: pa.Table, answered: pa.Table) -> pa.Table:
            group, keys, multi = refine(table, answered, rounds)
            return exchange.ask(group.g, keys, multi, n)

        return run

    def result(table: pa.Table, answered: pa.Table) -> pa.Table:
        rows = {"n_bytes": [], "n_removed": [], "spans": [], "kept": []}
        group, gone, _ = refine(table, answered, 3)
        for i, body in enumerate(group.bodies):
            cut = gone[i]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], cut.view(np.int8), [0]])))
            rows["n_bytes"].append(len(body))
            rows["n_removed"].append(int(cut.sum()))
            rows["spans"].append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
            kept = np.frombuffer(body, np.uint8)[~cut].tobytes()
            rows["kept"].append(kept.decode("utf-8", "ignore").encode() if valid and cut.any() else kept)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "spans": kind, "kept": pa.binary()}
        out = {"id": pa.array(group.ids, group.id_type)} | {c: pa.array(v, types[c]) for c, v in rows.items()}
        return pa.table(out | ({"rest": group.rest} if carry else {}))

    one = exchange.repeated(dealt.groupBy("g").applyInArrow(first, exchange.ASKED), 1, 1)
    two = exchange.refined(_with(dealt, one).applyInArrow(later(1), exchange.ASKED), 2)
    both = one.unionAll(two)
    three = exchange.repeated(_with(dealt, both).applyInArrow(later(2), exchange.ASKED), 3, 2)
    shape = T.StructType([T.StructField("id", dealt.schema["id"].dataType), *RESULT, *([dealt.schema["rest"]] if carry else [])])
    found = _with(dealt, both.unionAll(three)).applyInArrow(result, shape)
    return found.withColumnRenamed("id", doc_id)


def _with(dealt: DataFrame, answered: DataFrame):
    return dealt.groupBy("g").cogroup(answered.groupBy("g"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text``; a character that a cut splits is dropped, a null text empty."""
    rest = [c for c in docs.columns if c not in (doc_id, text)]
    found = find_repeats(docs, doc_id, text, rest, valid=True)
    left = F.col("kept").cast("string")
    of = lambda c: left if c == text else quoted(c) if c == doc_id else F.col("rest")[c]
    return found.select(*[of(c).alias(c) for c in docs.columns])
