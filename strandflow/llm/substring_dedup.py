"""Substring dedup over words: anchors at difference-cover positions find what long repeats may exist, then extend.

COVER is a perfect difference set modulo PERIOD: any two positions i and j have an offset below PERIOD that puts both on
cover positions. So two equal windows of WINDOW words share an aligned anchor of WINDOW - PERIOD + 1 words, whatever
their places, though only a quarter of all positions are hashed. Anchors that occur once drop out; around the others
each window is extended to its full length and asked for by a 128-bit name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandflow.llm import exchange
from strandflow.llm.common import CHUNK_BYTES, Rolling, grouped, mix, splitmix

WINDOW = 35
# The perfect difference set of order four.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
ANCHOR = WINDOW - PERIOD + 1

#: Words that are hashed together.
BLOCK_WORDS = 1 << 18
#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_COVERED = np.isin(np.arange(PERIOD), COVER)
_BYTE = splitmix(21, 256)
_IN_WORD = Rolling(0xA24BAED4963EE407)
_OVER_WORDS = (Rolling(0x9FB21C651E98DF25), Rolling(0xD6E8FEB86659FD93))

RESULT = "id {}, n_words long, removed array<struct<start:long,end:long>>, kept binary"


class Words:
    """The words of whole documents that lie one after the other in a byte array."""

    def __init__(self, bodies: list[bytes]):
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.doc_end = np.cumsum(sizes)
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        inside = ~_SPACE[self.data]
        before = np.append(False, inside[:-1])[: len(inside)]
        after = np.append(inside[1:], False)[: len(inside)]
        first, last = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
        filled = sizes > 0
        first[(self.doc_end - sizes)[filled]] = True
        last[self.doc_end[filled] - 1] = True
        self.start = np.flatnonzero(inside & (first | ~before))
        self.end = np.flatnonzero(inside & (last | ~after)) + 1
        self.word_end = np.searchsorted(self.start, self.doc_end)  # words up to the end of each document
        self.count = np.diff(self.word_end, prepend=0)
        self.limit = np.repeat(self.word_end, self.count)
        self.place = np.arange(len(self.start)) - np.repeat(self.word_end - self.count, self.count)
        word = np.concatenate([np.zeros(0, np.uint64), *(self._hashes(k, k + BLOCK_WORDS) for k in range(0, len(self.start), BLOCK_WORDS))])
        self.prefix = [roll.prefix(word) for roll in _OVER_WORDS]

    def _hashes(self, first: int, last: int) -> np.ndarray:
        """Hashes of some words, by prefix sums over their bytes only: a long text needs no array of all its bytes."""
        start, end = self.start[first:last], self.end[first:last]
        low = start[0]
        prefix = _IN_WORD.prefix(_BYTE[self.data[low : end[-1]]])
        return mix(_IN_WORD.spans(prefix, start - low, end - low) + (end - start).astype(np.uint64))

    def name(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        return mix(_OVER_WORDS[which].spans(self.prefix[which], at, at + length))

    def anchors(self) -> np.ndarray:
        """Cover positions with a whole anchor in their document."""
        at = np.arange(len(self.start))
        return at[_COVERED[self.place % PERIOD] & (at + ANCHOR <= self.limit)]

    def windows(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of ``anchors`` whole."""
        seen = np.zeros(len(self.start) + PERIOD + 1, np.int64)
        seen[anchors + 1] = 1
        total = np.cumsum(seen)
        at = np.arange(len(self.start))
        return at[(total[at + PERIOD] > total[at]) & (at + WINDOW <= self.limit)]

    def covered(self, windows: np.ndarray) -> np.ndarray:
        step = np.zeros(len(self.start) + 1, np.int32)
        step[windows] += 1
        np.add.at(step, windows + WINDOW, -1)
        return np.cumsum(step[:-1]) > 0

    def kept(self, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the words that stay, each followed by one space, and where each document's bytes end."""
        step = np.zeros(len(self.data) + 2, np.int32)
        step[self.start[~gone]] += 1
        # the byte after a word is a separator, or the document ends there
        end = np.minimum(self.end + 1, np.repeat(self.doc_end, self.count))
        np.add.at(step, end[~gone], -1)
        keep = np.cumsum(step[: len(self.data)]) > 0
        spaced = np.where(_SPACE[self.data], np.uint8(0x20), self.data)
        return spaced[keep], np.concatenate([[0], np.cumsum(keep)])[self.doc_end]


def ranked_rows(ids: list, bodies: list[bytes]) -> list[int]:
    """Places of rows in an order that only the rows determine, ids of any type that can be sorted, null last."""
    return sorted(range(len(ids)), key=lambda i: (True, bodies[i]) if ids[i] is None else (False, ids[i], bodies[i]))


def chunks(ids: list, bodies: list[bytes]):
    """(ids, bodies) in the order of ``ranked_rows``, as many as make about CHUNK_BYTES."""
    ranked = ranked_rows(ids, bodies)
    held, size = [], 0
    for i in ranked:
        if held and size + len(bodies[i]) > CHUNK_BYTES:
            yield [ids[k] for k in held], [bodies[k] for k in held]
            held, size = [], 0
        held.append(i)
        size += len(bodies[i])
    if held:
        yield [ids[k] for k in held], [bodies[k] for k in held]


def _loaded(table: pa.Table) -> list[tuple[list, Words]]:
    return [(ids, Words(bodies)) for ids, bodies in chunks(table.column("id").to_pylist(), table.column("body").to_pylist())]


def _asked(parts: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return exchange.distinct(np.concatenate(parts) if parts else np.zeros((0, width), np.uint64))


def _split(flags: np.ndarray, parts: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(flags, np.cumsum([len(p) for p in parts])[:-1])


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (id, n_words, removed, kept) for each row of ``docs``.

    Words are runs of other than space, tab, LF, VT, FF, CR. A word is removed if a window of WINDOW consecutive words
    of its document that covers it also starts at another place of any document; windows are judged on the input. Fewer
    words than WINDOW: nothing is removed. Null and empty texts have no words. ``removed`` holds maximal word runs,
    ``kept`` the other words joined by one space. Ids have any type that can be sorted. Repeated rows count as documents of their own; other columns are
    ignored; an empty table gives no rows.
    """
    dealt, total = grouped(docs, doc_id, text)
    n_anchors, n_windows = exchange.buckets(total / 24), exchange.buckets(total / 24)

    def first(table: pa.Table) -> pa.Table:
        parts = [w.name(w.anchors(), ANCHOR, 0)[:, None] for _, w in _loaded(table)]
        keys, multi, _ = _asked(parts, 1)
        return exchange.ask(table.column("g")[0].as_py(), keys, multi, n_anchors)

    def extended(table: pa.Table, answered: pa.Table):
        work = _loaded(table)
        spots = [w.anchors() for _, w in work]
        parts = [w.name(at, ANCHOR, 0)[:, None] for (_, w), at in zip(work, spots)]
        keys, _, place = _asked(parts, 1)
        again = _split(exchange.answers(answered, 1, len(keys))[place] > 0, parts)
        starts = [w.windows(at[flag]) for (_, w), at, flag in zip(work, spots, again)]
        parts = [np.column_stack([w.name(at, WINDOW, 0), w.name(at, WINDOW, 1)]) for (_, w), at in zip(work, starts)]
        return work, starts, parts

    def second(table: pa.Table, answered: pa.Table) -> pa.Table:
        _, _, parts = extended(table, answered)
        keys, multi, _ = _asked(parts, 2)
        return exchange.ask(table.column("g")[0].as_py(), keys, multi, n_windows)

    def result(table: pa.Table, answered: pa.Table) -> pa.Table:
        work, starts, parts = extended(table, answered)
        keys, _, place = _asked(parts, 2)
        again = _split(exchange.answers(answered, 2, len(keys))[place] > 0, parts)
        rows = {"id": [], "n_words": [], "removed": [], "kept": []}
        for (ids, w), at, flag in zip(work, starts, again):
            gone = w.covered(at[flag])
            out, ends = w.kept(gone)
            for k, (i, count, end) in enumerate(zip(ids, w.count, w.word_end)):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[end - count : end].view(np.int8), [0]])))
                rows["id"].append(i)
                rows["n_words"].append(int(count))
                rows["removed"].append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                rows["kept"].append(out[ends[k - 1] if k else 0 : ends[k]].tobytes().rstrip(b" "))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = {"id": table.column("id").type, "n_words": pa.int64(), "removed": kind, "kept": pa.binary()}
        return pa.table({c: pa.array(v, types[c]) for c, v in rows.items()})

    one = exchange.repeated(dealt.groupBy("g").applyInArrow(first, exchange.ASKED), 1, 1)
    asked = dealt.groupBy("g").cogroup(one.groupBy("g")).applyInArrow(second, exchange.ASKED)
    both = one.unionAll(exchange.repeated(asked, 2, 2))
    return dealt.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(result, RESULT.format(dealt.schema["id"].dataType.simpleString())).withColumnRenamed("id", doc_id)
