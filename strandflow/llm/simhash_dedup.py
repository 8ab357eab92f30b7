"""SimHash near-dedup with pivot distance tables.

Every distinct fingerprint gets a table of its Hamming distances to PIVOTS reference fingerprints, all 64 bits of each.
Fingerprints that are at most RADIUS apart differ by at most RADIUS in every coordinate of their tables, so a pair is
discarded by the maximum coordinate difference, and the survivors are verified bit by bit.

Not every pair is looked at. Two fingerprints that differ in at most two bits agree on two of any four supports, so
pairs are taken from cells of fingerprints that agree on two supports of 16 bits. A cell of more than CELL is parted by
the same rule: its free bits make four smaller supports, and its pairs agree on two of them too. After three rounds
eight bits are free, so no cell has more than 256 members, whatever the corpus.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandflow.llm.common import checkpointed, fresh, quoted, splitmix
from strandflow.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
CELL = 32
PIVOTS = 32
#: Rows of an id and a hash up to which a table is sent to all executors.
SENT_ROWS = 1_000_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: The reference fingerprints, in the order of a table's coordinates.
REFERENCES = [int(x) for x in splitmix(64, PIVOTS)]


def _parted(mask: int) -> list[int]:
    """``mask`` with two of the four supports that its free bits make, for each two of them."""
    free = [b for b in range(64) if not mask >> b & 1]
    size = len(free) // 4
    supports = [sum(1 << b for b in free[k * size : (k + 1) * size]) for k in range(4)]
    return [mask | x | y for x, y in itertools.combinations(supports, 2)]


#: The bits that the cells of each round agree on; those of a round come from one of the round before, six from each.
ROUNDS: list[list[int]] = [_parted(0)]
while len(ROUNDS) < 3:
    ROUNDS.append([m for mask in ROUNDS[-1] for m in _parted(mask)])


def fingerprint(body: bytes, size: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text in UTF-8: a bit is 1 if it is set in over half the hashes; no word: 0."""
    words = body.lower().split()  # of bytes: A-Z only, and the six ASCII separators
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    n = max(1, len(words) - size + 1)
    ends = (starts + lengths)[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n)
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(k) for k in np.flatnonzero(2 * bits > n)))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp): a hash and the fingerprint, as signed longs, of every whole text; a null text has no words."""
    body = docs.select(quoted(doc_id).alias("doc_id"), F.xxhash64(quoted(text)).alias("h"), quoted(text).cast("binary").alias("body"))

    def run(batches):
        for batch in batches:
            fps = [_signed(fingerprint(b or b"", size)) for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"])

    kind = dict(body.dtypes)["doc_id"]
    return body.mapInArrow(run, f"doc_id {kind}, h long, fp long")


def table(fp: Column) -> Column:
    """The distances of a fingerprint to all references, eight in a long."""
    far = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(r)))).cast("long") for r in REFERENCES]
    packed = [reduce(Column.bitwiseOR, (F.shiftleft(x, 8 * k) for k, x in enumerate(far[at : at + 8]))) for at in range(0, PIVOTS, 8)]
    return F.struct(*[x.alias(f"t{k}") for k, x in enumerate(packed)])


def _coordinate(of: str, k: int) -> Column:
    return F.shiftrightunsigned(F.col(f"{of}.t{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(255))


def survives(a: str, b: str) -> Column:
    """Whether the maximum coordinate difference of two tables is at most RADIUS."""
    return reduce(Column.__and__, (F.abs(_coordinate(a, k) - _coordinate(b, k)) <= RADIUS for k in range(PIVOTS)))


def candidates(nodes: DataFrame) -> DataFrame:
    """(fp, other, table, other_table): the pairs of all cells, the lesser fingerprint first; a pair may come repeatedly."""
    rows = nodes.select("fp", table(F.col("fp")).alias("table"), F.lit(0).alias("of"))
    found = []
    for depth, masks in enumerate(ROUNDS):
        each = F.lit([[_signed(m) for m in masks[k : k + 6]] for k in range(0, len(masks), 6)])
        rows = rows.select("fp", "table", "of", F.posexplode(F.get(each, F.col("of"))).alias("k", "mask"))
        rows = rows.select("fp", "table", (F.col("of") * 6 + F.col("k")).alias("of"), F.col("fp").bitwiseAND(F.col("mask")).alias("cell"))
        cells = rows.groupBy("of", "cell").agg(F.count("*").alias("n")).where("n > 1")
        rows = checkpointed(rows.join(cells, ["of", "cell"]))
        last = depth == len(ROUNDS) - 1
        few = rows if last else rows.where(F.col("n") <= CELL)
        right = few.select("of", "cell", F.col("fp").alias("other"), F.col("table").alias("other_table"))
        found.append(few.join(right, ["of", "cell"]).where("fp < other").select("fp", "other", "table", "other_table"))
        rows = rows.where(F.col("n") > CELL).select("fp", "table", "of")
        if last or rows.isEmpty():
            break
    return reduce(DataFrame.unionAll, found)


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): each pair of distinct fingerprints ``fp`` of ``nodes`` that are at most RADIUS apart, once."""
    pairs = candidates(nodes).where(survives("table", "other_table"))
    pairs = pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS)
    return pairs.select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct()


def _rooted(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` of each fingerprint's component."""
    found = components(links(nodes), "a", "b")
    return nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for each row: the least doc_id that is reachable over links of at most RADIUS bits.

    Texts are whole, lower-cased in A-Z; null, empty and blank texts have fingerprint 0 and are linked like any other.
    Equal fingerprints are one node, so copies cost nothing but their fingerprint. Repeated rows come out repeated;
    other columns are ignored; an empty table gives no rows; a null doc_id takes part as the largest one.
    """
    prints = checkpointed(fingerprints(docs, doc_id, text, size).drop("h"))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = _rooted(nodes)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(F.col("doc_id").alias(doc_id), "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row of ``docs``, all columns, of each component: one with the least id, null as the largest.

    A row is known by its id and a hash of its text, so rows without an id, or that share one, stay if their texts lie
    in different components. Texts aren't shuffled unless more than SENT_ROWS rows go: the rows to go, or else the rows
    to stay, are a table of ids and hashes. Of rows that repeat both, one stays.
    """
    prints = checkpointed(fingerprints(docs, doc_id, text, size))
    by_id = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    each = prints.groupBy("doc_id", "h", "fp").agg(F.count("*").alias("n"))  # rows that repeat id and text are one
    nodes = checkpointed(prints.groupBy("fp").agg(F.min(by_id).alias("least")))
    rooted = checkpointed(_rooted(nodes))
    first = rooted.groupBy("root").agg(F.min("least").alias("least"))
    known, same, times = fresh(docs, "known", "same", "times")
    named = [F.col("least.doc_id").alias(known), F.col("least.h").alias(same)]
    stay = first.select(*named)
    on = quoted(doc_id).eqNullSafe(F.col(known)) & (F.xxhash64(quoted(text)) == F.col(same))
    each = each.select(F.col("doc_id").alias(known), F.col("h").alias(same), F.col("n").alias(times))
    gone = checkpointed(each.join(stay.withColumns({f"{same}_s": F.col(same), f"{known}_s": F.col(known)}).drop(known, same), F.col(known).eqNullSafe(F.col(f"{known}_s")) & (F.col(same) == F.col(f"{same}_s")), "left_anti").drop(times))
    left = docs.join(F.broadcast(gone) if gone.count() <= SENT_ROWS else gone, on, "left_anti")
    # of rows that repeat id and text, which all are still there, one stays, chosen before the shuffle and after
    twice = checkpointed(each.where(F.col(times) > 1).join(gone, [known, same], "left_anti").drop(times))
    if twice.isEmpty():
        return left
    some = F.broadcast(twice) if twice.count() <= SENT_ROWS else twice
    told = F.xxhash64(*[quoted(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    again = left.join(some, on).groupBy(known, same).agg(F.min_by(F.struct(*map(quoted, docs.columns)), told).alias(times))
    return left.join(some, on, "left_anti").unionAll(again.select(f"{times}.*"))
