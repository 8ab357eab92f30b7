"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

A text is cut into stretches of SPAN bytes; the network reads each in both directions from a zero state, gives every byte
a distribution over the languages, and the document's is the mean over all its bytes. So whole texts count, memory is
bounded by a chunk, and a very long text is just more stretches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIDDEN = 8
SPAN = 128
#: Stretches that go through the network together.
WIDTH = 2048
#: Bounds of the training sample: documents of a language (in expectation; twice that at most) and stretches of each.
SAMPLE_DOCS, SAMPLE_SPANS, TRAIN_SPAN = 400, 4, 64
EPOCHS, BATCH, RATE, SEED = 8, 256, 0.02, 7
UNKNOWN = "und"
#: Score below which a text is taken to have no language that was learned; an even guess among four has 0.25.
LEAST_SCORE = 0.35


@dataclass
class Model:
    """``langs`` and, for each direction, the byte table (3H, 256), the recurrent weights (3H, H) and the output weights."""

    langs: list[str]
    tables: tuple[np.ndarray, np.ndarray]
    recurrent: tuple[np.ndarray, np.ndarray]
    output: tuple[np.ndarray, np.ndarray]
    bias: np.ndarray


def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of a gated recurrent unit for columns of states: gates z and r, candidate n, recurrent part of n, state."""
    size = len(h)
    g = u @ h
    gates = x[: 2 * size] + g[: 2 * size]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    z, r = gates[:size], gates[size:]
    inner = g[2 * size :]
    n = r * inner
    n += x[2 * size :]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return z, r, n, inner, new


def _run(table: np.ndarray, u: np.ndarray, data: np.ndarray, mask: np.ndarray, back: bool) -> np.ndarray:
    """States (T, H, B) for ``data`` (T, B); a masked byte leaves the state at zero."""
    steps, width = data.shape
    size = len(u) // 3
    out = np.empty((steps, size, width), np.float32)
    h = np.zeros((size, width), np.float32)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        h = _step(np.take(table, data[t], axis=1), h, u)[-1]
        if back:
            h *= mask[t]
        out[t] = h
    return out


def position_probabilities(model: Model, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(T, L, B): the distribution at each byte of ``data`` (T, B)."""
    logits = model.bias[:, None] + sum(model.output[d] @ _run(model.tables[d], model.recurrent[d], data, mask, d == 1) for d in (0, 1))
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def classify(model: Model, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean distribution of each text, and the share of its bytes whose own label is the text's."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    counts = -(-sizes // SPAN)
    doc = np.repeat(np.arange(len(bodies)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.frombuffer(b"".join(bodies) + bytes(SPAN), np.uint8)
    start = np.repeat(np.cumsum(sizes) - sizes, counts) + nth * SPAN
    length = np.minimum(SPAN, np.repeat(sizes, counts) - nth * SPAN)
    total, votes = np.zeros((len(bodies), len(model.langs))), np.zeros((len(bodies), len(model.langs)), np.int64)
    order = np.argsort(length, kind="stable")  # stretches of like length together
    for at in range(0, len(order), WIDTH):
        part = order[at : at + WIDTH]
        steps = np.arange(length[part].max())[:, None]
        data = flat[start[part][None, :] + steps]
        mask = (steps < length[part][None, :]).astype(np.float32)
        probs = position_probabilities(model, data, mask)
        probs *= mask[:, None, :]
        np.add.at(total, doc[part], probs.sum(axis=0, dtype=np.float64).T)
        top = (probs == probs.max(axis=1, keepdims=True)) & (mask[:, None, :] > 0)
        np.add.at(votes, doc[part], top.sum(axis=0).T)
    n = np.maximum(sizes, 1)[:, None]
    mean = total / n
    best = mean.argmax(axis=1)
    return mean, votes[np.arange(len(bodies)), best] / n[:, 0]


def train_model(spans: list[bytes], labels: list[str], hidden: int = HIDDEN, epochs: int = EPOCHS) -> Model:
    """The network after ``epochs`` of Adam on the mean cross entropy of all bytes of the labelled stretches."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(SEED)
    steps = max(map(len, spans))
    data = np.zeros((len(spans), steps), np.uint8)
    mask = np.zeros((len(spans), steps), np.float32)
    for i, s in enumerate(spans):
        data[i, : len(s)] = np.frombuffer(s, np.uint8)
        mask[i, : len(s)] = 1
    target = np.array([langs.index(x) for x in labels])
    shapes = [(3 * hidden, 256)] * 2 + [(3 * hidden, hidden)] * 2 + [(len(langs), hidden)] * 2 + [(len(langs),)]
    scales = [0.3, 0.3, hidden**-0.5, hidden**-0.5, hidden**-0.5, hidden**-0.5, 0]
    weights = [(rng.standard_normal(shape) * scale).astype(np.float32) for shape, scale in zip(shapes, scales)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    moves = 0
    for epoch in range(epochs):
        order = rng.permutation(len(spans))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            grads = _gradients(weights, data[part].T, mask[part].T, target[part])
            moves += 1
            rate = RATE * (1 - epoch / epochs)
            for w, g, m, v in zip(weights, grads, first, second):
                np.clip(g, -1, 1, out=g)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (rate * (m / (1 - 0.9**moves)) / (np.sqrt(v / (1 - 0.99**moves)) + 1e-8)).astype(np.float32)
    return Model(langs, (weights[0], weights[1]), (weights[2], weights[3]), (weights[4], weights[5]), weights[6])


def _gradients(weights: list[np.ndarray], data: np.ndarray, mask: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    steps, width = data.shape
    size = weights[2].shape[1]
    traces, states = [], []
    for d in (0, 1):
        h, trace, out = np.zeros((size, width), np.float32), [None] * steps, np.empty((steps, size, width), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            z, r, n, inner, new = _step(np.take(weights[d], data[t], axis=1), h, weights[2 + d])
            trace[t] = (z, r, n, inner, h)
            h = new * mask[t]
            out[t] = h
        traces.append(trace)
        states.append(out)
    logits = weights[6][:, None] + weights[4] @ states[0] + weights[5] @ states[1]
    logits -= logits.max(axis=1, keepdims=True)
    error = np.exp(logits)
    error /= error.sum(axis=1, keepdims=True)
    error[:, target, np.arange(width)] -= 1
    error *= mask[:, None, :] / mask.sum()
    grads = [np.zeros_like(w) for w in weights]
    grads[6] += error.sum(axis=(0, 2))
    for d in (0, 1):
        grads[4 + d] += np.einsum("tlb,thb->lh", error, states[d], optimize=True)
        onto = weights[4 + d].T @ error
        dh = np.zeros((size, width), np.float32)
        u = weights[2 + d]
        inputs = np.empty((steps, 3 * size, width), np.float32)
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            z, r, n, inner, h = traces[d][t]
            dh = (dh + onto[t]) * mask[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            inputs[t, :size], inputs[t, size : 2 * size], inputs[t, 2 * size :] = dz, dr, dn
            through = np.concatenate([dz, dr, dn * r])
            grads[2 + d] += through @ h.T
            dh = dh * z + u.T @ through
        flat = inputs.transpose(0, 2, 1).reshape(-1, 3 * size)
        of = data.ravel()
        for k in range(3 * size):
            grads[d][k] += np.bincount(of, flat[:, k], 256).astype(np.float32)
    return grads


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 2) -> Model | None:
    """A model learned from labelled documents outside the fold ``held_out``; None if there are none.

    The counts of the languages are of all such documents; the network sees a sample, bounded by twice SAMPLE_DOCS
    documents a language and SAMPLE_SPANS stretches each, spread over the whole text. It is drawn by a hash of id and
    text; of a language that has none drawn (many rows that are alike), the documents with the least hashes are taken.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & (remainder(doc_id) != held_out))
    counts = {r[lang]: r["n"] for r in labelled.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, SAMPLE_DOCS / n))])
    number = F.pmod(F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text)), F.lit(1 << 20))
    rows = labelled.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).cast("binary").alias("body"), number.alias("lot"))

    def cut(batches):
        for batch in batches:
            out = []
            for i, label, body in zip(*(batch.column(c).to_pylist() for c in ("id", "lang", "body"))):
                room = max(1, len(body) - TRAIN_SPAN + 1)
                at = sorted({(2 * k + 1) * room // (2 * SAMPLE_SPANS) for k in range(SAMPLE_SPANS)})
                out += [(i, label, k, body[a : a + TRAIN_SPAN]) for k, a in enumerate(at)]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column("id").type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())], ["id", "lang", "k", "span"])

    shape = f"id {dict(rows.dtypes)['id']}, lang string, k int, span binary"
    drawn = rows.where(F.col("lot") / float(1 << 20) < share[F.col("lang")])
    most = 2 * SAMPLE_DOCS * SAMPLE_SPANS
    found = drawn.select("id", "lang", "body", "lot").mapInArrow(cut, shape).orderBy(F.xxhash64("lang", "id", "k", "span")).limit(most * len(counts)).collect()
    for missing in set(counts) - {r.lang for r in found}:
        least = rows.where(F.col("lang") == missing).orderBy("lot", F.xxhash64("body")).limit(SAMPLE_DOCS)
        found += least.mapInArrow(cut, shape).collect()
    spans = sorted({(r.lang, str(r.id), r.k, bytes(r.span)) for r in found})
    return train_model([s[3] for s in spans], [s[0] for s in spans])


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, agree) for each row of ``docs``, from the whole text alone.

    ``score`` is the mean probability of ``lang_pred`` over the bytes, ``agree`` the share of bytes labelled so. A text
    that is null, empty or without a letter is UNKNOWN with score 0, as is every text if there was nothing to learn
    from. Ties go to the language that sorts first; repeated rows come out repeated; other columns are ignored.
    """
    body = F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).cast("binary")
    rows = docs.select(F.col(doc_id).alias("id"), body.alias("body"))
    if model is None:
        return rows.select(F.col("id").alias(doc_id), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("agree"))

    def run(batches):
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            lang, score, agree = [UNKNOWN] * len(bodies), np.zeros(len(bodies)), np.zeros(len(bodies))
            for part in _parts(bodies):
                mean, same = classify(model, [bodies[i] for i in part])
                best = mean.argmax(axis=1)
                for i, k in zip(part, best):
                    lang[i] = model.langs[k]
                score[part], agree[part] = np.clip(mean[np.arange(len(part)), best], 0, 1), same
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lang), pa.array(score), pa.array(agree)], ["id", "lang_pred", "score", "agree"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, agree double").withColumnRenamed("id", doc_id)


def keep_known(docs: DataFrame, model: Model | None, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not UNKNOWN, and a score of ``least`` or more."""
    if model is None:
        return docs.limit(0)

    def run(batches):
        for batch in batches:
            bodies = [t.encode() if t and any(map(str.isalpha, t)) else None for t in batch.column(text).to_pylist()]
            good = np.zeros(len(bodies), bool)
            for part in _parts(bodies):
                mean, _ = classify(model, [bodies[i] for i in part])
                good[part] = mean.max(axis=1) >= least
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def _parts(bodies: list[bytes | None], most: int = 4 << 20):
    """Places of the texts that have a body, in runs of about ``most`` bytes."""
    held, size = [], 0
    for i, body in enumerate(bodies):
        if body:
            held.append(i)
            size += len(body)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held
