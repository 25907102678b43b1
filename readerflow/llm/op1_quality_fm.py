"""Quality classifier: a factorisation machine.

Inputs of a text: its hashed words (log of the count, scaled to unit length),
structure statistics in bins, and metadata columns in bins. All pairs of inputs
interact through low-rank factors, and a text is scored in time linear in its
inputs: sum over factors of ((sum v x)**2 - sum (v x)**2) / 2.

Defined results: a null or empty text has no words and is scored from its
statistics; null metadata has a bin of its own; repeated rows are scored each;
an empty table gives an empty result; without labelled rows of both classes
every score is 0.5. Only the named columns are read, so others never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices, table, training_rows
from .wordhash import Words, keyed, mix

BITS = 14
BINS = 16
N_STATS = 9
FACTORS = 8
PUNCT = np.zeros(256, dtype=bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True


def _statistics(w: Words) -> np.ndarray:
    """Bins (one row a text) of: length, word length, shares of marks, capitals, digits, marks at words' ends, lines, distinct words, repeats."""
    n = np.maximum(1, w.count)
    size = np.maximum(1, np.diff(w.start) - 1)
    key = keyed(w.doc, w.hash)
    _, firsts = np.unique(key, return_index=True)
    distinct = np.bincount(w.doc[firsts], minlength=w.n)[: w.n]
    two, at = w.grams(2)
    _, firsts2 = np.unique(keyed(w.doc[at], two), return_index=True)
    distinct2 = np.bincount(w.doc[at][firsts2], minlength=w.n)[: w.n]
    tail = np.bincount(w.doc[PUNCT[w.data[w.end - 1]]], minlength=w.n)[: w.n] if len(w.end) else np.zeros(w.n)
    share = lambda x, of: np.sqrt(np.clip(x / of, 0, 1)) * (BINS - 1)
    cols = [
        np.log2(1 + w.count), np.minimum(w.per_text(~w.ws) / n, BINS - 1),
        share(w.per_text(PUNCT[w.data]), size), share(w.per_text(UPPER[w.data]), size), share(w.per_text(DIGIT[w.data]), size),
        share(tail, n), share(w.per_text(w.data == 10) - 1, n), share(distinct, n), share(distinct2, np.maximum(1, w.count - 1)),
    ]
    return np.clip(np.stack(cols, 1).astype(np.int64), 0, BINS - 1) if w.n else np.zeros((0, N_STATS), np.int64)


def inputs(batch: pa.RecordBatch, metadata: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, input, value) triples of a slice; numeric metadata is binned on a log scale."""
    w = Words(batch.column("text"))
    bucket = (mix(w.hash) >> np.uint64(64 - BITS)).astype(np.int64)
    pair, n = np.unique(w.doc * (1 << BITS) + bucket, return_counts=True)
    doc, idx, val = pair >> BITS, pair & ((1 << BITS) - 1), np.log1p(n)
    norm = np.sqrt(np.bincount(doc, weights=val * val, minlength=w.n))
    val = val / np.maximum(norm[doc], 1e-9)
    cols = [_statistics(w)]
    for m in metadata:
        x = batch.column(m).cast(pa.float64()).to_numpy(zero_copy_only=False)
        known = np.isfinite(x)
        cols.append(np.where(known, np.clip(np.log2(1 + np.abs(np.where(known, x, 0))), 0, BINS - 2).astype(np.int64) + 1, 0)[:, None])
    bins = np.concatenate(cols, 1)
    k = bins.shape[1]
    own = (1 << BITS) + np.arange(k)[None, :] * BINS + bins
    return (np.concatenate([doc, np.repeat(np.arange(w.n), k)]), np.concatenate([idx, own.reshape(-1)]),
            np.concatenate([val, np.full(w.n * k, 1 / np.sqrt(k))]))


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    metadata: tuple[str, ...] = ()

    def logits(self, doc: np.ndarray, idx: np.ndarray, val: np.ndarray, n: int) -> np.ndarray:
        vx = self.factors[idx] * val[:, None].astype(np.float32)
        out = self.bias + np.bincount(doc, weights=self.linear[idx] * val, minlength=n)
        for f in range(vx.shape[1]):
            s = np.bincount(doc, weights=vx[:, f], minlength=n)
            out += 0.5 * (s * s - np.bincount(doc, weights=vx[:, f] * vx[:, f], minlength=n))
        return out


def _sample(metadata):
    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                doc, idx, val = inputs(b, metadata)
                order = np.argsort(doc, kind="stable")
                cut = np.searchsorted(doc[order], np.arange(b.num_rows + 1))
                idx, val = idx[order].astype(np.int32), val[order].astype(np.float32)
                parts = list(zip(cut, cut[1:]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("label"), pa.array([idx[x:y].tobytes() for x, y in parts], pa.binary()), pa.array([val[x:y].tobytes() for x, y in parts], pa.binary())],
                    names=["y", "idx", "val"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = (), max_train: int = 6_000, epochs: int = 12,
        rate: float = 0.08, decay: float = 1e-5, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """AdaGrad on at most ``max_train`` labelled rows, in an order fixed by their content."""
    size = (1 << BITS) + (N_STATS + len(metadata)) * BINS
    train = training_rows(docs, labels, label, max_train, id_col, text_col, metadata)
    rows = train.mapInArrow(_sample(metadata), "y double, idx binary, val binary").collect()
    rows.sort(key=lambda r: (r["idx"], r["val"], r["y"]))
    y = np.array([float(r["y"] > 0) for r in rows])
    if len(rows) == 0 or y.min() == y.max():
        return Machine(0.0, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32), metadata)
    rng = np.random.default_rng(7)
    w, v = np.zeros(size), rng.normal(0, 0.05, (size, FACTORS))
    bias, gb, gw, gv = float(np.log(y.mean() / (1 - y.mean()))), 1e-6, np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)
    xs = [(np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float32).astype(np.float64)) for r in rows]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), 64):
            part = order[a:a + 64]
            idx = np.concatenate([xs[i][0] for i in part])
            val = np.concatenate([xs[i][1] for i in part])
            at = np.repeat(np.arange(len(part)), [len(xs[i][0]) for i in part])
            start = np.searchsorted(at, np.arange(len(part)))
            vx = v[idx] * val[:, None]
            s = np.add.reduceat(vx, start, axis=0)
            z = bias + np.bincount(at, weights=w[idx] * val) + 0.5 * (s * s - np.add.reduceat(vx * vx, start, axis=0)).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            e = (err[at] * val)[:, None]
            uniq, back = np.unique(idx, return_inverse=True)
            dw = np.bincount(back, weights=e[:, 0]) + decay * w[uniq]
            dv = np.stack([np.bincount(back, weights=(e[:, 0] * (s[at, f] - vx[:, f]))) for f in range(FACTORS)], 1) + decay * v[uniq]
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            v[uniq] -= rate * dv / np.sqrt(gv[uniq])
            gb += err.sum() ** 2
            bias -= rate * err.sum() / np.sqrt(gb)
    return Machine(bias, w.astype(np.float32), v.astype(np.float32), metadata)


def quality_scores(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score in 0..1."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *machine.metadata)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                z = machine.logits(*inputs(b, machine.metadata), b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, machine: Machine, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows that score at least ``threshold``, with all their columns; filtered in place, without a join."""

    def run(batches):
        for batch in batches:
            for b in slices(batch, text_col):
                part = pa.RecordBatch.from_arrays([b.column(text_col), *(b.column(m) for m in machine.metadata)], names=["text", *machine.metadata])
                z = machine.logits(*inputs(part, machine.metadata), b.num_rows)
                yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_scores(docs, fit(docs, labels, metadata=("n_chars",)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
