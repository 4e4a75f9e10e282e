"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages that together cover its whole text: equal byte slices of about
``PASSAGE_BYTES``, at most ``PASSAGES`` (long documents have longer passages, so a bag stays small).
Each passage is encoded by how often its character classes follow each other, by hashed words and by
how often its words repeat.  A gated attention network (h = relu(xW); weight = softmax of
w (tanh(hV) * sigmoid(hU)); score = sigmoid of the weighted mean of h) is learnt from document labels
alone, and scores the attention-weighted passage representation.

It is fitted on the driver on a bounded sample of labelled documents: at most ``SAMPLE`` bags, the
ones with the smallest hash of their id, encoded by Spark tasks.  Scoring is a map over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import free_name, map_batches
from wattline.llm.tokens import Words, blocks

#: Labelled documents the model is fitted on at most.
SAMPLE = 3000
PASSAGE_BYTES = 512
PASSAGES = 64
HIDDEN, GATE = 32, 16
WORD_BUCKETS = 64

_MARKS = b" \n.,!?|#$%&*-'\":;()/"
_KINDS = len(_MARKS) + 6
_KIND = np.zeros(256, dtype=np.int64)          # other ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[0x80:0xC0], _KIND[0xC0:] = 4, 5
for _i, _b in enumerate(_MARKS):
    _KIND[_b] = 6 + _i
FEATURES = _KINDS * _KINDS + WORD_BUCKETS + 3


def passages(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut texts into passages: (byte bounds of all passages, number of passages of each text >= 1)."""
    size = np.diff(bounds)
    n = np.clip(-(-size // PASSAGE_BYTES), 1, PASSAGES)
    of = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    starts = bounds[:-1][of] + size[of] * k // n[of]
    return np.append(starts, bounds[-1]), n


def encode(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Features of each passage (float32)."""
    n = len(cuts) - 1
    out = np.zeros((n, FEATURES), dtype=np.float32)
    size = np.diff(cuts)
    if len(data):
        kind = _KIND[data]
        of = np.repeat(np.arange(n), size)
        pair = kind[:-1] * _KINDS + kind[1:]
        same = of[:-1] == of[1:]
        square = _KINDS * _KINDS
        pairs = np.bincount(of[:-1][same] * square + pair[same], minlength=n * square).reshape(n, square)
        out[:, :square] = np.sqrt(pairs / np.maximum(size - 1, 1)[:, None])
        words = Words(data, cuts, lower=True)
        owner = np.repeat(np.arange(n), words.count)
        bucket = (words.hash % np.uint64(WORD_BUCKETS)).astype(np.int64)
        counts = np.bincount(owner * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
        total = np.maximum(words.count, 1)
        out[:, square:-3] = np.sqrt(counts / total[:, None])
        order = np.lexsort((words.hash, owner))
        h, o = words.hash[order], owner[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        out[:, -3] = np.bincount(o[new], minlength=n) / total
        length = np.bincount(owner, weights=words.end - words.start, minlength=n) / total
        out[:, -2] = np.minimum(length, 50) / 50
    out[:, -1] = np.log1p(size) / 10
    return out


def _sum(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, first, axis=0)


class Attention:
    """The network; bags are runs of passages, ``n`` of each (never 0)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: dict[str, np.ndarray]):
        self.mean, self.scale, self.p = mean, scale, weights

    def _forward(self, x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, np.cumsum(n) - n
        h = np.maximum(x @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        g = (t * s) @ p["w"]
        e = np.exp(g - np.repeat(np.maximum.reduceat(g, first), n))
        a = e / np.repeat(_sum(e, first), n)
        z = _sum(a[:, None] * h, first)
        logit = z @ p["c"] + p["c0"]
        return {"first": first, "h": h, "t": t, "s": s, "a": a, "z": z, "y": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}

    def score(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """In double precision and rounded: the order of a matrix product's sums depends on its other rows."""
        if not len(n):
            return np.zeros(0)
        wide = Attention(self.mean, self.scale, {k: v.astype(np.float64) for k, v in self.p.items()})
        return np.round(wide._forward((x - self.mean) / self.scale, n)["y"], 9)

    def gradient(self, x: np.ndarray, n: np.ndarray, label: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        p, f = self.p, self._forward(x, n)
        h, t, s, a, first = f["h"], f["t"], f["s"], f["a"], f["first"]
        d = ((f["y"] - label) / len(label)).astype(np.float32)
        dz = np.repeat(d[:, None] * p["c"], n, axis=0)
        da = (h * dz).sum(1)
        dg = a * (da - np.repeat(_sum(a * da, first), n))
        dts = dg[:, None] * p["w"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (h > 0)
        grad = {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ dg,
                "c": f["z"].T @ d, "c0": d.sum(keepdims=True)}
        for k in ("W", "V", "U", "c"):
            grad[k] = grad[k] + decay * p[k]
        return grad


def fit(x: np.ndarray, n: np.ndarray, label: np.ndarray, epochs: int = 12, steps: int = 600, batch: int = 64, rate: float = 2e-3,
        decay: float = 1e-4, seed: int = 5) -> Attention:
    """Learn the network from bags, ``x`` being used up (Adam, fixed seed; as many epochs as make ``steps``, and ``epochs`` at
    least).  Without bags the score is 0.5 for every text."""
    rng = np.random.default_rng(seed)
    shapes = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,),
              "c": (HIDDEN,), "c0": (1,)}
    p = {k: (rng.normal(size=v) / np.sqrt(v[0]) if k not in ("b", "c0") else np.zeros(v)).astype(np.float32)
         for k, v in shapes.items()}
    if not len(n):
        p["c"][:] = 0
        return Attention(np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32), p)
    mean = x.mean(0)
    x -= mean                                         # in place: the sample is the driver's largest array
    scale = np.sqrt(np.einsum("ij,ij->j", x, x) / len(x)) + np.float32(0.01)
    x /= scale
    model = Attention(mean, scale, p)
    epochs = max(epochs, -(-steps * batch // len(n)))
    first = np.cumsum(n) - n
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(n))
        slow = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            bags = order[at:at + batch]
            rows = np.concatenate([np.arange(first[i], first[i] + n[i]) for i in bags])
            step += 1
            for k, g in model.gradient(x[rows], n[bags], label[bags], decay).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= (slow * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", use: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Attention:
    """Fit on at most ``sample`` labelled documents (``use`` filters ``labels``).

    Null labels and ids are left out; an id with several labels counts as 1 if their mean is 0.5 or more.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if use is not None:
        known = known.where(use)
    chosen = (known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    rows = (docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
            .join(F.broadcast(chosen), F.col("_key") == F.col("_id"))     # at most ``sample`` small rows
            .select("_key", "_text", "_label"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, bounds in blocks(batch.column(1)):
                cuts, n = passages(bounds)
                x = encode(data, cuts).astype(np.float16)
                first = np.append(0, np.cumsum(n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                     pa.array([x[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())], ["key", "label", "bag"])

    kind = docs.schema[id_col].dataType.simpleString()
    got = rows.transform(map_batches, bags, f"key {kind}, label int, bag binary").toArrow().sort_by([("key", "ascending")])
    n = np.array([len(b.as_buffer()) // (2 * FEATURES) for b in got["bag"]], dtype=np.int64)
    x, at = np.empty((int(n.sum()), FEATURES), np.float32), 0
    for bag, rows in zip(got["bag"], n):
        x[at:at + rows] = np.frombuffer(bag.as_buffer(), np.float16).reshape(-1, FEATURES)
        at += rows
    label = np.array(got["label"].to_pylist(), dtype=np.float32)
    del got
    return fit(x, n, label)


def score(docs: DataFrame, model: Attention, keep: list[str], text_col: str = "text", out_col: str = "score",
          least: float | None = None) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with the score of its whole text; with ``least``,
    only rows that reach it.  Null texts score as empty ones; repeated rows score alike."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out_col, T.DoubleType())])
    text_at = keep.index(text_col) if text_col in keep else len(keep)        # a text travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.select(range(len(keep)))
            for i, j, data, bounds in blocks(batch.column(text_at)):
                cuts, n = passages(bounds)
                got = pa.array(model.score(encode(data, cuts), n), pa.float64())
                part = pa.RecordBatch.from_arrays([*kept.slice(i, j - i).columns, got], [*keep, out_col])
                yield part if least is None else part.filter(pc.greater_equal(got, least))

    text = [] if text_col in keep else [F.col(text_col).alias(free_name(docs, "_text"))]
    return docs.select(*keep, *text).transform(map_batches, run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
