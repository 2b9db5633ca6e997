"""Quality by attention-based multiple-instance learning.

Every passage of a document is encoded; gated attention, learned from document labels, weights the passages; a
logistic unit scores the weighted representation.

Edge cases: null and empty texts are one empty passage; a null doc_id or label is not learned from; repeated rows
give repeated rows; a tie at 0.5 is predicted 1; very long texts are many passages, all scored; without labels of both
kinds every score is the share of label 1 (0.5 without any); an empty table gives an empty table; other columns,
whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import crc_part, labelled_sample
from .textbytes import Words, blocks, texts_of

#: Bounds of the sample; words of a passage.
PER_LABEL, MOST_CHARS, PASSAGE = 2000, 12_000, 48
BLOCK_BYTES, FIT_TEXTS = 1 << 20, 200
CLASSES, BUCKETS = 12, 64
_CLASS = np.full(256, 11, np.uint8)  # other control signs
for _k, _signs in enumerate((range(97, 123), range(65, 91), range(48, 58), b" ", b"\n\r", b"\t", b".,;:", b"!?", b"'\"()-", b"|/\\_<>[]{}=", b"#$%&*+@^~`")):
    _CLASS[list(_signs)] = _k
_CLASS[128:] = 0  # bytes of letters beyond ASCII
_BUCKET = ((np.arange(CLASSES**3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.int64)
WIDTH = BUCKETS + CLASSES + 4


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of WIDTH features for each passage of PASSAGE words, and its document; each document has a passage."""
    n = len(offsets) - 1
    w = Words(data, offsets)
    per = np.maximum(1, -(-w.count // PASSAGE))
    first = np.cumsum(per) - per
    doc = np.repeat(np.arange(n), per)
    total = int(per.sum())
    out = np.zeros((total, WIDTH), np.float32)
    place = np.arange(len(w.hash)) - w.first[w.doc]  # of each word in its document
    mine = first[w.doc] + place // PASSAGE
    head = place % PASSAGE == 0
    # a passage's bytes go from its first word (its document's start) to the next one's
    begin = offsets[doc].copy()
    later = head & (place > 0)
    begin[mine[later]] = w.start[later]
    of = np.repeat(np.arange(total), np.diff(begin, append=len(data)))
    kind = _CLASS[data].astype(np.int64)
    size = np.bincount(of, minlength=total).astype(np.float32)
    safe = np.maximum(size, 1)[:, None]
    if len(data) > 2:
        tri = _BUCKET[(kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]]
        out[:, :BUCKETS] = np.bincount(of[:-2] * BUCKETS + tri, minlength=total * BUCKETS).reshape(total, BUCKETS) / safe
    out[:, BUCKETS : BUCKETS + CLASSES] = np.bincount(of * CLASSES + kind, minlength=total * CLASSES).reshape(total, CLASSES) / safe
    words = np.bincount(mine, minlength=total).astype(np.float32)
    some = np.maximum(words, 1)
    length = np.bincount(mine, w.end - w.start, total)
    order = np.lexsort((w.hash, mine))
    same = (w.hash[order][1:] == w.hash[order][:-1]) & (mine[order][1:] == mine[order][:-1])
    repeats = np.bincount(mine[order][1:][same], minlength=total)
    beside = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (mine[1:] == mine[:-1])) + 1
    k = BUCKETS + CLASSES
    out[:, k] = np.log1p(words) / 5
    out[:, k + 1] = length / some / 10
    out[:, k + 2] = repeats / some
    out[:, k + 3] = np.bincount(mine[beside], minlength=total) / some
    return out, doc


@dataclass
class GatedAttention:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, doc: np.ndarray, n: int) -> tuple:
        p = self.p
        h = np.tanh(((x - self.mean) / self.scale) @ p["w1"] + p["b1"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        start = np.searchsorted(doc, np.arange(n))
        e = np.exp(e - np.maximum.reduceat(e, start)[doc])
        a = e / np.add.reduceat(e, start)[doc]
        z = np.add.reduceat(h * a[:, None], start)
        s = z @ p["o"] + p["c"][0]
        return h, t, g, a, z, start, 1 / (1 + np.exp(-np.clip(s, -30, 30)))

    def scores(self, x: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of documents, and the attention on each passage."""
        if not self.p:
            return np.full(n, float(self.mean[0])), np.full(len(doc), 1.0)
        out = self.forward(x, doc, n)
        return out[-1], out[3]


def gradients(net: GatedAttention, x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The weighted log loss over documents, and its gradient by parameter."""
    p = net.p
    h, t, g, a, z, start, q = net.forward(x, doc, len(y))
    loss = float(-(weight * (y * np.log(q) + (1 - y) * np.log1p(-q))).sum())
    ds = (weight * (q - y)).astype(x.dtype)
    dz = ds[:, None] * p["o"]
    da = (h * dz[doc]).sum(1)
    de = a * (da - np.add.reduceat(a * da, start)[doc])
    dt, dg = de[:, None] * p["a"] * g * (1 - t * t), de[:, None] * p["a"] * t * g * (1 - g)
    dh = (a[:, None] * dz[doc] + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
    inputs = (x - net.mean) / net.scale
    return loss, {"o": z.T @ ds, "c": ds.sum(keepdims=True), "a": (t * g).T @ de, "v": h.T @ dt, "u": h.T @ dg, "w1": inputs.T @ dh, "b1": dh.sum(0)}


def start_from(x: np.ndarray, hidden: int, gate: int, seed: int) -> GatedAttention:
    r, width = np.random.default_rng(seed), x.shape[1]
    shapes = {"w1": (width, hidden), "v": (hidden, gate), "u": (hidden, gate), "a": (gate,), "o": (hidden,)}
    p = {k: r.normal(0, s[0] ** -0.5, s).astype(x.dtype) for k, s in shapes.items()}
    return GatedAttention(x.mean(0), x.std(0) + 1e-2, p | {"b1": np.zeros(hidden, x.dtype), "c": np.zeros(1, x.dtype)})


def train(net: GatedAttention, x: np.ndarray, doc: np.ndarray, y: np.ndarray, steps: int, rate: float, decay: float) -> GatedAttention:
    """Adam on the log loss, the two labels weighted alike."""
    p = net.p
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        for k, d in gradients(net, x, doc, y, weight)[1].items():
            d = d + decay * p[k]
            first[k], second[k] = 0.9 * first[k] + 0.1 * d, 0.99 * second[k] + 0.01 * d * d
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            p[k] -= (rate * move).astype(x.dtype)
    return net


def fit(texts: list[str], labels: list[int], steps: int = 250, hidden: int = 24, gate: int = 12, rate: float = 0.01, decay: float = 1e-4, seed: int = 1) -> GatedAttention:
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return GatedAttention(np.array([y.mean() if len(y) else 0.5]), np.ones(1), {})
    made = []
    for a in range(0, len(texts), FIT_TEXTS):
        features, of = encode(*texts_of(pa.array(texts[a : a + FIT_TEXTS], pa.large_string())))
        made.append((features, of + a))
    x, doc = (np.concatenate(z) for z in zip(*made, strict=True))
    return train(start_from(x, hidden, gate, seed), x, doc, y, steps, rate, decay)


def _rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: GatedAttention = model.value
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            for i, j in blocks(offsets, BLOCK_BYTES):
                x, doc = encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                score, attention = net.scores(x, doc, j - i)
                start = np.searchsorted(doc, np.arange(j - i))
                most = np.maximum.reduceat(attention, start)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score.astype(float), pa.float64()), pa.array(np.diff(start, append=len(doc)), pa.int64()), pa.array(most.astype(float), pa.float64())], ["doc_id", "score", "n_passages", "top_attention"])

    return run


def score_quality(docs: DataFrame, model: GatedAttention) -> DataFrame:
    """Per row: doc_id, score, n_passages, top_attention."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(_rows(shared), "doc_id long, score double, n_passages long, top_attention double")


def fit_on(docs: DataFrame, labels: DataFrame) -> GatedAttention:
    sample = labelled_sample(docs, labels, "quality", PER_LABEL, MOST_CHARS)
    return fit([r["text"] for r in sample], [r["quality"] for r in sample])


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = crc_part("doc_id", 3)
    model = fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(part != 1))
    return score_quality(docs, model).select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages", "top_attention")
