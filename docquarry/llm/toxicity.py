"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's score is a logistic function of its different words and of their beginnings (insults inflect); a
document's is the noisy-or of its sentences'. All words and beginnings of the sample are fitted, for either label, from
document labels alone; the decay of weights, stronger for those of fewer documents, is the only control. The sentences that carry a document are located by
byte span.

Edge cases: null and empty texts have no sentence, score 0 and are predicted 0; a null doc_id or label is not learned
from; repeated rows give repeated rows; a tie at 0.5 is predicted 1; very long texts are scored whole; without any
labelled row every score is 0; an empty table gives an empty table; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import crc_part, labelled_sample
from .textbytes import LOWER, blocks, span_hashes, texts_of

#: Bounds of the sample.
PER_LABEL, MOST_CHARS = 2500, 12_000
#: Lengths in bytes of words' beginnings; how often a toxic document counts; documents at which a word's decay doubles.
BEGINNINGS, TOXIC_COUNTS, DOUBLES_AT = (4, 5, 6, 7), 3.0, 30.0
BLOCK_BYTES, FIT_TEXTS = 1 << 20, 200
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Sentences:
    """Sentences that hold a word, in order: document, byte span; and each one's hashes of different words and beginnings."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray
    of: np.ndarray  # the sentence of each word


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    """Cuts at . ! ? and line ends; words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[1:] = _STOP[data]
    edge[offsets] = True
    at = np.flatnonzero(edge[:n]) if n else np.zeros(0, np.int64)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = _WORD[data]
    cut = np.diff(inside)
    begins, ends = cut[:-1] == 1, cut[1:] == -1
    touch = offsets[1:-1]
    touch = touch[(touch > 0) & (touch < n)]
    touch = touch[(inside[touch] == 1) & (inside[touch + 1] == 1)]
    begins[touch], ends[touch - 1] = True, True
    ws, we = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    low = LOWER[data]
    h, sent = [span_hashes(low, ws, we)], [np.searchsorted(at, ws, "right") - 1]
    for k in BEGINNINGS:
        long = np.flatnonzero(we - ws >= k)
        h.append(span_hashes(low, ws[long], ws[long] + k, seed=1))
        sent.append(sent[0][long])
    h, sent = np.concatenate(h), np.concatenate(sent)
    order = np.lexsort((h, sent))
    h, sent = h[order], sent[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (sent[1:] != sent[:-1])
    h, sent = h[new], sent[new]
    held, of = np.unique(sent, return_inverse=True)
    start = at[held]
    end = np.append(at, n)[held + 1]
    doc = np.searchsorted(offsets, start, "right") - 1
    return Sentences(doc, start - offsets[doc], end - offsets[doc], h, of)


@dataclass
class NoisyOr:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def logits(self, s: Sentences) -> np.ndarray:
        z = np.full(len(s.doc), self.bias)
        if len(self.words):
            at = np.searchsorted(self.words, s.word)
            at[at == len(self.words)] = 0
            z += np.bincount(s.of, np.where(self.words[at] == s.word, self.weights[at], 0.0), len(z))
        return z

    def documents(self, s: Sentences, n: int, z: np.ndarray) -> np.ndarray:
        return -np.expm1(-np.bincount(s.doc, np.logaddexp(0, z), n))


@dataclass
class Sample:
    """Which word (col) stands in which sentence (row), each sentence's document, the documents' labels and counts."""

    col: np.ndarray
    row: np.ndarray
    doc: np.ndarray
    y: np.ndarray
    weight: np.ndarray


def gradient(x: np.ndarray, s: Sample) -> tuple[float, np.ndarray]:
    """The mean weighted log loss over documents and its gradient; x: the words' weights, then the bias."""
    z = x[-1] + np.bincount(s.row, x[s.col], len(s.doc))
    total = np.maximum(np.bincount(s.doc, np.logaddexp(0, z), len(s.y)), 1e-9)  # minus log of "no sentence is toxic"
    loss = (s.weight * np.where(s.y == 1, -np.log(-np.expm1(-total)), total)).mean()
    up = s.weight * np.where(s.y == 1, -1 / np.expm1(total), 1.0)
    dz = up[s.doc] / (1 + np.exp(-z)) / len(s.y)
    return float(loss), np.append(np.bincount(s.col, dz[s.row], len(x) - 1), dz.sum())


def fit(texts: list[str], labels: list[int], steps: int = 150, rate: float = 0.1, decay: float = 2e-4) -> NoisyOr:
    """Adam on the mean weighted log loss over documents, with L2 decay of word weights."""
    empty = NoisyOr(np.zeros(0, np.uint64), np.zeros(0), -40.0)
    y = np.asarray(labels, float)
    if not y.any():
        return empty
    # in parts, and twice, to hold little: first every word is listed, then its places are gathered
    cuts = [(a, min(a + FIT_TEXTS, len(texts))) for a in range(0, len(texts), FIT_TEXTS)]
    part = lambda a, b: sentences(*texts_of(pa.array(texts[a:b], pa.large_string())))
    words = np.unique(np.concatenate([np.unique(part(a, b).word) for a, b in cuts]))
    if not len(words):
        return empty
    cols, rows, docs_of, n, held_by = [], [], [], 0, np.zeros(len(words))
    for a, b in cuts:
        s = part(a, b)
        cols.append(np.searchsorted(words, s.word).astype(np.int32))
        pairs = np.unique(cols[-1].astype(np.int64) * FIT_TEXTS + s.doc[s.of])
        held_by += np.bincount(pairs // FIT_TEXTS, minlength=len(words))
        rows.append((s.of + n).astype(np.int32))
        docs_of.append(s.doc + a)
        n += len(s.doc)
    sample = Sample(np.concatenate(cols), np.concatenate(rows), np.concatenate(docs_of), y, np.where(y == 1, TOXIC_COUNTS, 1.0))
    decays = decay * (1 + DOUBLES_AT / held_by)
    x = np.zeros(len(words) + 1)
    x[-1] = -5.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        g = gradient(x, sample)[1]
        g[:-1] += decays * x[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return NoisyOr(words, x[:-1], float(x[-1]))


def _rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: NoisyOr = model.value
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            for i, j in blocks(offsets, BLOCK_BYTES):
                s = sentences(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                z = fitted.logits(s)
                score = fitted.documents(s, j - i, z)
                bad = np.flatnonzero((z > 0) & (score[s.doc] >= 0.5))
                spans: list[list[dict]] = [[] for _ in range(j - i)]
                for b in bad.tolist():
                    spans[s.doc[b]].append({"start": int(s.start[b]), "end": int(s.end[b]), "score": float(1 / (1 + np.exp(-z[b])))})
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "sentences"])

    return run


def score_toxicity(docs: DataFrame, model: NoisyOr) -> DataFrame:
    """Per row: doc_id, score, sentences (byte spans over 0.5 of documents over 0.5, with their scores)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the words of a bounded sample
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(_rows(shared), "doc_id long, score double, sentences array<struct<start: long, end: long, score: double>>")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = crc_part("doc_id", 5)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(part != 0)
    sample = labelled_sample(docs, labels, "toxic", PER_LABEL, MOST_CHARS)
    made = score_toxicity(docs, fit([r["text"] for r in sample], [r["toxic"] for r in sample]))
    return made.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences")
