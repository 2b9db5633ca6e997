"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all
its segmentations into pieces, by a forward pass; piece probabilities are fitted by expectation maximisation with the
backward pass. A text's score is the product over its words.

Words are runs of ASCII letters and bytes beyond ASCII, in lower case, with the vocabulary's word-start sign; in
scripts without spaces a word may be a whole text. The sum is over all segmentations of the whole word, however long:
forward values are rescaled every RESCALE bytes. Only for learning is a longer word taken as parts of FIT_LONGEST
bytes, cut between characters. A byte may also stand alone, at one low probability for all languages.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so is every text if nothing could be
learned; a null doc_id is not learned from; repeated rows give repeated rows; ties go to the first language by name;
very long texts are scored whole; an empty table gives an empty table; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import crc_part, labelled_sample
from .textbytes import MIX, blocks, span_hashes, texts_of

#: Bounds of the sample; bytes of a word's parts in learning; probability of a byte alone; added to every piece's count.
PER_LABEL, MOST_CHARS, FIT_LONGEST, ALONE, ADDED = 250, 6_000, 64, 1e-4, 0.02
#: Bytes of words between two rescalings; a byte takes at most a factor ALONE, so nothing runs below the least number.
RESCALE = 16
BLOCK_BYTES = 2 << 20
START = 1  # the byte for the word-start sign
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(65, 91), *range(128, 256)]] = True


class Trie:
    """Pieces as paths of bytes; steps are looked up in a hash table for many places at once."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = sorted(set(pieces))
        steps: dict[int, int] = {}
        ends = [-1]
        for k, piece in enumerate(self.pieces):
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in steps:
                    steps[key] = len(ends)
                    ends.append(-1)
                node = steps[key]
            ends[node] = k
        self.ends, self.depth = np.array(ends), max(map(len, self.pieces), default=0)
        bits = max(4, (2 * len(steps)).bit_length())
        self.shift, self.keys = np.uint64(64 - bits), np.full((1 << bits) + 64, -1, np.int64)
        self.next = np.full(len(self.keys), -1, np.int64)
        at = self.slot(np.fromiter(steps, np.int64, len(steps))).tolist()
        for (key, node), h in zip(steps.items(), at, strict=True):
            while self.keys[h] >= 0:
                h += 1
            self.keys[h], self.next[h] = key, node

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * MIX[0] >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at, out, left = self.slot(key), np.full(len(key), -1, np.int64), np.arange(len(key))
        while len(left):
            have = self.keys[at]
            hit = have == key
            out[left[hit]] = self.next[at[hit]]
            go = ~hit & (have >= 0)
            left, key, at = left[go], key[go], at[go] + 1
        return out

    def edges(self, data: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """For each length, the places where a piece begins, and the pieces. end: of each byte's word."""
        place = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        for d in range(self.depth):
            inside = place + d < end[place]
            place, node = place[inside], node[inside]
            node = self.step(node, data[place + d].astype(np.int64))
            live = node >= 0
            place, node = place[live], node[live]
            if not len(place):
                return
            piece = self.ends[node]
            yield place[piece >= 0], d + 1, piece[piece >= 0]


@dataclass
class Lattice:
    """The segmentations of some words, as edges from byte to byte (of the words with one byte more for their ends)."""

    first: np.ndarray
    last: np.ndarray
    by_offset: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # offset in the word, start, end, piece (-1: a byte alone)
    size: int


def lattice(trie: Trie, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Lattice:
    """data holds the words one after another."""
    word = np.repeat(np.arange(len(size)), size)
    end = np.cumsum(size)[word]
    begin, length, piece = [np.arange(len(data))], [np.ones(len(data), np.int64)], [np.full(len(data), -1)]
    for place, d, found in trie.edges(data, end):
        begin.append(place)
        length.append(np.full(len(place), d))
        piece.append(found)
    begin, length, piece = map(np.concatenate, (begin, length, piece))
    offset = begin - start[word[begin]]
    begin = begin + word[begin]
    key = offset * 2 + (piece < 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.diff(key)) + 1
    b, e, p = begin[order], (begin + length)[order], piece[order]
    at = (key[np.append(0, cut)] // 2).tolist() if len(key) else []
    groups = list(zip(at, np.split(b, cut), np.split(e, cut), np.split(p, cut), strict=True)) if len(b) else []
    first = start + np.arange(len(size))
    return Lattice(first, first + size, groups, len(data) + len(size))


def forward(x: Lattice, p: np.ndarray) -> np.ndarray:
    """p: pieces and then the byte alone, by languages. Returns places by languages."""
    a = np.zeros((x.size, p.shape[1]))
    a[x.first] = 1
    for _, b, e, piece in x.by_offset:  # the ends within a group differ
        a[e] += a[b] * p[piece]
    return a


def log_forward(x: Lattice, p: np.ndarray, depth: int) -> np.ndarray:
    """Log of the forward values at the words' ends, words by languages. No piece has more than ``depth`` bytes."""
    a = np.zeros((x.size, p.shape[1]))
    a[x.first] = 1
    size = x.last - x.first
    scale = np.zeros((len(size), p.shape[1]))
    order = np.argsort(size, kind="stable")  # longer words are the end of this order
    due, ahead = RESCALE, np.arange(depth + 1)
    for offset, b, e, piece in x.by_offset:
        if offset >= due:
            due = offset + RESCALE
            long = order[np.searchsorted(size[order], offset, "right") :]
            if len(long):  # all that is still to come starts from these places
                for part in np.array_split(long, -(-len(long) // 4096)):
                    place = np.minimum(x.first[part][:, None] + offset + ahead, x.last[part][:, None])
                    most = a[place].max(1)
                    scale[part] += np.log(most)
                    a[place] = a[place] / most[:, None]
        a[e] += a[b] * p[piece]
    return np.log(a[x.last]) + scale


def expected(x: Lattice, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected counts of pieces; weight: of words, by languages."""
    a = forward(x, p)
    z = np.zeros_like(a)
    z[x.last] = weight / np.maximum(a[x.last], 1e-300)
    counts = np.zeros_like(p)
    for _, b, e, piece in reversed(x.by_offset):
        flow = p[piece] * z[e]
        z[b] += flow
        for k in range(p.shape[1]):
            counts[:, k] += np.bincount(piece % len(p), a[b, k] * flow[:, k], len(p))
    return counts


def words_of(data: np.ndarray, offsets: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different words' bytes, starts and sizes; for each word of the texts, which one it is and its text.

    With ``longest``, words of more bytes come in parts, cut between characters.
    """
    n = len(data)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = _LETTER[data]
    cut = np.diff(inside)
    begins, ends = cut[:-1] == 1, cut[1:] == -1
    touch = offsets[1:-1]
    touch = touch[(touch > 0) & (touch < n)]
    touch = touch[(inside[touch] == 1) & (inside[touch + 1] == 1)]
    begins[touch], ends[touch - 1] = True, True
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if longest and len(s):
        parts = -(-(e - s) // longest)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        s, e, last = np.repeat(s, parts) + k * longest, np.repeat(e, parts), np.append(np.diff(k) <= 0, True)
        for _ in range(3):  # a character has at most three bytes after its first
            s[(k > 0) & (data[s] & 0xC0 == 0x80)] -= 1
        e = np.where(last, e, np.append(s[1:], 0))
    doc = np.searchsorted(offsets, s, "right") - 1
    h = span_hashes(data, s, e)
    _, one, which = np.unique(h, return_index=True, return_inverse=True)
    size = e[one] - s[one] + 1
    start = np.cumsum(size) - size
    out = np.full(int(size.sum()), START, np.uint8)
    k = np.arange(len(out)) - np.repeat(start, size)
    rest = k > 0
    out[rest] = data[(np.repeat(s[one], size) + k - 1)[rest]]
    return out, start, size, which, doc


@dataclass
class Marginalised:
    languages: list[str]
    trie: Trie
    p: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log probability of each text, by languages."""
        words, start, size, which, doc = words_of(data, offsets)
        n = len(offsets) - 1
        out = np.zeros((n, len(self.languages)))
        if len(size):
            x = lattice(self.trie, words, start, size)
            log = log_forward(x, self.p, max(self.trie.depth, 1))
            for k in range(out.shape[1]):
                out[:, k] = np.bincount(doc, log[which, k], n)
        return out


def vocabulary(path: str) -> list[bytes]:
    """The ordinary pieces of a sentencepiece model, in lower case, as bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [x.lower().replace("▁", chr(START)).encode() for x in names]


def fit(texts: list[str], languages: list[str], path: str, rounds: int = 4) -> Marginalised:
    trie = Trie(vocabulary(path))
    names = sorted(set(languages))
    p = np.full((len(trie.pieces) + 1, max(1, len(names))), 1 / max(1, len(trie.pieces)))
    p[-1] = ALONE
    if names:
        words, start, size, which, doc = words_of(*texts_of(pc.utf8_lower(pa.array(texts, pa.large_string()))), FIT_LONGEST)
        label = np.searchsorted(names, languages)
        weight = np.bincount(which * len(names) + label[doc], minlength=len(size) * len(names)).reshape(len(size), len(names)).astype(float)
        x = lattice(trie, words, start, size)
        for _ in range(rounds):
            counts = expected(x, p, weight)[:-1] + ADDED
            p[:-1] = counts / counts.sum(0)
    return Marginalised(names, trie, p)


def _rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Marginalised = model.value
        for batch in batches:
            data, offsets = texts_of(pc.utf8_lower(batch.column(1)))
            for i, j in blocks(offsets, BLOCK_BYTES):
                n = j - i
                if net.languages:
                    log = net.scores(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    best = log.argmax(1)
                    post = np.exp(log - log.max(1, keepdims=True))
                    lang, score = [net.languages[k] for k in best], 1 / post.sum(1)
                else:
                    lang, score = ["und"] * n, np.zeros(n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(2).slice(i, n), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "letters", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Marginalised) -> DataFrame:
    """Per row: doc_id, lang_pred, score (the posterior under equal priors)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters"))
    made = got.mapInArrow(_rows(shared), "doc_id long, letters boolean, lang_pred string, score double")
    return made.select("doc_id", F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"), F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = crc_part("doc_id", 5)
    sample = labelled_sample(docs, docs.where(part != 0).select("doc_id", "lang"), "lang", PER_LABEL, MOST_CHARS)
    made = identify(docs, fit([r["text"] for r in sample], [r["lang"] for r in sample], default_path()))
    return made.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
