"""Byte-pair encoding and decoding with a pair occurrence index.

The pieces of a partition are encoded slice by slice, those of a slice that are new together. The index maps every
mergeable pair, named by its rank, to the list of all positions in these pieces where it stands; the ranks that have
positions are active and wait in a heap. The least active rank is taken, its positions are merged from left to right,
and for each merge only the two pairs beside it change: the old ones' entries become void, and the new ones' positions
join their own lists, which makes their ranks active. So a merge costs the same however long its piece is.

Normalising and splitting are the vocabulary file's own steps. Each different piece is encoded once while it is
remembered (KNOWN pieces and those of a slice at most; the older half is forgotten then), and a text's output is its pieces' in order; a text beyond the size of a slice is a
slice of its own.

Edge cases: a null or empty text has no tokens and decodes to the empty text; strings of special tokens in a text are
those tokens, as in the library; a null doc_id is carried along; repeated rows give repeated rows; an empty table
gives an empty table; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import release

#: Characters of texts that are encoded together; pieces that a worker remembers; rank of a pair that is none.
SLICE_CHARS, KNOWN, NONE = 1 << 20, 300_000, np.iinfo(np.int32).max
#: Texts of these characters normalise by lower() alone and split by the second pattern; others go through the library.
_PLAIN = re.compile("[\t-\r -~À-įı-ſ]*").fullmatch
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]|[^\t-\r a-z0-9À-ÖØ-öø-ſ]+").findall


def byte_signs() -> list[str]:
    """The sign of each byte in byte-level vocabularies: itself if it prints in Latin-1, else the next from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in prints else next(rest)) for b in range(256)]


class PairIndexBpe:
    """The model of a vocabulary file of the tokenizers library, with its own merging."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self.signs = [*self.tokens, "\n"]  # the last one parts pieces
        self.decimal = [*map(str, range(len(self.tokens))), "\n"]
        self.find_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        signs = byte_signs()
        self.byte_of = {c: b for b, c in enumerate(signs)}
        self.inner = np.array([vocab[c] for c in signs], np.int64)
        self.final = np.array([vocab[c + end] for c in signs], np.int64)
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        self.made = [vocab[x + y] for x, y in merges]
        #: Rank of each pair, which is written as one number.
        self.rank = {vocab[x] << 32 | vocab[y]: r for r, (x, y) in enumerate(merges)}
        last = {token: r for r, token in enumerate(self.made)}
        if any(last.get(vocab[z], -1) >= r for r, (x, y) in enumerate(merges) for z in (x, y)):
            raise ValueError("a merge comes before one that makes its parts, so ranks do not ascend")
        #: Places of known pieces in the columns below: their ids in decimal, their decoded text, their numbers of ids.
        self.known: dict[str, int] = {}
        self.ids = self.decoded = pa.array([], pa.string())
        self.count = np.zeros(0, np.int64)

    def occurrences(self, sym: list[int], last: list[int]) -> tuple[list[int], dict[int, list[int]]]:
        """The rank of the pair that begins at each position, and the index: each rank's positions in ascending order."""
        get = self.rank.get
        rank = [get(a << 32 | b, NONE) for a, b in zip(sym, sym[1:], strict=False)] + [NONE]
        for p in last:  # the next sign is another piece's
            rank[p] = NONE
        flat = np.array(rank, np.int64)
        order = np.argsort(flat, kind="stable")
        order = order[: np.searchsorted(flat[order], NONE)]
        cut = np.flatnonzero(np.diff(flat[order])) + 1
        lists = np.split(order, cut) if len(order) else []
        return rank, {rank[x[0]]: x.tolist() for x in lists}

    def merge_all(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and each piece's number of ids."""
        n = len(raw)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        ends = np.cumsum(size) - 1
        ids = self.inner[raw]
        ids[ends] = self.final[raw[ends]]
        sym = ids.tolist()
        rank, index = self.occurrences(sym, ends.tolist())
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        begins = ends + 1 - size
        for p in begins.tolist():
            before[p] = -1
        for p in ends.tolist():
            after[p] = n
        get, made, void = self.rank.get, self.made, -1
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            positions, new = index.pop(r), made[r]
            positions.sort()
            for p in positions:
                if rank[p] != r:  # void: a neighbour's merge took one of its signs
                    continue
                q = after[p]
                sym[p], rank[q] = new, void
                sym[q] = void
                beyond = after[p] = after[q]
                now = NONE
                if beyond < n:
                    before[beyond] = p
                    now = get(new << 32 | sym[beyond], NONE)
                    if now != NONE:
                        if now in index:
                            index[now].append(p)
                        else:
                            index[now] = [p]
                            heapq.heappush(active, now)
                rank[p] = now
                back = before[p]
                if back >= 0:
                    now = get(sym[back] << 32 | new, NONE)
                    rank[back] = now
                    if now != NONE:
                        if now in index:
                            index[now].append(back)
                        else:
                            index[now] = [back]
                            heapq.heappush(active, now)
        out = np.array(sym, np.int64)
        held = out != void
        return out[held], np.add.reduceat(held, begins, dtype=np.int64)

    def parts(self, text: str) -> list[str]:
        """The text's pieces in order: plain ones in lower case, others in byte signs after U+0000, special tokens after U+0001."""
        if _PLAIN(text) and not ("<" in text and self.find_special.search(text)):
            return _PIECES(text.lower())
        out = []
        for part in self.find_special.split(text):
            if part in self.special:
                out.append("\1" + part)
            elif part:
                out += ["\0" + piece for piece, _ in self.split(self.normalize(part)) if piece]
        return out

    def raw(self, piece: str) -> bytes:
        return bytes([self.byte_of[c] for c in piece[1:]]) if piece[0] == "\0" else piece.encode()

    def learn(self, pieces: list[str]) -> None:
        """Adds pieces to the known ones; they are encoded together."""
        special = [self.special[x[1:]] for x in pieces if x[0] == "\1"]
        names = [x for x in pieces if x[0] != "\1"]
        each = [self.raw(x) for x in names]
        ids, counts = self.merge_all(np.frombuffer(b"".join(each), np.uint8), np.fromiter(map(len, each), np.int64, len(each)))
        cut = np.insert(ids, np.cumsum(counts)[:-1], len(self.tokens)).tolist() if names else []
        split = lambda text: text.split(" \n ") if names else []
        written = split(" ".join([self.decimal[i] for i in cut])) + [self.decimal[i] for i in special]
        decoded = split(self.decode(cut)) + [self.decode([i]) for i in special]
        self.known.update(zip(names + [x for x in pieces if x[0] == "\1"], range(len(self.ids), len(self.ids) + len(pieces)), strict=True))
        self.ids, self.decoded = (pa.concat_arrays([old, pa.array(new, pa.string())]) for old, new in ((self.ids, written), (self.decoded, decoded)))
        self.count = np.concatenate([self.count, counts, np.ones(len(special), np.int64)])

    def forget(self) -> None:
        """Leaves the newer half of the known pieces."""
        half = len(self.ids) // 2
        self.known = {x: at - half for x, at in self.known.items() if at >= half}
        self.ids, self.decoded = (pa.concat_arrays([x.slice(half), pa.array([], pa.string())]) for x in (self.ids, self.decoded))
        self.count = self.count[half:].copy()

    def decode(self, ids: list[int]) -> str:
        """As the library does for a file without a decoder: the tokens, joined by spaces."""
        tokens = self.signs
        return " ".join([tokens[i] for i in ids])

    def columns(self, texts: list[str]) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of each text: the number of ids, the ids in decimal joined by spaces, the decoded text."""
        cut = [self.parts(x) for x in texts]
        known = self.known
        self.learn([x for x in set().union(*cut) if x not in known])
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, int(n.sum()))
        offsets = np.concatenate([[0], np.cumsum(n)])
        joined = lambda x: pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), x.take(pa.array(at))), " ")
        total = np.concatenate([[0], np.cumsum(self.count[at])])
        out = total[offsets[1:]] - total[offsets[:-1]], joined(self.ids), joined(self.decoded)
        if len(self.ids) > KNOWN:
            self.forget()
        return out

    def run(self, texts: list[str]) -> list[tuple[str, str, int]]:
        """Of each text: ids in decimal joined by spaces, the decoded text, the number of ids."""
        n, ids, decoded = self.columns(texts)
        return list(zip(ids.to_pylist(), decoded.to_pylist(), n.tolist(), strict=True))


_models: dict[str, PairIndexBpe] = {}


def model_at(path: str) -> PairIndexBpe:
    if path not in _models:
        _models[path] = PairIndexBpe(path)
    return _models[path]


def _rows(path: str):
    names = ["doc_id", "n_tokens", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model_at(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and size < SLICE_CHARS:
                    size += len(texts[j] or "")
                    j += 1
                collects = gc.isenabled()
                gc.disable()  # nothing here is cyclic, and passes over millions of small objects cost more than the work
                try:
                    n, ids, decoded = bpe.columns([x or "" for x in texts[i:j]])
                finally:
                    if collects:
                        gc.enable()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), ids, decoded], names)
                i = j
            del texts
        release()

    return run


def encode_decode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_tokens, ids (decimal, joined by one space), decoded (from these ids)."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_rows(path), "doc_id long, n_tokens long, ids string, decoded string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(made: DataFrame) -> DataFrame:
    return made.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path()))
