"""Removal of repeated byte strings with a run-length suffix index.

Every LENGTH-byte string holds a least GRAM-byte gram (by hash); the strings that follow each other with one least
gram make a piece. Equal strings have equal least grams, so pieces with different grams share no string, and the bytes
of pieces that share a gram meet, in blocks of bounded size. Hashes only tell which bytes meet; that bytes are equal is
decided by the bytes:

* pieces of a batch of documents that are equal byte by byte go on as one, the first, and the others are repeats;
* a gram that one piece alone has, once, is done. For the others, a block's pieces that are equal byte by byte are one
  in its index; a suffix array of the different ones gives the Burrows-Wheeler transform, kept as its runs, with the
  suffix positions sampled at both ends of each run;
* matching statistics are streamed over the text from these samples alone: between samples, the match's place moves
  along by one and its length falls by one;
* where the match is LENGTH or longer, it links the string to an equal one; the first of each linked chain stays. What
  the index says of a piece holds for each place of it.

A gram of more pieces than a block holds is split over blocks. The strings that stay in these meet again in the index
of a next level, by the least gram of another hash beside the first: copies are a block's first ones alone by then, and
strings that differ part ways. Levels follow until no gram is split. What is removed is every byte of a string that is
not the first of its equals.

Edge cases: null and empty texts and texts shorter than LENGTH keep all bytes; a row with a null doc_id has no place
in the order, takes no part and keeps all bytes; rows that repeat a doc_id with the same text are one document and
share its result; those that repeat one with another text share the places of the id, so what is removed of either is
removed of both, at the same bytes; very long texts are taken whole; ties are settled by doc_id and start; an empty
table gives an empty table; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import MOST_HOT, kept
from .textbytes import MIX, blocks, list_column, mixed, texts_of, words8

LENGTH, GRAM = 100, 32
#: Bytes of text at a time; most strings in a piece; most pieces of a gram in a block; bytes of pieces in a block.
BLOCK_BYTES, LONGEST, MOST_PIECES, INDEX_BYTES = 1 << 18, 512, 1024, 1 << 20
MOST_LEVELS = 60
_U = np.uint64


def string_hashes(eight: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes start to end (64 at least) of each pair, from the eight bytes at each position.

    Hashes of 16, 32, 64 and 128 bytes are made from those of their halves, each through a finaliser; a string takes
    the blocks from its start on, and the one that ends with it.
    """
    def doubled(h: np.ndarray, width: int) -> np.ndarray:
        out = h.copy()
        out[:-width] = mixed(h[:-width] * MIX[3] + h[width:]) if len(h) > width else out[:-width]
        return out

    h = mixed(eight * MIX[0] + _U(seed))
    for width in (8, 16, 32):
        h = doubled(h, width)
    size = end - start
    out = mixed(size.astype(np.uint64) * MIX[1] + h[end - 64])
    short = size < 128
    out = np.where(short, mixed((out ^ h[start]) * MIX[3]), out)
    if short.all():
        return out
    h = doubled(h, 64)
    live, k = np.flatnonzero(~short), 0
    out[live] = mixed((out[live] ^ h[end[live] - 128]) * MIX[3])
    while len(live):
        out[live] = mixed((out[live] ^ h[start[live] + k]) * MIX[3])
        k += 128
        live = live[size[live] - k >= 128]
    return out


def least_grams(eight: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """From the eight bytes at each position: the hash of the gram there, and the least in the string from there on."""
    h = np.full(max(0, len(eight) - GRAM + 1), seed, np.uint64)
    for k in range(0, GRAM, 8):
        h = (h ^ eight[k : k + len(h)]) * MIX[k // 8 % 4]
        h ^= h >> _U(31)
    every = h = mixed(h)
    width, have = LENGTH - GRAM + 1, 1
    while have < width:  # least of the next `have` grams
        step = min(have, width - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return every, h


def same_bytes(data: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes from one and from two on are equal, size of them for each pair."""
    out = np.zeros(len(one), bool)
    for at in range(0, len(one), 8192):
        s = slice(at, at + 8192)
        begin = np.cumsum(size[s]) - size[s]
        k = np.arange(int(size[s].sum())) - np.repeat(begin, size[s])
        out[s] = np.logical_and.reduceat(data[np.repeat(one[s], size[s]) + k] == data[np.repeat(two[s], size[s]) + k], begin)
    return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each piece: gram, hash of its bytes, text, first string's place in the data, number of strings, and 1 if the
    gram stands in it several times, as then it may repeat itself."""
    n = len(data)
    none = (np.zeros(0, np.int64),) * 6
    if n < LENGTH:
        return none
    eight = words8(data)
    every, h = least_grams(eight)
    width = LENGTH - GRAM + 1
    fits = np.zeros(n + 1, np.int8)
    size = np.diff(offsets)
    ok = size >= LENGTH
    np.add.at(fits, offsets[:-1][ok], 1)
    np.add.at(fits, offsets[1:][ok] - LENGTH + 1, -1)
    fits = np.cumsum(fits[: len(h)]) > 0
    new = fits.copy()
    new[1:] &= (h[1:] != h[:-1]) | ~fits[:-1]
    begins = offsets[:-1][ok]
    new[begins] = True
    start = np.flatnonzero(new)
    if not len(start):
        return none
    count = np.add.reduceat(fits, start, dtype=np.int64)
    parts = -(-count // LONGEST)
    if parts.max() > 1:
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + k * LONGEST
        count = np.minimum(np.repeat(count, parts) - k * LONGEST, LONGEST)
    doc = np.searchsorted(offsets, start, "right") - 1
    across = np.arange(width)
    ahead = start + every[start[:, None] + across].argmin(1)
    behind = start + count - 1 + width - 1 - every[(start + count - 1)[:, None] + across[::-1]].argmin(1)
    content = string_hashes(eight, start, start + count + LENGTH - 1)
    return h[start].view(np.int64), content.view(np.int64), doc, start, count, (ahead != behind).astype(np.int64)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of whole texts. Pieces of a batch with equal bytes are one row, the first; the later ones are marks (count below 0)."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = texts_of(batch.column(1))
        found = []
        for i, j in blocks(offsets, BLOCK_BYTES):
            at = offsets[i]
            gram, content, doc, start, count, folds = pieces(data[at : offsets[j]], offsets[i : j + 1] - at)
            found.append((gram, content, doc + i, start + at, count, folds))
        gram, content, row, at, count, folds = map(np.concatenate, zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 6
        start = at - offsets[row]
        doc = ids[row] if len(row) else row
        order = np.lexsort((start, doc, content, gram))
        gram, content, doc, start, at, count, folds = (x[order] for x in (gram, content, doc, start, at, count, folds))
        again = np.zeros(len(gram), bool)
        again[1:] = (gram[1:] == gram[:-1]) & (content[1:] == content[:-1]) & (count[1:] == count[:-1])
        first = np.flatnonzero(~again)[np.cumsum(~again) - 1] if len(gram) else np.zeros(0, np.int64)
        later = np.flatnonzero(again)
        again[later] = same_bytes(data, at[later], at[first[later]], count[later] + LENGTH - 1)
        go = ~again | (doc != doc[first]) | (start != start[first])  # a text that is given twice is no repeat of itself
        yield pa.RecordBatch.from_arrays([pa.array(gram[go]), pa.array(doc[go]), pa.array(start[go].astype(np.int32)), pa.array(np.where(again, -count, count)[go].astype(np.int32)), pa.array(folds[go].astype(np.int32))], ["gram", "doc_id", "start", "count", "folds"])


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of gram: the marks, and the pieces whose bytes must meet: of grams of several, or that fold.

    salt numbers the blocks of a gram's pieces; hot tells that there are several. At most a batch and a block's
    pieces of one gram are held.
    """
    def rows(t: np.ndarray, salt: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        kinds = (np.int64, np.int32, np.int32, np.int64)
        return pa.RecordBatch.from_arrays([*(pa.array(t[:, k].astype(d)) for k, d in zip((1, 2, 3, 0), kinds, strict=True)), pa.array(salt.astype(np.int32)), pa.array(hot)], ["doc_id", "start", "count", "gram", "salt", "hot"])

    held, gram0, number = np.zeros((0, 5), np.int64), None, 0  # number: pieces of the open gram that went out
    for batch in batches:
        t = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)], axis=1)
        marks = t[t[:, 3] < 0]
        if len(marks):
            yield rows(marks, np.zeros(len(marks)), np.zeros(len(marks), bool))
        every = np.concatenate([held, t[t[:, 3] > 0]])
        if not len(every):
            continue
        begin = np.flatnonzero(np.concatenate([[True], every[1:, 0] != every[:-1, 0]]))
        size, before = np.diff(begin, append=len(every)), np.zeros(len(begin), np.int64)
        if number and every[0, 0] == gram0:
            before[0] = number
        total = np.repeat(size + before, size)
        order = np.arange(len(every)) - np.repeat(begin - before, size)
        out = np.ones(len(every), bool)
        gram0, number, held = every[-1, 0], int(total[-1]), every[:0]
        if number <= MOST_PIECES:
            out = every[:, 0] != gram0
            number, held = 0, every[~out]
        out &= (total > 1) | (every[:, 4] > 0)
        if out.any():
            yield rows(every[out], (order // MOST_PIECES)[out], (total > MOST_PIECES)[out])
    if len(held) > 1 or len(held) and held[0, 4]:
        yield rows(held, np.zeros(len(held)), np.zeros(len(held), bool))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the requested pieces of each text."""
    names = ["gram", "salt", "hot", "doc_id", "start", "piece"]
    for batch in batches:
        data, offsets = texts_of(batch.column(1))
        ids, asked = batch.column(0).to_numpy(), batch.column(2).combine_chunks() if isinstance(batch.column(2), pa.ChunkedArray) else batch.column(2)
        flat = asked.flatten()
        counts = np.diff(asked.offsets.to_numpy())
        row = np.repeat(np.arange(len(ids)), counts)
        get = lambda k: flat.field(k).to_numpy(zero_copy_only=False)
        start, count = get("start").astype(np.int64), get("count").astype(np.int64)
        ok = start + count + LENGTH - 1 <= np.diff(offsets)[row]
        sel = np.flatnonzero(ok)
        for at in range(0, len(sel), 20_000):
            k = sel[at : at + 20_000]
            size = count[k] + LENGTH - 1
            begin = np.cumsum(size) - size
            raw = data[np.repeat(offsets[row[k]] + start[k] - begin, size) + np.arange(size.sum())]
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            piece = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(get("gram")[k]), pa.array(get("salt")[k]), pa.array(get("hot")[k]), pa.array(ids[row[k]]), pa.array(start[k].astype(np.int32)), piece], names)


class RunIndex:
    """Runs of the transform of a text of pieces, each ended by a sign of its own, with sampled run ends.

    ``at``: positions of the suffixes that begin runs, in text order; ``before``: of the suffix just before each in
    suffix order, the end of the run before; ``length``: of their common prefix.
    """

    def __init__(self, raw: np.ndarray, size: np.ndarray):
        ends = np.cumsum(size + 1) - 1
        n = int(ends[-1]) + 1
        text = np.zeros(n, np.int64)
        inner = np.ones(n, bool)
        inner[ends] = False
        text[inner] = raw.astype(np.int64) + len(ends)
        text[ends] = np.arange(len(ends))
        self.text, self.inner, self.n = text, inner, n
        order = self.suffixes(raw, inner, ends)
        bwt = text[order - 1]  # of the first suffix, the last sign
        head = np.ones(n, bool)
        head[1:] = bwt[1:] != bwt[:-1]
        self.runs = int(head.sum())
        rows = np.flatnonzero(head)[1:]
        at, before = order[rows], order[rows - 1]
        by = np.argsort(at)
        self.at, self.before = at[by], before[by]
        self.length = self.common(self.at, self.before)
        k = np.searchsorted(self.at, order[0])  # the first suffix has none before it
        self.at, self.before, self.length = np.insert(self.at, k, order[0]), np.insert(self.before, k, order[0]), np.insert(self.length, k, 0)

    @staticmethod
    def suffixes(raw: np.ndarray, inner: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """In order: by seven bytes first, then by prefix doubling, in which only suffixes that are still equal move.

        An end of a piece comes before any byte, and before the ends of later pieces.
        """
        n = len(inner)
        bytes_ = np.zeros(n, np.uint8)
        bytes_[inner] = raw
        room = np.minimum(np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n), 7)  # bytes before the end
        held = np.array([0] + [(1 << 64) - (1 << 64 - 8 * k) for k in range(1, 8)], np.uint64)
        key = words8(bytes_).byteswap() & held[room] | room.astype(np.uint64)
        order = np.argsort(key)
        short = np.flatnonzero(room[order] < 7)  # they end in the key, and the places of equal ones are in order of pieces
        order[short] = order[short][np.lexsort((order[short], key[order[short]]))]
        moved = key[order]
        new = np.ones(n, bool)
        new[1:] = (moved[1:] != moved[:-1]) | (room[order[1:]] < 7)
        head = np.flatnonzero(new)
        count = np.diff(head, append=n)
        rank = np.empty(n, np.int64)  # the first place of equals
        rank[order] = np.repeat(head, count)
        tied, have = np.flatnonzero(np.repeat(count > 1, count)), 7
        while len(tied):
            part = order[tied]
            key = rank[part] * (n + 1) + rank[part + have]
            by = np.argsort(key)
            part, key = part[by], key[by]
            order[tied] = part
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            head = np.flatnonzero(new)
            count = np.diff(head, append=len(key))
            rank[part] = np.repeat(tied[head], count)
            tied, have = tied[np.repeat(count > 1, count)], have * 2
        return order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes, by comparison of the samples' signs; ends of pieces differ."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            i, j = a[live] + out[live], b[live] + out[live]
            ok = (i < self.n) & (j < self.n)
            ok[ok] = self.text[i[ok]] == self.text[j[ok]]
            live = live[ok]
            out[live] += 1
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Streamed over the text: each position's match and its length, from the samples alone."""
        place = np.arange(self.n)
        k = np.searchsorted(self.at, place, "right") - 1
        safe = np.maximum(k, 0)
        past = place - self.at[safe]
        length = np.where(k >= 0, np.maximum(self.length[safe] - past, 0), 0)
        return np.where(length > 0, self.before[safe] + past, -1), length


def firsts(index: RunIndex, least: int = LENGTH) -> np.ndarray:
    """For each position the least position among those with an equal string of ``least`` bytes; -1 where none begins."""
    match, length = index.statistics()
    linked = length >= least
    to = np.where(linked, match, np.arange(index.n))
    low = np.minimum(np.arange(index.n), to)
    # chains lead to the equal string that is least in suffix order; its own least place is gathered on the way
    while True:
        further = to[to]
        low = np.minimum(low, low[to])
        if np.array_equal(further, to):
            break
        to = further
    best = np.arange(index.n)
    np.minimum.at(best, to, low)
    room = np.zeros(index.n, np.int64)
    ends = np.flatnonzero(~index.inner)
    room = ends[np.searchsorted(ends, np.arange(index.n))] - np.arange(index.n)
    return np.where(room >= least, best[to], -1)


INDEXED = ["doc_id", "start", "count", "gram", "piece"]


def decide(t: pa.Table, over: int | None, level: int) -> Iterator[pa.RecordBatch]:
    """From a block's pieces: the places of strings that are not the first of their equals (count below 0).

    Of split grams (hot, or ``over``) also the pieces that stay, with their bytes and the gram of the next level.
    """
    t = t.combine_chunks()
    t = t.take(pa.array(np.lexsort((t.column("start").to_numpy(), t.column("doc_id").to_numpy())))).combine_chunks()
    raw, offsets = texts_of(t.column("piece").combine_chunks())
    gram, doc, start = t.column("gram").to_numpy(), t.column("doc_id").to_numpy(), t.column("start").to_numpy().astype(np.int64)
    hot = t.column("hot").to_numpy(zero_copy_only=False) | (gram == over if over is not None else False)
    n, size, eight = len(doc), np.diff(offsets), words8(raw)
    # pieces of equal bytes are one in the index: the first, as they are in order of places
    h = string_hashes(eight, offsets[:-1], offsets[1:])
    order = np.argsort(h, kind="stable")
    new = np.ones(n, bool)
    new[1:] = h[order][1:] != h[order][:-1]
    rep = np.empty(n, np.int64)
    rep[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    other = np.flatnonzero((rep != np.arange(n)) & (size == size[rep]))
    rep[rep != np.arange(n)] = np.where(size == size[rep], rep, np.arange(n))[rep != np.arange(n)]
    other = other[~same_bytes(raw, offsets[:-1][other], offsets[:-1][rep[other]], size[other])]
    rep[other] = other
    mine = rep == np.arange(n)
    index = RunIndex(raw[np.repeat(mine, size)], size[mine])
    best = firsts(index)
    begin = np.cumsum(size[mine] + 1) - (size[mine] + 1)
    place_of = np.repeat(start[mine] - begin, size[mine] + 1) + np.arange(index.n)
    doc_of = np.repeat(doc[mine], size[mine] + 1)
    # what the index says of a piece's strings holds for each place of it
    count = size - LENGTH + 1
    piece = np.repeat(np.arange(n), count)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    origin = best[begin[np.cumsum(mine) - 1][rep[piece]] + k]
    where = start[piece] + k
    later = np.flatnonzero((doc_of[origin] != doc[piece]) | (place_of[origin] != where))

    def runs(at: np.ndarray, parts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        cut = np.ones(len(at), bool)
        cut[1:] = (np.diff(at) != 1) | (piece[at][1:] != piece[at][:-1])
        if parts is not None:
            cut[1:] |= parts[1:] != parts[:-1]
        head = np.flatnonzero(cut)
        return at[head], np.diff(head, append=len(at))

    if len(later):
        s, c = runs(later)
        yield pa.RecordBatch.from_arrays([pa.array(doc[piece[s]]), pa.array(where[s].astype(np.int32)), pa.array(-c.astype(np.int32)), pa.nulls(len(s), pa.int64()), pa.nulls(len(s), pa.binary())], INDEXED)
    stay = np.ones(len(piece), bool)
    stay[later] = False
    stay = np.flatnonzero(stay & hot[piece] & mine[piece])
    if len(stay):
        at = offsets[:-1][piece[stay]] + k[stay]
        key = mixed(gram[piece[stay]].view(np.uint64) * MIX[0] + least_grams(eight, level)[1][at])
        s, c = runs(stay, key)
        key = key[np.searchsorted(stay, s)].view(np.int64)
        for a in range(0, len(s), 20_000):
            one, z = s[a : a + 20_000], c[a : a + 20_000] + LENGTH - 1
            first = np.cumsum(z) - z
            text = raw[np.repeat(offsets[:-1][piece[one]] + k[one] - first, z) + np.arange(int(z.sum()))]
            ends = np.concatenate([[0], np.cumsum(z)]).astype(np.int32)
            bytes_ = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(doc[piece[one]]), pa.array(where[one].astype(np.int32)), pa.array((z - LENGTH + 1).astype(np.int32)), pa.array(key[a : a + 20_000]), bytes_], INDEXED)


def _index(batches: Iterator[pa.RecordBatch], level: int = 1) -> Iterator[pa.RecordBatch]:
    """From pieces (gram, salt, hot, doc_id, start, piece) in order of gram and salt: what ``decide`` tells of their blocks.

    A block ends with a gram and salt once it has INDEX_BYTES; a gram and salt of more than MOST_PIECES is split.
    """
    rest: list[pa.Table] = []
    held, number, open_ = 0, 0, None
    for batch in batches:
        if not len(batch):
            continue
        gram, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
        new[0] = open_ != (gram[0], salt[0])
        head = np.flatnonzero(new | (np.arange(len(gram)) == 0))
        order = np.arange(len(gram)) - np.repeat(head, np.diff(head, append=len(gram)))
        if not new[0]:
            order[: head[1] if len(head) > 1 else len(gram)] += number
        split = ~new & (order % MOST_PIECES == 0)
        batch = batch.set_column(2, "hot", pa.array(batch.column(2).to_numpy(zero_copy_only=False) | (order >= MOST_PIECES)))
        size = np.concatenate([[0], np.cumsum(np.diff(texts_of(batch.column(5))[1]))])
        at = 0
        for cut in np.flatnonzero(new | split).tolist():  # where a block may end, or must
            if split[cut] or held + size[cut] - size[at] >= INDEX_BYTES:
                if cut > at:
                    rest.append(pa.Table.from_batches([batch.slice(at, cut - at)]))
                if rest:
                    yield from decide(pa.concat_tables(rest), gram[cut] if split[cut] else None, level)
                rest, held, at = [], 0, cut
        rest.append(pa.Table.from_batches([batch.slice(at)]))
        held += int(size[-1] - size[at])
        open_, number = (gram[-1], salt[-1]), int(order[-1]) + 1
    if rest:
        yield from decide(pa.concat_tables(rest), None, level)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their marked strings, and the spans removed."""
    for batch in batches:
        data, offsets = texts_of(batch.column(1))
        asked = batch.column(2)
        flat = asked.flatten()
        counts = np.diff(asked.offsets.to_numpy()) if len(asked) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        start = flat.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
        end = start - flat.field("count").to_numpy(zero_copy_only=False) + LENGTH - 1
        size = np.diff(offsets)
        start, end = np.minimum(start, size[row]), np.minimum(end, size[row])
        depth = np.zeros(len(data) + 1, np.int64)
        np.add.at(depth, offsets[row] + start, 1)
        np.add.at(depth, offsets[row] + end, -1)
        gone = np.cumsum(depth)[:-1] > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = gone.copy()
        first[1:] &= ~gone[:-1] | edge[1:-1]
        last = gone.copy()
        last[:-1] &= ~gone[1:] | edge[1:-1]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(offsets, a, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(a - offsets[doc]), pa.array(b - offsets[doc])], ["start", "end"])
        n = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(counts)))]).astype(np.int32)
        left = np.concatenate([[0], np.cumsum(~gone)])[offsets].astype(np.int64)
        kept_text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(left.tobytes()), pa.py_buffer(data[~gone].tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.ListArray.from_arrays(pa.array(n), spans), kept_text], ["doc_id", "n_bytes", "spans", "kept"])


def _dealt(stays: DataFrame) -> DataFrame:
    """Pieces for the next level: those of hot grams in blocks, the others by gram alone."""
    counted = stays.groupBy("gram").agg(F.count("*").alias("n"))
    total = stays.count()
    hot = counted.where(F.col("n") > max(MOST_PIECES, total // MOST_HOT))  # fewer than MOST_HOT
    salt = F.pmod(F.xxhash64("doc_id", "start"), F.ceil(F.col("n") / MOST_PIECES)).cast("int")
    met = stays.join(F.broadcast(hot), "gram", "left")
    return met.select("gram", F.coalesce(salt, F.lit(0)).alias("salt"), F.col("n").isNotNull().alias("hot"), "doc_id", "start", "piece")


def _levels(first: DataFrame) -> list[DataFrame]:
    """The marks of all levels of the index."""
    out, rows = [], first
    kind = "doc_id long, start int, count int, gram long, piece binary"
    for level in range(1, MOST_LEVELS):
        met = rows.repartition("gram", "salt").sortWithinPartitions("gram", "salt")
        told = kept(met.mapInArrow(lambda batches, level=level: _index(batches, level), kind), f"marks-{level}")
        out.append(told.where("count < 0").select("doc_id", "start", "count"))
        stays = told.where("count > 0")
        if not stays.limit(1).count():
            return out
        rows = _dealt(stays)
    raise RuntimeError("the levels of the index did not end")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (start, end of the removed runs), kept (the bytes that stay)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = base.where("doc_id is not null and text is not null").mapInArrow(_scan, "gram long, doc_id long, start int, count int, folds int")
    # marks go anywhere: only a batch's first pieces meet by gram
    by_gram = found.repartition(F.when(F.col("count") > 0, F.col("gram")).otherwise(F.xxhash64("doc_id", "start"))).sortWithinPartitions("gram")
    told = kept(by_gram.mapInArrow(_requests, "doc_id long, start int, count int, gram long, salt int, hot boolean"), "pieces")
    asked = told.where("count > 0").groupBy("doc_id").agg(F.collect_list(F.struct("start", "count", "gram", "salt", "hot")).alias("asked"))
    bytes_of = base.join(asked.hint("merge"), "doc_id").select("doc_id", "text", "asked").mapInArrow(_extract, "gram long, salt int, hot boolean, doc_id long, start int, piece binary")
    every = told.where("count < 0").select("doc_id", "start", "count")
    for marks in _levels(bytes_of):
        every = every.unionByName(marks)
    gone = every.groupBy("doc_id").agg(F.collect_list(F.struct("start", "count")).alias("gone"))
    met = base.join(gone.hint("merge"), "doc_id", "left")
    none = F.array().cast("array<struct<start: int, count: int>>")
    return met.select("doc_id", F.coalesce("text", F.lit(b"")).alias("text"), F.coalesce("gone", none).alias("gone")).mapInArrow(_cut, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    made = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return made.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), c AS (
  SELECT doc_id, len(x) // 2 AS n, regexp_extract_all(x, '.{1,200}') AS c FROM d
), b AS (
  SELECT doc_id, n, unnest(c) AS one, unnest(list_append(c[2:], '')) AS next, unnest(range(len(c))) AS k FROM c
), p AS (
  SELECT doc_id, one || next AS x, k, unnest(range(greatest(0, least(100, n - 99 - 100 * k)))) AS j FROM b
), s AS (
  SELECT doc_id, 100 * k + j AS i, md5(substr(x, 2 * j + 1, 200)) AS h FROM p
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM s) WHERE k > 1
), g AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS begins FROM r
), t AS (
  SELECT doc_id, i, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g
), u AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM t GROUP BY doc_id, run
), stay AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM u
  UNION ALL SELECT d.doc_id, coalesce(max(u.b), 0), any_value(len(d.x) // 2) FROM d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY d.doc_id
), y AS (
  SELECT stay.doc_id, string_agg(substr(d.x, 2 * stay.a + 1, 2 * (stay.b - stay.a)), '' ORDER BY stay.a) AS x
  FROM stay JOIN d ON d.doc_id = stay.doc_id GROUP BY stay.doc_id
)
SELECT d.doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, ((len(d.x) - len(y.x)) // 2)::BIGINT AS n_removed,
  (SELECT count(*) FROM u WHERE u.doc_id = d.doc_id)::BIGINT AS n_spans, sha256(unhex(y.x)) AS kept_sha256
FROM d JOIN y ON y.doc_id = d.doc_id
"""
