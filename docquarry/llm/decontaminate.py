"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become sequences of terms: numbers, names (capitalised words) and units give way to typed
placeholders; other words are lower-cased letters and digits without punctuation. ``99km`` and ``$99`` are a number and
its unit, in that order, as ``99 km`` and ``99 dollars`` are. A capitalised word that begins a sentence may be a name
or not, so each sequence has three variants: names without such words, names with them, and words alone. Windows of any
variants that share a hash are joined; placeholders' values are slots. A window with fewer than LEAST_PLAIN words
beside its placeholders is no template and is joined by its values alone. A window pair is consistent if the document's
value for each of the item's values is one and the same, and the other way round, and so is a chain of alignments over
all its windows: a re-parameterised question renames consistently. Adjacent names may count as one value there, so a
name may be renamed to one of another word count. A document is contaminated by an item if consistent windows cover at
least COVER of the item's terms, in the item's order, each on the alignment of the one before or on one at most WINDOW
terms off: words put in or left out shift the rest.

Windows have a third of an item's terms, from TEMPLATE to WINDOW, so that a word put in leaves some on both sides. Items
under SHORT terms are one window of their own length, those under TEMPLATE terms by their values alone.

A window that an item has once meets all its equals in a document. One that it has several times meets each of them
once, at the place that the nearest window of the first kind tells (or, without any, in order); so pairs are no more
than places in documents.

The benchmark is the stated query set. One of at most ITEMS items and ITEM_BYTES bytes is broadcast, with the hashes of
its windows in order. The windows of a larger one are a table: a filter of FILTER bits tells which windows of documents
can be among its hashes, those are joined with it by hash, and documents meet only the items whose windows they hold
enough of. Both ways give the same rows.

Edge cases: null and empty texts have no terms and are clean; a null doc_id is reported as null; items without terms or
with a null text match nothing; rows that repeat are reported each; ties between items are all reported; very long texts
are searched whole; an empty table or benchmark gives no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept
from .textbytes import MIX, blocks, mixed, span_hashes, texts_of

WINDOW, SHORT, TEMPLATE, LEAST_PLAIN, COVER = 8, 10, 5, 2, 0.7
#: Most items, and bytes of items, that are broadcast; bits of the filter of a larger benchmark's hashes, a power of two.
ITEMS, ITEM_BYTES, FILTER = 20_000, 32 << 20, 1 << 27
#: Items that a document is compared with at a time, if the benchmark is larger than that.
ITEMS_TOGETHER = 1000
BLOCK_BYTES = 1 << 19
#: Words that stand for units.
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "lb", "oz", "ml", "l", "s", "sec", "min", "h", "hr", "hours", "hour", "minutes", "seconds", "days", "day", "years", "year", "miles", "mile", "feet", "ft", "inches", "inch", "meters", "metres", "dollars", "dollar", "euros", "euro", "cents", "usd", "eur", "percent", "degrees", "kmh", "mph")
#: Signs before a number that are its unit, and those after one.
CURRENCIES, AFTER = ("$", "£", "¥", "€"), ("%",)
PLAIN, NUMBER, NAME, UNIT = range(4)
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True
#: Whether the character of these two bytes is a capital letter; of one byte, whatever follows.
_CAPITAL = np.zeros((256, 256), bool)
_CAPITAL[65:91] = True
for _lead in range(0xC2, 0xE0):
    for _next in range(0x80, 0xC0):
        _CAPITAL[_lead, _next] = bytes([_lead, _next]).decode().isupper()
_U = np.uint64


def _units() -> np.ndarray:
    raw = np.frombuffer("".join(UNITS).encode(), np.uint8)
    end = np.cumsum([len(x) for x in UNITS])
    return np.sort(span_hashes(raw, np.concatenate([[0], end[:-1]]), end))


_UNIT = _units()
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "$%"]] = True
_SIGNS = np.concatenate([span_hashes(np.frombuffer(c.encode(), np.uint8), np.zeros(1, np.int64), np.full(1, len(c.encode()))) for c in CURRENCIES[1:]])
_MARK = mixed(np.arange(1, 5, dtype=np.uint64) * MIX[2])


def _is_unit(value: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_UNIT, value)
    at[at == len(_UNIT)] = 0
    return _UNIT[at] == value


def spelled(texts: pa.Array) -> pa.Array:
    """Texts with each unit sign as a word after its number: $99 as 99 $, 50% as 50 %."""
    made = texts.cast(pa.large_string())
    if pc.any(pc.match_substring_regex(made, "[" + "".join(CURRENCIES) + "] ?[0-9]|[0-9] ?[" + "".join(AFTER) + "]")).as_py():
        made = pc.replace_substring_regex(made, r"([" + "".join(CURRENCIES) + r"]) ?([0-9]+(?:[.,][0-9]+)*)", r"\2 \1 ")
        made = pc.replace_substring_regex(made, r"([0-9]) ?([" + "".join(AFTER) + r"])", r"\1 \2 ")
    return made


def signs_of(data: np.ndarray, n: int) -> np.ndarray:
    """1 at the bytes of terms' signs: letters, digits, bytes beyond ASCII, points inside numbers, unit signs after numbers."""
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = _TERM[data]
    if n > 2:
        mid = np.flatnonzero(((data[1:-1] == 46) | (data[1:-1] == 44)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]) + 1  # 3.5 and 1,000 are one number
        inside[mid + 1] = 1
        for c in "$%":
            inside[np.flatnonzero((data[2:] == ord(c)) & (data[1:-1] == 32) & _DIGIT[data[:-2]]) + 3] = 1
    return inside


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data < 91), data + 32, data).astype(np.uint8)


def _values(texts: pa.Array, data: np.ndarray, offsets: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the lower-cased terms; letters beyond ASCII are lower-cased too, text by text where that changes sizes."""
    low = _lowered(data)
    if len(data) and data.max() >= 0xC3:
        made, at = texts_of(pc.utf8_lower(texts.cast(pa.large_string())))
        for i in range(len(offsets) - 1) if len(made) != len(low) else ():
            if at[i + 1] - at[i] == offsets[i + 1] - offsets[i]:
                low[offsets[i] : offsets[i + 1]] = made[at[i] : at[i + 1]]
        if len(made) == len(low):
            low = made
    return span_hashes(low, s, e)


@dataclass
class Terms:
    value: np.ndarray  # hash of the lower-cased word
    kind: np.ndarray
    sure: np.ndarray  # the kind, but plain for capitalised words that begin a sentence
    symbols: tuple[np.ndarray, ...]  # by variant the value, or the placeholder's hash
    doc: np.ndarray
    first: np.ndarray
    run: np.ndarray  # the value, or for a name that of all the names it stands among


def terms(texts: pa.Array) -> Terms:
    """Of the texts, which ``spelled`` has made."""
    data, offsets = texts_of(texts)
    n = len(data)
    inside = signs_of(data, n)
    cut = np.diff(inside)
    begins, ends = cut[:-1] == 1, cut[1:] == -1
    touch = offsets[1:-1]
    touch = touch[(touch > 0) & (touch < n)]
    touch = touch[(inside[touch] == 1) & (inside[touch + 1] == 1)]
    begins[touch], ends[touch - 1] = True, True
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    digit = _DIGIT[data[s]] if len(s) else np.zeros(0, bool)
    if digit.any():  # 99km is two terms
        letters = np.flatnonzero(_TERM[data] & ~_DIGIT[data])
        first = np.append(letters, n)[np.searchsorted(letters, s)]
        joined = np.flatnonzero(digit & (first < e))
        joined = joined[_is_unit(span_hashes(_lowered(data), first[joined], e[joined]))]
        s, e = np.sort(np.append(s, first[joined])), np.sort(np.append(e, first[joined]))
        digit = _DIGIT[data[s]]
    value = _values(texts, data, offsets, s, e)
    kind = np.zeros(len(s), np.int8)
    doc = np.searchsorted(offsets, s, "right") - 1
    if len(s):
        prior = np.concatenate([[0], np.cumsum(_STOP[data])])
        opens = np.ones(len(s), bool)
        opens[1:] = (prior[s[1:]] > prior[e[:-1]]) | (doc[1:] != doc[:-1])
        after = np.zeros(len(s), bool)
        after[1:] = digit[:-1] & (doc[1:] == doc[:-1])
        capital = _CAPITAL[data, np.append(data[1:], 0)]
        inner = np.concatenate([[0], np.cumsum(capital)])
        kind[capital[s] & (inner[e] - inner[s] == 1) & (e - s > 1 + (data[s] >= 128))] = NAME
        kind[(_is_unit(value) | _SIGN[data[s]] | np.isin(value, _SIGNS)) & after] = UNIT
        kind[digit] = NUMBER
    sure = kind.copy()
    if len(s):
        sure[opens & (kind == NAME)] = PLAIN
    run = value.copy()
    if len(s):
        joined = np.zeros(len(s), bool)
        joined[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & ~opens[1:]
        head = np.flatnonzero(~joined)
        size = np.diff(head, append=len(s))
        place = np.arange(len(s)) - np.repeat(head, size)
        total = np.add.reduceat(mixed(value + place.astype(np.uint64) * MIX[0]), head)
        run = np.where(np.repeat(size > 1, size), np.repeat(total, size), value)
    symbols = (*(np.where(c > 0, _MARK[c], value) for c in (sure, kind)), value)
    return Terms(value, kind, sure, symbols, doc, np.searchsorted(s, offsets), run)


def _rolled(symbol: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(symbol) - size + 1), np.uint64)
    for i in range(size):
        out *= MIX[3]
        out += symbol[i : i + len(out)]
    return mixed(out + _U(size))


def _variants(t: Terms, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each variant, hashes and first terms of the windows that differ from an earlier one's and are templates or all words."""
    base = _rolled(t.symbols[0], size)
    whole = t.doc[: len(base)] == t.doc[size - 1 : size - 1 + len(base)]
    for k, (symbol, kind) in enumerate(zip(t.symbols, (t.sure, t.kind, None), strict=True)):
        h = _rolled(symbol, size) if k else base
        go = whole & (h != base) if k else whole
        if kind is not None:
            words = np.concatenate([[0], np.cumsum(kind == PLAIN)])
            plain = words[size : size + len(h)] - words[: len(h)]
            go = go & ((plain >= min(size, LEAST_PLAIN)) | (plain == size))
        elif k:  # all words: also where the first variant's window is no template
            go = whole & (h != base)
        at = np.flatnonzero(go)
        yield h[at], at


@dataclass
class Windows:
    """Of all items' windows of one size: hashes and items in order, each group's windows (first terms) in order."""

    hash: np.ndarray
    item: np.ndarray
    begin: np.ndarray  # of each group (hash, item) in place, and the end
    place: np.ndarray


@dataclass
class Items:
    ids: np.ndarray
    terms: Terms
    windows: dict[int, Windows]  # by size
    count: np.ndarray  # of each item's terms
    size: np.ndarray  # of each item's windows


def window_sizes(count: np.ndarray) -> np.ndarray:
    """By an item's number of terms."""
    return np.where(count >= SHORT, np.clip(count // 3, TEMPLATE, WINDOW), count)


def items_of(ids: list[int], texts: list[str]) -> Items:
    t = terms(spelled(pa.array(texts, pa.large_string())))
    count = np.diff(t.first)
    size = window_sizes(count)
    found = {}
    for z in np.unique(size[size > 0]).tolist():
        every = list(_variants(t, z))
        if z < TEMPLATE:
            values = _rolled(t.symbols[2], z)
            every = [(values, np.arange(len(values)))]
        h, at = (np.concatenate(c) for c in zip(*every, strict=True))
        own = (size[t.doc[at]] == z) & (t.doc[at] == t.doc[np.minimum(at + z - 1, len(t.doc) - 1)])
        h, at = h[own], at[own]
        order = np.lexsort((at, t.doc[at], h))
        h, at = h[order], at[order]
        item = t.doc[at]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1])
        begin = np.flatnonzero(new)
        found[z] = Windows(h[begin], item[begin], np.append(begin, len(h)), at)
    return Items(np.asarray(ids, np.int64), t, found, count, size)


def paired(w: Windows, h: np.ndarray, x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of windows x of texts and windows of items with the same hash, at most one for each x and item of several."""
    order = np.lexsort((x, h))
    h, x, doc = h[order], x[order], doc[order]
    lo, hi = np.searchsorted(w.hash, h, "left"), np.searchsorted(w.hash, h, "right")
    n = hi - lo
    group = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    x, doc = np.repeat(x, n), np.repeat(doc, n)
    first, many = w.begin[group], w.begin[group + 1] - w.begin[group]
    y = w.place[first]
    if len(x) and many.max() > 1:
        key = doc * (int(w.item.max()) + 1) + w.item[group]  # of a text and an item
        order = np.lexsort((x, group, key))
        key, x, group, first, many, y = (c[order] for c in (key, x, group, first, many, y))
        head = np.ones(len(x), bool)
        head[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        start = np.flatnonzero(head)
        y = w.place[first + (np.arange(len(x)) - np.repeat(start, np.diff(start, append=len(x)))) % many]
        once = np.flatnonzero(many == 1)
        once = once[np.lexsort((x[once], key[once]))]
        some = np.flatnonzero(many > 1)
        if len(once):
            span = int(x.max()) + 1
            at = np.searchsorted(key[once].astype(np.int64) * span + x[once], key[some].astype(np.int64) * span + x[some])
            left, right = once[np.maximum(at - 1, 0)], once[np.minimum(at, len(once) - 1)]
            far = lambda o: np.where(key[o] == key[some], np.abs(x[o] - x[some]), span)
            near = np.where(far(left) <= far(right), left, right)
            known = key[near] == key[some]
            some, near = some[known], near[known]
            target = x[some] - x[near] + y[near]
            wide = int(w.place.max()) + 2
            of = np.repeat(np.arange(len(w.hash)), np.diff(w.begin))
            k = np.searchsorted(of.astype(np.int64) * wide + w.place, group[some].astype(np.int64) * wide + np.clip(target, 0, wide - 1))
            below, above = np.clip(k - 1, first[some], first[some] + many[some] - 1), np.clip(k, first[some], first[some] + many[some] - 1)
            y[some] = np.where(np.abs(w.place[below] - target) <= np.abs(w.place[above] - target), w.place[below], w.place[above])
    return x, y


def consistent(a: Terms, x: np.ndarray, b: Terms, y: np.ndarray, size: int) -> np.ndarray:
    """Whether the slots of windows at terms x of a and y of b go one to one."""
    ok = np.ones(len(x), bool)
    for i in range(size):
        ok &= (a.value[x + i] == b.value[y + i]) | (a.kind[x + i] > 0) & (a.kind[x + i] == b.kind[y + i])
        for j in range(i):
            both = (a.kind[x + i] > 0) & (a.kind[x + j] == a.kind[x + i])
            ok &= ~both | ((a.value[x + i] == a.value[x + j]) == (b.value[y + i] == b.value[y + j]))
    return ok


def one_to_one(items: Items, t: Terms, windows: np.ndarray, z: int) -> bool:
    """Whether the slots of windows of z terms together go one to one, by terms or by runs of names."""
    x, y = ((c[:, None] + np.arange(z)).ravel() for c in (windows[:, 2] + windows[:, 3], windows[:, 3]))
    slot = (items.terms.kind[y] > 0) | (t.kind[x] > 0)
    x, y = x[slot], y[slot]
    for a, b in ((items.terms.value, t.value), (items.terms.run, t.run)):
        pairs = set(zip(a[y].tolist(), b[x].tolist(), strict=True))
        if len(pairs) == len({v for v, _ in pairs}) == len({v for _, v in pairs}):
            return True
    return False


def whole_alignment(items: Items, t: Terms, windows: np.ndarray) -> np.ndarray:
    """The windows of one term each of a chain's whole item, each on the alignment of the nearest window before it, where
    both texts have placeholders of one kind."""
    doc, item = windows[0, :2]
    y = np.arange(items.terms.first[item], items.terms.first[item + 1])
    shift = windows[np.maximum(np.searchsorted(windows[:, 3], y, "right") - 1, 0), 2]
    x = np.clip(y + shift, t.first[doc], t.first[doc + 1] - 1)
    held = (x == y + shift) & (items.terms.kind[y] > 0) & (items.terms.kind[y] == t.kind[x])
    return np.stack([np.full(len(y), doc), np.full(len(y), item), x - y, y], axis=1)[held]


def covered(y: np.ndarray, z: int) -> int:
    """Terms of an item in windows of z terms that begin at the ascending places y."""
    return int(np.minimum(np.diff(y), z).sum()) + z


def chains(windows: np.ndarray, z: int, least: float) -> list[np.ndarray]:
    """Of the windows of a text and an item, in order of alignment and item term: the chain of most terms up to each run
    of windows, and each alignment alone, if it covers at least so many terms, most first. A chain is windows of
    ascending terms of both, each window's alignment at most WINDOW terms off the one's before."""
    cut = np.flatnonzero((np.diff(windows[:, 2]) != 0) | (np.diff(windows[:, 3]) != 1)) + 1
    head, tail = np.append(0, cut), np.append(cut, len(windows)) - 1
    order = np.lexsort((windows[head, 2], windows[head, 3]))
    head, tail = head[order], tail[order]
    shift, y0, y1 = windows[head, 2], windows[head, 3], windows[tail, 3]
    best, back, begin = y1 - y0 + z, np.full(len(head), -1), y0.copy()
    for k in range(1, len(head)):
        near = np.flatnonzero(np.abs(shift[:k] - shift[k]) <= WINDOW)
        start = np.maximum(y0[k], np.maximum(y1[near], y1[near] + shift[near] - shift[k]) + 1)
        total = np.where(start <= y1[k], best[near] + np.minimum(y1[k] - y1[near], y1[k] - start + z), 0)
        if len(near) and total.max() > best[k]:
            m = int(total.argmax())
            best[k], back[k], begin[k] = total[m], near[m], start[m]
    out = []
    for k in np.argsort(-best, kind="stable").tolist():
        if best[k] < least:
            break
        parts = []
        while k >= 0:
            parts.append(windows[head[k] + begin[k] - y0[k] : tail[k] + 1])
            k = back[k]
        out.append(np.concatenate(parts[::-1]))
    out += [x for x in np.split(windows, np.flatnonzero(np.diff(windows[:, 2])) + 1) if covered(x[:, 3], z) >= least]
    return sorted(out, key=lambda x: -covered(x[:, 3], z))


def matches(items: Items, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each contaminated pair: text, item, share of the item's terms, whether slots differ."""
    t = terms(spelled(pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))))
    found = []
    for z, w in items.windows.items():
        h, at = (np.concatenate(c) for c in zip(*_variants(t, z), strict=True))
        lo = np.searchsorted(w.hash, h, "left")
        some = np.flatnonzero(w.hash[np.minimum(lo, len(w.hash) - 1)] == h)
        if not len(some):
            continue
        x, y = paired(w, h[some], at[some], t.doc[at[some]])
        x, y = np.unique(np.stack([x, y], axis=1), axis=0).T
        ok = consistent(t, x, items.terms, y, z)
        x, y = x[ok], y[ok]
        exact, firm = np.ones(len(x), bool), np.ones(len(x), bool)
        for i in range(z):
            same = t.value[x + i] == items.terms.value[y + i]
            exact &= same
            firm &= same | (t.sure[x + i] > 0) & (items.terms.sure[y + i] > 0)
        found.append(np.stack([t.doc[x], items.terms.doc[y], x - y, y, exact, firm], axis=1))
    none = np.zeros(0, np.int64)
    if not found:
        return none, none, np.zeros(0), none.astype(bool)
    m = np.concatenate(found)
    m = m[np.lexsort((m[:, 3], m[:, 2], m[:, 1], m[:, 0]))]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:, :2] != m[:-1, :2]).any(axis=1)
    head = np.flatnonzero(new)
    count = np.diff(head, append=len(m))
    told = []
    for k in np.flatnonzero(count * items.size[m[head, 1]] >= COVER * items.count[m[head, 1]]).tolist():
        own = m[head[k] : head[k] + count[k]]
        total, z = items.count[own[0, 1]], int(items.size[own[0, 1]])
        firm = own[own[:, 5] == 1]  # without renamed words that begin sentences, which need not be names
        every = [(c, False) for c in chains(own, z, COVER * total)]
        if 0 < len(firm) < len(own):
            every += [(c, True) for c in chains(firm, z, COVER * total)]
        for chain, partial in every:
            left_out = partial and not chain[:, 4].all()  # renamed, so the words left out must be renamed alike
            if one_to_one(items, t, chain, z) and not (left_out and not one_to_one(items, t, whole_alignment(items, t, chain), 1)):
                told.append((own[0, 0], own[0, 1], covered(chain[:, 3], z) / total, not chain[:, 4].all()))
                break
    if not told:
        return none, none, np.zeros(0), none.astype(bool)
    doc, item, share, other = zip(*told, strict=True)
    return np.array(doc), np.array(item), np.array(share, float), np.array(other, bool)


def _rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            for i, j in blocks(offsets, BLOCK_BYTES):
                doc, item, share, other = matches(items, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).take(pa.array(doc)), pa.array(items.ids[item]), pa.array(share), pa.array(other)], ["doc_id", "item_id", "coverage", "reparameterised"])

    return run


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of items (key, text): hashes of their windows, how often each, the windows' size and the item's number of terms."""
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            items = items_of(part.column(0).to_pylist(), part.column(1).to_pylist())
            for z, w in items.windows.items():
                n = np.diff(w.begin)
                yield pa.RecordBatch.from_arrays([pa.array(w.hash.view(np.int64)), pa.array(items.ids[w.item]), pa.array(n), pa.array(np.full(len(n), z)), pa.array(items.count[w.item])], ["hash", "item", "often", "size", "terms"])


def _document_windows(bits, sizes: list[int]):
    """Of documents (doc_id, form, text): different hashes of windows that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            data, offsets = texts_of(batch.column(2))
            for i, j in blocks(offsets, BLOCK_BYTES):
                t = terms(spelled(batch.column(2).slice(i, j - i).fill_null("")))
                for z in sizes:
                    h, at = (np.concatenate(c) for c in zip(*_variants(t, z), strict=True))
                    place = (h & _U(FILTER - 1)).astype(np.int64)
                    go = passes[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0
                    found = np.unique(np.stack([t.doc[at[go]], h[go].view(np.int64)], axis=1), axis=0)
                    row = pa.array(found[:, 0] + i)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(found[:, 1])], ["doc_id", "form", "hash"])

    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From documents (doc_id, form, text, items) with some of their candidates: the hits."""
    for batch in batches:
        row, ids, shares, others = [], [], [], []
        for k in range(len(batch)):
            met = batch.column(3)[k].as_py()
            items = items_of([x["item_id"] for x in met], [x["item_text"] for x in met])
            _, item, share, other = matches(items, *texts_of(pa.array([batch.column(2)[k].as_py()], pa.large_string())))
            row += [k] * len(item)
            ids += items.ids[item].tolist()
            shares += share.tolist()
            others += other.tolist()
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(ids, pa.int64()), pa.array(shares, pa.float64()), pa.array(others, pa.bool_())], ["doc_id", "form", "item_id", "coverage", "reparameterised"])


def _joined(base: DataFrame, items: DataFrame) -> DataFrame:
    """The hits of a benchmark of any size, by a join of window hashes."""
    spark = base.sparkSession
    items = kept(items.withColumn("item", F.xxhash64("item_id", "text")), "items")
    windows = kept(items.select("item", "text").mapInArrow(_item_windows, "hash long, item long, often long, size long, terms long"), "item-windows")
    place = F.col("hash").bitwiseAND(F.lit(FILTER - 1)) + 1
    parts = windows.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bits = np.zeros(FILTER // 8, np.uint8)
    for part, raw in parts.collect():  # FILTER bits at most
        begin = (part - 1) * 4096
        bits[begin : begin + 4096] = np.frombuffer(bytes(raw), np.uint8)[: len(bits) - begin]
    sizes = sorted(x[0] for x in windows.select("size").distinct().collect())  # WINDOW at most
    rows = base.withColumn("form", F.xxhash64("text"))
    held = rows.select("doc_id", "form", "text").mapInArrow(_document_windows(spark.sparkContext.broadcast(bits.tobytes()), sizes), "doc_id long, form long, hash long").distinct()
    enough = F.sum("often") * F.first("size") >= F.lit(COVER) * F.first("terms")
    pairs = held.join(windows, "hash").groupBy("doc_id", "form", "item").agg(enough.alias("enough")).where("enough").drop("enough")
    pairs = kept(pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item"), "candidates")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["form"] == b["form"])
    texts = rows.join(pairs.select("doc_id", "form").distinct(), same(rows, pairs), "left_semi").dropDuplicates(["doc_id", "form"])
    # a document's candidates are parted into lists, so its text is sent once for each ITEMS_TOGETHER of them
    place = F.row_number().over(Window.partitionBy("doc_id", "form").orderBy("item"))
    lists = pairs.withColumn("part", F.floor((place - 1) / ITEMS_TOGETHER)).groupBy("doc_id", "form", "part").agg(F.collect_list(F.struct("item_id", "item_text")).alias("items"))
    met = lists.alias("p").join(texts.alias("t"), F.expr("p.doc_id <=> t.doc_id AND p.form = t.form"))
    hits = met.selectExpr("p.doc_id", "p.form", "t.text", "p.items").mapInArrow(_verified, "doc_id long, form long, item_id long, coverage double, reparameterised boolean")
    out = rows.select("doc_id", "form").alias("r").join(hits.alias("h"), F.expr("r.doc_id <=> h.doc_id AND r.form = h.form"))
    return out.selectExpr("r.doc_id", "h.item_id", "h.coverage", "h.reparameterised")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per contaminated document and item: doc_id, item_id, coverage (share of terms), reparameterised."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if n > ITEMS or size > ITEM_BYTES:
        return _joined(base, items)
    rows = items.orderBy("item_id", "text").collect()  # ITEMS items and ITEM_BYTES bytes at most
    shared = docs.sparkSession.sparkContext.broadcast(items_of([r[0] for r in rows], [r[1] for r in rows]))
    return base.mapInArrow(_rows(shared), "doc_id long, item_id long, coverage double, reparameterised boolean")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    made = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return made.select("doc_id", "item_id", "coverage", "reparameterised", F.lit(True).alias("contaminated"))
