"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

A signature has K coordinates of b bits. Split into CHUNKS chunks, two signatures that differ in at most
2 * CHUNKS - 1 coordinates differ in at most one of some chunk (pigeonhole); every chunk is indexed with each of its
coordinates left out, which enumerates the one allowed error. So all pairs under the threshold share a key. The least
similarity is an argument; a lower one takes more chunks, so that a pair just at it is as rarely beyond the threshold.

Equal sets are one class first. Then, for each key, every class is compared with a first class and with the one before
it, in its slice of the classes, and the slices' first ones in the same way over all slices, so a key of very many
classes meets in one task only once a slice; links are confirmed on full sets and joined to components. Keys whose
classes are still in several components then give all pairs across these, which are compared too. So each candidate
pair is compared or already connected, and no key's rows meet in memory but in bounded blocks. The blocks of a key of
more than BLOCK_ROWS classes are made by set size first: similar sets differ in size by no more than the least
similarity allows, so only blocks of neighbouring sizes meet.

A pair is compared by odd sketches first: PARITY bits, each the parity of the shingles that fall on it. Two sketches
differ in no more bits than the sets differ in shingles, so a pair that differs in more than the least similarity
allows for its sizes is refuted without error. All others are confirmed on full sets. A pair that shares several keys
is told by the first of them alone.

Edge cases: null, empty and blank texts have no shingles and are their own component; so is a null doc_id (component
null, kept); rows that repeat a doc_id with the same text share one result; those that repeat one with another text have
each their own text's, and are one id in links, which each of its texts can confirm; an empty table gives an empty
table; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import discard, join_counted, kept
from .textbytes import MIX, Words, blocks, list_column, mixed, shingles, texts_of

WORDS, PERCENT = 5, 85
K, BITS, CHUNKS = 128, 8, 22
MOST_APART = 2 * CHUNKS - 1
#: The most of pairs just at the least similarity that may differ in more coordinates than their chunks allow.
MISSED = 1e-7
#: Bits of an odd sketch; bytes of coordinates, set size and sketch together.
PARITY = 2048
WIDE = K + 4 + PARITY // 8
BLOCK_BYTES, BLOCK_ROWS = 1 << 19, 2048
_draw = np.random.default_rng(20240229)
_A = _draw.integers(1, 1 << 32, K, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _draw.integers(0, 1 << 32, K, dtype=np.uint64).astype(np.uint32)
_COORDINATE = K - 1  # the bits of a key that name the coordinate left out; K is a power of two


def chunks_of(percent: int) -> int:
    """As many chunks as a least similarity needs, CHUNKS at least."""
    p = (1 - percent / 100) * (1 - 0.5**BITS)
    missed = lambda c: sum(comb(K, i) * p**i * (1 - p) ** (K - i) for i in range(2 * c, K + 1))
    return next(c for c in range(CHUNKS, K + 1) if missed(c) <= MISSED)


def _layout(chunks: int) -> tuple[np.ndarray, np.ndarray]:
    """Each coordinate's chunk, each chunk's first coordinate."""
    chunk = np.arange(K) * chunks // K
    return chunk, np.searchsorted(chunk, np.arange(chunks))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in ascending order, and how many."""
    h, doc = shingles(Words(data, offsets), WORDS)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(offsets) - 1)


def signatures(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """n x WIDE bytes: K coordinates (zeros for an empty set), the set's size, its odd sketch."""
    n = len(counts)
    out = np.zeros((n, WIDE), np.uint8)
    out[:, K : K + 4] = np.asarray(counts, np.uint32)[:, None].view(np.uint8)
    some = np.flatnonzero(counts)
    if len(some):
        start = (np.cumsum(counts) - counts)[some]
        x = (sets >> np.uint64(32)).astype(np.uint32)
        h = np.empty_like(x)
        for k in range(K):
            np.multiply(x, _A[k], out=h)
            np.add(h, _B[k], out=h)
            m = np.minimum.reduceat(h, start)
            out[some, k] = (m ^ (m >> np.uint32(13))) & np.uint32((1 << BITS) - 1)
        end = np.append(0, np.cumsum(counts))
        for i in range(0, n, 1024):
            j = min(i + 1024, n)
            bit = np.repeat(np.arange(j - i) * PARITY, counts[i:j]) + (sets[end[i] : end[j]] & np.uint64(PARITY - 1)).astype(np.int64)
            odd = np.bincount(bit, minlength=(j - i) * PARITY) & 1
            out[i:j, K + 4 :] = np.packbits(odd.astype(np.uint8).reshape(-1, PARITY), axis=1)
    return out


def possible(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Of rows of signatures, whether the sets can be similar enough: their sizes and the least they differ by."""
    one, two = (np.ascontiguousarray(z[:, K : K + 4]).view(np.uint32).ravel().astype(np.int64) for z in (x, y))
    apart = np.bitwise_count(x[:, K + 4 :] ^ y[:, K + 4 :]).sum(1, dtype=np.int64)
    return (apart * (100 + percent) <= (100 - percent) * (one + two)) & (100 * np.minimum(one, two) >= percent * np.maximum(one, two))


def keys_of(sig: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """n x K keys: for each coordinate its chunk without it; the lowest bits are the coordinate."""
    chunk, begin = _layout(chunks)
    at = np.arange(K, dtype=np.uint64)
    term = mixed((sig.astype(np.uint64) + np.uint64(1)) * MIX[0] + (at + np.uint64(1)) * MIX[1])
    total = np.add.reduceat(term, begin, axis=1)
    return (mixed(total[:, chunk] - term + at * MIX[3]) & ~np.uint64(_COORDINATE) | at).view(np.int64)


def first_key(x: np.ndarray, y: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """The coordinate of the first key that rows of coordinates under the threshold share."""
    of, begin = _layout(chunks)
    differ = x != y
    apart = np.add.reduceat(differ, begin, axis=1, dtype=np.int64)
    chunk = (apart <= 1).argmax(1)
    alone = (differ & (of == chunk[:, None])).argmax(1)
    return np.where(apart[np.arange(len(chunk)), chunk] == 0, begin[chunk], alone)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column(1))
        for i, j in blocks(offsets, BLOCK_BYTES):
            sets, counts = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            end = np.cumsum(counts)
            sums = [np.concatenate([[0], np.cumsum(x)]).astype(np.uint64) for x in (mixed(sets + MIX[1]), mixed(sets ^ MIX[3]))]
            one, two = ((s[end] - s[end - counts]).view(np.int64) for s in sums)
            sig = signatures(sets, counts)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(counts, pa.int64()), pa.array(one), pa.array(two), pa.array([x.tobytes() for x in sig], pa.binary())], ["doc_id", "n_shingles", "one", "two", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column(1))
        for i, j in blocks(offsets, BLOCK_BYTES):
            sets, counts = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), list_column(sets.view(np.int64), counts, pa.int64())], ["rep", "shingles"])


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = texts_of(column)
    return data.reshape(-1, WIDE)


def _firsts(key: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in order of key: whether a row is its key's first, that first class, the class before."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = rep[np.flatnonzero(new)][np.cumsum(new) - 1] if len(key) else rep
    return new, first, np.append(rep[:1], rep[:-1])


KEYS = ["key", "rep", "first", "before"]


def _keys(batches: Iterator[pa.RecordBatch], chunks: int) -> Iterator[pa.RecordBatch]:
    """Keys of classes (rep, sig), slice by slice: of each key its first class alone (first is null), and of the
    slice's others the first class and the one before."""
    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            key = keys_of(_matrix(part.column(1))[:, :K], chunks).ravel()
            rep = np.repeat(part.column(0).to_numpy(), K)
            order = np.lexsort((rep, key))
            key, rep = key[order], rep[order]
            new, first, before = _firsts(key, rep)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(rep), pa.array(first, mask=new), pa.array(before, mask=new)], KEYS)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of ``_keys``, those without a first class in order of key and class: of a key's, all but the first,
    with that first class and the one before. The other rows pass."""
    key0, first0, last0 = None, 0, 0
    for batch in batches:
        done = batch.column(2).is_valid()
        yield batch.filter(done)
        key, rep = (batch.column(k).filter(pc.invert(done)).to_numpy() for k in (0, 1))
        if not len(key):
            continue
        new, first, before = _firsts(key, rep)
        if key0 is not None and key[0] == key0:
            first, new[0], before[0] = np.where(key == key0, first0, first), False, last0
        other = ~new & (rep != before)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[other], rep[other], first[other], before[other])], KEYS)
        key0, first0, last0 = key[-1], first[-1], rep[-1]


def _across(batches: Iterator[pa.RecordBatch], percent: int = PERCENT, chunks: int = CHUNKS) -> Iterator[pa.RecordBatch]:
    """From rows (group, component, class, signature, side, coordinate) in order of group: pairs across components under the threshold, each told by its first key."""
    rest: pa.Table | None = None
    names = ["a", "b"]

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        comp, rep = t.column("component").to_numpy(), t.column("rep").to_numpy()
        wide, side, of = _matrix(t.column("sig").combine_chunks()), t.column("side").to_numpy(), t.column("coordinate").to_numpy()
        sig = np.ascontiguousarray(wide[:, :K].T)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        theirs = np.ascontiguousarray(sig[:, right])
        for at in range(0, len(left), 128):
            mine = left[at : at + 128]
            apart, differ = np.zeros((len(mine), len(right)), np.uint8), np.empty((len(mine), len(right)), bool)
            for k in range(K):
                np.not_equal(sig[k, mine][:, None], theirs[k], out=differ)
                np.add(apart, differ.view(np.uint8), out=apart)
            i, j = np.nonzero((apart <= 2 * chunks - 1) & (comp[mine][:, None] != comp[right]))
            i, j = mine[i], right[j]
            once = (side[i] != 2) | (rep[i] < rep[j])  # within a block each pair is met from both ends
            i, j = i[once], j[once]
            for k in range(0, len(i), 8192):
                a, b = i[k : k + 8192], j[k : k + 8192]
                told = possible(wide[a], wide[b], percent) & (first_key(wide[a, :K], wide[b, :K], chunks) == of[a])
                a, b = rep[a[told]], rep[b[told]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names)

    def whole(t: pa.Table) -> Iterator[pa.RecordBatch]:
        group = t.column("group").to_numpy()
        cut = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for i, j in zip(cut, cut[1:], strict=False):
            if j - i > 1:
                yield from pairs(t.slice(i, j - i))

    for batch in batches:
        t = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, t]) if rest is not None else t
        group = rest.column("group").to_numpy()
        if len(group) and group[0] != group[-1]:
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1
            yield from whole(rest.slice(0, cut))
            rest = rest.slice(cut)
    if rest is not None and len(rest):
        yield from whole(rest)


def _close(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of (a, b, signature of a, signature of b) that are not refuted."""
    for batch in batches:
        for at in range(0, len(batch), 8192):
            part = batch.slice(at, 8192)
            near = possible(_matrix(part.column(2)), _matrix(part.column(3)), percent)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(near)), part.column(1).filter(pa.array(near))], ["a", "b"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    near = pairs.where(F.col("a") != F.col("b")).join(left, "a").join(right, "b")
    near = near.where(100 * F.least(F.size("x"), F.size("y")) >= percent * F.greatest(F.size("x"), F.size("y")))
    return near.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b")


def _cells(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Classes of keys that stand in several components, dealt to groups in which all pairs are compared.

    side 2: pairs within a block; sides 0 and 1: of two blocks.
    """
    counted = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    keys = kept(counted.select("key", "n", (F.col("n") > BLOCK_ROWS).alias("hot")), "keys")
    # similar sets are in one band of sizes or in neighbouring ones; a trace wider than need be, for the logarithm's rounding
    band = F.floor(F.log("n_shingles") / (log(100 / percent) * (1 + 1e-9))).cast("int")
    met = join_counted(rows, keys, ["key"]).distinct().join(classes.select("rep", "sig", "n_shingles"), "rep")
    left_out = F.col("key").bitwiseAND(F.lit(_COORDINATE)).cast("int").alias("coordinate")
    met = kept(met.select("key", "component", "rep", "sig", left_out, "hot", band.alias("band")), "spread")
    few = met.where("not hot").select(F.xxhash64("key").alias("group"), "component", "rep", "sig", F.lit(2).alias("side"), "coordinate")
    bands = met.where("hot").groupBy("key", "band").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    bands = kept(bands, "bands")
    beside = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.struct((F.col("band") + k).alias("band"), F.struct(F.col("band").alias("band"), F.col("blocks").alias("blocks")).alias("other")))
    others = bands.select("key", F.inline(beside)).groupBy("key", "band").agg(F.collect_set("other").alias("others"))  # three at most
    many = join_counted(met.where("hot"), kept(bands.join(others, ["key", "band"]), "others"), ["key", "band"])
    many = many.withColumn("own", F.struct(F.col("band").alias("band"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")))
    every = F.flatten(F.transform("others", lambda o: F.transform(F.sequence(F.lit(0), o["blocks"] - 1), lambda k: F.struct(o["band"].alias("band"), k.alias("block")))))
    side = lambda o: F.when(o == F.col("own"), 2).when(F.col("own") < o, 0).otherwise(1).cast("int")
    one = F.transform(every, lambda o: F.struct(F.xxhash64("key", F.least("own", o), F.greatest("own", o)).alias("group"), side(o).alias("side")))
    dealt = many.select("component", "rep", "sig", "coordinate", F.inline(one)).select("group", "component", "rep", "sig", "side", "coordinate")
    return few.unionByName(dealt)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept; sets are similar that share percent of their union at least."""
    chunks = chunks_of(percent)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    told = kept(base.mapInArrow(_describe, "doc_id long, n_shingles long, one long, two long, sig binary"), "signatures")
    some = told.where("n_shingles > 0 and doc_id is not null")
    classes = kept(some.groupBy("one", "two").agg(F.min_by("sig", "doc_id").alias("sig"), F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n_shingles")), "classes")
    kind = "key long, rep long, first long, before long"
    keys = classes.select("rep", "sig").mapInArrow(lambda batches: _keys(batches, chunks), kind)
    met = keys.repartition(F.when(F.col("first").isNull(), F.col("key")).otherwise(F.xxhash64("key", "rep"))).sortWithinPartitions("key", "rep")
    shared = kept(met.mapInArrow(_shared, kind), "shared")
    first = shared.select(F.col("first").alias("a"), F.col("rep").alias("b")).union(shared.select(F.col("before").alias("a"), F.col("rep").alias("b"))).distinct()
    sig_of = lambda name: classes.select(F.col("rep").alias(name), F.col("sig").alias(f"sig_{name}"))
    tested = first.join(sig_of("a"), "a").join(sig_of("b"), "b").select("a", "b", "sig_a", "sig_b")
    pairs = kept(tested.mapInArrow(lambda batches: _close(batches, percent), "a long, b long"), "pairs")
    involved = shared.select(F.col("rep").alias("doc_id")).union(shared.select(F.col("first").alias("doc_id"))).distinct()
    # ids come with one text each as a rule; sorting by a text's hash too would hold whole texts
    of_ids = some.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("one", "two")])
    several = of_ids.where("min_one <> max_one or min_two <> max_two").limit(1).count() > 0
    texts = base.join(involved, "doc_id", "left_semi")
    texts = texts.dropDuplicates(["doc_id"]) if not several else texts.withColumn("form", F.xxhash64("text")).dropDuplicates(["doc_id", "form"]).drop("form")
    sets = kept(texts.mapInArrow(_sets, "rep long, shingles array<long>"), "sets")
    links = kept(confirm(pairs, sets, percent), "links")
    comp = components(links)
    # Keys with classes in several components
    rows = shared.select("key", "rep").union(shared.select("key", F.col("first").alias("rep")).distinct())
    rows = kept(rows.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component")), "rows")
    cells = _cells(rows, classes, percent)
    more = cells.repartition("group").sortWithinPartitions("group").mapInArrow(lambda batches: _across(batches, percent, chunks), "a long, b long")
    late = kept(confirm(more.join(pairs, ["a", "b"], "left_anti"), sets, percent), "late")
    if late.limit(1).count():
        discard(comp)
        comp = components(links.union(late))
    discard(shared, pairs, sets, links, late, rows)
    own = told.select("doc_id", "n_shingles", "one", "two").join(classes.select("one", "two", "rep"), ["one", "two"], "left")
    own = own.withColumn("rep", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).otherwise(F.col("doc_id")))
    out = own.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM w
), k AS (
  SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) ELSE 'none ' || doc_id END AS k, s FROM s
), c AS (
  SELECT k, min(doc_id) AS rep, any_value(s) AS s, any_value(n) AS n FROM k GROUP BY k
), x AS (
  SELECT rep, n, unnest(s) AS g FROM c
), e AS (
  SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (
  SELECT rep AS node, rep AS reach FROM c UNION SELECT r.node, both_ways.b FROM r JOIN both_ways ON r.reach = both_ways.a
), m AS (
  SELECT node, min(reach) AS component_id FROM r GROUP BY node
)
SELECT k.doc_id, k.n::BIGINT AS n_shingles, m.component_id, k.doc_id = m.component_id AS kept
FROM k JOIN c ON k.k = c.k JOIN m ON m.node = c.rep
"""
