"""The operators against brute force, round trips and held-out accuracy, with the odd rows that each docstring names."""

import collections
import hashlib
import math
import os
import random
import re
import time
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docquarry.llm import bpe, chat_format, decontaminate, language_id, line_dedup, near_dedup, ogg_media, quality, suffix_dedup, toxicity
from docquarry.llm.components import components

SF = "/root/testdata/sf0.001"
r = random.Random(5)
WORDS = [f"{a}{b}" for a in "ba ko ti re mu za lo ne".split() for b in "n s rt lk m d".split()]
line = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
PASSAGE = "\n".join(line(20) for _ in range(4))
BASE = line(120)
TEXTS = [
    None, "", " \n ", "one two", "a" * 700, "ab " * 400, line(300), BASE, BASE, BASE.upper(), BASE.replace(BASE.split()[60], "other", 1), BASE + " tail",
    PASSAGE, line(30) + "\n" + PASSAGE + "\n" + line(10), PASSAGE + "\n\n" + PASSAGE, "É è ü\x85 \x1c x", "<s>[INST] \\s </s>", line(4000), "one two", "Ünïcode 日本語 " * 30,
]
ROWS = [(i * 3 - 5, t) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame([(i, t, "x", "kept", "runs", "score", 1) for i, t in ROWS] + [(None, BASE, "x", "", "", "", 1)], "doc_id long, text string, rep string, kept string, runs string, score string, n_lines int")
    return made.unionByName(made.where("doc_id = 13")).repartition(3)


EMPTY = "doc_id long, text string"


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def test_suffix_dedup(spark, docs):
    got = by_id(suffix_dedup.remove_repeats(docs))
    seen = set()
    for i, t in sorted(ROWS):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        assert bytes(got[i]["kept"]) == bytes(c for c, g in zip(b, gone, strict=True) if not g), i
        assert sum(s["end"] - s["start"] for s in got[i]["spans"]) == sum(gone) and got[i]["n_bytes"] == len(b)
    assert bytes(got[None]["kept"]) == BASE.encode()
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], EMPTY)).count() == 0


def test_run_index_and_split_grams(monkeypatch):
    """Matching statistics against brute force, and a gram of more pieces than a block."""
    raw = [bytes(r.choice(b"ab") for _ in range(n)) for n in (60, 5, 120, 60)]
    index = suffix_dedup.RunIndex(np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw]))
    best = suffix_dedup.firsts(index, 6)
    text, at, first = [], [], {}
    for x in raw:
        at += [(x, p) for p in range(len(x) + 1)]
        text += [x]
    for p, (x, k) in enumerate(at):
        w = x[k : k + 6]
        assert best[p] == (first.setdefault(w, p) if len(w) == 6 else -1)
    assert index.runs < index.n
    monkeypatch.setattr(suffix_dedup, "MOST_PIECES", 2)
    shared = line(60)[:140].encode()
    texts = [line(20).encode() + shared + line(20).encode() for _ in range(9)]
    ids = list(range(9))
    scanned = [x for i in ids for x in suffix_dedup._scan(iter([pa.record_batch([pa.array([i]), pa.array([texts[i]], pa.binary())], ["doc_id", "text"])]))]
    rows = pa.Table.from_batches(scanned).sort_by("gram")
    told = pa.Table.from_batches(list(suffix_dedup._requests(iter(rows.to_batches(max_chunksize=7))))).to_pandas()
    assert told["hot"].any() and told["salt"].max() > 0
    marks = told[told["count"] < 0][["doc_id", "start", "count"]].values.tolist()
    asked = told[told["count"] > 0]
    cut = asked.assign(piece=[texts[d][s : s + n + 99] for d, s, n in asked[["doc_id", "start", "count"]].values])
    levels = 0
    while len(cut):
        levels += 1
        cut = cut.sort_values(["gram", "salt"])[["gram", "salt", "hot", "doc_id", "start", "piece"]]
        told = list(suffix_dedup._index(iter(pa.Table.from_pandas(cut, preserve_index=False).to_batches(max_chunksize=5)), levels))
        out = pa.Table.from_batches(told, told[0].schema if told else pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("count", pa.int32())])).to_pandas()
        marks += out[out["count"] < 0][["doc_id", "start", "count"]].values.tolist()
        cut = out[out["count"] > 0].assign(salt=0, hot=False)
    assert levels > 2
    got = {(int(d), int(s) + k) for d, s, n in marks for k in range(-int(n))}
    seen, want = set(), set()
    for d, t in enumerate(texts):
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                want.add((d, p))
            seen.add(t[p : p + 100])
    assert got == want


def test_near_dedup(spark, docs):
    got = by_id(near_dedup.near_duplicates(docs))
    sets = {}
    for i, t in ROWS:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    assert {i: (len(s), least[i], least[i] == i) for i, s in sets.items()} == {i: tuple(got[i])[1:] for i in sets}
    assert got[None]["kept"] and got[None]["component_id"] is None
    assert near_dedup.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_near_dedup_of_ids_with_several_texts(spark):
    """Each text of an id confirms its own links, whatever order the rows come in."""
    x, y = line(80), line(80)
    rows = [(5, x), (5, y), (5, y), (8, x + " more"), (9, y + " more"), (11, line(80))]
    for order in (rows, rows[::-1]):
        got = near_dedup.near_duplicates(spark.createDataFrame(order, EMPTY).repartition(3)).select("doc_id", "component_id", "kept").collect()
        assert sorted(map(tuple, got)) == [(5, 5, True)] * 3 + [(8, 5, False), (9, 5, False), (11, 11, True)]


def test_pigeonhole():
    """Signatures under the threshold share a key."""
    g = np.random.default_rng(3)
    for _ in range(200):
        a = g.integers(0, 256, near_dedup.K).astype(np.uint8)
        b = a.copy()
        at = g.choice(near_dedup.K, near_dedup.MOST_APART, replace=False)
        b[at] ^= g.integers(1, 256, len(at)).astype(np.uint8)
        ka, kb = near_dedup.keys_of(np.stack([a, b]))
        assert (ka == kb).any()
        k = near_dedup.first_key(a[None], b[None])[0]
        assert np.flatnonzero(ka == kb)[0] == k and (ka & 127 == np.arange(128)).all()


def test_pipeline_near_takes_similarities_from_80(spark):
    """Planted pairs in [0.80, 0.85) go in the pipeline and stay apart at op9's 85; pairs below 0.80 stay in both."""
    rows, want = [], set()
    for k, changed in enumerate((8, 9, 10, 11, 12, 13, 14) * 3):  # each change costs five shingles of about 500
        words = [f"{k}w{i}" for i in range(504)]
        other = [f"{x}x" if i % 36 == 20 and i // 36 < changed else x for i, x in enumerate(words)]
        rows += [(2 * k, " ".join(words), "en", "s", 1), (2 * k + 1, " ".join(other), "en", "s", 1)]
        if 100 * (500 - 5 * changed) >= 80 * (500 + 5 * changed):
            want.add(2 * k + 1)
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {x["doc_id"] for x in corpus_pipeline.near(spark, made, "").collect()} == {x[0] for x in rows} - want and len(want) == 12
    at_85 = {x["doc_id"] for x in near_dedup.near_duplicates(made).where("not kept").collect()}
    assert at_85 == {2 * k + 1 for k in range(21) if k % 7 == 0}
    chunks = near_dedup.chunks_of(80)
    assert near_dedup.chunks_of(85) == near_dedup.CHUNKS < chunks
    g = np.random.default_rng(6)
    a = g.integers(0, 256, (50, near_dedup.K)).astype(np.uint8)
    b = a.copy()
    for x in b:
        x[g.choice(near_dedup.K, 2 * chunks - 1, replace=False)] ^= 1
    same = near_dedup.keys_of(a, chunks) == near_dedup.keys_of(b, chunks)
    assert same.any(1).all() and (same.argmax(1) == near_dedup.first_key(a, b, chunks)).all()


def test_odd_sketches_refute_no_similar_pair():
    g = np.random.default_rng(4)
    for n in (1, 7, 100, 3000):
        for apart in (0, n // 20, n // 12, n // 4):
            shared = np.unique(g.integers(0, 1 << 63, n, dtype=np.uint64))
            a, b = (np.sort(np.concatenate([shared, g.integers(0, 1 << 63, apart, dtype=np.uint64)])) for _ in range(2))
            sig = near_dedup.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
            similar = 100 * len(shared) >= 85 * (len(shared) + 2 * apart)
            assert near_dedup.possible(sig[:1], sig[1:])[0] >= similar
            assert n < 100 or near_dedup.possible(sig[:1], sig[1:])[0] == similar


def test_each_pair_is_told_once():
    """All classes of the same keys: pairs across components, over blocks, once each."""
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(words[:i] + ["x"] + words[i + 1 :]) for i in range(0, 200, 9)]
    sets, counts = near_dedup.shingle_sets(*near_dedup.texts_of(pa.array(texts)))
    sig = near_dedup.signatures(sets, counts)
    keys = near_dedup.keys_of(sig[:, : near_dedup.K])
    rows = [(key, k, 0, k) for k in range(len(texts)) for key in keys[k].tolist()]
    cells = [(2 * key, k, k, sig[k].tobytes(), 2, key & 127) for key, k, _, _ in rows if k < 12] + [(2 * key + 1, k, k, sig[k].tobytes(), int(k >= 12), key & 127) for key, k, _, _ in rows]
    names = ["group", "component", "rep", "sig", "side", "coordinate"]
    t = pa.table({c: [x[i] for x in sorted(cells)] for i, c in enumerate(names) if c != "group"} | {"group": np.unique([x[0] for x in sorted(cells)], return_inverse=True)[1]}).select(names)
    got = [(a, b) for x in near_dedup._across(iter(t.to_batches(max_chunksize=97))) for a, b in zip(*[c.to_pylist() for c in x.columns], strict=True)]
    assert len(got) == len(set(got)) and set(got) >= {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if a < 12}


def test_components(spark):
    edges = [(a, a + 1) for a in range(1, 40)] + [(50, 60), (60, 55), (70, 50)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys((50, 55, 60, 70), 50)}


def test_line_dedup(spark, docs):
    out = line_dedup.remove_repeated_lines(docs)
    got = by_id(out)
    assert out.columns == docs.columns[:4] + docs.columns[5:6] + ["n_lines", "n_removed", "runs"] and got[7]["kept"] == "kept"
    seen, n = {}, lambda x: len(re.findall("[^\x20\x09-\x0d]+", x))
    for i, t in sorted(ROWS):
        lines = (t or "").split("\n")
        gone, units = set(), [k for k, x in enumerate(lines) if n(x)]
        for a in range(len(units)):
            b, total = a, 0
            while b < len(units) and total < line_dedup.WORDS:
                total += n(lines[units[b]])
                b += 1
            if total >= line_dedup.WORDS:
                w = tuple(lines[u] for u in units[a:b])
                if seen.setdefault(w, (i, units[a])) != (i, units[a]):
                    gone |= set(range(units[a], units[b - 1] + 1))
        want = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        assert got[i]["text"] == want and got[i]["n_removed"] == len(gone), i
    assert got[None]["text"] == BASE
    assert line_dedup.remove_repeated_lines(spark.createDataFrame([], EMPTY)).count() == 0


def test_line_dedup_takes_whole_runs(spark):
    """Maximal runs against brute force over all earlier places: short ends go, whichever place they repeat."""
    g = random.Random(9)
    long, short = [line(60) for _ in range(3)], [line(5) for _ in range(9)]
    texts = [[long[0], *short[:8]], [line(9), long[0], *short[:8], line(9)], [long[0], *short[:2], line(4), long[1]], [long[0], *short[:3], line(4)]]
    texts += [[x for _ in range(g.randint(1, 4)) for x in (g.sample(long, 1) + g.sample(short, g.randint(0, 8)) + [""] * g.randint(0, 1))] for _ in range(40)]
    got = by_id(line_dedup.remove_repeated_lines(spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(texts)], EMPTY)))
    assert got[1]["n_removed"] == 9
    units = [[(k, x) for k, x in enumerate(t) if x] for t in texts]
    for d, mine in enumerate(units):
        gone = set()
        for e, theirs in enumerate(units[: d + 1]):
            for a in range(len(mine)):
                for b in range(len(theirs) if e < d else a):
                    n = words = 0
                    while a + n < len(mine) and b + n < len(theirs) and mine[a + n][1] == theirs[b + n][1]:
                        words += len(mine[a + n][1].split())
                        n += 1
                    if words >= line_dedup.WORDS:
                        gone |= set(range(mine[a][0], mine[a + n - 1][0] + 1))
        assert got[d]["text"] == "\n".join(x for k, x in enumerate(texts[d]) if k not in gone), d


def test_bpe(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(bpe.default_path())
    rows = ROWS + [(900, "a<|endoftext|><|startoftext|>'S don't ΣΑΣ İ ŉ 1a2 aaaa!!"), (901, "x" * 5000)]
    got = by_id(bpe.encode_decode(spark.createDataFrame(rows, EMPTY), bpe.default_path()))
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert tuple(got[i])[1:] == (len(ids), " ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False)), i
    assert bpe.encode_decode(spark.createDataFrame([], EMPTY), bpe.default_path()).count() == 0


def test_ogg(spark, docs):
    crc = 0
    for b in b"123456789":  # bit by bit
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc >> 31 else crc << 1) & 0xFFFFFFFF
    assert ogg_media.checksum(b"123456789") == crc
    for i, row in by_id(ogg_media.store_as_ogg(docs)).items():
        raw = (dict(ROWS).get(i, BASE) or "").encode()
        assert row["n_bytes"] == len(raw) and bytes(row["payload"]) == raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
    packets = [bytes([k]) * n for k, n in enumerate((0, 255, 254, 70_000, 510, 3))]
    data = ogg_media.write({7: (packets, [1, 2, 3, 4, 5, 6]), 9: ([b"x"], [8])})
    back = list(ogg_media.read(data))
    assert [p.data for p in back if p.serial == 7] == packets and [p.granule for p in back if p.serial == 7][-1] == 6 and len({p.serial for p in back}) == 2
    for at in (0, 30, len(data) // 2, len(data) - 1):
        with pytest.raises(ogg_media.OggError):
            list(ogg_media.read(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]))
    assert ogg_media.store_as_ogg(spark.createDataFrame([], EMPTY)).count() == 0


def test_chat(spark):
    turns = [(1, 0, "user", "</s>[INST] \\s ok"), (1, 1, "assistant", "<a> fine \\b [/INST]"), (2, 0, "system", None), (2, 1, "assistant", "x"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, None, "t"), (None, 0, "o>d", "z"), (4, 0, "user", ""), (4, 1, "assistant", "")]
    made = chat_format.format_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {x["conv_id"]: x for x in made.withColumn("back", chat_format.read_back(F.col("formatted"))).collect()}
    assert [(t["role"], t["text"], t["loss"]) for t in got[1]["back"]] == [("user", "</s>[INST] \\s ok", False), ("assistant", "<a> fine \\b [/INST]", True)]
    assert [(t["role"], t["text"]) for t in got[3]["back"]] == [("", "t"), ("user", "a"), ("user", "a")] and [(t["role"], t["text"]) for t in got[None]["back"]] == [("o>d", "z")]
    assert {k: (x["valid"], x["bad_turn"]) for k, x in got.items()} == {1: (True, None), 2: (False, 1), 3: (False, 0), None: (False, 0), 4: (True, None)}
    assert got[1]["formatted"].count("[INST]") == 1 and len(got[4]["back"]) == 2
    assert "".join(s["text"] for s in got[1]["segments"]) == got[1]["formatted"]


def test_decontamination(spark, docs):
    items = [(1, "The train leaves Paris at 10 and reaches Lyon after 120 km, how fast does Paris 10 go in total per hour then"), (2, None), (3, "..."), (4, "five small words stand here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [(1, "Well. " + items[0][1] + " Indeed."), (2, "so the train leaves Rome at 7 and reaches Bari after 99 km, how fast does Rome 7 go in total per hour then"), (3, "so the train leaves Rome at 7 and reaches Bari after 99 km, how fast does Bari 8 go in total per hour then"), (4, line(400)), (5, "FIVE small, words stand here!"), (6, None), (None, items[0][1])]
    got = {(x["doc_id"], x["item_id"]): x["reparameterised"] for x in decontaminate.contaminated(spark.createDataFrame(texts, EMPTY), bench).collect()}
    assert got == {(1, 1): False, (2, 1): True, (5, 4): False, (None, 1): False}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 == decontaminate.contaminated(spark.createDataFrame([], EMPTY), bench).count()


def contaminations(items, texts):
    made = decontaminate.matches(decontaminate.items_of(list(range(len(items))), items), *decontaminate.texts_of(pa.array(texts)))
    return {(int(d), int(i)): bool(o) for d, i, _, o in zip(*made, strict=True)}


def test_shifted_contamination():
    """Words put in or left out in the middle, and a name of another word count, shift the rest of an item."""
    words = [f"term{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    item, name = " ".join(words), " ".join([*words[:19], "Smith", *words[20:]])
    texts = ["so " + " ".join([*words[:20], "more", *words[20:]]), " ".join(words[:20] + words[21:]), name.replace("Smith", "Mary Jones"), name.replace("Smith", "Jones")]
    apart = [" ".join(words[20:] + words[:20]), " ".join([*words[:20], *["far"] * 30, *words[20:]]), " ".join(words[:20])]
    assert contaminations([item], texts[:2] + apart) == {(0, 0): False, (1, 0): False}
    assert contaminations([name], texts[2:]) == {(0, 0): True, (1, 0): True}


def test_names_that_begin_sentences():
    """A capitalised word is a name or not whatever stands before it, in renamed and in verbatim items."""
    tom = "Tom has 5 apples and buys 3 more at the shop. Tom then gives 2 to his friend."
    anna = tom.replace("Tom", "Anna").replace("5", "7").replace("3", "4").replace("2", "6")
    short = "What is the capital city of France?"
    assert contaminations([tom, short], [anna, "he says: " + anna, anna.replace("Anna then", "Eve then"), f"he asked, {short}", f'"{short}"', f"so {short.lower()}"]) == {(0, 0): True, (1, 0): True, (3, 1): False, (4, 1): False, (5, 1): False}
    the = "The small dog eats 5 bones in the garden. The old cat sleeps on a chair in the warm kitchen all day long while the children of the house play a quiet game of cards."
    assert contaminations([the], [the.replace("The old", "An old"), "now " + the.lower()]) == {(0, 0): False, (1, 0): False}


def test_forward_sums_segmentations():
    trie = language_id.Trie([b"\x01a", b"\x01ab", b"b", b"bc", b"c", b"abc"])
    p = np.array([[0.1], [0.2], [0.3], [0.15], [0.05], [0.2]])[[trie.pieces.index(x) for x in trie.pieces]]
    p = np.concatenate([p, [[language_id.ALONE]]])
    words, start, size, which, doc = language_id.words_of(np.frombuffer(b"abc", np.uint8), np.array([0, 3]))
    got = language_id.forward(x := language_id.lattice(trie, words, start, size), p)[x.last][0, 0]

    def total(w):
        return 1.0 if not w else language_id.ALONE * total(w[1:]) + sum(p[k, 0] * total(w[len(x) :]) for k, x in enumerate(trie.pieces) if w.startswith(x))

    assert got == pytest.approx(total(b"\x01abc"))


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_learned(spark, docs):
    for f, label, least in ((language_id.op2_language_id, "lang", 0.95), (quality.op6_quality, "quality", 0.85), (toxicity.op7_toxicity, "toxic", 0.8)):
        d = "/root/testdata/sf0.01"
        made = f(spark, d).collect()
        table = spark.read.parquet(f"{d}/{'documents' if label == 'lang' else 'labels'}.parquet")
        want = {x["doc_id"]: x[label] for x in table.collect()}
        got = [(x["lang_pred"] if label == "lang" else x["predicted"]) == want[x["doc_id"]] for x in made if x["held_out"] and want.get(x["doc_id"]) is not None]
        assert len(made) == 1000 and all(0 <= x["score"] <= 1 for x in made) and sum(got) / len(got) >= least, label
    model = language_id.fit(["das und die", "the and of"], ["de", "en"], language_id.default_path())
    got = by_id(language_id.identify(docs, model))
    assert got[-5]["lang_pred"] == got[-2]["lang_pred"] == "und" and len(got) == len(ROWS) + 1
    assert by_id(quality.score_quality(docs, quality.fit([], [])))[-5]["score"] == 0.5
    assert by_id(toxicity.score_toxicity(docs, toxicity.fit([], [])))[1]["score"] == pytest.approx(0, abs=1e-9)
    none = spark.createDataFrame([], EMPTY)
    assert language_id.identify(none, model).count() + quality.score_quality(none, quality.fit([], [])).count() + toxicity.score_toxicity(none, toxicity.fit([], [])).count() == 0


def test_toxic_sentences():
    bad = ["The sky is blue. You utter moron! Fine day.", "Nice. What a moron.", "moron here", "A moron. Yes."] * 3
    good = ["The sky is blue. Fine day.", "Nice. What a day.", "here we are", "Yes. You utter it."] * 3
    model = toxicity.fit(bad + good, [1] * 12 + [0] * 12)
    s = toxicity.sentences(*toxicity.texts_of(pa.array([bad[0]])))
    z = model.logits(s)
    k = int(z.argmax())
    assert "moron" in bad[0][s.start[k] : s.end[k]] and model.documents(s, 1, z)[0] > 0.5


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {x["doc_id"]: x for x in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = docs.collect()
        assert {x["doc_id"] for x in after} <= set(before), name
        if k < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "near":
            assert collections.Counter(hashlib.md5(x["text"].encode()).digest() for x in after if x["text"].strip()).most_common(1)[0][1] == 1
    whole = corpus_pipeline.run(spark, SF)
    assert {tuple(x) for x in whole.collect()} == {tuple(x) for x in after}

def test_line_dedup_of_hot_lines_and_repeated_ids(spark, monkeypatch):
    """Hot fingerprints are broadcast; the same doc_id with other texts is another document."""
    from docquarry.llm import shared

    monkeypatch.setattr(shared, "HOT_ROWS", 3)
    head = [line(55) for _ in range(2)]
    texts = [(i, "\n".join([line(9), head[i % 2], line(7), f"x{i}"])) for i in range(20)] + [(3, head[0] + "\n" + line(60)), (None, head[0])]
    made = line_dedup.remove_repeated_lines(spark.createDataFrame(texts + texts[:2], EMPTY))
    got = collections.defaultdict(set)
    for x in made.collect():
        got[x["doc_id"]].add((x["n_removed"], x["text"]))
    for i in range(20):
        cut = next(t for n, t in got[i] if t.endswith(f"x{i}"))
        assert (head[i % 2] in cut) == (i < 2), i
    assert (1, texts[20][1].split("\n")[1]) in got[3] and (0, head[0]) in got[None]


def test_line_dedup_goes_through_fingerprints(spark):
    """Only selected lines go on, fewer than lines; each carries the lines of its windows, and matches end where lines differ."""
    texts = [(i, "\n".join(line(10) for _ in range(60))) for i in range(5)]
    shared = "\n".join(line(10) for _ in range(12))
    texts += [(10, line(10) + "\n" + shared + "\n" + line(10)), (11, shared + "\n" + line(10)), (12, line(10) + "\n" + shared)]
    docs = spark.createDataFrame(texts, EMPTY)
    got = line_dedup.fingerprints(docs).collect()
    assert len(got) < 0.75 * sum(len(t.split("\n")) for _, t in texts)
    for x in got:
        assert x["lines"][x["at"] - 1]["h"] == x["print"] and all(w["first"] <= x["at"] <= w["last"] for w in x["own"])
        for w in x["own"]:
            part = x["lines"][w["first"] - 1 : w["last"]]
            assert min(y["h"] for y in part) == x["print"] and sum(y["n"] for y in part) >= line_dedup.WORDS > sum(y["n"] for y in part[1:])
    runs = {x["doc_id"]: [tuple(y) for y in x["runs"]] for x in line_dedup.repeats(docs).collect()}
    assert runs == {11: [(0, 11)], 12: [(1, 12)]}


def test_line_dedup_extension_decides(spark, monkeypatch):
    """Places meet by their fingerprint alone, and the extension tells what repeats; what the earliest place lacks goes on to later ones."""
    g = random.Random(11)
    pool = {line(11) for _ in range(80)}
    hub, *others = [x[0] for x in spark.createDataFrame([(x,) for x in pool], "x string").orderBy(F.xxhash64("x")).collect()]
    choice = [[others[3 * k + g.choice((0, 0, 1, 2))] for k in range(10)] for _ in range(40)]
    texts = [(i, [*c[:5], hub, *c[5:]]) for i, c in enumerate(choice)]
    texts += [(40 + k, [hub, *others[:k], *others[40 + 6 * k : 46 + 6 * k]]) for k in range(5)]  # each parts a line later than the one before
    docs = spark.createDataFrame([(i, "\n".join(x)) for i, x in texts], EMPTY)
    places = line_dedup.fingerprints(docs, whole=False).where(F.col("print") == F.xxhash64(F.lit(hub)))
    assert line_dedup.pairs(places).count() == places.count() - 1 == len(texts) - 1
    rounds, real = [], line_dedup.extend
    monkeypatch.setattr(line_dedup, "extend", lambda met: rounds.append(1) or real(met))
    got, whole, seen = by_id(line_dedup.remove_repeated_lines(docs, whole=False)), by_id(line_dedup.remove_repeated_lines(docs)), set()
    assert len(rounds) > 4
    for i, x in texts:
        gone = set()
        for a in range(len(x) - 4):  # five lines have 55 words
            if tuple(x[a : a + 5]) in seen:
                gone |= set(range(a, a + 5))
            seen.add(tuple(x[a : a + 5]))
        for y in (got[i], whole[i]):
            assert y["text"] == "\n".join(z for k, z in enumerate(x) if k not in gone) and y["n_removed"] == len(gone), i
    copies = spark.createDataFrame([(i, "\n".join(others[:6])) for i in range(2)], EMPTY)
    assert by_id(line_dedup.remove_repeated_lines(copies, whole=False))[1]["n_removed"] == 6
    monkeypatch.setattr(line_dedup, "extend", lambda met: real(met).withColumn("last", F.col("first") - 1))
    assert by_id(line_dedup.remove_repeated_lines(copies, whole=False))[1]["n_removed"] == 0


def test_near_dedup_of_hot_keys(spark, monkeypatch):
    """Keys of more classes than a block: blocks by size, hot keys broadcast, against brute force."""
    from docquarry.llm import shared

    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(shared, "HOT_ROWS", 3)
    g = random.Random(8)
    words = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(40):  # prefixes of one text with a few words changed: many share keys, in several components
        own = words[: g.choice([60, 62, 75, 95, 118, 148])]
        for _ in range(g.randint(0, 3)):
            own[g.randrange(len(own))] = f"x{k}"
        texts.append((k, " ".join(own)))
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(texts, EMPTY)))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts)}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    assert {i: x["component_id"] for i, x in got.items()} == least and len(set(least.values())) > 3


def test_hashes_are_linear_in_nothing():
    """Words that a polynomial over the bytes cannot tell apart, and spans of all lengths."""
    from docquarry.llm.textbytes import span_hashes

    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    sets = [near_dedup.shingle_sets(*near_dedup.texts_of(pa.array([x])))[0].tolist() for x in (word, word.translate(str.maketrans("ab", "ba")))]
    assert sets[0] != sets[1]
    data = np.frombuffer(bytes(r.randrange(256) for _ in range(1000)) * 2, np.uint8)
    size = np.arange(1000)
    one, two = (span_hashes(data, np.full(1000, at), at + size) for at in (0, 1000))
    assert (one == two).all() and len(set(one.tolist())) == 1000
    eight = suffix_dedup.words8(data)
    size = np.arange(64, 900)
    one, two = (suffix_dedup.string_hashes(eight, np.full(len(size), at), at + size) for at in (0, 1000))
    assert (one == two).all() and len(set(one.tolist())) == len(size)


def test_bpe_index():
    """Any text as the library; time in proportion to a word's length; the index is what tells the merges."""
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(bpe.default_path())
    own = bpe.PairIndexBpe(bpe.default_path())
    g = random.Random(2)
    signs = "abcdeéßİŉſΣ日本'’ \n\t\x0b\x1c\x85  <|>0159.,!-_" + "etaoin" * 3
    texts = ["".join(g.choice(signs) for _ in range(g.randint(0, 60))) for _ in range(3000)]
    texts += ["don't we'll I'M 'S ' s", "<|endoftext|>a<|startoftext|>", "a<|endoftext|", "x" * 3000, "ab" * 2000 + "ba" * 2000, "e" * 4999 + " " + "e" * 5000]
    for x, (ids, decoded, n) in zip(texts, own.run(texts), strict=True):
        want = lib.encode(x, add_special_tokens=False).ids
        assert (ids, decoded, n) == (" ".join(map(str, want)), lib.decode(want, skip_special_tokens=False), len(want)), x
    word = "".join(g.choice("abcdefgh") for _ in range(160_000))
    times = []
    for parts in (1, 4):
        began = time.process_time()
        own.known.clear()
        for k in range(parts):
            own.run([word[k * 160_000 // parts : (k + 1) * 160_000 // parts]])
        times.append(time.process_time() - began)
    assert times[0] < 5 * times[1] + 0.2
    rank, index = own.occurrences([own.inner[b] for b in b"ababx"], [4])
    (r_,) = {rank[0]}
    assert index[r_] == [0, 2] and rank[4] == bpe.NONE


def test_chat_flags(spark):
    """The loss text is made of the segments whose flag is set, whatever stands in the formatted string."""
    turns = [(1, 0, "system", "s<"), (1, 1, "user", "u"), (1, 2, "assistant", "</s>a\\"), (1, 3, "user", "v"), (1, 4, "assistant", ""), (1, 5, "tool", "t"), (None, 0, "user", "x"), (None, 0, "user", "y")]
    made = chat_format.format_chat(spark.createDataFrame([(*t, "extra", 1.0) for t in turns], "conv_id long, turn long, role string, text string, segments string, rows double"))
    rows = made.select("conv_id", "n_turns", "segments", chat_format.loss_text(F.col("segments")).alias("loss")).collect()
    one = next(x for x in rows if x["conv_id"] == 1)
    flags = [s["loss"] for s in one["segments"]]
    assert flags == [False] * 1 + [False] * 6 + [False, True, False] + [False] * 3 + [False, True, False] + [False] * 3 and one["loss"] == "</s>a\\"
    assert [x["n_turns"] for x in rows if x["conv_id"] is None] == [1, 1]
    other = F.transform("segments", lambda s: F.struct(s["text"].alias("text"), (~s["loss"]).alias("loss")))
    assert made.where("conv_id = 1").select(chat_format.loss_text(other)).first()[0] != one["loss"]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chat(empty).count() == 0


def brute_contaminated(item, text):
    """The rule for texts without capitals: runs of equal templates on one alignment, slots one to one, share of the item's terms."""
    kinds = lambda x: ["#" if w[0].isdigit() else w for w in x]
    a, b = item.split(), text.split()
    ka, kb = kinds(a), kinds(b)
    z = len(a) if len(a) < decontaminate.SHORT else min(max(len(a) // 3, decontaminate.TEMPLATE), decontaminate.WINDOW)
    if len(a) < decontaminate.TEMPLATE:
        return any(b[x : x + len(a)] == a for x in range(len(b)))
    best = 0.0
    for shift in range(-len(a), len(b)):
        hit, pairs = set(), set()
        for y in range(len(a) - z + 1):
            x = y + shift
            if 0 <= x <= len(b) - z and ka[y : y + z] == kb[x : x + z] and (a[y : y + z] == b[x : x + z] or sum(w != "#" for w in ka[y : y + z]) >= decontaminate.LEAST_PLAIN):
                slots = {(a[y + i], b[x + i]) for i in range(z) if ka[y + i] == "#"}
                if len(slots) == len({v for v, _ in slots}) == len({v for _, v in slots}):
                    hit |= set(range(y, y + z))
                    pairs |= slots
        if len(pairs) == len({v for v, _ in pairs}) == len({v for _, v in pairs}):
            best = max(best, len(hit) / len(a))
    return best >= decontaminate.COVER


def test_decontamination_against_brute_force():
    g = random.Random(12)
    words = [f"word{chr(97 + k)}" for k in range(20)]
    term = lambda: str(g.randint(10, 99)) if g.random() < 0.25 else g.choice(words)
    items = [" ".join(term() for _ in range(g.choice([1, 3, 5, 7, 9, 12, 16, 24, 40]))) for _ in range(60)]
    texts = []
    for k in range(240):
        own = g.choice(items).split()
        if k % 3 == 1:  # new values, one to one or not
            values = {w: str(g.randint(100, 120)) for w in own if w[0].isdigit()}
            own = [values.get(w, w) for w in own]
        if k % 3 == 2:  # a part alone
            at = g.randrange(len(own))
            own = own[:at] + [g.choice(words) for _ in range(g.randint(0, 12))]
        texts.append(" ".join([g.choice(words) for _ in range(g.randint(0, 10))] + own + [g.choice(words) for _ in range(g.randint(0, 10))]))
    got = contaminations(items, texts)
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            assert (brute_contaminated(item, text) <= ((i, j) in got)) if len(item.split()) >= decontaminate.SHORT else brute_contaminated(item, text) == ((i, j) in got), (item, text)
    extra = [(i, j) for i, j in got if not brute_contaminated(items[j], texts[i])]
    assert len(extra) <= 0.05 * len(got)  # chains of several alignments, which the rule above has not


def test_reparameterised_variants():
    """Units that are joined or signs, words put in, short items, letters beyond ASCII, and tables of numbers."""
    train = "The train leaves Paris at 10 and reaches Lyon after 120 km, how fast does Paris 10 go in total per hour then"
    shop = "Tom pays 120 dollars for the new chair in the shop, how much is left of the money now"
    texts = [train.replace("120 km", "99km"), shop.replace("120 dollars", "$99"), shop.replace("120 dollars", "€7"), shop.replace("new chair", "new wooden chair"), shop.replace("Tom", "Émile").replace("120", "7"), "so, What is LOVE today?", "what is love"]
    assert contaminations([train, shop, "what is love today"], texts) == {(0, 0): True, (1, 1): True, (2, 1): True, (3, 1): False, (4, 1): True, (5, 2): False}
    number = lambda n, seed: " ".join(str(random.Random(seed * 100_000 + i).randint(0, 999)) for i in range(n))
    began = time.process_time()
    assert contaminations([number(2000, 1)], [number(16_000, 2), "so " + number(2000, 1)]) == {(1, 0): False}
    assert contaminations(["ha " * 2000], ["ha " * 16_000]) == {(0, 0): False}
    assert time.process_time() - began < 10


def test_decontamination_of_odd_rows(spark):
    """Clashing columns, repeated rows, repeated items, ties between items."""
    docs = spark.createDataFrame([(1, "we know that the capital of this land is a town", "a", 0.5, True)] * 2 + [(2, None, "b", 0.1, None)], "doc_id long, text string, item_id string, coverage double, reparameterised boolean")
    bench = spark.createDataFrame([(1, "the capital of this land is a town", 1), (2, "The capital of this land is a town", 2), (2, "The capital of this land is a town", 3), (None, "the capital of this land", 1)], "item_id long, text string, doc_id long")
    got = sorted((x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, bench).collect())
    assert got == [(1, 1), (1, 1), (1, 2), (1, 2)]


def test_long_words_sum_all_segmentations():
    """Words beyond every former bound, against a sum with exact fractions."""
    trie = language_id.Trie([b"\x01a", b"ab", b"b", b"abab", "é".encode(), "éa".encode()])
    g = np.random.default_rng(1)
    p = g.uniform(0.01, 0.2, (len(trie.pieces) + 1, 2))
    p[-1] = language_id.ALONE
    for word in ("ab" * 700, "éa" * 300 + "b", "z" * 900):
        data = word.encode()
        words, start, size, which, doc = language_id.words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        assert size.tolist() == [len(data) + 1]
        got = language_id.log_forward(language_id.lattice(trie, words, start, size), p, trie.depth)[0]
        text = b"\x01" + data
        for k in range(2):
            total, chances = [Fraction(1)] + [Fraction(0)] * len(text), [Fraction(float(x)) for x in p[:, k]]
            for i in range(len(text)):
                total[i + 1] += total[i] * chances[-1]
                for c, piece in zip(chances, trie.pieces, strict=False):
                    if text.startswith(piece, i):
                        total[i + len(piece)] += total[i] * c
            want = math.log(total[-1].numerator) - math.log(total[-1].denominator)
            assert got[k] == pytest.approx(want, rel=1e-9)
    parts = language_id.words_of(np.frombuffer(("日本" * 40).encode(), np.uint8), np.array([0, 240]), 64)
    assert all(bytes(parts[0][s + 1 : s + n]).decode() for s, n in zip(parts[1], parts[2], strict=True)) and (parts[2] <= 68).all()


def test_language_fit_and_ties(spark):
    """Expectation maximisation raises the likelihood; equal languages are a tie for the first name; very long texts."""
    texts = ["der die das und nicht ein mann"] * 3 + ["the and of not a man"] * 3
    model = [language_id.fit(texts, ["de"] * 3 + ["en"] * 3, language_id.default_path(), rounds) for rounds in (1, 2, 4)]
    data = language_id.texts_of(pa.array(texts, pa.large_string()))
    like = [sum(row[k] for row, k in zip(m.scores(*data), [0] * 3 + [1] * 3, strict=True)) for m in model]
    assert like[0] < like[1] < like[2]
    tie = language_id.fit(["same words"] * 2, ["b", "a"], language_id.default_path())
    rows = spark.createDataFrame([(1, "same words here", "x"), (1, "same words here", "x"), (2, "das " * 50_000, "x"), (3, "é" * 30_000, "x")], "doc_id long, text string, lang_pred string")
    assert {x["lang_pred"] for x in language_id.identify(rows, tie).collect()} == {"a"}
    assert by_id(language_id.identify(rows, model[-1]))[2]["lang_pred"] == "de"


def test_quality_gradient_and_attention():
    """Gradients against finite differences; a task that only attention solves."""
    g = np.random.default_rng(0)
    doc = np.repeat(np.arange(30), g.integers(1, 9, 30))
    x = g.normal(size=(len(doc), 5))
    y = (g.random(30) < 0.5).astype(float)
    net, weight = quality.start_from(x, 6, 4, 1), np.full(30, 1 / 30)
    _, grad = quality.gradients(net, x, doc, y, weight)
    for name, p in net.p.items():
        for _ in range(4):
            at = tuple(g.integers(0, n) for n in p.shape)
            old, loss = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = old + step
                loss.append(quality.gradients(net, x, doc, y, weight)[0])
            p[at] = old
            assert grad[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-5, abs=1e-6), name
    # of 20 passages one is marked, and it alone tells the label; the others tell the contrary of chance
    doc = np.repeat(np.arange(600), 20)
    y = g.integers(0, 2, 600).astype(float)
    x = g.normal(size=(len(doc), 3)) * [1, 0, 1]
    key = np.arange(600) * 20 + g.integers(0, 20, 600)
    x[key, 0], x[key, 1] = (2 * y - 1) * 0.5, 3
    net = quality.train(quality.start_from(x[:8000], 8, 6, 1), x[:8000], doc[:8000], y[:400], 400, 0.02, 1e-4)
    score, attention = net.scores(x[8000:], doc[8000:] - 400, 200)
    assert ((score >= 0.5) == (y[400:] == 1)).mean() > 0.95 and attention[key[400:] - 8000].mean() > 0.5
    mean = np.add.reduceat(x[8000:, 0], np.arange(0, 4000, 20)) / 20
    assert ((mean > 0) == (y[400:] == 1)).mean() < 0.75
    assert ((attention.reshape(200, 20).sum(1) - 1) ** 2).max() < 1e-6


def test_quality_of_odd_texts(spark, docs):
    model = quality.fit(["one two three. " * 9, "x#x $$ 1 " * 9] * 6, [1, 0] * 6)
    rows = spark.createDataFrame([(1, "one two three. " * 20_000, 9.0), (1, "one two three. " * 20_000, 9.0), (2, "one two three. " * 9, 1.0), (None, None, 0.0)], "doc_id long, text string, score double")
    got = quality.score_quality(rows, model).collect()
    assert len(got) == 4 and {x["n_passages"] for x in got if x["doc_id"] == 1} == {1250} and all(x["score"] > 0.5 for x in got if x["doc_id"])
    assert quality.score_quality(docs, model).count() == docs.count()


def test_noisy_or():
    """Document scores against a product over sentences; gradients against finite differences."""
    g = np.random.default_rng(4)
    z, doc = g.normal(size=12) * 3, np.sort(g.integers(0, 4, 12))
    s = toxicity.Sentences(doc, doc, doc, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    got = toxicity.NoisyOr(np.zeros(0, np.uint64), np.zeros(0), 0.0).documents(s, 4, z)
    for d in range(4):
        assert got[d] == pytest.approx(1 - np.prod([1 - 1 / (1 + math.exp(-v)) for v in z[doc == d]]))
    sample = toxicity.Sample(g.integers(0, 6, 40), np.sort(g.integers(0, 15, 40)), np.sort(g.integers(0, 8, 15)), g.integers(0, 2, 8).astype(float), g.uniform(1, 3, 8))
    x = g.normal(size=7)
    _, grad = toxicity.gradient(x, sample)
    for k in range(7):
        step = np.eye(7)[k] * 1e-6
        assert grad[k] == pytest.approx((toxicity.gradient(x + step, sample)[0] - toxicity.gradient(x - step, sample)[0]) / 2e-6, abs=1e-6)


def test_toxicity_of_odd_texts(spark):
    """Words of one document are fitted too; very long texts, repeated rows, clashing columns."""
    model = toxicity.fit(["you moron", "a fine day", "once dolt here", "fine"] * 2 + ["rare nitwit"], [1, 0, 1, 0] * 2 + [1])
    hashes = toxicity.sentences(*toxicity.texts_of(pa.array(["nitwit fine"]))).word
    assert np.isin(hashes, model.words).all()
    rows = spark.createDataFrame([(1, "a fine day. " * 20_000 + "you moron.", 0.0, "s"), (1, "fine", 0.0, "s"), (1, "fine", 0.0, "s"), (2, "!!!", None, None)], "doc_id long, text string, score double, sentences string")
    got = toxicity.score_toxicity(rows, model).collect()
    assert len(got) == 4 and max(x["score"] for x in got) >= 0.5
    hit = next(x for x in got if x["score"] >= 0.5)["sentences"]
    assert hit[-1]["start"] >= 12 * 20_000 - 2 and len({x["score"] for x in got if x["doc_id"] == 1}) == 2


def test_ogg_times_and_bad_streams(spark):
    """Each packet's times from granule positions; a bad stream is an error of its row."""
    packets = [bytes([k]) * n for k, n in enumerate((10, 300, 70_000, 0, 5))]
    ends = [10, 310, 70_310, 70_310, 70_315]
    media = ogg_media.write({4: (packets, ends), 9: ([b"xy", b"z"], [2, 3])})
    times = [(t.packet.serial, t.packet.index, t.start, t.end) for t in ogg_media.timed(ogg_media.read(media))]
    assert sorted(times) == [(4, k, e - len(p), e) for k, (p, e) in enumerate(zip(packets, ends, strict=True))] + [(9, 0, 0, 2), (9, 1, 2, 3)]
    rows = spark.createDataFrame([(1, bytearray(media)), (2, bytearray(media[:100] + b"!" + media[101:])), (3, None), (4, bytearray(media[:-3])), (None, bytearray(b"no stream"))], "doc_id long, media binary")
    got = by_id(ogg_media.read_ogg(rows))
    assert len(got[1]["packets"]) == 7 and got[1]["error"] is None and got[3]["packets"] == []
    assert all(got[k]["packets"] is None and got[k]["error"] for k in (2, 4, None))
    payload, feature = ogg_media.load(ogg_media.store(b"ab" * 96))
    assert payload == b"ab" * 96 and feature == "ogg;streams=1;pages=1;packets=1;samples=192;ms=24;mean=97500;crossings=191"


def test_stages_of_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, an extra column, an empty table; emptied documents go."""
    passage = "\n".join(line(25) for _ in range(4))
    rows = [(1, passage, "en", "s", 5), (2, passage, None, None, None), (3, line(30) + "\n" + passage, "en", "s", 1), (4, None, "en", "s", 0), (5, "", "en", "s", 0), (None, passage, "en", "s", 1), (6, line(20_000), "en", "s", 1), (7, " \n ", "en", "s", 1)]
    docs = spark.createDataFrame([(*x, "extra") for x in rows + rows[:1]], "doc_id long, text string, lang string, source string, n_chars long, kept string")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, rows[0][1].split("\n")[0]), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        kept[name] = sorted((x["doc_id"] for x in out.collect()), key=str)
        assert name == "encoding" or out.columns == list(corpus_pipeline.COLUMNS)
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert kept["lines"] == [1, 1, 3, 4, 5, 6, 7, None] and kept["near"] == [1, 1, 3, 4, 5, 6, 7, None] and kept["decontamination"] == [4, 5, 6, 7, None]  # a row without an id is in no decision
    assert len(kept["encoding"]) == 9 and set(kept["quality"]) >= {None}


def test_large_benchmarks_are_joined_by_hash(spark, monkeypatch):
    """The same hits as with a broadcast benchmark, for repeated rows, null ids and items of all sizes too."""
    g = random.Random(21)
    term = lambda: str(g.randint(10, 99)) if g.random() < 0.2 else g.choice(WORDS)
    items = [(k % 50, " ".join(term() for _ in range(g.choice([1, 2, 4, 6, 11, 20, 45])))) for k in range(60)] + [(99, None), (98, "")]
    texts = [(g.choice([None, k, k // 2]), " ".join([line(12), re.sub("[0-9]+", lambda m: str(int(m[0]) + 100), x) if k % 2 else x, line(g.randint(1, 9))])) for k, (_, x) in enumerate(items * 2) if x]
    docs = spark.createDataFrame(texts + texts[:5] + [(1, None), (2, ""), (3, line(900))], EMPTY).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    told = lambda: sorted((str(tuple(x)) for x in decontaminate.contaminated(docs, bench).collect()))
    want = told()
    monkeypatch.setattr(decontaminate, "ITEMS", 3)
    assert told() == want and len(want) > 100
    everything = spark.createDataFrame([(7, " . ".join(x for _, x in items if x))], EMPTY)  # one document of all items
    monkeypatch.setattr(decontaminate, "ITEMS_TOGETHER", 2)  # so its candidates are parted into many lists
    whole = lambda: sorted(str(tuple(x)) for x in decontaminate.contaminated(everything, bench).collect())
    parted = whole()
    assert told() == want
    monkeypatch.setattr(decontaminate, "ITEMS", 20_000)
    assert parted == whole() and len(parted) > 30
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
