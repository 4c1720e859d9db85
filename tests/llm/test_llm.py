"""The text operators on small fixtures, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate, combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terraframe.llm import chat, decontaminate, exact, license, packing, repeats, shard, simhash, tokens, toxicity, wavelet

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
# Extra columns carry names that the operators use inside.
SCHEMA = "doc_id long, text string, id string, h long, len int, word string, row string"


def texts():
    rng = random.Random(7)
    vocabulary = [rng.choice(["Ab", "cé", "dé", "ü", "the", "MIT", "License."]) + str(i % 60) for i in range(80)]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, base = draw(70), draw(120)
    out = [None, "", " \n\t ", "one", "ONE", "one two", "Released under the MIT License.", "the Apache  license, MIT License mit-LICENSE",
           "GNU General Public License, version 3", base, base.upper(), base, base + " end", draw(5000)]
    out += [f"{draw(rng.randint(0, 30))} {shared} {draw(rng.randint(0, 30))}" for _ in range(12)]
    return out + [draw(rng.randint(1, 90)) for _ in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, 2, "w", "r") for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[9], (None, "one", *rows[0][2:]), (None, None, *rows[0][2:])], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def spaced(text, lower=True):
    return ((lowered(text) if lower else text or "").encode().split())


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_licenses(docs, empty):
    import re

    got = license.scan_licenses(docs).collect()
    want = []
    for i, text in pairs(docs):
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
        at = [(j, label) for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
              for j in range(len(words)) if words[j : j + len(phrase.split())] == phrase.split()]
        places = sorted(j for j, _ in at)
        want.append((i, len(words), len(at), places[0] if at else None, places[-1] if at else None, ",".join(sorted({x for _, x in at}))))
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(want)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} for r in got)
    assert any("gpl-3.0" in r.labels for r in got) or not any("version 3" in (t or "") for _, t in pairs(docs))
    assert license.scan_licenses(empty).collect() == []


def fingerprint(text):
    words = spaced(text)
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    h = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, empty):
    rows = pairs(docs)
    prints = {t: fingerprint(t) for _, t in rows}
    root = {p: p for p in prints.values()}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, t in rows:
        if i is not None:
            least[find(prints[t])].append(i)
    want = Counter((i, f"{prints[t]:016x}", min(least[find(prints[t])], default=None)) for i, t in rows)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("most", [1024, 3])
def test_links_are_complete(spark, most):
    rng = random.Random(1)
    near = {rng.getrandbits(64) for _ in range(20)}
    for p in list(near)[:5]:
        near |= {p ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1 for _ in range(60)}
    near = [p - (1 << 64) if p >> 63 else p for p in near]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(near) for b in near[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    found = simhash.links(spark.createDataFrame([(p,) for p in near], "print long"), most=most)
    assert {tuple(r) for r in found.collect()} == want


@pytest.mark.parametrize(("path", "kept"), [(BYTES, True), (WORDS, False)])
def test_encoder_equals_the_library(path, kept):
    rng, whole = random.Random(2), Tokenizer.from_file(path)
    alphabet = "abé1. \n\t'sÅ\u0301<|Σ\x1c\u3000,"
    cases = ["a  b", "\n\nfoo", " x", "x ", "<|endoftext|> hi", "It's 12 o'clock,\tnow", "  ", "don't,stop 'tis"]
    encoder = tokens.Encoder(path, kept)
    cases += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(2000)] + ["a | b", "|", "x|y", "｜", "", None]
    want = [whole.encode(text or "", add_special_tokens=False).ids for text in cases]
    for text, ids in zip(cases, want, strict=True):
        assert list(np.frombuffer(encoder.of(text), "<u4")) == ids, text
    together = tokens.Encoder(path, kept).each(cases)
    assert [list(np.frombuffer(found, "<u4")) for found in together] == want


def test_words_are_asked_once_of_the_model_alone(monkeypatch):
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = ["The the THE tHe", "Straße STRASSE Évian ÉVIAN évian", "İstanbul Iſ ŉ ΑΣ ΑΣ. It'S DON'T", *letters, " ".join(letters), "".join(letters)]
    whole, encoder, asked, ask = Tokenizer.from_file(WORDS), tokens.Encoder(WORDS, False), [], tokens.Encoder._ids
    monkeypatch.setattr(tokens.Encoder, "_ids", lambda self, text: asked.extend(text.split()) or ask(self, text))
    want = [whole.encode(text, add_special_tokens=False).ids for text in texts]
    assert [list(np.frombuffer(found, "<u4")) for found in encoder.each(texts)] == want
    assert "İstanbul" in asked and not {"The", "the", "THE", "Straße", "Évian", "évian", "é"} & set(asked)
    assert encoder._known["The"] is encoder._known["the"] is encoder._known["tHe"] and encoder._known["É"] is encoder._known["é"]
    assert list(np.frombuffer(encoder.of("tHE ÉVIAn"), "<u4")) == whole.encode("the évian").ids  # known by another spelling


def test_wavelet_matrix():
    ids = np.random.default_rng(3).integers(0, 900, 3000).astype(np.uint16)
    ids[::7] = 5
    held = wavelet.WaveletShard(wavelet.pack(ids, [4, None], [1000, 2000]))
    at = np.flatnonzero(ids == 5)
    assert (held.decode() == ids).all() and held.doc_ids.to_pylist() == [4, None]
    assert all(held.access(i) == ids[i] for i in range(0, 3000, 53))
    assert held.count(5) == len(at) and held.rank(5, 1500) == (at < 1500).sum() and held.count(1 << 20) == 0
    assert [held.select(5, j) for j in range(0, len(at), 40)] == at[::40].tolist() and held.select(5, len(at)) == -1


def test_planes_are_parted_in_strides(monkeypatch):
    monkeypatch.setattr(wavelet, "_STRIDE", 100)
    for top, size in ((900, 3000), (1 << 17, 1234), (1, 100), (2, 1)):
        ids = np.random.default_rng(top).integers(0, top, size).astype(np.uint16 if top < 1 << 16 else np.uint32)
        held = wavelet.WaveletShard(wavelet.pack(ids, [1], [size]))
        assert (held.decode() == ids).all() and held.decode().dtype == ids.dtype
        assert all(held.access(i) == ids[i] for i in range(0, size, 97))


def test_distinct_pieces_are_learnt_once_per_chunk(monkeypatch):
    texts = ["foo,bar,baz foo,\nbaz", "foo bar\0 foo", None, "a  foo", "foo <|endoftext|>", "", "x\u3000y foo", "x\n\nfoo", "don't, foo's.", "(foo) é,foo 3.5,foo"]
    whole, encoder, asked, learn = Tokenizer.from_file(BYTES), tokens.Encoder(BYTES, True), [], tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, new: asked.append(new) or learn(self, new))
    want = [whole.encode(text or "", add_special_tokens=False).ids for text in texts]
    for _ in range(2):
        assert [list(np.frombuffer(found, "<u4")) for found in encoder.each(texts)] == want
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) and {"foo", " foo", ",bar", ",baz", ","} <= set(asked[0])
    assert list(encoder.each([])) == []


def test_shard_tasks_give_memory_back_before_texts_and_planes(docs, tmp_path, monkeypatch):
    from types import SimpleNamespace

    taken, given = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: taken.append(f) or self)
    monkeypatch.setattr(wavelet, "settle", lambda frame, purpose: frame)
    monkeypatch.setattr(wavelet, "give_back", lambda: given.append("back"))
    monkeypatch.setattr(wavelet, "pack", lambda *held, pack=wavelet.pack: given.append("planes") or pack(*held))
    monkeypatch.setattr(wavelet, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3, taskAttemptId=lambda: 5)))
    wavelet.write_shards(docs, str(tmp_path), BYTES)
    rows = list(taken[0](iter([pa.RecordBatch.from_arrays([pa.array([7]), pa.array(["a b"])], ["id", "text"])])))
    assert given == ["back", "back", "planes"] and [r.column(3).to_pylist() for r in rows] == [[1]]
    assert wavelet.WaveletShard((tmp_path / "shard-0000003.wvm").read_bytes()).lengths.tolist() == [3]


def test_token_files(spark, docs, empty):
    own = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    whole, start, want = Tokenizer.from_file(BYTES), 0, set()
    for i, t in sorted(pairs(own)):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.add((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r) for r in wavelet.token_files(own, BYTES, shard_bytes=2000).collect()} == want
    assert wavelet.token_files(docs, BYTES).count() == docs.count()
    assert wavelet.token_files(empty, BYTES).collect() == []


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_exact_dedup(docs, empty, limit):
    groups = defaultdict(list)
    for i, t in pairs(docs):
        groups[lowered(t)].append(i)
    want = Counter()
    for text, ids in groups.items():
        sha, top = hashlib.sha256(text.encode()).hexdigest(), max(ids, key=lambda i: (i is not None, i or 0))
        kept = True
        for i in sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True):
            want[(i, top, len(ids), kept and i == top, sha)] += 1
            kept = False
    got = exact.exact_dedup(docs, prefix=4, broadcast_bytes=limit).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want
    left = exact.drop_duplicates(docs, prefix=4, broadcast_bytes=limit)
    assert left.columns == docs.columns and Counter(lowered(t) for _, t in pairs(left)) == Counter(groups.keys())
    assert exact.exact_dedup(empty).collect() == []


def test_minimax_cuts():
    rng = random.Random(4)
    for _ in range(150):
        sizes, n = [rng.randint(1, 9) for _ in range(rng.randint(0, 8))], rng.randint(1, 4)
        prefix = [0, *accumulate(sizes)]
        parts = lambda cuts: [sum(sizes[a:b]) for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True)]
        best = min((max(p), -min(p)) for p in map(parts, combinations_with_replacement(range(len(sizes) + 1), n - 1)))
        found = parts(shard.even_cuts(prefix, shard.capacity(prefix, n), n))
        assert (max(found), -min(found)) == best


def test_sharding(docs, empty):
    rows = shard.minimax_shards(docs, 5, cells=3).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs(docs))
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        shards[(r.size, r.text_crc32)].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(5))
    assert all(len(s) == 1 for s in shards.values())
    assert shard.minimax_shards(empty, 5).collect() == []


@pytest.mark.parametrize(("group", "limit"), [(100_000, 64 << 20), (3, 0)])
def test_substring_dedup(docs, empty, group, limit):
    rows = pairs(docs)
    first = {}
    for i, t in rows:
        words = spaced(t, lower=False)
        for a in range(len(words) - 49) if i is not None else ():
            key = tuple(words[a : a + 50])
            first[key] = min(first.get(key, i), i)
    want = Counter()
    for i, t in rows:
        words = spaced(t, lower=False)
        gone = {x for a in range(len(words) - 49) if i is not None and first[tuple(words[a : a + 50])] < i for x in range(a, a + 50)}
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        want[(i, len(words), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    got = repeats.remove_repeats(docs, group=group, broadcast_bytes=limit).collect()
    assert sum(r.n_removed for r in got) > 500
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert all(sum(s.stop - s.first for s in r.spans) == r.n_removed for r in got)
    assert repeats.remove_repeats(empty).collect() == []


def test_best_fill_is_the_closest_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts, room = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}, rng.randint(0, 40)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        used = packing.best_fill(counts, room)
        assert all(n <= counts[x] for x, n in used.items())
        assert sum(x * n for x, n in used.items()) == max(s for s in sums if s <= room)


def test_packing(docs, empty):
    whole, ids = Tokenizer.from_file(WORDS), Counter()
    for i, t in pairs(docs):
        ids[(i, tuple(whole.encode(t or "", add_special_tokens=False).ids) + (1,))] += 1
    rows = packing.pack_documents(docs, WORDS, sequence=64, cells=3).collect()
    assert sum(r.length for r in rows) == sum(len(t) * n for (_, t), n in ids.items())
    by_id = {i: np.array(t, "<u4") for (i, t) in ids if i is not None}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            own = by_id[r.doc_id]
            assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(own)
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [0, *accumulate(n for _, n in held)][:-1] and sum(held[-1]) <= 64
    assert packing.pack_documents(empty, WORDS).collect() == []


def test_toxicity(spark, empty):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    docs = docs.union(spark.createDataFrame([(-5, None, "en", "s", 0), (None, "", "en", "s", 0)], docs.schema))
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    known = {r.doc_id: r.toxic for r in labels.collect()}
    seen = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    right = Counter(seen)
    assert right[(1, 1)] >= 0.5 * (right[(1, 1)] + right[(1, 0)]) and right[(0, 1)] <= 0.01 * (right[(0, 0)] + right[(0, 1)])
    scores = {y: np.array([r.score for r in rows if r.held_out and known.get(r.doc_id) == y]) for y in (0, 1)}
    above = (scores[1][:, None] > scores[0]).mean() + (scores[1][:, None] == scores[0]).mean() / 2
    assert above > 0.93  # of pairs with one toxic text, in the right order
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_toxicity(docs.limit(5), nothing).collect()} == {0}
    assert toxicity.score_toxicity(empty, nothing).collect() == []


@pytest.mark.parametrize("flush", [3, 40, 1 << 20])
def test_gram_counts_do_not_depend_on_the_flush(flush):
    rng = random.Random(4)
    rows = [(" ".join(rng.choice("abcde") * rng.randint(1, 9) for _ in range(20)), rng.randrange(4)) for _ in range(60)]
    batches = [pa.RecordBatch.from_pydict({"text": [t for t, _ in part], "kind": [k for _, k in part]}) for part in (rows[:25], rows[25:])]
    want = Counter((g, k) for t, k in rows for w in t.split() for g in toxicity._grams(w))
    got = Counter()
    for b in toxicity._count(iter(batches), flush):
        for r in b.to_pylist():
            got[r["gram"], r["kind"]] += r["n"]
    assert got == want


def toxicity_by_hand(rows, grams):
    """Differences by the definition of the model, from dictionaries of all grams."""
    order, less = toxicity.ORDER, toxicity.DISCOUNT
    level, lower = {g: sum(n) for g, n in grams.items()}, None
    levels = [level]
    for _ in range(order - 1):
        level = Counter(g[1:] for g in level)
        levels.append(level)
    for level in reversed(levels):
        of, kinds = Counter(), Counter(g[:-1] for g in level)
        for g, n in level.items():
            of[g[:-1]] += n
        below = lower
        lower = {
            g: (max(n - less, 0) + less * kinds[g[:-1]] * (below[g[1:]] if below else 1 / (kinds[g[:-1]] + 1))) / of[g[:-1]]
            for g, n in level.items()
        }
    of, kinds = Counter(), Counter()
    for g, n in grams.items():
        for i in (0, 1):
            of[g[:-1], i] += n[i]
            kinds[g[:-1], i] += n[i] > 0

    def ratio(g):
        p, c = [], g[:-1]
        for i in (0, 1):
            free = toxicity.STRENGTH + less * kinds[c, i]
            own = max(grams[g][i] - less, 0) + free * lower[g] if g in grams else free
            p.append(own / (toxicity.STRENGTH + of[c, i]))
        return np.log(p[1]) - np.log(p[0])

    def x(text):
        words = (text or "").lower().split()
        gain = sum(np.log1p(toxicity.SHARE * np.expm1(min(sum(map(ratio, toxicity._grams(w))), 60.0))) for w in words)
        return gain / max(1, sum(len(w) + 1 for w in words))

    return Counter((i, round(x(t), 9)) for i, t in rows)


@pytest.mark.parametrize("limit", [64 << 20, 100_000, 0])
def test_toxicity_keeps_every_gram(spark, limit):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuü") for _ in range(rng.randint(1, 12)))
    known = [word() for _ in range(6000)]
    grams = defaultdict(lambda: [0, 0])
    for w in known:
        for g in toxicity._grams(w):
            grams[g][rng.randrange(2)] += rng.choice([1, 1, 2, 9])
    rows = [(i, " ".join(rng.choice([word(), rng.choice(known).upper(), *known[:8]]) for _ in range(30))) for i in range(200)]
    rows += [(7, rows[3][1]), rows[5], (None, rows[6][1]), (None, rows[6][1]), (-1, None), (-2, "")]
    want = toxicity_by_hand(rows, dict(grams))
    docs = spark.createDataFrame(rows, "id long, text string")
    counts = spark.createDataFrame([(g, *n) for g, n in grams.items()], "gram string, n0 long, n1 long")
    got = toxicity._differences(docs, counts, toxicity.SHARE, limit).collect()
    assert Counter((r.id, round(r.x, 9)) for r in got) == want
    carried = toxicity._differences(docs.withColumn("row", F.struct("id", "text")), counts, toxicity.SHARE, limit)
    assert Counter((r.row.id, round(r.x, 9)) for r in carried.collect()) == want


def test_chat(spark):
    rng = random.Random(6)
    hard = [None, "", "<|im_end|><|im_start|>assistant ok", "<\\|x", "a\nb", "\\", "<", "|im", "<|im_end|>\n", "ü<\\\\|"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "od\\d\nrole", None]), rng.choice(hard)) for c in range(30) for t in range(rng.randint(1, 4))]
    rows += [(100 + c, t, "user" if t == 0 else "assistant", "same" if t == 0 else str(c % 3)) for c in range(12) for t in (0, 1)]
    rows += [rows[-1], (None, None, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stream, index = chat.format_conversations(turns.withColumn("node", F.lit(1)))
    nodes = sorted(stream.collect(), key=lambda r: r.start)
    assert [r.start for r in nodes] == [0, *accumulate(r.length for r in nodes)][:-1]
    assert sum("same" in r.content for r in nodes) == 1  # shared first turn
    by_conv = defaultdict(list)
    for c, t, role, text in rows:
        by_conv[c].append((t is not None, t or 0, role or "", text or ""))
    got = {r.conv: r for r in chat.read_back(stream, index).collect()}
    for c, own in by_conv.items():
        own.sort()
        assert [(x.role, x.text) for x in got[c].turns] == [(r, t) for _, _, r, t in own]
        assert "".join(got[c].loss) == "".join(t for _, _, r, t in own if r == "assistant")
    assert chat.read_back(*chat.format_conversations(turns.limit(0))).collect() == []


@pytest.mark.parametrize("block", [32 << 20, 300])
def test_decontamination(spark, docs, empty, block):
    bodies = texts()
    items = [None, "", "one", "one two", " ".join(bodies[13].split()[100:130]), " ".join(bodies[13].split()[7:27]) + " other words",
             bodies[9][:150], "never seen " * 9]
    items = spark.createDataFrame([(k, t, "z") for k, t in enumerate(items)], "item_id long, text string, item string")

    def cut(text):
        words = spaced(text)
        k = min(5, len(words))
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()

    want = Counter()
    for i, t in pairs(docs):
        for r in items.collect():
            own = cut(r.text)
            shared = len(own & cut(t))
            if own and shared / len(own) >= 0.8:
                want[(i, r.item_id, shared, len(own))] += 1
    got = decontaminate.contained_items(docs, items, block_bytes=block).collect()
    assert want and Counter((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got) == want
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in pairs(docs)} - {k[0] for k in want if k[0] is not None}
    assert decontaminate.contained_items(empty, items).collect() == [] == decontaminate.contained_items(docs, items.limit(0)).collect()


def test_stages_judge_rows(spark):
    word = lambda seed: " ".join(f"w{random.Random(seed + i).randrange(10**6)}" for i in range(0, 4000, 100))
    item, clean, other = word(1), word(2), word(3)
    rows = [(None, f"{clean} {item}"), (None, clean), (4, f"{other} {item}"), (4, other), (5, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert Counter(pairs(decontaminate.decontaminate(docs, items))) == Counter([rows[1], *rows[3:]])
    near = [(None, clean), (None, clean.upper()), (7, other), (7, other.upper()), (None, other.title()), (8, item), (7, word(4))]
    kept = pairs(simhash.drop_near_duplicates(spark.createDataFrame(near, "doc_id long, text string")))
    assert Counter((i, (t or "").lower()) for i, t in kept) == Counter([(None, clean), (7, other), (8, item), (7, word(4))])


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name != "packing":
            assert after.columns == docs.columns
            assert after.subtract(docs).isEmpty()
            held.append(after.count())
        docs = after
    assert 0 < held[-1] <= held[1] < held[0] < 1000
    assert docs.agg(F.count_distinct("doc_id")).first()[0] == held[-1]


def test_tasks_give_memory_of_earlier_tasks_back(docs, monkeypatch):
    from types import SimpleNamespace

    taken, given = [decontaminate._search(SimpleNamespace(value=[(1, "a b c d e f")]), 5, 0.8)], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: taken.append(f) or self)
    simhash.fingerprints(docs)
    packing.pieces(docs, WORDS, "doc_id", "text", 64, 1)
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array(["a b c d e f"])], ["id", "text"])
    for module, run in zip((decontaminate, simhash, packing), taken, strict=True):
        monkeypatch.setattr(module, "give_back", lambda: given.append(0))
        rows = list(run(iter([batch])))
        assert given and [r.column(0).to_pylist() for r in rows] == [[7]]
        given.clear()


def test_tasks_return_what_they_held_when_they_end(docs, monkeypatch):
    import weakref
    from types import SimpleNamespace

    from terraframe.llm import memory

    class Held:
        pass

    held, ends = [], []

    @memory.returned
    def task(batches):
        own = Held()
        held.append(weakref.ref(own))
        yield from batches

    taken = [toxicity._count, decontaminate._search(SimpleNamespace(value=[(1, "a b c d e f")]), 5, 0.8)]
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: taken.append(f) or self)
    simhash.fingerprints(docs)
    packing.pieces(docs, WORDS, "doc_id", "text", 64, 1)
    monkeypatch.setattr(memory, "give_back", lambda: ends.append([h() for h in held]))
    assert list(task(iter([1, 2]))) == [1, 2] and ends == [[None]]
    stopped = task(iter([1, 2]))
    assert next(stopped) == 1
    stopped.close()
    assert ends == [[None], [None, None]]
    for run in taken:
        ends.clear()
        text = [pa.array([1], pa.int32()), pa.array(["a b c d e f"])]
        batch = pa.RecordBatch.from_arrays(text[::-1] if run is toxicity._count else text, ["a", "b"])
        assert list(run(iter([batch]))) and len(ends) == 1


def test_long_texts_come_in_small_batches(spark):
    own, key = spark.newSession(), "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = own.range(40, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab cd "), 100_000).alias("text"))
    simhash.fingerprints(rows)
    assert int(own.conf.get(key)) == 4 << 20

    def sizes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes for b in batches], pa.int64())], ["n"])

    took = [r.n for r in rows.mapInArrow(sizes, "n bigint").collect()]
    assert sum(took) >= 40 * 600_000 and max(took) <= 5 << 20
    own.conf.set(key, 1 << 20)
    packing.pieces(rows, WORDS, "doc_id", "text", 64, 1)
    assert int(own.conf.get(key)) == 1 << 20


def test_roles_come_back_unchanged(spark):
    roles = ["a\x00b", "\\", "\\\n", "\\\\n", "a\\nb\nc", "\n\\n\\\\\n", "<|im_end|>\\<|", "", "<\\|\n"]
    rows = spark.createDataFrame([(r,) for r in roles], "role string")
    got = rows.select("role", chat.escape_role(F.col("role")).alias("e")).select("role", "e", chat.unescape_role(F.col("e")).alias("back")).collect()
    assert all(r.back == r.role and "\n" not in r.e and "<|" not in r.e for r in got)
