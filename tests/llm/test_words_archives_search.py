"""Spelling variants, archives and ranked search on small fixtures, against brute force."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terraframe.llm import ranking, variants, warc
from terraframe.session import shared_folder

# Extra columns carry names that the operators use inside.
EXTRA = "n int, key string, word string, record long, chunk int, page string, score long, item string, rank int"
VALUES = (1, "k", "w", 2, 3, "p", 4, "i", 5)


def frame(spark, rows, schema):
    return spark.createDataFrame([(*r, *VALUES) for r in rows], f"{schema}, {EXTRA}")


# Spelling variants


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("size", [2, 3, 6, 7, 40, 150])
def test_near_in_list(size):
    rng = random.Random(size)
    for round_ in range(60):
        letters, base = "abcdé"[: rng.choice([2, 5])], rng.choice([1, 2, 4, 6])
        words = {"".join(rng.choice(letters) for _ in range(base + rng.randint(0, 1))) for _ in range(size)}
        entries = sorted(words | ({"", "a"} if round_ % 3 == 0 else set()))
        want = [(i, j) for i, a in enumerate(entries) for j, b in enumerate(entries) if i != j and one_edit(a, b)]
        assert sorted(variants.near_in_list(entries)) == want


def brute_variants(rows, typo_of=31):
    counts = Counter()
    for i, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo_of == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) if vs else None for w, vs in near.items()}
    form = {w: b if b and n[b] >= 10 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def variant_texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 11))) for _ in range(60)]
    words += ["Straßenbahn", "straßenbahn", "ÉTÉétéété", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaaaaab", "xaaaaaaa", "ab" * 40]
    out = [None, "", " 12 ", "short words", "a×bcdefg÷h"]
    for _ in range(60):
        text = []
        for _ in range(rng.randint(1, 80)):
            w = rng.choice(words[: rng.choice([4, 70])])
            if rng.random() < 0.1:
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + "q" + w[at + 1 :]])
            text.append(w)
        out.append(rng.choice([" ", ", ", "\n"]).join(text))
    return out


@pytest.mark.parametrize(("most", "typo_of"), [(2048, 31), (3, 31), (40, 2)])
def test_spelling_variants(spark, most, typo_of):
    rows = [*enumerate(variant_texts()), (None, "aaaaaaa aaaaaaa zzzzzzzz zzzzzzzz"), (9, variant_texts()[9])]
    docs = frame(spark, rows, "doc_id long, text string")
    got = variants.spelling_variants(docs, most=most, typo_of=typo_of).collect()
    assert Counter(tuple(r) for r in got) == brute_variants(rows, typo_of)


def test_variants_chains_empty_tables_and_long_texts(spark):
    # Ten times as frequent at each step: forms lead from word to word.
    text = " ".join(["lanterns"] * 300 + ["lanternz"] * 30 + ["lanternzz"] * 3)
    rows = [(i, text) for i in range(1)]
    got = {r.word: (r.form, r.root) for r in variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), typo_of=1 << 40).collect()}
    assert got["lanternzz"] == ("lanternz", "lanterns") and got["lanterns"] == (None, "lanterns")
    empty = frame(spark, [], "doc_id long, text string")
    assert variants.spelling_variants(empty).collect() == []
    long = ("Wonderful wanderer " * 150_000) + "x" * 70_000 + " " + "x" * 70_001
    rows = [(1, long), (2, "x" * 70_000 + " " + "x" * 70_001)]
    found = variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), typo_of=1 << 40).collect()
    assert {(len(r.word), r.n, r.n_near) for r in found} == {(9, 150_000, 0), (8, 150_000, 0), (70_000, 2, 1), (70_001, 2, 1)}
    with pytest.raises(ValueError, match="frequent"):
        variants.spelling_variants(empty, ratio=1)


def test_a_crowded_group_sends_one_row_per_word(spark):
    words = [f"prefix{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    frame_ = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    found = variants.near_words(frame_, most=20).collect()
    assert {r.word: r.n_near for r in found} == dict.fromkeys(words, 21)


# Archives


def brute_archive(rows, least=100):
    """Rows by (id, length, digest, type, refers_to); ties of repeated rows leave one response."""
    groups = defaultdict(list)
    for i, p in rows:
        groups[p or b""].append(i)
    want = Counter()
    for p, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for nth, i in enumerate(ids):
            again = nth > 0 and len(p) >= least
            want[(i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", ids[0] if again else None)] += 1
    return want


def page_texts():
    rng = random.Random(3)
    long = "é\r\n\r\nWARC/1.1\r\n" * 40_000
    same = "<p>" + "x" * 120
    out = [None, "", "short", "short", same, same, "y" * 99, "y" * 99, "z" * 100, "z" * 100, long, long, "\r\n\r\n", "\0�"]
    return out + ["".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 400))) for _ in range(40)]


@pytest.mark.parametrize(("chunk", "file"), [(256 << 10, 64 << 20), (1000, 500), (64, 1)])
def test_archive_round_trip(spark, chunk, file):
    pages = [(i, f"http://a.example/ü {i}?q=1%20+2\n", t) for i, t in enumerate(page_texts())]
    pages += [pages[5], (None, None, "z" * 100), (None, "u", None)]
    rows = frame(spark, pages, "page_id long, url string, html string").repartition(3)
    got = warc.archive_pages(rows, chunk_bytes=chunk, file_bytes=file)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in got.collect()) == brute_archive([(i, (t or "").encode()) for i, _, t in pages])
    assert warc.archive_pages(rows.where("false")).collect() == []


def test_archive_files_and_chunks(spark, tmp_path):
    payloads = [b"", b"a" * 5000, bytes(range(256)) * 30, b"a" * 5000, b"q" * 99, b"q" * 99]
    pages = spark.createDataFrame(list(enumerate(payloads)), "key int, body binary").coalesce(1)
    chunks = warc.chunk_table(pages, "key", "body", None, chunk_bytes=512)
    assert {len(zlib.decompress(r.packed)) for r in chunks.where("NOT last").collect()} == {512}
    files = warc.write_archives(chunks, warc.revisits(chunks), str(tmp_path / "w"), file_bytes=2000)
    named = [r.file.removeprefix("file:") for r in files.collect()]
    assert sorted(str(p) for p in (tmp_path / "w").glob("[!_]*.warc.gz")) == sorted(named)
    data = b"".join(gzip.open(n).read() for n in named)
    assert data.count(b"WARC-Type: response\r\n") == 5 and data.count(b"WARC-Type: revisit\r\n") == 1
    assert data.count(b"a" * 5000) == 1
    read = warc.read_archives(files, chunk_bytes=300)
    assert read.agg(F.max(F.octet_length("data"))).first()[0] == 300
    parts = defaultdict(list)
    for r in read.where("type = 'response'").collect():
        parts[int(r.page)].append((r.chunk, bytes(r.data or b"")))
    assert {k: b"".join(d for _, d in sorted(v)) for k, v in parts.items()} == {i: p for i, p in enumerate(payloads) if i != 3}
    again = read.where("type = 'revisit'").first()
    assert (again.page, again.data, again.declared) == ("3", None, hashlib.sha256(b"a" * 5000).hexdigest())
    # A damaged file is refused.
    broken = named[0] + ".broken.warc.gz"
    with open(named[0], "rb") as f, open(broken, "wb") as g:
        g.write(f.read()[:-9])
    damaged = spark.createDataFrame([(broken, 1)], "file string, records long")
    with pytest.raises(Exception, match="ends within"):
        warc.read_archives(damaged).collect()


def test_a_hot_payload_is_one_row_per_task(spark, plan):
    pages = spark.range(0, 3000, numPartitions=6).selectExpr("id AS page_id", "'u' AS url", "if(id % 3 = 0, repeat('h', 200), concat(repeat('p', 100), id)) AS html")
    got = warc.archive_pages(pages)
    kinds = {r.record_type: r["count"] for r in got.groupBy("record_type").count().collect()}
    assert kinds == {"response": 2001, "revisit": 999} and got.where("refers_to <> 0").count() == 0


# Ranked search


def terms_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute_ranking(docs, items, top):
    own = [(i, Counter(terms_of(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, total = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms_of(text))
    want = Counter()
    for item, terms in asked.items():
        scores = []
        for i, c, n in own:
            m = 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            want[(item, rank, i, -score)] += 1
    return want


def search_tables():
    rng = random.Random(11)
    vocabulary = ["the", "The", "über", "x1", "can't", "naïve—word", "ÜBER", "e", "ab-cd", "日本"] + [f"w{i}" for i in range(40)]
    draw = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, draw(rng.randint(0, 60))) for i in range(120)]
    docs += [(200 + i, "the w1 w2 same text") for i in range(80)] + [(None, "w3 w3 e"), (None, None), (500, ""), docs[7], (501, "... --- "), (502, draw(5000))]
    items = [(i, draw(rng.randint(1, 12))) for i in range(12)]
    return docs, [*items, items[0], (3, "über e"), (None, "w5 the"), (90, None), (91, ""), (92, "nowhere-to-be-found"), (93, "!!")]


@pytest.mark.parametrize(("top", "block"), [(50, 4 << 20), (3, 600), (1, 400)])
def test_ranked_search(spark, top, block):
    docs, items = search_tables()
    found = ranking.rank_documents(
        frame(spark, docs, "doc_id long, text string").repartition(5), frame(spark, items, "item_id int, text string"),
        top=top, block_bytes=block,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and dict(found.dtypes)["rank"] == "int"
    assert Counter(tuple(r) for r in found.collect()) == brute_ranking(docs, items, top)


def test_search_of_long_texts_and_empty_tables(spark):
    docs = frame(spark, [(1, "alpha beta " * 200_000), (2, "beta"), (3, "gamma")], "doc_id long, text string")
    items = frame(spark, [(7, "ALPHA beta")], "item_id long, text string")
    want = brute_ranking([(1, "alpha beta " * 200_000), (2, "beta"), (3, "gamma")], [(7, "ALPHA beta")], 50)
    assert Counter(tuple(r) for r in ranking.rank_documents(docs, items).collect()) == want
    for d, i in ((docs.where("false"), items), (docs, items.where("false"))):
        assert ranking.rank_documents(d, i).collect() == []


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([(f"d{i}", "term") for i in range(120)], "doc_id string, text string")
    items = spark.createDataFrame([("q", "term"), ("r", "other")], "item_id string, text string")
    rows = ranking.rank_documents(docs.unionByName(docs.limit(1).selectExpr("'zz' AS doc_id", "'else' AS text")), items).collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.rank)] == sorted(f"d{i}" for i in range(120))[:50]


def test_shared_folder_holds_the_archives(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark, "warc").startswith(base.rstrip("/"))
