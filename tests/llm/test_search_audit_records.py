"""Ranked search, divergence audit and token records against brute force, with NULLs, ties, repeats and clashing names."""

from __future__ import annotations

import glob
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_edges import CLASH, LONG

from tenderlens.llm import records
from tenderlens.llm.divergence import _cell, divergence_audit
from tenderlens.llm.queries import QUERIES
from tenderlens.llm.ranked_search import Shard, ranked_search, search, terms_of, weight
from tenderlens.llm.tokens import default_path, encoder

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def clashing(df, *names):
    return df.withColumns({c: F.lit("x") for c in names if c not in df.columns})


# --- ranked search


def rank_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def ranked(docs, queries, k):
    lists = [(i, Counter(rank_terms(t))) for i, t in docs]
    lists = [(i, c) for i, c in lists if c]
    n, total = len(lists), sum(c.total() for _, c in lists)
    df = Counter(t for _, c in lists for t in c)
    asked = defaultdict(set)
    for i, t in queries:
        if i is not None:
            asked[i] |= set(rank_terms(t))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in lists:
            m = 10 + (90 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def test_terms():
    for text in (None, "", " \x00", "A1-b_CÉ中 x\x7fy@Z", LONG):
        assert [t.decode() for t in terms_of(text) if t] == rank_terms(text)


@pytest.mark.parametrize(("share", "block", "shard"), [(1 / 64, 400_000, 8192), (0.2, 7, 40), (1.0, 10, 40), (0.0, 400_000, 64)])
def test_ranked_search(spark, share, block, shard):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(rnd.choices(words, [1 / (i + 1) for i in range(60)], k=n))
    docs = [(i, draw(rnd.randrange(1, 40))) for i in range(300)]
    docs += [(i, "Same; copy of w3 W4") for i in range(300, 400)] + [(7, docs[7][1]), (7, "w1 w1 another"), (400, None), (401, ""), (402, "-- !"), (403, LONG), (None, "w1 w50 w59")]
    queries = [(i, draw(6)) for i in range(12)] + [(0, "w59 extra"), (12, None), (13, "?"), (14, "nowhere"), (None, "w1"), (15, "W3 copy same"), (16, "w0"), (17, "tail7 word7")]
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), *CLASH, "item_id", "score", "term", "n", "row")
    q = clashing(spark.createDataFrame(queries, "item_id long, text string"), *CLASH, "doc_id", "score", "term", "n", "row")
    got = sorted(tuple(r) for r in ranked_search(d, q, k=4, short_share=share, block_terms=block, shard_docs=shard).collect())
    assert got == ranked(docs, queries, 4)


def test_ranked_search_of_nothing(spark):
    d, q = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search(d, q).count() == ranked_search(some, q).count() == ranked_search(d, some.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert ranked_search(some, q).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_skips_postings():
    """With one rare and two common terms, most postings of the common ones are never read."""
    rng = np.random.default_rng(3)
    n = 20_000
    m = rng.integers(20, 400, n)
    rare = np.sort(rng.choice(n, 40, replace=False))
    common = [np.flatnonzero(rng.random(n) < 0.5) for _ in range(2)]
    place, term = np.concatenate(common), np.repeat([1, 2], [len(c) for c in common])
    tf = rng.integers(1, 4, len(place))
    shard = Shard(np.arange(n), m, place, term, tf)
    w = np.array([weight(n, len(c)) for c in common])
    gain = lambda w, tf, m: w * ((10**9 * tf) // (1000 * tf + 8 * m))
    acc = gain(weight(n, 40), np.ones(40, np.int64), m[rare])
    got = search(shard, np.array([1, 2]), w, rare, acc, int(np.sort(acc)[-10]), 10)
    scores = np.zeros(n, np.int64)
    scores[rare] += acc
    for t in (1, 2):
        own = term == t
        scores[place[own]] += gain(w[t - 1], tf[own], m[place[own]])
    want = np.lexsort((np.arange(n), -scores))[:10]
    assert got[0].tolist() == want.tolist() and got[1].tolist() == scores[want].tolist()
    assert shard.read < 0.1 * len(place)


# --- divergence audit


def audit(docs, least, top):
    letters = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(SMALL))
    docs = [(lang or "", source or "", Counter(letters(t))) for lang, source, t in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = [t for t in df if df[t] >= least]
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            counts[s].update({t: n for t, n in c.items() if df[t] >= least})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (c.total() + 5 * len(kept)) for t in kept}
        p = {s: share(c) for s, c in counts.items()}
        q = share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, r + 1) for r, (v, item) in enumerate(rows)]
    return sorted(out)


@pytest.mark.parametrize(("sources", "terms"), [(32, 4096), (2, 3), (1, 1)])
def test_divergence_audit(spark, sources, terms):
    rnd = random.Random(2)
    words = [f"{a}{b}" for a in ("ab", "Cd", "éx", "中", "\U0001f600q") for b in "uvwxyz"]
    docs = [(rnd.choice(["a", "b", None]), rnd.choice(["s1", "S2", "s3", "üs", None, "s5"]), " ".join(rnd.choices(words[: rnd.randrange(3, 30)], k=20)) + " 12x3") for _ in range(160)]
    docs += [("a", "copies", "same text of copies")] * 60 + [("a", "bare", None), ("a", "bare", ""), ("a", "rare", "seen once")]
    docs += [("none", "x", "few"), ("none", "y", None), ("none", "z", "few"), ("alone", "x", "one"), ("a", "s1", LONG)]
    df = clashing(spark.createDataFrame(docs, "lang string, source string, text string").repartition(4), *CLASH, "term", "times", "n", "v", "part", "item", "value", "block")
    got = sorted(tuple(r) for r in divergence_audit(df, least_docs=12, top_terms=5, source_block=sources, term_block=terms).collect())
    assert got == audit(docs, 12, 5)


def test_pairs_are_the_same_in_every_term_block():
    """Rows of a cell come in any order; a pair that changed sides with it was two pairs with parts of the sum."""
    one = {"lang": "a", "first": 0, "second": 0, "block": 0, "block_terms": 2, "terms": ["t"]}
    rows = [one | {"source": s, "base": b, "shares": [p]} for s, b, p in (("x", 1, 10), ("é", 2, 30), ("b", 4, 70))]
    want = {("b", "x"): 63, ("b", "é"): 42, ("x", "é"): 21}
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        got = _cell(pa.Table.from_pylist(order)).to_pylist()
        assert {(r["left"], r["right"]): r["partial"] for r in got} == want


def test_divergence_of_many_sources_and_terms(spark):
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "uvwxyz"]
    docs = [("a", f"s{rnd.randrange(30)}", " ".join(rnd.choices(words, k=rnd.randrange(1, 40)))) for _ in range(400)]
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(7)
    got = sorted(tuple(r) for r in divergence_audit(df, least_docs=5, term_block=5).collect())
    assert got == audit(docs, 5, 50)


def test_divergence_of_nothing(spark):
    assert divergence_audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


# --- token records


def slow_crc32c(data):
    c = 0xFFFFFFFF
    for x in data:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_checksum():
    rnd = random.Random(1)
    data = [rnd.randbytes(n) for n in (0, 1, 2, 3, 4, 5, 8, 9, 255, 256, 257, 513, 5000)] + [b"123456789"]
    got = records.crc32c(data).tolist()
    assert got == [slow_crc32c(d) for d in data] and got[-1] == 0xE3069283
    crc = 0xE3069283
    assert records.masked(np.array([crc], np.uint32))[0] == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


DOCS = [(5, "five"), (5, "five"), (5, None), (1, ""), (None, "no id"), (3, LONG), (2, "é中 \U0001f600 <|endoftext|>"), (-4, " \n\t x"), (9, "tail")]


def test_token_records(spark, tmp_path):
    enc = encoder(default_path())
    df = clashing(spark.createDataFrame(DOCS, "doc_id long, text string"), *CLASH, "part", "file", "offset", "start", "tokens", "place")
    path = f"file://{tmp_path}/a"
    records.write_token_records(df, path, files=3)
    index = records.read_token_index(spark, path)
    got = records.read_token_records(index, path).collect()
    want = sorted(((i is not None, i or 0), np.append(enc.encode(t or ""), 2).astype("<u4").tobytes()) for i, t in DOCS)
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), bytes(r["ids"])) for r in got) == want
    # starts are without gaps, in ascending order of the ids
    at, last = 0, None
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and (last is None or r["doc_id"] >= last)
        at, last = at + len(r["ids"]) // 4, r["doc_id"]
    # any order: each record is fetched where the index says
    mixed = records.read_token_records(index.orderBy(F.xxhash64("file", "offset")), path).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, got))
    # the files alone, without the index
    files = glob.glob(f"{tmp_path}/a/data/*.records")
    alone = [c for f in files for c in records.contents(list(records.split(open(f, "rb").read())), f)]
    assert sorted(records.ids_of(c).tobytes() for c in alone) == sorted(b for _, b in want)
    assert {c[0] for c in alone} == {2}
    wide = np.array([5, 1 << 20], np.uint32)
    assert records.ids_of(records.serialized(wide, 4)).tolist() == wide.tolist()


def test_broken_records_are_found(spark, tmp_path):
    path = str(tmp_path / "b")
    records.write_token_records(spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string"), path, files=1)
    (file,) = glob.glob(f"{path}/data/*")
    whole = open(file, "rb").read()
    for at in (0, 9, 13, len(whole) - 1):
        bad = bytearray(whole)
        bad[at] ^= 4
        open(file, "wb").write(bad)
        with pytest.raises(Exception, match="broken record"):
            records.read_token_records(records.read_token_index(spark, path), path).collect()
    open(file, "wb").write(whole)
    assert records.read_token_records(records.read_token_index(spark, path), path).count() == 20
    # what a lost task left behind is not read
    open(f"{path}/data/other.records", "wb").write(struct.pack("<Q", 5))
    assert records.read_token_records(records.read_token_index(spark, path), path).count() == 20


def test_records_of_nothing(spark, tmp_path):
    path = str(tmp_path / "c")
    records.write_token_records(spark.createDataFrame([], "doc_id long, text string"), path)
    assert records.read_token_records(records.read_token_index(spark, path), path).count() == 0


def test_token_records_query(spark, sf_dir):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want, at = [], 0
    for i, text in sorted(docs):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op13_token_records"](spark, sf_dir).collect()) == want
