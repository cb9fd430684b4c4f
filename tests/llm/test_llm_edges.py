"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import math
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.llm import langid
from tenderlens.llm.bpe import ChunkReuse, bpe_decode, bpe_encode, cuts
from tenderlens.llm.components import components
from tenderlens.llm.exact_dedup import exact_dedup
from tenderlens.llm.licence_texts import BODIES, TEMPLATES
from tenderlens.llm.licences import _terms, numbered, scan, weigh
from tenderlens.llm.line_dedup import LineRuns, line_dedup
from tenderlens.llm.minhash import band_rows, least_matches, links, near_duplicates
from tenderlens.llm.pack import pack, solve
from tenderlens.llm.tokens import default_path, encoder
from tenderlens.llm.topk import top_k
from tenderlens.llm.url_filter import url_filter
from tenderlens.llm.warc import parse_records, read_records, write_archive

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
DOCS = [
    (1, "a b c d e f g h"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r"),
    (5, "A b C d e f  g h"),
    (5, "A b C d e f  g h"),
    (6, LONG),
    (7, LONG + " end"),
    (None, "a b c d e f g h"),
    (8, "one two"),
    (9, "ONE\ttwo"),
    (10, "\u00e9\u4e2d \U0001f600 <|endoftext|>"),
]
CLASH = ("keep_id", "digest", "row_id", "hash", "pos", "batch", "size", "rank", "n_lines", "ids", "cell", "norm", "tag")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def test_exact_dedup(docs, nothing):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs).collect()}
    assert {(1, 1, 2, True), (None, 1, 2, False), (5, 5, 2, True)} <= got
    # the row with most code points stays, though white space only
    assert {(2, 4, 3, False), (3, 4, 3, False), (4, 4, 3, True)} <= got
    assert {(8, 8, 1, True), (9, 9, 1, True), (6, 6, 1, True), (7, 7, 1, True)} <= got
    assert exact_dedup(docs).count() == len(DOCS) and exact_dedup(nothing).count() == 0


def test_exact_dedup_keeps_texts_of_one_digest_apart(docs):
    weak = exact_dedup(docs, digest=F.substring("norm", 1, 1))
    strong = exact_dedup(docs)
    assert sorted(map(str, weak.collect())) == sorted(map(str, strong.collect()))


def test_line_dedup(spark, docs, nothing):
    rows = [
        (1, "  Common line here \nown line number one\nshort"),
        (2, "COMMON LINE HERE\nshort\nrepeat inside doc\nrepeat inside doc"),
        (3, None),
        (4, ""),
        (5, "common line here\n\ncommon line here\nlast own line"),
        (5, "common line here"),
        (None, "common line here"),
        (6, "\n".join(["repeat inside doc"] + [f"line number {i}" for i in range(5000)])),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in (*CLASH, "kept_text")})
    for batches, fanout in ((1, 2), (3, 2), (5, 3)):
        got = line_dedup(df, batches=batches, fanout=fanout).collect()
        by = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got}
        assert len(got) == len(rows)
        assert by[rows[0]] == (3, 0, rows[0][1])
        assert by[rows[1]] == (4, 1, "short\nrepeat inside doc\nrepeat inside doc")
        assert by[rows[2]] == (1, 0, "") and by[rows[3]] == (1, 0, "")
        assert by[rows[4]] == (4, 2, "\nlast own line") and by[rows[5]] == (1, 1, "")
        assert by[rows[6]] == (1, 0, "common line here")
        assert by[rows[7]][:2] == (5001, 1)
    assert line_dedup(nothing).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    rows = [(1, "common line here\nsecond common line"), *[(2, "common line here\nown line of two\nsecond common line\nlast own line")] * 3, (2, "second common line\nx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3):
        got = sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup(df, batches=batches).collect())
        assert got == [(1, 2, 0, rows[0][1]), (2, 2, 1, "x"), *[(2, 4, 2, "own line of two\nlast own line")] * 3]


def test_runs_are_compacted(spark):
    store = LineRuns(spark, buckets=4, fanout=2)
    for k in range(5):
        store.add(spark.createDataFrame([(bytearray([k]), k)], "hash binary, owner long"))
    assert [len(level) for level in store.levels] == [1, 0, 1]
    keys = spark.createDataFrame([(bytearray([k]), 9, 9) for k in range(6)], "hash binary, owner long, last long")
    assert sorted((r["known"] is None, r["known"] or 0) for r in store.match(keys).collect()) == [(False, k) for k in range(5)] + [(True, 0)]


def test_near_duplicates(docs, nothing):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs, percent=85).collect()}
    assert {(1, 4, 1, True), (5, 4, 1, False), (None, 4, 1, False)} <= got
    assert {(2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True)} <= got
    assert {(8, 1, 8, True), (9, 1, 8, False)} <= got
    assert (6, 39996, 6, True) in got and (7, 39997, 6, False) in got
    assert near_duplicates(docs).count() == len(DOCS) and near_duplicates(nothing).count() == 0


def test_links_in_blocks_and_through_the_middle():
    """Copies that agree only with their source are one group, in whatever blocks they come."""
    rng = np.random.default_rng(1)
    source = rng.choice(1 << 40, 400, replace=False).astype(np.uint64)
    sets = [np.sort(source)]
    for _ in range(60):
        changed = source.copy()
        changed[rng.choice(400, 24, replace=False)] = rng.choice(1 << 40, 24).astype(np.uint64)
        sets.append(np.unique(changed))
    every = np.arange(len(sets))
    exact = {
        (i, j) for i in every for j in every[:i]
        if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - n)
    }
    assert 0 < len(exact) < 60 * 61 // 2
    whole = links(sets, every, every, 85, 1e-8)
    assert len(whole) == 60  # a spanning tree, not the pairs
    blocks = [every[every % 3 == k] for k in range(3)]
    parts = []
    for a in range(3):
        for b in range(a, 3):
            at = np.union1d(blocks[a], blocks[b])
            left, right = np.flatnonzero(np.isin(at, blocks[a])), np.flatnonzero(np.isin(at, blocks[b]))
            parts += [(at[i], at[j]) for i, j in links([sets[k] for k in at], left, right, 85, 1e-8)]
    up = list(every)
    root = lambda i: i if up[i] == i else root(up[i])
    for i, j in parts:
        assert (max(i, j), min(i, j)) in exact
        up[root(i)] = root(j)
    assert len({root(i) for i in every}) == 1


def test_posterior_bound():
    for n, m in ((36, 20), (180, 140)):
        grid = np.linspace(0, 1, 200_001)
        density = grid**m * (1 - grid) ** (n - m)
        tail = density[grid >= 0.85].sum() / density.sum()
        exact = sum(math.comb(n + 1, k) * 0.85**k * 0.15 ** (n + 1 - k) for k in range(m + 1))
        assert abs(tail - exact) < 1e-3 * max(tail, 1e-6)
        assert (least_matches(n, 0.85, 1e-8) <= m) == (exact >= 1e-8)
    for percent in (80, 85, 90):
        r = band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (180 // r) <= 1e-6


def test_components(spark):
    edges = [(9, 8), (8, 7), (7, 6), (6, 5), (3, 3), (2, 1), (20, 1), (1, 2), (None, 4)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 1: 1, 2: 1, 20: 1}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_language_id(spark, docs, nothing):
    labelled = [(i, t * 3, lang) for i, (t, lang) in enumerate([("the cat and the dog of the house ", "en"), ("der hund und die katze im haus ", "de")] * 5)]
    learnt = langid.learn(spark.createDataFrame([*labelled, (90, None, "en"), (91, "x", None)], "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert sorted(learnt) == ["de", "en"]
    probe = spark.createDataFrame([(1, "the dog and the cat"), (2, None), (3, ""), (4, "123 -- 456"), (5, "die katze und der hund"), (6, LONG)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(probe, learnt).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["en", "und", "und", "und", "de"]
    assert all(got[i]["rejected"] and got[i]["score"] == 0 for i in (2, 3, 4)) and got[6]["lang_pred"] in ("en", "de")
    narrow = langid.identify(probe, learnt, min_margin=0.999)
    assert all(r["rejected"] for r in narrow.collect())
    assert {r["lang_pred"] for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(nothing, learnt).count() == 0 and langid.learn(nothing.withColumn("lang", F.lit("en")), "doc_id", "text", "lang") == {}


def test_language_id_of_long_texts(spark, sf_dir):
    """The length of a text neither narrows the margin nor lets the opening decide."""
    import random

    from corpus_pipeline import LEAST_MARGIN

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    dictionaries = langid.learn(docs, "doc_id", "text", "lang")
    said = {lang: sorted({w for r in docs.where(F.col("lang") == lang).collect() for w in (r["text"] or "").split()}) for lang in ("de", "en")}

    def prose(lang, chars):
        pick, out, held = random.Random(7), [], 0
        while held < chars:
            out.append(pick.choice(said[lang]))
            held += len(out[-1]) + 1
        return " ".join(out)

    texts = [(1, prose("en", 3_000_000)), (2, prose("de", 3_000_000)), (3, prose("de", 50_000) + " " + prose("en", 4_000_000))]
    probe = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(probe, dictionaries, min_margin=LEAST_MARGIN).collect()}
    assert {i: (r["lang_pred"], r["rejected"]) for i, r in got.items()} == {1: ("en", False), 2: ("de", False), 3: ("en", False)}
    short = spark.createDataFrame([(1, texts[0][1][:100_000])], "doc_id long, text string")
    assert got[1]["score"] > langid.identify(short, dictionaries).first()["score"] / 2


def test_blocks_hold_the_whole_text():
    raw = bytes(i % 251 for i in range(3 * langid.BLOCK_BYTES + 1))
    for n in (0, 1, langid.BLOCK_BYTES, langid.BLOCK_BYTES + 1, len(raw)):
        blocks = langid._blocks(raw[:n])
        assert b"".join(blocks) == raw[:n] and max(map(len, blocks)) <= langid.BLOCK_BYTES and len(blocks) == max(1, -(-n // langid.BLOCK_BYTES))


def test_bpe_round_trip(docs, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    got = bpe_decode(bpe_encode(docs)).collect()
    want = sorted(((i is None, i or 0), t.encode(x or "", add_special_tokens=False).ids, x or "") for i, x in DOCS)
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in got) == want
    assert bpe_encode(nothing).count() == 0


def test_chunks_are_reused_and_joins_exact():
    from tokenizers import Tokenizer

    t, reuse = Tokenizer.from_file(default_path()), ChunkReuse(encoder(default_path()))
    rng = np.random.default_rng(5)
    parts = ["a", "bc", " ", "  ", "\n", "\n\n", "\u00e9", "\u4e2d", "\U0001f600", "'s", "12", "<|endoftext|>", "\t", "\xa0", ".", " the quick"]
    shared = "".join(rng.choice(parts, 30_000))
    for head in ("", "x", "A different start. ", "\n\n", "12 34 "):
        text = head + shared + head
        assert reuse.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids
    assert reuse.reused > reuse.encoded
    for text in ("x" * 40_000, " " * 9_000, "ab " * 9_000, "<|endoftext|>" * 2_000):
        assert reuse.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids
    data = shared.encode()
    ends = cuts(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends)) and all(data[e : e + 1] == b"" or data[e] & 0xC0 != 0x80 for e in ends)


def test_small_cache_gives_the_same():
    enc = encoder(default_path())
    assert np.array_equal(ChunkReuse(enc, keep_bytes=2000).encode(LONG), enc.encode(LONG))


def test_pack(docs, nothing):
    enc = encoder(default_path())
    rows = pack(docs, capacity=64, unit=4, with_ids=True).collect()
    total = sum(len(enc.encode(t or "")) + 1 for _, t in DOCS)
    assert sum(r["length"] for r in rows) == total
    assert all(r["length"] * 4 == len(r["ids"]) and r["offset"] + r["length"] <= 64 for r in rows)
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert pack(nothing).count() == 0


@pytest.mark.parametrize("counts", [{}, {128: 7}, {1: 1000}, {65: 10, 64: 10, 63: 10}, {s: s % 7 + 1 for s in range(1, 129)}])
def test_patterns_use_up_the_histogram(counts):
    used, n = dict.fromkeys(counts, 0), 0
    for times, pattern in solve(counts, 128):
        assert times > 0 and sum(s * a for s, a in pattern.items()) <= 128
        n += times
        for s, a in pattern.items():
            used[s] += times * a
    bound = math.ceil(sum(s * c for s, c in counts.items()) / 128)
    assert used == counts and n <= bound * 1.02 + 3 + counts.get(65, 0)


def test_licence_scan(spark, nothing):
    files = [
        ("LICENSE", "Released under the MIT License."),
        ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3.\n"),
        ("a/b/c/d.py", "code\n# Licensed under the Apache License, Version 2.0.\n" + LONG),
        ("a/x.py", "nothing here"),
        ("a/b/y.py", None),
        ("a/b/y.py", ""),
        (None, "Released under the MIT License."),
    ]
    df = spark.createDataFrame(files, "path string, text string").withColumns({c: F.lit("x") for c in ("line", "licence", "folder", "w")})
    got = {(r["path"], r["line_no"], r["licence"], r["inherited"], r["inherited_from"]) for r in scan(df).collect()}
    assert got == {
        ("LICENSE", 0, "MIT", "MIT", ""),
        ("a/b/COPYING", 0, "GPL-3.0", "GPL-3.0", "a/b"),
        ("a/b/c/d.py", 1, "Apache-2.0", "GPL-3.0", "a/b"),
        ("a/x.py", None, None, "MIT", ""),
        ("a/b/y.py", None, None, "GPL-3.0", "a/b"),
        (None, None, None, None, None),
    }
    assert scan(df).count() == len(files) and scan(df.limit(0)).count() == 0


def _wrapped(text, width=60, mark=""):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


def test_licence_bodies_headers_and_variants(spark):
    mit, two, three = BODIES["MIT"][1], BODIES["BSD-2-Clause"][0], BODIES["BSD-3-Clause"][0]
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    apache = next(x for x in TEMPLATES["Apache-2.0"] if x.endswith("LICENSE-2.0"))
    code = "\nimport os\n" + "".join(f"def f{i}(x):\n    return x * {i}\n\n" for i in range(300))
    commented = lambda text, mark: "\n".join(mark + x for x in ["Copyright 2020 A. Person", "", *textwrap.wrap(text, 60)])
    wanted = {
        "m/LICENSE": ("MIT License\n\nCopyright (c) 2019 Some Body\n\n" + _wrapped(mit), "MIT"),
        "m/head.c": ("/*\n" + commented(mit, " * ") + "\n */" + code, "MIT"),
        "b/two": ("Copyright (c) 2001, Some Body\nAll rights reserved.\n\n" + _wrapped(two), "BSD-2-Clause"),
        "b/three": ("Copyright (c) 2001, Some Body\nAll rights reserved.\n\n" + _wrapped(three), "BSD-3-Clause"),
        "b/two.py": (commented(two, "# ") + code, "BSD-2-Clause"),
        "b/three.py": (commented(three, "# ") + code, "BSD-3-Clause"),
        "g/two.py": (commented(gpl.format(2), "# ") + code, "GPL-2.0"),
        "g/three.sql": (commented(gpl.format(3), "-- ") + code, "GPL-3.0"),
        "g/affero.js": (commented(gpl.format(3).replace("GNU", "GNU Affero"), "// ") + code, "AGPL-3.0"),
        "g/COPYING": ("   GNU GENERAL PUBLIC LICENSE\n     Version 2, June 1991\n\n" + LONG, "GPL-2.0"),
        "g/library": ("   GNU LIBRARY GENERAL PUBLIC LICENSE\n     Version 2, June 1991\n\n" + LONG + "\n\n" + gpl.format(2), "LGPL-2.0"),
        "g/line": ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        "a/x.java": ("/*\n" + commented(apache, " * ") + "\n */" + code, "Apache-2.0"),
        "a/one": ("Licensed under the Apache License, Version 1.1.", None),
        "c/ncsa": ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        "c/sa3": ("Licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
        "c/nc": ("This is licensed under a Creative Commons Attribution-Non-Commercial 4.0 International License.", None),
        "s/x.rs": ("// SPDX-License-Identifier: LGPL-2.1-or-later\n" + code, "LGPL-2.1"),
        "s/y.rs": ("// SPDX-License-Identifier: BSD-2-Clause\r\n" + code, "BSD-2-Clause"),
        "n/none.py": (code, None),
    }
    files = spark.createDataFrame([(p, t) for p, (t, _) in wanted.items()], "path string, text string")
    got = {r["path"]: r for r in scan(files.unionAll(files)).collect()}
    assert {p: r["licence"] for p, r in got.items()} == {p: x for p, (_, x) in wanted.items()}
    assert got["m/head.c"]["inherited"] == "MIT" and got["g/two.py"]["inherited"] == "GPL-2.0" and got["a/one"]["inherited"] is None
    assert (got["g/COPYING"]["line_no"], got["g/COPYING"]["n_lines"]) == (0, 2)


def test_licence_markers_are_rare_and_enough():
    entries = numbered(TEMPLATES, BODIES)
    vocabulary = sorted({t for _, _, x, _ in entries for t in _terms(x)})
    common = {"the", "of", "and", "to", "in", "or", "this", "is", "for", "a"}
    _, _, weights, markers = weigh({t: 900 if t in common else 0 for t in vocabulary}, 1000, entries, 0.8)
    assert not common & set(markers)
    left = [sum(w * w for k, t, w in weights if k == n and t not in markers) for n in range(len(entries))]
    assert max(left) < 0.64


def test_url_filter(spark):
    urls = [
        (1, "http://WWW.Example.com/en/1?q=/x"), (2, "https://a.example.com/en/2#t"), (3, "http://b.net/es/x"), (4, "http://b.net/fr"),
        (5, None), (6, ""), (7, "no scheme/at all"), (8, "://"), (9, "http://com/"), (9, "http://com/"), (10, "http://h.org/" + "p" * 50_000),
        (11, "x://xcom/"),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "_x", "score")})
    got = {r["page_id"]: (r["host"], r["path"][:9], r["rule"], r["verdict"]) for r in url_filter(df).collect()}
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/2", "example.com/en/", "block")
    assert got[3] == ("b.net", "/es/x", "net/es/", "block") and got[4][2] is None
    assert got[5][:3] == got[6][:3] == got[7][:3] == ("", "", None) and got[9][2] == "com/" and got[11][2] is None
    one = {r["verdict"] for r in url_filter(df.where("page_id in (3, 4)")).collect()}
    none = {r["verdict"] for r in url_filter(df.where("page_id = 10")).collect()}
    assert one == {"block"} and none == {"allow"} and url_filter(df.limit(0)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).round(1).tolist(), 0) for i in range(600)]
    rows += [(1001, None, 0), (1002, [1.0, None] + [0.0] * 6, 0), (1003, [float("nan")] * 8, 0), (1004, [float("inf")] * 8, 0), (None, hot, 0), (300, hot, 0), (1005, hot[:3], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")
    own = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in rows if i is not None and i < 1000 or i == 1005]
    own = [(i, np.pad(v, (0, 8 - len(v)))) for i, v in own]
    want = set()
    for q, v in {(i, tuple(v)) for i, v in own if i % 100 == 0}:
        best = sorted((-int(np.dot(v, x)), i) for i, x in own if i != q)[:10]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    got = {tuple(r) for r in top_k(df).collect()}
    assert got == want
    few = {tuple(r) for r in top_k(df.where("vec_id in (0, 1, 2)")).collect()}
    assert len(few) == 2 and top_k(df.limit(0)).count() == 0


def test_top_k_of_repeated_queries(spark):
    """A query row that stands there twice, or under several vectors, has all its true neighbours."""
    rng = np.random.default_rng(4)
    hot = [3.0, 1.0, 2.0, -1.0]
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=4).round(1).tolist()) for i in range(301)]
    rows += [(0, hot)] + [(3, hot)] * 2 + [(100, hot)] * 3 + [(200, rng.normal(size=4).round(2).tolist()) for _ in range(15)]
    own = [(i, tuple(np.floor(1024 * np.array(v)).astype(int).tolist())) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for pivots in (2, 16):
        want = set()
        for q in (0, 100, 200, 300):
            asked = {v for i, v in own if i == q}
            best = sorted((-int(np.dot(v, x)), i) for v in asked for i, x in own if i != q)[:10]
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
        got = [tuple(r) for r in top_k(df, pivots=pivots).collect()]
        assert set(got) == want and len(got) == len(want)


def test_archive_round_trip(spark, tmp_path):
    big = "<p>" + "\u00e9" * 600 + "</p>"
    pages = [(1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/\r\nX: y", big), (3, None, None), (4, "", ""), (5, "u", "same"), (6, "u", "same"), (7, "u", "z" * 100_000), (None, "u", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("digest", "payload", "holder", "size")})
    write_archive(df, f"{tmp_path}/a")
    records = read_records(spark, f"{tmp_path}/a")
    got = {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in parse_records(records).collect()}
    assert {(1, 1207, "revisit", 9), (2, 1207, "revisit", 9), (9, 1207, "response", None), (3, 0, "response", None), (4, 0, "response", None)} <= got
    assert {(5, 4, "response", None), (6, 4, "response", None), (7, 100_000, "response", None)} <= got and len(got) == 9
    for r in read_records(spark, f"{tmp_path}/a", with_payload=True).collect():
        head, _, block = bytes(r["record_bytes"]).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert len(block) == int(fields["Content-Length"]) + 4 and block.endswith(b"\r\n\r\n") and "X" not in fields
        assert (block[:-4] == bytes(r["payload"])) == (fields["WARC-Type"] == "response")
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == 4
    write_archive(df.limit(0), f"{tmp_path}/b")
    assert read_records(spark, f"{tmp_path}/b").count() == 0
