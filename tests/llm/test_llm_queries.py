"""The registered queries against SQL or against brute force on the smallest tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from tenderlens.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    from tenderlens.llm.tokens import default_path

    t = Tokenizer.from_file(default_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def words(text):
    return text.encode().lower().split()


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(texts, percent):
    """Smallest id reachable over exact links."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        common.update((a, b) for k, a in enumerate(ids) for b in ids[:k])
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return sets, {i: root(i) for i in sets}


def test_all_are_registered():
    keys = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in keys} and "pipeline" in keys
    assert set(QUERIES) <= keys and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, key):
    assert compare(QUERIES[key](spark, sf_dir), con, ORACLES[key]) is None


def test_op1_has_every_group(spark, sf_dir, texts):
    sets, root = groups(texts, 85)
    got = {r["doc_id"]: r for r in QUERIES["op1_minhash_bayes"](spark, sf_dir).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(sets[i]), root[i], root[i] == i) for i in texts
    }


def test_op2_finds_held_out_languages(spark, sf_dir, con):
    truth = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op2_language_id"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_op3_ids_and_round_trip(spark, sf_dir, texts, reference):
    got = {r["doc_id"]: r for r in QUERIES["op3_bpe_chunks"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = reference(t)
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), sha)
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def check_packing(rows, ids_of, capacity=2048, most_padding=None):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    padding = total = 0
    assert sorted(by_seq) == list(range(len(by_seq)))
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert set(by_doc) == set(ids_of)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = np.array(ids_of[i][at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(own), len(ids_of[i]))
            at += r["length"]
        assert at == len(ids_of[i])
    assert most_padding is None or padding <= most_padding * (padding + total)


def test_op8_pieces_and_sequences(spark, sf_dir, texts, reference):
    rows = QUERIES["op8_pack"](spark, sf_dir).collect()
    check_packing(rows, {i: [*reference(t), 1] for i, t in texts.items()}, most_padding=0.03)


def test_op5_cosines(spark, sf_dir, con):
    """Every line, block, run and file against every template, in plain Python."""
    import math
    import re

    from tenderlens.llm.licence_texts import BODIES, TEMPLATES, VARIANTS
    from tenderlens.llm.licences import LEAST_COSINE

    docs = con.execute("SELECT doc_id, coalesce(text, ''), coalesce(source, 'none') FROM documents").fetchall()
    split = lambda t: [x for x in re.split("[^a-z0-9]+", t.lower()) if x]
    entries = [(n, x, b) for group, b in ((TEMPLATES, False), (BODIES, True)) for n, texts in group.items() for x in texts]
    vocabulary = {t for _, x, _ in entries for t in split(x)}
    df = Counter(t for _, text, _ in docs for t in set(split(text)) & vocabulary)
    idf = lambda t: math.log((len(docs) + 1) / (df[t] + 1)) + 1 if t in vocabulary else math.log(len(docs) + 1) + 1
    version = lambda t: bool(re.fullmatch("v?[1-9]", t))

    def vector(text):
        v = {t: n * idf(t) for t, n in Counter(split(text)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    def agree(text, template, body):
        a, b = set(split(text)), set(split(template))
        numbers = not body and any(map(version, b))
        return all(t not in VARIANTS and not (numbers and version(t)) for t in a ^ b)

    def passages(lines):
        yield 0, lines
        mark = [(re.match(r"[ \t]*/?([*]|/|#|--|;|%)", x) or [None, ""])[1] for x in lines]
        bare = [not split(x) for x in lines]
        for same in (lambda i: False, lambda i: mark[i] == mark[i - 1], lambda i: mark[i] == mark[i - 1] and bare[i] == bare[i - 1]):
            cuts = [i for i in range(len(lines)) if i == 0 or not same(i)] + [len(lines)]
            yield from ((a, lines[a:b]) for a, b in zip(cuts, cuts[1:]))

    models = [(n, vector(x), x, b) for n, x, b in entries]
    want, path = {}, {}
    for i, text, source in docs:
        path[i] = "/".join([source, *str(i)[:-1], str(i)])
        found = []
        for no, lines in passages(text.split("\n")):
            part = "\n".join(lines)
            v = vector(part)
            full = [k for k, x in enumerate(lines) if split(x)]
            for n, m, x, b in models:
                if (c := sum(y * m.get(t, 0) for t, y in v.items())) >= LEAST_COSINE and agree(part, x, b):
                    found.append((-round(c, 9), no + full[0], full[-1] - full[0] + 1, n))
        want[i] = min(found) if found else None
    got = {r["doc_id"]: r for r in QUERIES["op5_licence_scan"](spark, sf_dir).collect()}
    assert set(got) == set(want) and any(want.values())
    holds = {}
    for i, w in sorted(want.items(), key=lambda x: path[x[0]]):
        if w:
            holds.setdefault(path[i].rpartition("/")[0], w[3])
    for i, r in got.items():
        assert (r["line_no"], r["n_lines"], r["licence"]) == ((want[i][1:]) if want[i] else (None, None, None))
        assert r["cosine"] is None or abs(r["cosine"] + want[i][0]) < 1e-8
        at = path[i].rpartition("/")[0]
        while at and at not in holds:
            at = at.rpartition("/")[0]
        assert (r["path"], r["inherited"], r["inherited_from"]) == (path[i], holds.get(at), at or None)


def test_op6_rules_and_verdicts(spark, sf_dir, con):
    from tenderlens.llm.url_filter import RULES

    urls = dict(con.execute("SELECT page_id, url FROM pages").fetchall())
    got = QUERIES["op6_url_filter"](spark, sf_dir).collect()
    assert sorted(r["page_id"] for r in got) == sorted(urls)
    right = n = 0
    for r in got:
        url = urls[r["page_id"]] or ""
        rest = url.partition("://")[2] if "://" in url else ""
        cut = lambda s, marks: s[: min([s.find(m) for m in marks if m in s], default=len(s))]
        host = cut(rest, "/?#")
        path = cut(rest[len(host) :], "?#")
        host = host.lower()
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == best[2] if best else r["verdict"] in ("allow", "block")
        if best:
            n += 1
            right += (r["score"] >= 0.5) == (best[2] == "block")
    assert right >= 0.95 * n  # the model agrees with the labels it learnt from


def test_pipeline_stages(spark, sf_dir, con, reference):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "pack"]
    made = {}
    for name, stage in P.STAGES:
        before = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        out = P.cut_lineage(stage(spark, docs, sf_dir))
        if name != "pack":
            assert out.columns == docs.columns
        rows = out.collect()
        made[name] = len(rows)
        if name == "language_id":
            assert 0.95 * len(before) <= len(rows) <= len(before)
            assert all(any(map(str.isalpha, r["text"])) for r in rows)
        elif name == "line_dedup":
            key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
            owner = {}
            for i in sorted(before):
                for x in before[i].split("\n"):
                    owner.setdefault(key(x), i)
            want = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == i) for i, t in before.items()}
            assert {r["doc_id"]: r["text"] for r in rows} == want
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "near_dedup":
            _, root = groups(before, 80)
            assert {r["doc_id"] for r in rows} == set(root.values())
        else:
            check_packing(rows, {i: [*reference(t), 1] for i, t in before.items()}, most_padding=0.04)
        docs = out
    assert P.run(spark, sf_dir).count() == made["pack"]
