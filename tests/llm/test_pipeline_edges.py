"""The pipeline's stages on awkward rows, reuse of passages, pruning of the top-k join, and the solver beside a session."""

from __future__ import annotations

import faulthandler
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_edges import LONG

import corpus_pipeline as P
from tenderlens.llm import langid, topk
from tenderlens.llm.bpe import ChunkReuse
from tenderlens.llm.line_dedup import line_dedup
from tenderlens.llm.pack import solve
from tenderlens.llm.tokens import default_path, encoder

EN = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions for the king of the northern hills"
DE = "der schnelle braune Fuchs springt über den faulen Hund und sieben Zauberer mischen leise Tränke für den König der Hügel"
NAMES = ("score", "rejected", "lang_pred", "n_lines", "n_dropped", "kept_text", "_tag", "_row", "_holes", "_lines", "_doc", "tag", "packed", "row_id", "kept", "ids")
ROWS = [
    *((i, f"{EN} {i} {' '.join(EN.split()[i % 9 :])}", "en", "a") for i in range(1, 9)),
    *((i, f"{DE} {i} {' '.join(DE.split()[i % 9 :])}", "de", "b") for i in range(11, 19)),
    (21, None, "en", "a"),
    (22, "", None, None),
    (23, " \t\n", "de", None),
    (24, "12345 !?", "en", "a"),
    (30, LONG, None, "a"),
    (31, LONG + " end", "en", "a"),
    (40, EN + " twice", "en", "a"),
    (40, EN + " twice", "en", "a"),
    (40, DE + " and another text under the id", None, "a"),
    (None, EN, "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    return df.withColumns({c: F.concat(F.lit(c + "-"), F.col("doc_id").cast("string")) for c in NAMES})


def kept_as_given(out, docs, but=()):
    """Other columns come out as they went in."""
    assert out.columns == docs.columns
    for r in out.where("doc_id is not null").collect():
        assert all(r[c] == f"{c}-{r['doc_id']}" for c in NAMES if c not in but)


def test_language_stage(spark, docs):
    out = P.language_stage(spark, docs, "")
    kept_as_given(out, docs)
    rows = out.collect()
    assert {21, 22, 23, 24}.isdisjoint(r["doc_id"] for r in rows) and {1, 11, 30, 40, None} <= {r["doc_id"] for r in rows}
    assert all(r["lang"] is not None for r in rows) and {r["lang"] for r in rows if r["doc_id"] in range(11, 19)} == {"de"}
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert P.language_stage(spark, bare, "").count() == docs.count()


def test_line_stage(spark, docs):
    more = spark.createDataFrame([(50, "a line of its own\nshared by two of them", "en", "a"), (51, "Shared by two of them \n", "en", "a")], "doc_id long, text string, lang string, source string")
    more = docs.unionByName(more.withColumn("n_chars", F.lit(0).cast("long")).withColumns({c: F.concat(F.lit(c + "-"), F.col("doc_id").cast("string")) for c in NAMES}))
    runs = {t.name for t in spark.catalog.listTables()}
    out = P.line_stage(spark, more, "")
    assert {t.name for t in spark.catalog.listTables()} == runs
    kept_as_given(out, more)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == more.count() and got[51]["text"] == "" and got[51]["n_chars"] == 0 and got[21]["text"] == ""
    assert got[50]["text"].endswith("two of them") and got[31]["text"] == LONG + " end"


def test_line_dedup_keeps_clashing_names(spark):
    df = spark.createDataFrame([(1, "one line of text", 5, 6), (2, "one line of text", 7, 8)], "doc_id long, text string, _tag int, hash int")
    got = sorted(tuple(r) for r in line_dedup(df).select("doc_id", "_tag", "hash", "n_dropped", "kept_text").collect())
    assert got == [(1, 5, 6, 0, "one line of text"), (2, 7, 8, 1, "")]


def test_near_duplicate_stage(spark, docs):
    out = P.near_duplicate_stage(spark, docs, "")
    kept_as_given(out, docs)
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(rows) == len(set(rows)) and rows.count((40, EN + " twice")) <= 1
    ids = [i for i, _ in rows]
    assert 30 in ids and 31 not in ids and ids.count(None) == 1 and {21, 22, 23, 24} <= set(ids)
    assert (40, DE + " and another text under the id") in rows


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_stages_of_nothing(spark, docs, stage):
    assert stage(spark, docs.limit(0), "").count() == 0


def test_whole_pipeline(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} >= {1, 11, 30} and max(r["offset"] + r["length"] for r in out) <= 2048


def test_language_against_a_plain_loop(spark, docs):
    """Sizes by one compressor per block and language, without Spark."""
    import zstandard

    dictionaries = langid.learn(docs, "doc_id", "text", "lang")
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], round(r["score"], 12)) for r in langid.identify(docs, dictionaries, keep=["doc_id", "text"]).collect()}
    assert sorted(dictionaries) == ["de", "en"]
    params = zstandard.ZstdCompressionParameters(
        window_log=18, strategy=zstandard.STRATEGY_GREEDY, min_match=4, hash_log=17, chain_log=17, search_log=4, target_length=32, write_content_size=False, write_checksum=False
    )
    for (i, text), (lang, score) in got.items():
        if not text or not any(map(str.isalpha, text)):
            assert (lang, score) == ("und", 0.0)
            continue
        raw, sizes = text.lower().encode(), {}
        n = max(1, -(-len(raw) // langid.BLOCK_BYTES))
        for name, d in dictionaries.items():
            c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)
            sizes[name] = max(1, sum(len(c.compress(raw[k * len(raw) // n : (k + 1) * len(raw) // n])) - len(c.compress(b"")) for k in range(n)))
        best, other = sorted(sizes, key=lambda x: (sizes[x], x))
        assert (lang, score) == (best, round(1 - sizes[best] / sizes[other], 12))


def test_shared_passages_are_encoded_once():
    """Documents that share passages of a few hundred words, but no copies: most bytes of later ones come from kept chunks."""
    rnd = random.Random(4)
    draw = lambda n: " ".join("".join(rnd.choices("abcdefghij", k=rnd.randrange(2, 9))) for _ in range(n))
    passages = [draw(400) for _ in range(5)]
    enc, texts = encoder(default_path()), []
    for _ in range(40):
        texts.append(" ".join([draw(60), rnd.choice(passages), draw(60), rnd.choice(passages)]))
    reuse = ChunkReuse(enc)
    for t in texts:
        assert np.array_equal(reuse.encode(t), enc.encode(t))
    assert reuse.reused > 0.6 * (reuse.reused + reuse.encoded)


def share_sent(spark, df, **kw):
    asked, placed = topk.deal(df, 10, "vec_id", "embedding", 1024, 100, kw.get("pivots"))
    sizes = placed.groupBy("cell", "block", "part").count()
    pairs = asked.groupBy("cell", "block", "part").agg(F.count("*").alias("q")).join(sizes, ["cell", "block", "part"]).agg(F.sum(F.col("q") * F.col("count"))).first()[0]
    return pairs / (df.where("vec_id % 100 = 0").count() * df.count()), placed.count() / df.count()


def test_cells_are_pruned_and_vectors_travel_once(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    v = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.02
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    share, sent = share_sent(spark, df, pivots=120)
    assert share < 0.25 and sent <= 1.0
    flat = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(1500, 16)))], "vec_id long, embedding array<double>")
    assert share_sent(spark, flat)[1] <= 1.0
    ints = np.floor(1024 * v).astype(np.int64)
    want = set()
    for q in range(0, 4000, 100):
        s = ints @ ints[q]
        order = [int(i) for i in np.lexsort((np.arange(4000), -s)) if i != q][:10]
        want |= {(q, r, i, int(s[i])) for r, i in enumerate(order, 1)}
    assert {tuple(r) for r in topk.top_k(df, pivots=120).collect()} == want


def test_solver_beside_a_session(spark):
    """Threads of numpy's linear algebra may be lost once the JVM runs: the solver must end without them."""
    a = np.random.default_rng(0).random((300, 300))
    assert spark.range(3).count() == 3 and a.shape == (300, 300)
    faulthandler.dump_traceback_later(240, exit=True)
    try:
        for counts in ({s: s % 7 + 1 for s in range(1, 129)}, {s: s * 7919 % 1009 + 1 for s in range(1, 129)}):
            used = dict.fromkeys(counts, 0)
            for times, pattern in solve(counts, 128):
                for s, n in pattern.items():
                    used[s] += times * n
            assert used == counts
    finally:
        faulthandler.cancel_dump_traceback_later()
