"""Language identification by compression: the language whose dictionary makes the text smallest.

Per language, a raw-content zstandard dictionary is made of a bounded sample of labelled texts. A text is compressed
with each in blocks, all of them and each on its own, so that its own history never stands in for the dictionary; the
smallest sum wins. Where the runner-up is nearly as small, the text is rejected.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Documented bound of the sample: texts per language, and bytes of a language's dictionary.
SAMPLE_ROWS = 300
DICTIONARY_BYTES = 112 << 10
#: Most bytes of a block. Shorter than a dictionary, and short enough for zstandard to refer to it without copying it.
BLOCK_BYTES = 16 << 10
UNKNOWN = "und"


def learn(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary of each language from the ``rows`` labelled texts with the smallest hash of their id.

    No text fills more than a tenth of a dictionary. Rows without text or language teach nothing.
    """
    ids = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    ids = ids.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.xxhash64(F.col(id_col).cast("string")).alias("_h"))
    # The rank limit is applied within each task first: a language with most rows sends no more than the others.
    ranked = ids.withColumn("_r", F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_id")))
    chosen = ranked.where(F.col("_r") <= rows).select("_id", "_lang", "_h")
    small = labelled.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    texts = labelled.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.substring(text_col, 1, size // 10).alias("_t"))
    picked = texts.where("_t is not null").join(F.broadcast(small), ["_id", "_lang"]).collect()  # rows x languages
    out: dict[str, bytes] = {}
    for lang in sorted({r["_lang"] for r in picked}):
        seen, parts, held = set(), [], 0
        for r in sorted((r for r in picked if r["_lang"] == lang), key=lambda r: (r["_h"], r["_t"])):
            raw = r["_t"].lower().encode("utf-8")[: size // 10]
            if held + len(raw) <= size and raw and raw not in seen:
                seen.add(raw)
                parts.append(raw)
                held += len(raw)
        if parts:
            out[lang] = b"\n".join(parts)
    return out


@functools.lru_cache(4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]):
    """Matches from four bytes on, since most of what tells languages apart is short."""
    params = zstandard.ZstdCompressionParameters(
        window_log=18, strategy=zstandard.STRATEGY_GREEDY, min_match=4, hash_log=17, chain_log=17, search_log=4,
        target_length=32, write_content_size=False, write_checksum=False,
    )
    out = []
    for _, raw in dictionaries:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
    return out


def _letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _blocks(raw: bytes, most: int = BLOCK_BYTES) -> list[bytes]:
    """``raw`` in as few blocks of at most ``most`` bytes as there can be, all about equally long."""
    n = max(1, -(-len(raw) // most))
    ends = [i * len(raw) // n for i in range(n + 1)]
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_margin: float = 0.0,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per input row: the columns ``keep`` (default: the id), ``lang_pred``, ``score``, ``rejected``.

    ``score`` is the margin, 1 - smallest / second smallest size without the frames' own bytes (1 with one language).
    A size is the sum over the text's blocks, so the margin does not shrink with the length of a text.
    ``rejected`` where the margin is not above ``min_margin``. Texts that are NULL or hold no letter, and all texts if
    there is no dictionary, are ``und``, score 0, rejected. Ties go to the first language by name. Whole texts count.
    """
    keep = [id_col] if keep is None else keep
    given = tuple(sorted(dictionaries.items()))
    langs = [lang for lang, _ in given]
    kept = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_text")
    names = [*kept.columns[1:], "lang_pred", "score", "rejected"]

    def run(batches):
        made = _compressors(given)
        empty = [len(c.compress(b"")) for c in made]
        for b in batches:
            for start in range(0, b.num_rows, 1000):
                part = b.slice(start, 1000)
                pred, score, rejected = [], [], []
                for cell in part.column(0):
                    text = cell.as_py()
                    if text is None or not made or not _letter(text):
                        pred.append(UNKNOWN), score.append(0.0), rejected.append(True)
                        continue
                    blocks = _blocks(text.lower().encode("utf-8"))
                    sizes = np.array([max(1, sum(len(c.compress(x)) - e for x in blocks)) for c, e in zip(made, empty)])
                    order = np.argsort(sizes, kind="stable")
                    margin = 1 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0
                    pred.append(langs[order[0]]), score.append(float(margin)), rejected.append(bool(margin <= min_margin))
                extra = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *extra], names)
            pa.default_memory_pool().release_unused()  # the worker lives on: give freed batches back

    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")
