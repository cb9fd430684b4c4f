"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .bpe import bpe_decode, bpe_encode
from .common import scratch_path, table
from .divergence import divergence_audit
from .exact_dedup import exact_dedup
from .licence_texts import BODIES, TEMPLATES, VARIANTS, VERSIONS
from .licences import COMMENT, LEAST_COSINE, numbered, scan
from .line_dedup import line_dedup
from .minhash import near_duplicates
from .pack import pack
from .ranked_search import ranked_search
from .records import read_token_index, read_token_records, write_token_records
from .topk import top_k
from .url_filter import url_filter
from .warc import parse_records, read_records, write_archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return register


@query("op1_minhash_bayes")
def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


@query("op2_language_id")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    dictionaries = langid.learn(docs.where(~held_out), "doc_id", "text", "lang")
    out = langid.identify(docs.withColumn("held_out", held_out), dictionaries, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query("op3_bpe_chunks")
def op3(spark, sf_dir):
    out = bpe_decode(bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op4_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), w AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w""",
)
def op4(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


_ENTRIES = numbered(TEMPLATES, BODIES)
_NOTICES = ", ".join("({}, '{}', '{}', {})".format(k, name, x.replace("'", "''"), body) for k, name, x, body in _ENTRIES)
_TOLD = ", ".join(f"('{w}', {w in VERSIONS})" for w in [*VARIANTS, *VERSIONS])
_TERM_LIST = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda t: t <> '')"
_TERMS = f"unnest({_TERM_LIST})"


@query(
    "op5_licence_scan",
    f"""
WITH tpl(k, licence, notice, body) AS (VALUES {_NOTICES}),
tt AS (SELECT k, term, count(*) AS tf FROM (SELECT k, {_TERMS.format('notice')} AS term FROM tpl) GROUP BY ALL),
told(word, version) AS (VALUES {_TOLD}),
versioned AS (SELECT DISTINCT k FROM tt JOIN told ON word = term AND version),
guard AS (SELECT tpl.k, word, tt.term IS NOT NULL AS wanted FROM tpl CROSS JOIN told LEFT JOIN tt ON tt.k = tpl.k AND tt.term = word
          WHERE NOT version OR (NOT body AND tpl.k IN (SELECT k FROM versioned))),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, {_TERMS.format('text')} AS term FROM documents))
       WHERE term IN (SELECT term FROM tt) GROUP BY term),
idf AS (SELECT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), n),
tw AS (SELECT k, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY k)) AS w FROM tt JOIN idf USING (term)),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
m AS (SELECT *, regexp_extract(line, '{COMMENT}', 1) AS mark, len({_TERM_LIST.format('line')}) = 0 AS bare FROM l),
b AS (SELECT *, coalesce(mark <> lag(mark) OVER o, true) AS turn, bare <> coalesce(lag(bare) OVER o, true) AS gap
      FROM m WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
c AS (SELECT *, count(*) FILTER (WHERE turn) OVER o AS run, count(*) FILTER (WHERE turn OR gap) OVER o AS part
      FROM b WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
u AS (SELECT doc_id, 'line' AS kind, line_no AS no, line_no, line FROM c WHERE NOT bare
      UNION ALL SELECT doc_id, 'block', part, line_no, line FROM c WHERE NOT bare
      UNION ALL SELECT doc_id, 'run', run, line_no, line FROM c WHERE NOT bare
      UNION ALL SELECT doc_id, 'file', 0, line_no, line FROM c WHERE NOT bare),
e AS (SELECT doc_id, kind, no, min(line_no) AS line_no, max(line_no) - min(line_no) + 1 AS n_lines FROM u GROUP BY ALL),
lt AS (SELECT doc_id, kind, no, term, count(*) AS tf FROM (SELECT doc_id, kind, no, {_TERMS.format('line')} AS term FROM u) GROUP BY ALL),
lw AS (SELECT doc_id, kind, no, term, tf * coalesce(idf, ln(n + 1) + 1) AS w FROM lt LEFT JOIN idf USING (term), n),
norm AS (SELECT doc_id, kind, no, sqrt(sum(w * w)) AS norm FROM lw GROUP BY ALL),
dots AS (SELECT doc_id, kind, no, k, sum(lw.w * tw.w) AS dot FROM lw JOIN tw USING (term) GROUP BY ALL),
cos AS (SELECT doc_id, kind, no, k, round(dot / norm, 9) AS cosine FROM dots JOIN norm USING (doc_id, kind, no)
        WHERE round(dot / norm, 9) >= {LEAST_COSINE}),
wrong AS (SELECT DISTINCT cos.doc_id, cos.kind, cos.no, cos.k FROM cos JOIN guard USING (k)
          LEFT JOIN lt ON lt.doc_id = cos.doc_id AND lt.kind = cos.kind AND lt.no = cos.no AND lt.term = word
          WHERE wanted <> (lt.term IS NOT NULL)),
own AS (SELECT doc_id, line_no, n_lines, licence, cosine
        FROM cos ANTI JOIN wrong USING (doc_id, kind, no, k) JOIN e USING (doc_id, kind, no) JOIN tpl USING (k)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, line_no, n_lines, licence) = 1),
p AS (SELECT doc_id, coalesce(source, 'none') || '/' || regexp_replace(left(CAST(doc_id AS VARCHAR), -1), '([0-9])', '\\1/', 'g') AS stem FROM documents),
f AS (SELECT doc_id, stem || doc_id AS path, left(stem, -1) AS folder FROM p),
h AS (SELECT folder, licence FROM f JOIN own USING (doc_id)
      QUALIFY row_number() OVER (PARTITION BY folder ORDER BY path) = 1),
a AS (SELECT f.doc_id, h.licence, h.folder FROM f JOIN h ON f.folder = h.folder OR starts_with(f.folder, h.folder || '/')
      QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(h.folder) DESC) = 1)
SELECT f.doc_id, f.path, CAST(line_no AS INTEGER) AS line_no, CAST(n_lines AS INTEGER) AS n_lines, own.licence AS licence, cosine,
       a.licence AS inherited, a.folder AS inherited_from
FROM f LEFT JOIN own USING (doc_id) LEFT JOIN a ON a.doc_id = f.doc_id""",
)
def op5(spark, sf_dir):
    """Documents as files ``source/1/2/3/1234``: a folder a digit of the id but the last, so shorter ids stand further up.

    A document with a notice is its directory's licence file, for all directories below that have none.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    name = F.col("doc_id").cast("string")
    folders = F.regexp_replace(F.regexp_replace(name, ".$", ""), "([0-9])", "$1/")
    path = F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), folders, name)
    out = scan(docs.select(path.alias("path"), "text"), is_licence_file=F.lit(True))
    return out.withColumn("doc_id", F.element_at(F.split("path", "/"), -1).cast("long")).select("doc_id", *out.columns)


@query("op6_url_filter")
def op6(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))


@query(
    "op7_voronoi_topk",
    """
WITH b AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM b q JOIN b d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
)
def op7(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op8_pack")
def op8(spark, sf_dir):
    out = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query(
    "op9_line_dedup",
    r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
f AS (SELECT k.*, o.owner IS NOT NULL AND k.doc_id > o.owner AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id""",
)
def op9(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op10_warc_archive",
    """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest,
             CASE WHEN octet_length(b) >= 1000 THEN max(page_id) OVER (PARTITION BY b) ELSE page_id END AS holder FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM q""",
)
def op10(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    out = parse_records(read_records(spark, path))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_RANK_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"


@query(
    "op11_ranked_search",
    f"""
WITH t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_RANK_TERMS} AS term FROM documents) GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
m AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM d, c),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_RANK_TERMS} AS term FROM benchmark)),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM i JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n FROM s WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM r WHERE n <= 10""",
)
def op11(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


_SHARE = "1 + CAST(CAST({} + 5 AS HUGEINT) * 1000000000 // ({} + 5 * v) AS BIGINT)"
_LETTERS = _RANK_TERMS.replace(r"\x00-\x2F\x3A-\x40", r"\x00-\x40")


@query(
    "op12_divergence_audit",
    f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT k, lang, source, term, count(*) AS tf FROM (SELECT k, lang, source, {_LETTERS} AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, CAST(sum(tf) AS BIGINT) AS lc FROM t GROUP BY ALL HAVING count(*) >= 30),
lv AS (SELECT lang, count(*) AS v, CAST(sum(lc) AS BIGINT) AS ln FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(sum(tf) AS BIGINT) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c, {_SHARE.format('coalesce(c, 0)', 'coalesce(n, 0)')} AS p, {_SHARE.format('lc', 'ln')} AS q
      FROM g JOIN kept USING (lang) JOIN lv USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS f
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 50""",
)
def op12(spark, sf_dir):
    return divergence_audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query("op13_token_records")
def op13(spark, sf_dir):
    path = scratch_path(spark, "records")
    write_token_records(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    out = read_token_records(read_token_index(spark, path), path)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))
