"""The registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.llm import toxicity, warc
from baton.llm.decontaminate import decontaminate
from baton.llm.html_text import extract_text
from baton.llm.jaccard_join import jaccard_components
from baton.llm.lm import score_documents
from baton.llm.mixing import mix_sources
from baton.llm.periodic_runs import periodic_runs
from baton.llm.substring_dedup import dedup_words
from baton.llm.suffix_array_dedup import dedup_bytes
from baton.llm.token_counts import token_counts
from baton.llm.topk import top_k
from baton.llm.vector_codes import Codebooks, compress
from baton.llm.wire import stored

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

#: Words as the contracts define them, for SQL.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register("op1_substring_dedup", f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    s AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS k
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS p FROM d)),
    hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS n FROM s) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM hit),
    word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS t FROM d),
    kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS k
             FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(k, '')) AS kept_sha256
    FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op1_substring_dedup(spark, sf_dir):
    return dedup_words(documents(spark, sf_dir))


@register("op4_suffix_array_dedup", """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
    s AS (SELECT doc_id, p, substr(hx, 2 * p + 1, 200) AS k
          FROM (SELECT doc_id, hx, unnest(range(0, greatest(length(hx) // 2 - 99, 0))) AS p FROM d)),
    hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM s)
            WHERE r > 1),
    step AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS f FROM hit),
    isle AS (SELECT doc_id, p, sum(f) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM step),
    runs AS (SELECT doc_id, g, min(p) AS a, max(p) + 100 AS b FROM isle GROUP BY doc_id, g),
    segs AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s0, a AS e0 FROM runs
             UNION ALL
             SELECT doc_id, coalesce(max(b), 0), any_value(length(hx)) // 2 FROM d LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(substr(hx, 2 * s0 + 1, 2 * (e0 - s0)), '' ORDER BY s0, e0) AS k
             FROM segs JOIN d USING (doc_id) GROUP BY doc_id),
    cut AS (SELECT doc_id, sum(b - a) AS n, count(*) AS c FROM runs GROUP BY doc_id)
    SELECT d.doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(c, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
    FROM d JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)""")
def op4_suffix_array_dedup(spark, sf_dir):
    return dedup_bytes(documents(spark, sf_dir))


@register("op2_exact_topk", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20""")
def op2_exact_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    return token_counts(spark, table(spark, sf_dir, "documents").select("text"))


@register("op5_lm_scoring")
def op5_lm_scoring(spark, sf_dir):
    return score_documents(documents(spark, sf_dir))


@register("op6_html_extraction")
def op6_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.severity_grade(), keep_toxic=True)
    return toxicity.severity(docs, model)


@register("op8_mixing")
def op8_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


@register("op9_decontamination", r"""
    WITH low AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, doc_id FROM documents),
    d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, z, array_to_string(w[p:p + z - 1], ' ') AS k
           FROM (SELECT item_id, w, least(len(w), 10) AS z, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0)),
    dw AS (SELECT doc_id, z, p, array_to_string(w[p:p + z - 1], ' ') AS k
           FROM (SELECT doc_id, w, z, unnest(range(1, greatest(len(w) - z + 2, 1))) AS p FROM d, (SELECT DISTINCT z FROM bw))),
    m AS (SELECT doc_id, p, z, item_id FROM dw JOIN bw USING (z, k)),
    hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + z)) AS i FROM m) GROUP BY doc_id),
    held AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
             FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(held.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)""")
def op9_decontamination(spark, sf_dir):
    return decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@register("op10_jaccard_join", r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS k
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
    reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(min(reach.b), d.doc_id)) AS component_id
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n""")
def op10_jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


@register("op11_warc_archives", """
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           CASE WHEN strlen(html) >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN strlen(html) >= 1000 AND page_id <> m THEN m END AS refers_to
    FROM (SELECT *, max(page_id) OVER (PARTITION BY html) AS m FROM pages)""")
def op11_warc_archives(spark, sf_dir):
    packages = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.read_archives(spark, packages)
    return records.select(warc.row_id("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          warc.row_id("refers_to").cast("bigint").alias("refers_to"))


def _seed(ident: Column) -> Column:
    return F.crc32(ident.cast("string").cast("binary"))


def _planted(docs: DataFrame) -> DataFrame:
    """The input that the contract of op12 asks for: in a tenth of the documents, the words from
    a place on repeat the first of them."""
    @F.pandas_udf("string")
    def repeat(idents: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for ident, text in zip(idents, texts):
            words = text.encode().split() if text is not None else []
            if words:
                n, g = len(words), zlib.crc32(str(int(ident)).encode()) // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + i % p] for i in range(n - a)]
            out.append(None if text is None else b" ".join(words).decode())
        return pd.Series(out, dtype=object)

    chosen = F.coalesce(_seed(F.col("doc_id")) % 10 == 0, F.lit(False))
    # texts that stay as they are do not go through Python
    changed = repeat(F.coalesce("doc_id", F.lit(0)), F.when(chosen, F.col("text")))
    return docs.select("doc_id", F.when(chosen, changed).otherwise(F.col("text")).alias("text"))


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs(_planted(documents(spark, sf_dir)))
    runs = F.col("runs")
    # the greatest length / period, compared without rounding; of equal ones the first in order
    best = F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size(runs).cast("bigint").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("b.length * 1000 div b.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def codebooks_sha256(codebooks: Codebooks, length: int) -> str:
    """The digest of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for part in codebooks[length] for x in part.reshape(-1).tolist()).encode()).hexdigest()


def _codes_oracle() -> str:
    nearest = """a{r} AS (SELECT vec_id, j, v, min({{'d': list_sum(list_transform(range(1, len(v) + 1), lambda k: (v[k] - e[k]) * (v[k] - e[k]))), 'i': i}}) AS m
              FROM p JOIN e{r} USING (j) GROUP BY vec_id, j, v)"""
    moved = """c{r} AS (SELECT j, i, list(x ORDER BY k) AS e FROM (
                 SELECT j, m.i AS i, k, CAST(floor(sum(v[k]) / count(*)) AS BIGINT) AS x FROM a{r}, (SELECT unnest(range(1, 5)) AS k) GROUP BY ALL) GROUP BY j, i),
            e{s} AS (SELECT j, i, coalesce(c{r}.e, e{r}.e) AS e FROM e{r} LEFT JOIN c{r} USING (j, i))"""
    return f"""
    WITH w AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT vec_id, j, v[4 * j + 1:4 * j + 4] AS v FROM w, (SELECT unnest(range(0, 16)) AS j)),
    e0 AS (SELECT j, CAST(row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS BIGINT) AS i, v AS e FROM p
           WHERE vec_id IN (SELECT vec_id FROM w ORDER BY vec_id LIMIT 64)),
    {nearest.format(r=0)}, {moved.format(r=0, s=1)}, {nearest.format(r=1)}, {moved.format(r=1, s=2)}, {nearest.format(r=2)},
    code AS (SELECT vec_id, string_agg(printf('%02x', m.i), '' ORDER BY j) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
    books AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY j, i)) AS codebooks_sha256 FROM e2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM code JOIN w USING (vec_id), books"""


#: Labels whose sums are broadcast; more are joined by a shuffle, whose hot keys Spark splits.
BROADCAST_LABELS = 100_000


@register("op13_vector_codes", _codes_oracle())
def op13_vector_codes(spark, sf_dir):
    codes, codebooks = compress(table(spark, sf_dir, "embeddings"))
    codes = stored(codes)
    # a sum of longs need not be one: it is null then
    sums = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")).withColumnRenamed("label", "of")
    few = sums.count() <= BROADCAST_LABELS
    joined = codes.join(F.broadcast(sums) if few else sums.hint("merge"), F.col("label").eqNullSafe(F.col("of")))
    digest = F.lit("")
    for length in codebooks:
        digest = F.when(F.col("length") == length, F.lit(codebooks_sha256(codebooks, length))).otherwise(digest)
    return joined.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: " ".join(v.split()) for k, v in ORACLE.items()}
