"""Token counts: an exact histogram of encoded lengths, and what its sums answer.

Every whole text is encoded by a public byte-pair tokenizer (its file is a parameter; the
ranks, a few MB, are broadcast) and only its length is kept; the lengths are counted per
task before the one small shuffle.  Sums over the histogram then answer, for any context
limit, how many documents and tokens fit, how many tokens remain if texts are cut at the
limit, and which length is a quantile.

Defined results: a null text has length 0, as an empty one; no documents give no rows; texts of
any length count, also single runs of millions of characters.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baton.llm.wire import stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Ranks larger than this are not broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
#: Fixed value: the pattern by which byte-level BPE vocabularies of this kind split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Histogram rows whose sums are taken together; the blocks' totals are summed afterwards.
BLOCK = 256

_ENCODERS: dict[int, object] = {}


def encoder(raw: bytes, pattern: str = PATTERN):
    """The tokenizer of a vocabulary file's bytes, built once per worker."""
    key = hash((raw, pattern))
    if key not in _ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def encoded_length(enc, text: str | None, pattern: str = PATTERN) -> int:
    """How many tokens a text has.

    The tokenizer's own splitter gives up on very long runs (about a million spaces or
    letters): its matcher backtracks on a stack.  Such a text is split by the same pattern
    with an iterative matcher, and its pieces are encoded one by one, which is the same.
    """
    if not text:
        return 0
    try:
        return len(enc.encode_ordinary(text))
    except BaseException as e:  # a panic of the native code is no Exception
        if type(e).__name__ != "PanicException":
            raise
    return sum(len(enc._encode_single_piece(piece)) for piece in pieces(text, pattern))


def pieces(text: str, pattern: str = PATTERN) -> Iterator[str]:
    """The pieces of a text that are encoded on their own."""
    import regex

    # white space as the tokenizer means it; regex's own class has four characters more
    same = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return (m.group() for m in regex.finditer(same, text))


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return raw


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(sent.value, pattern)
        seen: Counter[int] = Counter()
        for batch in batches:
            for t in batch.column(0):  # one text at a time: nothing but its length is kept
                seen[encoded_length(enc, t.as_py(), pattern)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["n_tokens", "n"])

    return (docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "n_tokens bigint, n bigint")
            .groupBy("n_tokens").agg(F.sum("n").alias("n_docs")))


def with_sums(hist: DataFrame) -> DataFrame:
    """The histogram with, for each length taken as a context limit: ``docs_longer`` and
    ``tokens_longer`` (suffix sums), ``docs_fit`` and ``tokens_fit``, ``truncated_tokens`` if
    texts are cut there, and ``quantile``, the share of documents that fit.

    Sums run within blocks of lengths and over the blocks' totals, so no task holds the
    histogram of all lengths.
    """
    h = hist.select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / BLOCK).alias("block"), (F.col("n_tokens") * F.col("n_docs")).alias("tokens"))
    totals = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                           F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    h = h.join(totals, "block").withColumn("docs_longer", F.col("d_above") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0)))
    h = h.withColumn("tokens_longer", F.col("t_above") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return h.select("n_tokens", "n_docs", "docs_longer", "tokens_longer", (F.col("d_all") - F.col("docs_longer")).alias("docs_fit"),
                    (F.col("t_all") - F.col("tokens_longer")).alias("tokens_fit"),
                    (F.col("t_all") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_tokens"),
                    ((F.col("d_all") - F.col("docs_longer")) / F.col("d_all")).alias("quantile"))


def _lower_row(sums: DataFrame, limit: int, value: Column) -> int:
    row = sums.where(F.col("n_tokens") <= limit).agg(F.max_by(value, F.col("n_tokens"))).first()[0]
    return 0 if row is None else int(row)


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens that remain if every text is cut at ``limit``, also between lengths that occur."""
    if not sums.where(F.col("n_tokens") <= limit).head(1):
        return limit * int(sums.agg(F.sum("n_docs")).first()[0] or 0)
    return _lower_row(sums, limit, F.col("truncated_tokens") + (F.lit(limit) - F.col("n_tokens")) * F.col("docs_longer"))


def length_quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least a share q of the documents does not exceed."""
    return sums.where(F.col("quantile") >= q).agg(F.min("n_tokens")).first()[0]


def token_counts(spark: SparkSession, docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The histogram of all texts with its sums.  The histogram is stored: its sums read it
    several times, the texts are encoded once."""
    return with_sums(stored(length_histogram(docs, text_col, vocabulary)))
