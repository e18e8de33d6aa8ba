"""LM scoring with a weighted backoff automaton learned from the corpus itself.

The model is an interpolated bigram model with three discounts estimated from the counts of
counts (as in modified Kneser-Ney smoothing) over an additively smoothed unigram model.  As
an automaton: every word that was seen before another is a state, the root is the state
without context; a seen bigram is an arc with its smoothed log-probability, and each state
has a failure arc to the root with its backoff weight.  A text is read once, left to right:
an arc if there is one, else the failure arc and the root's arc; the weights add up to the
text's log10 probability, its end included.

The automaton of the whole corpus is never held anywhere.  Chunks of documents ask hash parts
for the counts of the n-grams they hold, with the counts they contribute (``wire``), and each
builds the arcs and states its own texts use:

1. chunks send their distinct bigrams with counts in training documents;
2. parts answer with the corpus counts, and name one *owner* among the chunks that hold a bigram;
3. chunks send their distinct words with counts, and how many owned bigrams with count one,
   two, and three or more follow each (so a frequent word's followers are counted by all
   chunks, and no task gathers them);
4. parts answer with the corpus sums, and all totals;
5. chunks score their texts.

Defined results: a null text is empty and scores its end only; documents with a null id are
training documents; equal rows count as often as they occur; with nothing to learn from,
every token has the probability of an unknown one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from baton.llm.text import NOT_SPACE, U64, flat, lower, mix, word_hashes, word_spans
from baton.llm.wire import MESSAGE, chunked, in_order, incoming, messages, n_chunks, pack, sort_by_part, text_bytes, unpack

#: The tokens that end and (as a context only) begin every text.
END, START = U64(0x51ED270B9F5A3C17), U64(0xA24BAED4963EE407)
RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def held_out(ids: pa.ChunkedArray, folds: int, fold: int) -> np.ndarray:
    """Whether crc32 of each id as text falls into the fold that is kept out; null is not."""
    return np.array([i is not None and zlib.crc32(str(i).encode()) % folds == fold for i in ids.to_pylist()], dtype=bool)


class Chunk:
    """The tokens of a chunk's documents, its distinct words and bigrams, and their training counts."""

    def __init__(self, table: pa.Table, folds: int, fold: int):
        self.ids = table.column("id")
        self.out = held_out(self.ids, folds, fold)
        data, offsets = flat(table.column("text"))
        data = lower(data)
        start, end, bounds = word_spans(data, offsets, NOT_SPACE)
        words = word_hashes(data, start, end)
        del data, start, end
        n = len(bounds) - 1
        self.bounds = bounds + np.arange(n + 1)  # one end token each
        tokens = np.empty(len(words) + n, U64)
        body = np.ones(len(tokens), bool)
        body[self.bounds[1:] - 1] = False
        tokens[body] = words
        tokens[~body] = END
        before = np.empty(len(tokens), U64)
        before[1:] = tokens[:-1]
        before[self.bounds[:-1]] = START
        self.train = np.repeat(~self.out, np.diff(self.bounds))
        self.words, self.word = np.unique(np.concatenate([tokens, [START]]), return_inverse=True)
        self.word, self.start = self.word[:-1].astype(np.int32), int(self.word[-1])
        self.context = np.empty(len(tokens), np.int32)
        self.context[1:] = self.word[:-1]
        self.context[self.bounds[:-1]] = self.start
        key = mix(before * U64(0x9E3779B97F4A7C15) + tokens, seed=11)
        del before, tokens
        self.keys, first, self.bigram = np.unique(key, return_index=True, return_inverse=True)
        self.bigram = self.bigram.astype(np.int32)
        self.bigram_context = self.context[first]

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct word: as a token, and as a context, in training documents."""
        n = len(self.words)
        return np.bincount(self.word[self.train], minlength=n), np.bincount(self.context[self.train], minlength=n)

    def words_by_part(self, parts: int):
        """The order in which words are sent, and the offsets of the parts in it."""
        return sort_by_part((mix(self.words, seed=12) % U64(parts)).astype(np.int64), parts)

    def bigrams_by_part(self, parts: int):
        """The same for bigrams, and what is sent of each: 40 bits within its part.  Two bigrams
        that fall together count together; with parts that grow with the corpus, that stays rarer
        than one in a hundred thousand."""
        part, short = (mix(self.keys, seed=12) % U64(parts)).astype(np.int64), mix(self.keys, seed=13) >> U64(24)
        order = np.lexsort((short, part))
        return order, np.searchsorted(part[order], np.arange(parts + 1)), short[order]


def gaps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, which pack better."""
    return np.diff(keys, prepend=U64(0))


def ask_bigrams(table: pa.Table, folds: int, fold: int, parts: int) -> pa.Table:
    if not table.num_rows:
        return messages([])
    number = table.column("chunk")[0].as_py()
    c = Chunk(in_order(table), folds, fold)
    counts = np.bincount(c.bigram[c.train], minlength=len(c.keys)).astype(np.uint32)
    order, at, short = c.bigrams_by_part(parts)
    return messages((p, number, pack(gaps(short[at[p]:at[p + 1]]), counts[order[at[p]:at[p + 1]]])) for p in np.flatnonzero(np.diff(at)).tolist())


def count_bigrams(table: pa.Table, chunks: int) -> pa.Table:
    """Corpus counts of each bigram, for the chunks that asked, and who owns it."""
    got = dict(incoming(table))
    if not got:
        return messages([])
    part = table.column("dst")[0].as_py()
    keys, place = np.unique(np.concatenate([np.cumsum(a[0], dtype=U64) for a in got.values()]), return_inverse=True)
    mine = np.concatenate([a[1] for a in got.values()])
    total = np.bincount(place, weights=mine, minlength=len(keys)).astype(np.uint32)
    # the owner: the first that holds it in a training document
    holders = np.flatnonzero(mine > 0)
    own = np.zeros(len(place), bool)
    own[holders[np.unique(place[holders], return_index=True)[1]]] = True
    tally = np.bincount(np.minimum(total, 5), minlength=6)[1:5].astype(np.int64)
    out, at = [], 0
    for s in range(chunks):  # every chunk hears this part's counts of counts
        n = len(got[s][0]) if s in got else 0
        out.append((s, part, pack(total[place[at:at + n]], np.packbits(own[at:at + n]), tally)))
        at += n
    return messages(out)


def ask_words(table: pa.Table, replies: pa.Table, folds: int, fold: int, parts: int) -> pa.Table:
    if not table.num_rows:
        return messages([])
    number = table.column("chunk")[0].as_py()
    c = Chunk(in_order(table), folds, fold)
    order, at, _ = c.bigrams_by_part(parts)
    total, own = np.zeros(len(c.keys), np.uint32), np.zeros(len(c.keys), bool)
    tally = np.zeros(4, np.int64)
    for p, (t, o, n) in incoming(replies):
        i = order[at[p]:at[p + 1]]
        total[i], own[i] = t, np.unpackbits(o, count=len(i)).astype(bool)
        tally += n
    n = len(c.words)
    follow = [np.bincount(c.bigram_context[own & hit], minlength=n).astype(np.uint32) for hit in (total == 1, total == 2, total > 2)]
    tokens, contexts = (x.astype(np.uint32) for x in c.word_counts())
    order, at = c.words_by_part(parts)
    home = number % parts
    out = []
    for p in sorted({*np.flatnonzero(np.diff(at)).tolist(), home}):
        i = order[at[p]:at[p + 1]]
        note = pack(total, tally) if p == home else b""  # this chunk's own note for the last step
        out.append((p, number, pack(gaps(c.words[i]), tokens[i], contexts[i], *(f[i] for f in follow), np.frombuffer(note, np.uint8))))
    return messages(out)


def count_words(table: pa.Table, chunks: int) -> pa.Table:
    got = dict(incoming(table))
    if not got:
        return messages([])
    part = table.column("dst")[0].as_py()
    keys, place = np.unique(np.concatenate([np.cumsum(a[0], dtype=U64) for a in got.values()]), return_inverse=True)
    sums = [np.bincount(place, weights=np.concatenate([a[i] for a in got.values()]), minlength=len(keys)).astype(np.int64) for i in range(1, 6)]
    whole = np.array([sums[0].sum(), (sums[0] > 0).sum()], np.int64)  # training tokens and distinct ones
    out, at = [], 0
    for s in range(chunks):
        n = len(got[s][0]) if s in got else 0
        i = place[at:at + n]
        out.append((s, part, pack(*(x[i] for x in sums), whole, got[s][6] if s in got else np.zeros(0, np.uint8))))
        at += n
    return messages(out)


def discounts(tally: np.ndarray) -> np.ndarray:
    """Discounts of bigrams seen once, twice, and more often, from how many there are of each count."""
    n1, n2, n3, n4 = (float(x) for x in tally)
    if not n1 or not n2:
        return np.array([0.75, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return np.clip([d1, d2, d3], 0.05, [0.98, 1.95, 2.9])


def score_chunk(table: pa.Table, replies: pa.Table, folds: int, fold: int, parts: int) -> pa.Table:
    if not table.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()),
                         "n_known": pa.array([], pa.int64()), "train_tokens": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()),
                         "score": pa.array([], pa.float64())})
    c = Chunk(in_order(table), folds, fold)
    order, at = c.words_by_part(parts)
    sums = np.zeros((5, len(c.words)), np.int64)
    total, tally, whole = np.zeros(len(c.keys), np.int64), np.zeros(4, np.int64), np.zeros(2, np.int64)
    for p, (*s, w, note) in incoming(replies):
        sums[:, order[at[p]:at[p + 1]]] = s
        whole += w
        if len(note):
            total, tally = unpack(note.tobytes())
    count, context, one, two, more = sums
    n_train, v_train = (float(x) for x in whole)

    # the automaton of this chunk: root arcs, failure weights, bigram arcs
    unigram = (count + 0.5) / (n_train + 0.5 * (v_train + 1))
    d = discounts(tally)
    state = context > 0
    safe = np.maximum(context, 1)
    failure = np.where(state, (d[0] * one + d[1] * two + d[2] * more) / safe, 1.0)
    total = total.astype(float)
    off = np.select([total == 0, total == 1, total == 2], [0.0, d[0], d[1]], d[2])
    word = np.zeros(len(c.keys), np.int32)
    word[c.bigram] = c.word
    has_arc = total > 0
    h = c.bigram_context
    arc = np.where(has_arc, (total - off) / safe[h] + failure[h] * unigram[word], 1.0)
    root_arc, failure_arc, arc = np.log10(unigram), np.log10(np.maximum(failure, 1e-300)), np.log10(arc)

    # one traversal of every text: the state before a token is the word before it, if that is a state
    taken = has_arc[c.bigram]
    weight = np.where(taken, arc[c.bigram], failure_arc[c.context] + root_arc[c.word])

    def per_doc(x):
        return np.add.reduceat(x, c.bounds[:-1])

    n = len(c.ids)
    return pa.table({
        "doc_id": c.ids, "held_out": pa.array(c.out), "n_tokens": pa.array(np.diff(c.bounds).astype(np.int64)),
        "n_known": pa.array(per_doc((count[c.word] > 0).astype(np.int64))), "train_tokens": pa.array(np.full(n, int(whole[0]), np.int64)),
        "base_score": pa.array(per_doc(root_arc[c.word])), "score": pa.array(per_doc(weight))})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, fold: int = 1,
                    chunks: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document,
    learned from those whose crc32(id as text) modulo ``folds`` is not ``fold``."""
    docs = docs.withColumn(id_col, docs[f"`{id_col}`"].cast("bigint"))
    chunks = chunks or n_chunks(docs.sparkSession, text_bytes(docs, text_col))
    parts = chunks
    texts = chunked(docs, id_col, text_col, chunks)
    asked = texts.groupBy("chunk").applyInArrow(lambda t: ask_bigrams(t, folds, fold, parts), MESSAGE)
    bigrams = asked.groupBy("dst").applyInArrow(lambda t: count_bigrams(t, chunks), MESSAGE)
    words = texts.groupBy("chunk").cogroup(bigrams.groupBy("dst")).applyInArrow(lambda t, r: ask_words(t, r, folds, fold, parts), MESSAGE)
    sums = words.groupBy("dst").applyInArrow(lambda t: count_words(t, chunks), MESSAGE)
    return texts.groupBy("chunk").cogroup(sums.groupBy("dst")).applyInArrow(lambda t, r: score_chunk(t, r, folds, fold, parts), RESULT)
