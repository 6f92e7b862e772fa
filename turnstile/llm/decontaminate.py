"""Benchmark decontamination: an FM-index per training shard, searched for test phrases.

A test phrase is a window of consecutive item words (a shorter item is one
phrase).  Per shard of texts, only runs of words that could hold a phrase are
indexed: words of the test vocabulary whose neighbours form a word pair of
some test phrase.  The index is a suffix array, the Burrows-Wheeler transform
in a wavelet matrix, and suffix positions sampled at every ``SAMPLE``-th place
and at the start of each run.  All phrases are searched backwards at once by
ranks; occurrences are located by stepping back to a sampled position, checked
against the words themselves, and merged into spans.

The test set is taken in blocks of about ``block_bytes`` text.  One block after
another is broadcast, the texts are searched for it, its hits are written, and it is
released; the driver and the tasks hold one block at a time.  Hits of all blocks are
put together by a 128-bit hash of each row's id and text.

Defined cases: a null or wordless text has no words and isn't contaminated; an
item without words has no phrase; a null item id counts as the empty string;
repeated items and ids are judged row by row; an empty table gives an empty
result, an empty test set clean ones.  Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat
from turnstile.session import materialize

#: everything but letters, digits and bytes beyond ASCII separates words
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
SAMPLE = 16
SHARD_BYTES = 4 << 20


def word_class() -> tuple[np.ndarray, np.ndarray]:
    is_word, lower = flat.byte_class(SEPARATORS, lower=True)
    return is_word[lower], lower


class Phrases:
    """The distinct test phrases of a block, as words and as vocabulary numbers."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        w = flat.Words(pa.array([t for _, t in items], pa.string()), word_class())
        h = w.hashes() if len(w) else np.zeros(0, np.uint64)
        self.vocabulary, number = np.unique(h, return_inverse=True)
        number = number + 1  # 0 parts runs
        texts: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.items: list[set[str]] = []
        pairs = []
        for r, (name, _) in enumerate(items):
            a, b = int(w.first[r]), int(w.first[r + 1])
            pairs.append(number[a:b - 1] * (len(self.vocabulary) + 1) + number[a + 1:b])
            for at in range(a, max(b - window, a) + 1) if b > a else ():
                to = min(at + window, b)
                body = w.data[w.start[at]:w.end[to - 1]].tobytes()
                i = texts.setdefault(body, len(texts))
                if i == len(self.words):
                    self.words.append(number[at:to])
                    self.items.append(set())
                self.items[i].add(name)
        self.texts = list(texts)
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.length = np.array([len(x) for x in self.words], np.int64)
        width = int(self.length.max(initial=0))
        self.table = np.zeros((len(self.words), width), np.int64)  # last word first
        for i, x in enumerate(self.words):
            self.table[i, :len(x)] = x[::-1]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of word hashes, 0 for other words."""
        out = np.zeros(len(h), np.int64)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.vocabulary, h[at]), max(len(self.vocabulary) - 1, 0))
        if len(at):
            hit = self.vocabulary[place] == h[at]
            out[at[hit]] = place[hit] + 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; zeros are all different, in the order of their places."""
    n = len(text)
    zeros = text == 0
    value = np.where(zeros, np.cumsum(zeros) - 1, int(zeros.sum()) + text)
    rank = np.unique(value, return_inverse=True)[1]
    step = 1
    while rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        rank = np.unique(rank * np.int64(n + 1) + after, return_inverse=True)[1]
        step *= 2
    return np.argsort(rank)


class WaveletMatrix:
    """Symbols of a text by bits, highest first, with ranks."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for shift in range(max(int(top).bit_length(), 1) - 1, -1, -1):
            bit = (symbols >> shift) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.levels.append((shift, bit.astype(bool), ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at
        for shift, _, ones, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for shift, bit, ones, zeros in self.levels:
            one = bit[at]
            out |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones[at], at - ones[at])
        return out


class FMIndex:
    """Self-index of runs of numbers (1 to ``top``), each ended by a zero."""

    def __init__(self, text: np.ndarray, top: int):
        order = suffix_array(text)
        before = text[order - 1]  # the first suffix wraps to the last zero
        self.matrix = WaveletMatrix(before, top)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.place = np.where(sampled, order, -1)

    def search(self, table: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of phrases given last word first."""
        low = np.zeros(len(length), np.int64)
        high = np.full(len(length), len(self.place), np.int64)
        for i in range(table.shape[1]):
            at = np.flatnonzero((length > i) & (low < high))
            if len(at) == 0:
                break
            word = table[at, i]
            low[at] = self.less[word] + self.matrix.rank(word, low[at])
            high[at] = self.less[word] + self.matrix.rank(word, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes, by stepping back to sampled ones."""
        steps, rows = np.zeros(len(rows), np.int64), rows.copy()
        todo = np.flatnonzero(self.place[rows] < 0)
        while len(todo):
            word = self.matrix.access(rows[todo])
            rows[todo] = self.less[word] + self.matrix.rank(word, rows[todo])
            steps[todo] += 1
            todo = todo[self.place[rows[todo]] < 0]
        return self.place[rows] + steps


def occurrences(w: flat.Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of each occurrence in a shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(w) == 0 or not phrases.texts:
        return none
    number = phrases.numbers(w.hashes())
    known = number > 0
    link = np.zeros(len(w), bool)  # whether a word goes on with the next one
    at = np.flatnonzero(known[:-1] & known[1:] & w.inside(2)[:-1])
    pair = number[at] * (len(phrases.vocabulary) + 1) + number[at + 1]
    if len(phrases.pairs):
        place = np.minimum(np.searchsorted(phrases.pairs, pair), len(phrases.pairs) - 1)
        link[at[phrases.pairs[place] == pair]] = True
    start = np.flatnonzero(known & ~np.concatenate([[False], link[:-1]]))
    end = np.flatnonzero(known & ~link) + 1
    some = end - start >= phrases.length.min()
    start, size = start[some], (end - start)[some]
    if len(start) == 0:
        return none
    words = flat.spread(start, size + 1)  # the word after a run stands for the zero that ends it
    last = np.cumsum(size + 1) - 1
    text = number[np.minimum(words, len(w) - 1)]
    text[last] = 0
    index = FMIndex(text, len(phrases.vocabulary))
    low, high = index.search(phrases.table, phrases.length)
    found = np.flatnonzero(high > low)
    which = np.repeat(found, (high - low)[found])
    first = words[index.locate(flat.spread(low[found], (high - low)[found]))]
    to = w.end[first + phrases.length[which] - 1]
    true = np.array([w.data[a:b].tobytes() == phrases.texts[i]
                     for i, a, b in zip(which.tolist(), w.start[first].tolist(), to.tolist())], bool)
    return which[true], first[true]


SPANS_ARROW = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
FOUND = "_k1 long, _k2 long, spans array<struct<from: long, to: long>>, items array<string>"


def _find(plan):
    """Spans and items of the rows that hold a phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, cls = flat.revive(Phrases, plan.value), word_class()
        for batch in flat.rounds(batches, limit=SHARD_BYTES):
            w = flat.Words(batch.column("_text"), cls)
            which, first = occurrences(w, phrases)
            hit = flat.covered(w.first, first, phrases.length[which], len(w))
            rows = np.flatnonzero(flat.row_sums(hit, w.first))
            items: dict[int, set[str]] = {r: set() for r in rows.tolist()}
            for r, i in zip((np.searchsorted(w.first, first, "right") - 1).tolist(), which.tolist()):
                items[r] |= phrases.items[i]
            spans = []
            for r in rows.tolist():
                lo, hi = flat.runs(hit[w.first[r]:w.first[r + 1]])
                spans.append([{"from": a, "to": b} for a, b in zip(lo.tolist(), hi.tolist())])
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k1").take(at), batch.column("_k2").take(at), pa.array(spans, SPANS_ARROW),
                 pa.array([sorted(x) for x in items.values()], pa.list_(pa.string()))], ["_k1", "_k2", "spans", "items"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but the text, and the number of words."""
    for batch in flat.rounds(batches, limit=SHARD_BYTES):
        keep = [n for n in batch.schema.names if n != "_text"]
        w = flat.Words(batch.column("_text"), word_class())
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(np.diff(w.first))], [*keep, "n_words"])


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The test set in blocks: as many as its measured bytes take, at least one."""
    size = items.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for i in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("_i", "_t"), F.lit(n)) == i)
        yield [(r["_i"], r["_t"]) for r in block.collect()]


def find(docs: DataFrame, tests: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = 13, block_bytes: int = 8 << 20,
         extra: tuple = ()) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans (word ranges of test
    phrases), items (ids with occurring phrases) and contaminated.

    ``extra`` columns of the documents are kept, under their own names.
    """
    tests = tests.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("_i"),
                         F.col(item_text).cast("string").alias("_t"))
    keyed = flat.keyed(docs, id_col, text_col, *(F.col(c).alias(f"_x{i}") for i, c in enumerate(extra)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields if f.name != "_text")
    context, parts = docs.sparkSession.sparkContext, []
    for block in _blocks(tests, block_bytes):
        plan = context.broadcast(vars(Phrases(block, window)))
        parts.append(materialize(keyed.select("_k1", "_k2", "_text").mapInArrow(_find(plan), FOUND)))
        plan.destroy()
    merged = functools.reduce(DataFrame.unionByName, parts).groupBy("_k1", "_k2").agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    none = F.array().cast("array<struct<from: bigint, to: bigint>>")
    found = keyed.mapInArrow(_counted, f"{kinds}, n_words long").join(merged.withColumn("spans", _merged("spans")), ["_k1", "_k2"], "left").withColumns(
        {"spans": F.coalesce("spans", none), "items": F.coalesce("items", F.array().cast("array<string>"))})
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    out = found.select(F.col("_id").alias(id_col), *(F.col(f"_x{i}").alias(c) for i, c in enumerate(extra)),
                       "n_words", hit.alias("n_hit"), "spans", F.col("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _merged(spans):
    """Sorted spans without overlaps."""
    empty = F.array().cast("array<struct<from: bigint, to: bigint>>")

    def add(done, s):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["from"].alias("from"), F.greatest(last["to"], s["to"]).alias("to"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["to"] >= s["from"]), joined).otherwise(
            F.concat(done, F.array(s)))

    return F.aggregate(spans, empty, add)


def digest(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """op7: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return find(docs, tests).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def _words_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE = rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words_sql('text')} AS w FROM benchmark),
phrases AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 13) AS size, md5(array_to_string(w[i + 1:i + 13], ' ')) AS g
  FROM items, range(greatest(len(w) - 12, 1)) AS x(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT r, i, size, md5(array_to_string(w[i + 1:i + size], ' ')) AS g FROM docs, sizes, range(len(w) - size + 1) AS x(i) WHERE len(w) >= size),
found AS MATERIALIZED (SELECT r, i, windows.size, item FROM windows JOIN phrases ON windows.g = phrases.g AND windows.size = phrases.size),
hits AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n > 0 AND 20 * n >= len(w), false) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
