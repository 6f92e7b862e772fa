"""Periodic run detection on Re-Pair grammars of word ids.

A run is a stretch of consecutive words of one text with smallest period q and
length at least ``max(min_length, times * q)`` that no neighbouring word
extends keeping period q.  A word is repeated if a run contains it after that
run's first q words; those words can be removed.

1.  Re-Pair.  Word ids, one range of ids a text, go through rounds: all pairs of
    neighbours are counted, and each pair that is the most frequent among those
    it overlaps is replaced by a new symbol everywhere, until no pair of a text
    repeats.  What is left of a text is paired up in a balanced way, so each text is
    one symbol at last.  Texts of a batch go through the rounds together.
2.  Crossing runs.  A run lies inside a lowest symbol of the derivation, and
    crosses the boundary between that symbol's two children.  Runs that cross
    it are looked for once for each symbol: for one that crosses at c, the words around
    c occur again at distance q, which gives the periods to try, and longest
    common extensions to both sides (by names of all stretches of 2**k words,
    exact) give its ends within the symbol.
3.  Translation.  Each run found goes to all positions of its symbol's derivation.
4.  Merging.  Stretches with one period that overlap in at least a period are
    one; those whose period has a smaller one in it are dropped.

A task holds one round of texts (a longer text is a round of its own); nothing
is shuffled.

Defined cases: null or empty text: no words and no runs; rows are judged one by
one, whatever their ids; an empty table gives an empty result.  Other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat

#: periods tried at once
TRIES = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_SQL = "struct<start: long, length: long, period: long>"


def _groups(key: np.ndarray) -> np.ndarray:
    """Group number of each key, in the order of keys."""
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return number


class Grammar:
    """Symbols over word ids: for each, the boundary and the length at one of its positions, and all positions.

    ``symbol[i]`` starts at word ``at[i]``; symbol k is ``left[k]`` words and then
    ``size[k] - left[k]`` more.  Words themselves aren't listed.
    """

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        self._row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self._length = np.ones(int(ids.max()) + 1 if len(ids) else 0, np.int64)
        self._found: list[tuple[np.ndarray, ...]] = []  # symbol, position, boundary, length
        rest = self._repair(ids)
        self._balance(rest)
        parts = [np.concatenate(x) for x in zip(*self._found)] if self._found else [np.zeros(0, np.int64)] * 4
        order = np.argsort(parts[0], kind="stable")
        self.symbol, self.at, self.left, self.size = (x[order] for x in parts)

    def _name(self, key: np.ndarray, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """New symbols for pairs (a, b) by key."""
        number = _groups(key)
        symbol = len(self._length) + number
        length = self._length[a] + self._length[b]
        grown = np.empty(int(number.max()) + 1, np.int64)
        grown[number] = length
        self._found.append((symbol, at, self._length[a], length))
        self._length = np.concatenate([self._length, grown])
        return symbol

    def _repair(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, positions) when no pair of a text repeats."""
        at, done = np.arange(len(seq)), []
        while len(seq) > 1:
            key = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:].astype(np.uint64)
            start = np.ones(len(key), bool)
            start[1:] = key[1:] != key[:-1]
            where = np.arange(len(key))
            free = (where - np.maximum.accumulate(np.where(start, where, 0))) % 2 == 0  # x x x holds the pair once
            number = _groups(key)
            count = np.bincount(number[free], minlength=len(key))[number]
            can = free & (count > 1)
            if not can.any():
                break
            rank = np.where(can, count.astype(np.uint64) << np.uint64(40) | flat.mix(key) >> np.uint64(24), np.uint64(0))
            beats = (rank[1:] > rank[:-1]) | (rank[1:] == rank[:-1]) & (key[1:] > key[:-1])
            pick = can.copy()
            pick[1:] &= beats | ~can[:-1]
            pick[:-1] &= ~beats | ~can[1:]
            pick &= (np.bincount(number[pick], minlength=len(key)) > 1)[number]
            i = np.flatnonzero(pick)
            seq = seq.copy()
            seq[i] = self._name(key[i], seq[i], seq[i + 1], at[i])
            live = np.zeros(int(self._row[-1]) + 1, bool)  # texts without a repeated pair are done
            live[self._row[at[:-1][can]]] = True
            stay = np.ones(len(seq), bool)
            stay[i + 1] = False
            seq, at = seq[stay], at[stay]
            more = live[self._row[at]]
            done.append((seq[~more], at[~more]))
            seq, at = seq[more], at[more]
        done.append((seq, at))
        seq, at = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(at)
        return seq[order], at[order]

    def _balance(self, rest: tuple[np.ndarray, np.ndarray]) -> None:
        """One symbol a text, from neighbours paired by their places."""
        seq, at = rest
        while len(seq) > 1:
            row = self._row[at]
            first = np.searchsorted(row, row)
            even = (np.arange(len(seq)) - first) % 2 == 0
            i = np.flatnonzero(even[:-1] & (row[1:] == row[:-1]))
            if len(i) == 0:
                return
            seq = seq.copy()
            seq[i] = self._name(i, seq[i], seq[i + 1], at[i])
            stay = np.ones(len(seq), bool)
            stay[i + 1] = False
            seq, at = seq[stay], at[stay]


class Names:
    """Names of all stretches of 2**k words of the texts in ``mask``; equal names, equal words."""

    def __init__(self, ids: np.ndarray, mask: np.ndarray, longest: int):
        self.to = np.cumsum(mask) - 1
        ids = ids[mask]
        self.levels = [ids]
        size = 1
        while 2 * size <= longest:
            a = self.levels[-1]
            beyond = int(a.max()) + 1
            b = np.concatenate([a[size:], beyond + np.arange(min(size, len(a)))])  # stretches past the end equal nothing
            self.levels.append(_groups(a.astype(np.uint64) * np.uint64(beyond + size) + b.astype(np.uint64)))
            size *= 2
        self.n = len(ids)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j (i < j) on."""
        i, j = self.to[i], self.to[j]
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            ok = np.flatnonzero(j + out < self.n)
            ok = ok[self.levels[k][i[ok] + out[ok]] == self.levels[k][j[ok] + out[ok]]]
            out[ok] += 1 << k
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words up to i and j (i < j), both included."""
        i, j = self.to[i], self.to[j]
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            low = i - out - (1 << k) + 1
            ok = np.flatnonzero(low >= 0)
            ok = ok[self.levels[k][low[ok]] == self.levels[k][(j - i)[ok] + low[ok]]]
            out[ok] += 1 << k
        return out


def gram_length(min_length: int, times: int) -> int:
    """Words around a boundary that occur again at the period's distance, whatever the period.

    The larger side of a crossing run has half of its length or more, of which
    all but a period are matched, and one word of the other side.
    """
    return min(max(-(-min_length // 2), -(-times * q // 2)) - q + 1 for q in range(1, min_length + 1))


def _tries(nodes: tuple[np.ndarray, ...], order: np.ndarray, key: np.ndarray, group: np.ndarray, turn: np.ndarray, gram: int, times: int):
    """(first, number) of the grams at most a period away, later and earlier, in the sorted grams, for boundaries of nodes."""
    s, c, e = nodes
    far, wide = (e - s) // times, np.uint64(len(group) + 1)
    place = lambda i, to: group[i].astype(np.uint64) * wide + to.astype(np.uint64)
    i = c - 1
    ok = (i >= s) & (i + gram <= e)
    i = np.where(ok, i, 0)
    later = np.searchsorted(key, place(i, np.maximum(np.minimum(i + far, e - gram), i)), "right") - turn[i] - 1
    right = (turn[i] + 1, np.where(ok, later, 0))
    i = c - gram + 1
    ok = (i >= s) & (c < e)
    i = np.where(ok, i, 0)
    lo = np.searchsorted(key, place(i, np.minimum(np.maximum(i - far, s), i)), "left")
    return right, (lo, np.where(ok, turn[i] - lo, 0))


def crossing_runs(ids: np.ndarray, first: np.ndarray, nodes: tuple[np.ndarray, ...], min_length: int, times: int):
    """(names, node, start, end, period) of runs that cross a node's boundary, within the node; nodes: start, boundary, end."""
    gram = gram_length(min_length, times)
    empty = np.zeros(0, np.int64)
    if len(ids) < gram or len(nodes[0]) == 0:
        return None, empty, empty, empty, empty
    group = _groups(flat.windows_hash(flat.mix(ids.astype(np.uint64)), gram))
    place = group.astype(np.uint64) * np.uint64(len(group) + 1) + np.arange(len(group), dtype=np.uint64)
    order = np.argsort(place)
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    key = place[order]
    right, left = _tries(nodes, order, key, group, turn, gram, times)
    if not (right[1].any() or left[1].any()):
        return None, empty, empty, empty, empty
    total = np.cumsum(right[1] + left[1])
    rows = np.unique(np.searchsorted(first, nodes[0][right[1] + left[1] > 0], "right") - 1)  # texts with tries
    size = np.diff(first)
    names = Names(ids, np.repeat(np.isin(np.arange(len(size)), rows), size), int(size[rows].max()))
    found = []
    a = 0
    while a < len(total):
        base = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, base + TRIES, "right")))
        for (lo, n), is_right in ((right, True), (left, False)):
            node = np.repeat(np.arange(a, b), n[a:b])
            other = order[flat.spread(lo[a:b], n[a:b])]
            c = nodes[1][node]
            q = other - (c - 1) if is_right else c - gram + 1 - other
            found.append(_extended(names, node, q, nodes, is_right, min_length, times))
        a = b
    return names, *(np.concatenate(x) for x in zip(*found))


def _extended(names: Names, node: np.ndarray, q: np.ndarray, nodes: tuple[np.ndarray, ...], is_right: bool, min_length: int, times: int):
    """The runs among (node, period) tries, in the order of nodes; the least period of a node rules out its multiples inside its run."""
    def runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s, c, e = (x[node[k]] for x in nodes)
        d = q[k]
        i = c if is_right else c - d
        f = np.minimum(names.forward(i, i + d), e - i - d)
        b = np.zeros(len(k), np.int64)
        inner = np.flatnonzero(i > s)
        b[inner] = np.minimum(names.backward(i[inner] - 1, i[inner] + d[inner] - 1), i[inner] - s[inner])
        return i - b, i + d + f

    by = np.lexsort((q, node))
    node, q = node[by], q[by]
    head = np.ones(len(node), bool)
    head[1:] = node[1:] != node[:-1]
    heads = np.flatnonzero(head)
    s0, e0 = runs(heads)
    of = np.cumsum(head) - 1
    c = nodes[1][node]
    lo, hi = (c - 1, c + q) if is_right else (c - q, c + 1)
    least = q[heads][of] if len(heads) else q
    multiple = ~head & (q % np.maximum(least, 1) == 0) & (s0[of] <= lo) & (hi <= e0[of]) if len(heads) else head
    k = np.flatnonzero(~multiple)
    s, e = runs(k)
    c, q = nodes[1][node[k]], q[k]
    ok = (e - s >= np.maximum(min_length, times * q)) & (s < c) & (c < e)
    return node[k[ok]], s[ok], e[ok], q[ok]


def _merged(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches with one period that overlap in at least a period, as one."""
    order = np.lexsort((s, q))
    s, e, q = s[order], e[order], q[order]
    if len(s) == 0:
        return s, e, q
    wide = int(e.max()) + 1
    reach = np.maximum.accumulate(q * wide + e)  # periods ascend, so each starts anew
    new = np.ones(len(s), bool)
    new[1:] = (q[1:] != q[:-1]) | (s[1:] + q[1:] > reach[:-1] - q[1:] * wide)
    heads = np.flatnonzero(new)
    return s[heads], np.maximum.reduceat(e, heads), q[heads]


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def all_runs(ids: np.ndarray, first: np.ndarray, min_length: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and then period; texts share no ids."""
    g = Grammar(ids, first)
    some = g.size >= min_length
    symbol, at, left, size = g.symbol[some], g.at[some], g.left[some], g.size[some]
    new = np.ones(len(symbol), bool)
    new[1:] = symbol[1:] != symbol[:-1]
    heads = np.flatnonzero(new)
    times_used = np.diff(np.append(heads, len(symbol)))
    s, c, e = at[heads], at[heads] + left[heads], at[heads] + size[heads]
    names, node, start, end, q = crossing_runs(ids, first, (s, c, e), min_length, times)
    if len(node) == 0:
        return start, end, q
    each = times_used[node]
    moved = at[flat.spread(heads[node], each)] - np.repeat(s[node], each)  # to all positions of the derivation
    start, end, q = _merged(np.repeat(start, each) + moved, np.repeat(end, each) + moved, np.repeat(q, each))
    true = np.ones(len(q), bool)
    for period in np.unique(q).tolist():
        for p in _primes(period):
            k = np.flatnonzero((q == period) & true)
            d = np.full(len(k), period // p)
            true[k[names.forward(start[k], start[k] + d) >= end[k] - start[k] - d]] = False
    start, end, q = start[true], end[true], q[true]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def word_ids(w: flat.Words) -> np.ndarray:
    """Ids from 0 on; words of different texts have different ids."""
    row = np.repeat(np.arange(len(w.first) - 1, dtype=np.uint64), np.diff(w.first))
    return _groups(flat.mix(flat.content_hash(w.data, w.start, w.end) ^ flat.mix(row + np.uint64(1))))


def _strongest(s: list[int], n: list[int], q: list[int]) -> dict | None:
    """The run with the greatest length by period; ties: the earliest, then the shortest period."""
    best = None
    for run in zip(s, n, q):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best and dict(zip(("start", "length", "period"), best))


def _detect(min_length: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in flat.rounds(batches):
            w = flat.Words(batch.column("_text"), flat.byte_class(flat.SPACES))
            s, e, q = all_runs(word_ids(w), w.first, min_length, times) if len(w) else (np.zeros(0, np.int64),) * 3
            off = np.searchsorted(s, w.first)
            base = np.repeat(w.first[:-1], np.diff(off))
            gone = flat.covered(w.first, s + q, e - s - q, len(w))
            bytes_kept = np.repeat(~gone, w.end - w.start + 1)
            to = np.concatenate([[0], np.cumsum(bytes_kept)])[np.append(w.start, len(w.data))[w.first]]
            kept = flat.strings(w.data[bytes_kept], to, pa.string())
            fields = (s - base, e - s, q)
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.StructArray.from_arrays([pa.array(x) for x in fields], fields=list(RUN)))
            best = [_strongest(*(x[a:b].tolist() for x in fields)) if b > a else None for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(w.first)), lists, pa.array(best, RUN), pa.array([t[:-1] for t in kept.to_pylist()], pa.string())],
                ["_id", "n_words", "runs", "strongest", "collapsed"])

    return run


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24, times: int = 3) -> DataFrame:
    """One row per input row: id, n_words, runs, strongest (run or null) and
    collapsed (the text's words that repeat no period, joined by one space)."""
    if times < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.dtypes[0][1]
    return rows.mapInArrow(_detect(min_length, times), f"_id {kind}, n_words long, runs array<{RUN_SQL}>, strongest {RUN_SQL}, collapsed string"
                           ).withColumnRenamed("_id", id_col)


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        planted = {}
        for r, i in enumerate(ids):
            h = 1 if i is None else zlib.crc32(str(i).encode())
            if h % 10 == 0 and (words := (texts[r].as_py() or "").translate(_SPACE).split(" ")):
                words = [w for w in words if w]
                if n := len(words):
                    g = h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    planted[r] = " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
        if planted:
            texts = pa.array([planted.get(r, t) for r, t in enumerate(texts.to_pylist())], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])


_SPACE = dict.fromkeys(range(9, 14), " ")


def digest(docs: DataFrame) -> DataFrame:
    """op11: the runs of the texts, a tenth of which the contract makes periodic first."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = detect(rows.mapInArrow(_plant, f"doc_id {rows.dtypes[0][1]}, text string"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = {c: F.col(f"strongest.{c}") for c in ("start", "length", "period")}
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *(v.alias(c) for c, v in best.items()),
                        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS h
  FROM documents),
sized AS (SELECT r, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS k FROM texts),
words AS MATERIALIZED (
  SELECT r, doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END]) ELSE w END AS w
  FROM sized),
grams AS MATERIALIZED (
  SELECT r, n, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS gram FROM words, range(n - 15) AS x(i) WHERE n >= 24),
again AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY r, gram) AS c FROM grams QUALIFY c > 1),
pairs AS (SELECT a.r, a.i, b.i - a.i AS q FROM again a JOIN again b ON a.r = b.r AND a.gram = b.gram AND a.i < b.i AND 3 * (b.i - a.i) <= a.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS MATERIALIZED (
  SELECT r, q, min(i) AS s, max(i) + 16 + q AS e FROM islands GROUP BY r, q, island HAVING max(i) + 16 + q - min(i) >= greatest(24, 3 * q)),
runs AS MATERIALIZED (
  SELECT r, s, e, q FROM stretches x WHERE NOT EXISTS (
    SELECT 1 FROM stretches y WHERE y.r = x.r AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND x.e <= y.e)),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r),
best AS (
  SELECT r, s, e, q FROM runs x
  WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.r = x.r AND (
    (y.e - y.s) * x.q > (x.e - x.s) * y.q OR ((y.e - y.s) * x.q = (x.e - x.s) * y.q AND (y.s < x.s OR (y.s = x.s AND y.q < x.q)))))),
gone AS (SELECT DISTINCT r, unnest(range(s + q, e)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(w[i + 1], ' ' ORDER BY i) AS text FROM words JOIN told USING (r), range(n) AS x(i)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.r = words.r AND g.i = x.i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, e - s AS length, q AS period, 1000 * (e - s) // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(CASE WHEN n_runs IS NULL THEN array_to_string(w, ' ') ELSE coalesce(text, '') END) AS collapsed_sha256
FROM words LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
