"""SentencePiece encoding and decoding by vectorised merge rounds.

Texts are cut into words where no piece of the model reaches across, equal
words of a batch are encoded once, and all of them lie in one flat array of
symbols.  In each round every word finds its best pair by a segmented minimum
of the pairs' ranks and merges all its occurrences that one-at-a-time merging
would merge next, leftmost first; arrays are then compacted, and words without
a pair leave.  A merge that would make a new pair at least as good ends the
word's round there, so the order is exactly that of the sequential algorithm.

The model file (BPE with byte fallback) is a parameter; executors get its
pieces by broadcast, whose size is that of the vocabulary.

Defined cases: a null or empty text has only the begin and end ids and decodes
to the empty text; other columns are ignored; null or repeated ids are encoded
row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat

SPACE = "▁"  # fixed by the model format
_FAR = np.int64(1) << 40


class Model:
    """Tables of a model: characters, pairs and what each id decodes to."""

    def __init__(self, path: str):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end, unknown = p.bos_id(), p.eos_id(), p.unk_id()
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.byte = np.full(256, unknown, np.int64)
        for i, name in enumerate(names):
            if p.is_byte(i):
                self.byte[int(name[3:5], 16)] = i
        normal = {name: i for i, name in enumerate(names)
                  if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))}
        # symbols are piece ids; a character that is no piece is the number of ids plus its code point
        self.size = len(names)
        symbol = dict(normal)
        for c in {c for name in normal for c in name}:
            symbol.setdefault(c, self.size + ord(c))
        # equal scores have equal ranks: the leftmost pair goes first
        score = {name: p.get_score(i) for name, i in normal.items()}
        rank_of = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = {}
        for name, i in normal.items():
            for cut in range(1, len(name)):
                a, b = symbol.get(name[:cut]), symbol.get(name[cut:])
                if a is not None and b is not None:
                    pairs[(a << 22) | b] = (i, rank_of[score[name]])
        keys = np.array(list(pairs), np.int64)
        self.bits = max(10, int(4 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int64)
        self.merged, self.rank = (np.zeros(1 << self.bits, np.int64) for _ in range(2))
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):  # open addressing: the first of each slot gets it, the others move on
            free = self.table[slot[todo]] < 0
            first = np.unique(slot[todo[free]], return_index=True)[1]
            put = todo[free][first]
            self.table[slot[put]] = keys[put]
            todo = todo[self.table[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        for at, key in zip(slot.tolist(), keys.tolist()):
            self.merged[at], self.rank[at] = pairs[key]
        self.probes = int((((slot - self._slot(keys)) & ((1 << self.bits) - 1)) + 1).max(initial=1))
        # adjacent characters inside some piece; words are cut everywhere else
        inner = np.array(sorted({(ord(n[i]) << 21) | ord(n[i + 1]) for n in normal for i in range(len(n) - 1)}), np.int64)
        self.inner = np.zeros(1 << 22, bool)
        self.inner[self._pair_slot(inner)] = True
        # spaces that no letter took are merged last; a run becomes longest pieces and what the rest gives
        last = max(rank_of.values(), default=0)
        sizes = {len(n): i for n, i in normal.items() if set(n) == {SPACE}}
        longest = max(sizes, default=1)
        given = [_space_run(n, sizes) for n in range(3 * longest + 1)]
        self.spaces = None
        if 1 in sizes and all(rank_of[score[SPACE * k]] == last for k in sizes) and not any(
                SPACE in n[1:] and set(n) != {SPACE} for n in normal) and all(
                given[n] == [longest, *given[n - longest]] for n in range(longest, len(given))):
            self.spaces = longest, [[sizes[k] for k in run] for run in given[:longest]], sizes
        self.space_rank = last
        out = [b"" if p.is_control(i) else bytes([int(n[3:5], 16)]) if p.is_byte(i) else
               n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.text_off = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        self.text = np.frombuffer(b"".join(out), np.uint8)
        self.codes = self.size + np.arange(0x110000, dtype=np.int64)
        for c, i in normal.items():
            if len(c) == 1:
                self.codes[ord(c)] = i

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(merged symbol, rank) of pairs; the rank is ``_FAR`` where there is none."""
        key = (a.astype(np.int64) << 22) | b
        slot = self._slot(key)
        merged, rank = np.zeros(len(key), np.int64), np.full(len(key), _FAR)
        todo = np.arange(len(key))
        for _ in range(self.probes):
            at = slot[todo]
            held = self.table[at]
            hit = held == key[todo]
            merged[todo[hit]], rank[todo[hit]] = self.merged[at[hit]], self.rank[at[hit]]
            todo = todo[~hit & (held >= 0)]
            if len(todo) == 0:
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return merged, rank

    def encode_words(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the words symbols[first[i]:first[i + 1]] to the end; (symbols, word bounds)."""
        n_words = len(first) - 1
        word = np.repeat(np.arange(n_words), np.diff(first))
        done_symbol, done_word = [], []
        seq = symbols.astype(np.int64)
        merged, rank = self._pairs(seq, word)
        while len(seq):
            # words without a pair are done
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(seq)))
            alive = np.repeat(best < _FAR, size)
            if not alive.all():
                done_symbol.append(seq[~alive]), done_word.append(word[~alive])
                seq, word, merged, rank, best, size = (seq[alive], word[alive], merged[alive], rank[alive],
                                                       best[best < _FAR], size[best < _FAR])
                if len(seq) == 0:
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            # of overlapping occurrences every second one, from the left
            run = np.ones(len(hit), bool)
            run[1:] = hit[1:] != hit[:-1] + 1
            index = np.arange(len(hit))
            hit = hit[(index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0]
            new = merged[hit]
            # the pairs that each merge makes: with what stands left by then, and with what stands right
            left = hit > 0
            left[left] = word[hit[left] - 1] == word[hit[left]]
            before = seq[hit - 1]
            close = np.zeros(len(hit), bool)
            close[1:] = hit[1:] == hit[:-1] + 2
            before[close] = new[np.flatnonzero(close) - 1]
            worse = np.ones(len(hit), bool)
            worse[left] = self.look(before[left], new[left])[1] > rank[hit[left]]
            right = hit + 2 < len(seq)
            right[right] = word[hit[right] + 2] == word[hit[right]]
            worse[right] &= self.look(new[right], seq[hit[right] + 2])[1] > rank[hit[right]]
            # a word's round ends with the first merge that makes a pair at least as good
            of = word[hit]
            bad = np.cumsum(~worse)
            head = np.flatnonzero(np.diff(of, prepend=-1))
            base = np.repeat(bad[head] - ~worse[head], np.diff(np.append(head, len(hit))))
            hit, new = hit[bad - ~worse - base == 0], new[bad - ~worse - base == 0]
            seq[hit] = new
            keep = np.ones(len(seq), bool)
            keep[hit + 1] = False
            seq, word = seq[keep], word[keep]
            changed = np.zeros(len(keep), bool)
            changed[hit] = True
            changed[hit[hit > 0] - 1] = True
            # the symbol before a merge may itself be the second half of one
            two = hit[hit > 1]
            changed[two - 2] |= ~keep[two - 1]
            merged, rank, changed = merged[keep], rank[keep], np.flatnonzero(changed[keep])
            m, r = self._pairs(seq, word, changed)
            merged[changed], rank[changed] = m, r
        symbols = np.concatenate([*done_symbol, np.zeros(0, np.int64)])
        word = np.concatenate([*done_word, np.zeros(0, np.int64)])
        order = np.argsort(word, kind="stable")
        return symbols[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n_words))])

    def _pairs(self, seq: np.ndarray, word: np.ndarray, at: np.ndarray | None = None):
        """(merged, rank) of the pairs that start at the places ``at`` (all by default)."""
        at = np.arange(len(seq)) if at is None else at
        merged, rank = np.zeros(len(at), np.int64), np.full(len(at), _FAR)
        some = at + 1 < len(seq)
        some[some] = word[at[some] + 1] == word[at[some]]
        a = at[some]
        m, r = self.look(seq[a], seq[a + 1])
        if self.spaces:  # runs of spaces are taken at the end
            r[r == self.space_rank] = _FAR
        merged[some], rank[some] = m, r
        return merged, rank

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row bounds), without begin and end."""
        data, off = flat.utf8(texts)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        code = _code_points(data, lead)
        rows = np.searchsorted(lead, off)
        code[code == 32] = ord(SPACE)
        # every text that isn't empty gets a space in front
        some = np.flatnonzero(np.diff(rows))
        place = rows[some]
        code = np.insert(code, place, ord(SPACE))
        rows = rows + np.searchsorted(place, rows, "left")
        if len(code) == 0:
            return np.zeros(0, np.int64), rows
        cut = np.ones(len(code), bool)
        pair = (code[:-1].astype(np.int64) << 21) | code[1:]
        cut[1:] = ~self._inside(pair)
        if self.spaces:  # spaces before a word's last one stand alone until the end
            both = (code[:-1] == ord(SPACE)) & (code[1:] == ord(SPACE))
            cut[1:] |= both
        cut[rows[:-1][np.diff(rows) > 0]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(code)))
        # equal words once
        h = flat.mix(flat.ranges_hash(flat.prefix(code.astype(np.uint64) + np.uint64(1)), start, start + size)
                     + size.astype(np.uint64))
        _, one, which = np.unique(h, return_index=True, return_inverse=True)
        same = np.repeat(start[one[which]], size) + (np.arange(len(code)) - np.repeat(start, size))
        if not np.array_equal(code[same], code):  # two words with one hash
            one, which = np.arange(len(start)), np.arange(len(start))
        bounds = np.concatenate([[0], np.cumsum(size[one])])
        symbols, bounds = self.encode_words(self.codes[code[flat.spread(start[one], size[one])]], bounds)
        length = np.diff(bounds)[which]
        seq = symbols[flat.spread(bounds[which], length)]
        first = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(start, rows)]
        seq, first = self._spaces(seq, first)
        other = np.flatnonzero(seq >= self.size)
        if len(other):  # characters that are no piece become bytes
            raw, count = _utf8_bytes(seq[other] - self.size)
            each = np.ones(len(seq), np.int64)
            each[other] = count
            at = np.cumsum(each) - each
            out = np.repeat(seq, each)
            out[flat.spread(at[other], count)] = self.byte[raw]
            seq, first = out, np.append(at, len(out))[first]
        return seq, first

    @staticmethod
    def _pair_slot(pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def _inside(self, pair: np.ndarray) -> np.ndarray:
        """Whether two adjacent characters may stand together in some piece (never wrongly false)."""
        return self.inner[self._pair_slot(pair)]

    def _spaces(self, seq: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the single spaces left in each row to the longest pieces, from the left."""
        if not self.spaces or len(seq) == 0:
            return seq, first
        longest, rest, sizes = self.spaces
        single = seq == sizes[1]
        head = np.zeros(len(seq) + 1, bool)
        head[first] = True
        new = ~single | head[:-1] | ~np.concatenate([[False], single[:-1]])
        at = np.flatnonzero(new)
        length = np.where(single[at], np.diff(np.append(at, len(seq))), 0)
        count = np.where(length > 0, length // longest + np.array([len(x) for x in rest])[length % longest], 1)
        to = np.cumsum(count) - count
        out = np.repeat(np.where(length > 0, sizes[longest], seq[at]), count)
        for r, ids in enumerate(rest):
            runs = np.flatnonzero((length > 0) & (length % longest == r))
            for i, k in enumerate(ids):
                out[to[runs] + length[runs] // longest + i] = k
        place = np.append(to, len(out))
        return out, place[np.searchsorted(at, first)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, row bounds): pieces as text, without the space in front."""
        size = np.diff(self.text_off)[ids]
        data = self.text[flat.spread(self.text_off[ids], size)]
        off = np.concatenate([[0], np.cumsum(size)])[first]
        front = off[:-1][np.diff(off) > 0]
        front = front[data[front] == 32]
        keep = np.ones(len(data), bool)
        keep[front] = False
        return data[keep], np.concatenate([[0], np.cumsum(keep)])[off]


def _space_run(n: int, sizes: dict[int, int]) -> list[int]:
    """What merging the leftmost pair again and again makes of n spaces, if all pairs rank alike."""
    run = [1] * n
    while True:
        at = next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in sizes), None)
        if at is None:
            return run
        run[at:at + 2] = [run[at] + run[at + 1]]


def _code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Unicode code points of UTF-8 bytes whose characters begin at ``lead``."""
    b = data[lead].astype(np.int32)
    pad = np.concatenate([data, np.zeros(3, np.uint8)])
    at = np.flatnonzero(b >= 0xC0)
    if len(at):
        one, two, three = ((pad[lead[at] + i] & 0x3F).astype(np.int32) for i in (1, 2, 3))
        x = b[at]
        b[at] = np.where(x < 0xE0, ((x & 0x1F) << 6) | one, np.where(
            x < 0xF0, ((x & 0x0F) << 12) | (one << 6) | two, ((x & 0x07) << 18) | (one << 12) | (two << 6) | three))
    return b


def _utf8_bytes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all code points, bytes of each)."""
    count = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    rest = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    code, size = np.repeat(code, count), np.repeat(count, count)
    part = code >> (6 * (size - 1 - rest))
    lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])[size]
    return np.where(rest == 0, lead | part, 0x80 | (part & 0x3F)), count


def _code(model, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = flat.revive(Model, model.value)
        for batch in flat.rounds(batches):
            ids, first = m.encode(batch.column("_text"))
            n = np.diff(first)
            whole = np.empty(len(ids) + 2 * len(n), np.int32)
            bounds = first + 2 * np.arange(len(first))
            inner = np.ones(len(whole), bool)
            inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
            whole[bounds[:-1]], whole[bounds[1:] - 1], whole[inner] = m.begin, m.end, ids
            out = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(whole))]
            if decode:
                out.append(flat.strings(*m.decode(whole, bounds), pa.string()))
            names = [x for x in batch.schema.names if x != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *out],
                                             [*names, "ids", "decoded"][:len(names) + len(out)])

    return run


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           decode: bool = True, extra: tuple = ()) -> DataFrame:
    """One row per document: id, the ``extra`` columns, ids (with begin and end) and decoded."""
    keyed = flat.keyed(docs, id_col, text_col, *(F.col(c).alias(f"_x{i}") for i, c in enumerate(extra))).drop("_k1", "_k2")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields if f.name != "_text")
    model = docs.sparkSession.sparkContext.broadcast(vars(Model(model_path)))
    out = keyed.mapInArrow(_code(model, decode), f"{kinds}, ids array<int>" + ", decoded string" * decode)
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_x{i}").alias(c) for i, c in enumerate(extra)),
                      "ids", *["decoded"] * decode)


def _digests(model):
    """Digests in the task that makes the ids, so that these don't travel as lists."""
    code = _code(model, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in code(batches):
            ids = batch.column("ids")
            view, off = memoryview(np.asarray(ids.values)).cast("B"), (np.asarray(ids.offsets).astype(np.int64) * 4).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(np.asarray(ids.offsets)).astype(np.int64)),
                 pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(off, off[1:])]), batch.column("decoded")],
                ["_id", "n_tokens", "ids_sha256", "decoded"])

    return run


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """op8: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    keyed = flat.keyed(docs, "doc_id", "text").drop("_k1", "_k2")
    model = docs.sparkSession.sparkContext.broadcast(vars(Model(model_path)))
    kind = keyed.schema["_id"].dataType.simpleString()
    out = keyed.mapInArrow(_digests(model), f"_id {kind}, n_tokens long, ids_sha256 string, decoded string")
    return out.select(F.col("_id").alias("doc_id"), "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
