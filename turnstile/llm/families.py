"""Components of documents whose shingle sets are similar: what the similarity joins have in common.

Documents are dealt to lists of which linked ones share one.  Each is
compared with the leader (the least document) of most of its lists, and those
with one such leader are a family.  In families and lists that still hold several
components, documents are first compared with a few others (pivots), then all
candidates of different components are verified where they lie: tasks take
blocks of whole documents and send links only, at most one less than a block has
components.  So no step makes all pairs of a group of near copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat

#: documents, and shingles, of a family or list that meet as many others in one task
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: ids that may be broadcast (some 50 MB); more are joined by a shuffle
BROADCAST_IDS = 1 << 20
#: bytes of compressed texts, or of sketches, handled at once
STEP_BYTES = 1 << 20


def materialize(df: DataFrame) -> DataFrame:
    from turnstile import session  # not above: this module goes to tasks, the package may not

    return session.materialize(df, "snappy")  # many small frames, in executors that also feed Python workers


class Sets:
    """Distinct shingle hashes of a text column, sorted in each row."""

    def __init__(self, col: pa.Array, k: int):
        w = flat.Words(col, flat.byte_class(flat.SPACES, lower=True))
        rows = len(w.first) - 1
        h = w.hashes()
        at = np.flatnonzero(w.inside(k))
        row = np.repeat(np.arange(rows), np.diff(w.first))[at]
        grams = flat.mix(flat.windows_hash(h, k)[at])
        few = np.flatnonzero((np.diff(w.first) > 0) & (np.diff(w.first) < k))
        if len(few):  # the whole sequence, told apart by its length
            whole = flat.ranges_hash(flat.prefix(h), w.first[few], w.first[few + 1])
            grams = np.concatenate([grams, flat.mix(whole + np.diff(w.first)[few].astype(np.uint64))])
            row = np.concatenate([row, few])
        bits = np.uint64(max(rows, 1).bit_length())
        key = (row.astype(np.uint64) << (np.uint64(64) - bits)) | (grams >> bits)
        order = np.argsort(key)
        key, grams, row = key[order], grams[order], row[order]
        if ((key[1:] == key[:-1]) & (grams[1:] != grams[:-1])).any():  # hashes that differ in their last bits only
            order = np.lexsort((grams, row))
            grams, row = grams[order], row[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        self.h, self.row = grams[new], row[new]
        self.first = np.searchsorted(self.row, np.arange(rows + 1))
        self.n = np.diff(self.first)

def seals(s: Sets) -> pa.Array:
    """128-bit digests of the sets."""
    a, b = flat.digests(s.h.view(np.uint8), 8 * s.first[:-1], 8 * s.first[1:])
    return flat.strings(np.stack([a, b], 1).view(np.uint8).ravel(), 16 * np.arange(len(a) + 1), pa.binary())


def _sealed(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in flat.rounds(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, seals(Sets(batch.column("_text"), shingle))], [*batch.schema.names, "seal"])

    return run


def one_row_each(docs: DataFrame, base: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """docs (_id, _text) and base (doc, seal, ...) without rows that lack an id, and with one row for each
    id: of rows with one id the one whose set has the least digest."""
    docs, base = docs.filter("_id is not null").select("_id", "_text"), base.filter("doc is not null")
    often = materialize(base.groupBy("doc").agg(F.count("*").alias("c"), F.min("seal").alias("seal")).filter("c > 1").select("doc", "seal"))
    if often.isEmpty():
        return docs, base
    ids = often.select("doc")
    sealed = among(docs, "_id", ids).mapInArrow(_sealed(shingle), "_id long, _text string, seal binary")
    texts = materialize(sealed.groupBy("_id").agg(F.min_by("_text", "seal").alias("_text")))
    rest = among(docs, "_id", ids, how="left_anti").select("_id", "_text")
    rows = base.join(often, ["doc", "seal"]).select(base.columns).dropDuplicates(["doc"])
    return rest.unionByName(texts), among(base, "doc", ids, how="left_anti").select(base.columns).unionByName(rows)


def equal_sets(base: DataFrame) -> DataFrame:
    """(a, b): each document b with the least one of an equal set; base: doc, seal."""
    heads = base.groupBy("seal").agg(F.min("doc").alias("a"), F.max("doc").alias("_last")).filter("a < _last").select("seal", "a")
    return materialize(base.select("seal", F.col("doc").alias("b")).join(heads, "seal").filter("a < b").select("a", "b").distinct())


def shared_lists(dealt: DataFrame) -> DataFrame:
    """(key, doc, n, leader, w) of the keys that several rows (key, doc, n) have.

    Of lists that hold the same documents (by a 128-bit hash over them) one is taken, for w of them."""
    partitions = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(dealt.repartition(partitions, "key").sortWithinPartitions("key", "doc").mapInArrow(_shared, SHARED))
    taken = rows.filter("doc is null").groupBy("n", "h1", "h2").agg(F.min("key").alias("key"), F.count("*").alias("w")).select("key", "w")
    return materialize(rows.filter("doc is not null").drop("h1", "h2").join(taken, "key"))


def leaders(lists: DataFrame) -> DataFrame:
    """(a, b): each document b with the leader a of most of its lists."""
    votes = lists.filter("leader < doc").groupBy("doc", "leader").agg(F.sum("w").alias("v"))
    return materialize(votes.groupBy("doc").agg(F.max_by("leader", F.struct("v", -F.col("leader"))).alias("a")).select("a", F.col("doc").alias("b")))


SHARED = "key long, doc long, n long, leader long, h1 long, h2 long"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and document: those of keys with several, with the first
    document; and for each such key a row without document that has their number and a hash over them."""
    names = [c.split()[0] for c in SHARED.split(", ")]

    def made(key, doc, n, leader, h1=None, h2=None) -> pa.RecordBatch:
        columns = [pa.array(key), pa.array(doc) if doc is not None else pa.nulls(len(key), pa.int64()), pa.array(n),
                   pa.array(leader) if leader is not None else pa.nulls(len(key), pa.int64()),
                   *(pa.array(h.view(np.int64)) if h is not None else pa.nulls(len(key), pa.int64()) for h in (h1, h2))]
        return pa.RecordBatch.from_arrays([c.cast(pa.int64()) for c in columns], names)

    last = None  # of the key that may go on: key, leader, rows, hashes, and its row if it is the only one so far
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key, doc, n = (batch.column(c).to_numpy() for c in ("key", "doc", "n"))
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(head, len(key)))
        h = doc.astype(np.uint64)
        h1 = np.bitwise_xor.reduceat(flat.mix(h + np.uint64(1)), head)
        h2 = np.add.reduceat(flat.mix(h ^ np.uint64(0x5851F42D4C957F2D)), head)
        leader, total = doc[head], size.copy()
        goes_on = last is not None and last[0] == key[0]
        if goes_on:
            leader[0], total[0] = last[1], size[0] + last[2]
            h1[:1] ^= last[3]
            h2[:1] += last[4]
            if last[5]:
                yield made([last[0]], [last[5][0]], [last[5][1]], [last[1]])
        elif last is not None and last[2] > 1:
            yield made([last[0]], None, [last[2]], None, np.array([last[3]]), np.array([last[4]]))
        rows = np.repeat(total > 1, size)
        yield made(key[rows], doc[rows], n[rows], np.repeat(leader, size)[rows])
        done = np.flatnonzero(total[:-1] > 1)
        if len(done):
            yield made(key[head[done]], None, total[done], None, h1[done], h2[done])
        only = (int(doc[-1]), int(n[-1])) if total[-1] == 1 else None
        last = (key[-1], int(leader[-1]), int(total[-1]), h1[-1], h2[-1], only)
    if last is not None and last[2] > 1:
        yield made([last[0]], None, [last[2]], None, np.array([last[3]]), np.array([last[4]]))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in flat.rounds(batches):
        z = [pack((t or "").encode()) for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(z, pa.binary())], ["doc", "z"])


def among(rows: DataFrame, column: str, ids: DataFrame, *, how: str = "left_semi") -> DataFrame:
    """Rows whose id is among ``ids`` (doc); few ids are broadcast, by their count."""
    ids = materialize(ids)
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.join(side.withColumnRenamed("doc", "_among"), F.col(column) == F.col("_among"), how)


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows, cut between blocks, with about two parts' documents or shingles, or one block."""
    kept: list[pa.RecordBatch] = []
    held = 0.0  # share of what is taken at once
    for batch in batches:
        while batch.num_rows:
            key, block, n = (batch.column(c).to_numpy() for c in ("key", "block", "n"))
            weight = np.concatenate([[0], np.cumsum(1 / (2 * BLOCK) + n / (2 * BLOCK_SHINGLES))])
            last = (kept[-1].column("key")[-1].as_py(), kept[-1].column("block")[-1].as_py()) if kept else None
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(block) != 0)) + 1
            if kept and (key[0], block[0]) != last:
                cuts = np.concatenate([[0], cuts])
            far = cuts[weight[cuts] + held >= 1]
            if len(far) == 0:
                kept.append(batch)
                held += weight[-1]
                break
            kept.append(batch.slice(0, int(far[0])))
            yield [b for b in kept if b.num_rows]
            kept, held, batch = [], 0.0, batch.slice(int(far[0]))
    if any(b.num_rows for b in kept):
        yield [b for b in kept if b.num_rows]


def cut(total: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of rows whose running ``total`` grows by about ``step``."""
    a = 0
    while a < len(total):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + step, "right")))
        yield a, b
        a = b


def open_lists(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """The lists that hold several components, with them and their sizes."""
    known = lists.drop("comp", "held").join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    several = known.groupBy("key").agg(F.min("comp").alias("_c1"), F.max("comp").alias("_c2"), F.count("*").alias("held")).filter("_c1 < _c2")
    return materialize(known.join(several.select("key", "held"), "key"))


def pivots(members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of documents and up to eight others of their family, of other components; members: doc, fam, comp, n."""
    first = F.min(F.struct(F.xxhash64("doc").alias("h"), F.col("doc").alias("p"), F.col("comp").alias("pc"), F.col("n").alias("pn")))
    chosen = members.groupBy("fam", F.pmod(F.xxhash64("doc"), F.lit(8)).alias("_class")).agg(first.alias("x")).select("fam", "x.p", "x.pc", "x.pn")
    fits = num * F.greatest("n", "pn") <= den * F.least("n", "pn")
    met = members.join(chosen, "fam").filter((F.col("comp") != F.col("pc")) & fits)
    return met.select(F.least("doc", "p").alias("a"), F.greatest("doc", "p").alias("b")).distinct()


def block_rows(lists: DataFrame) -> DataFrame:
    """The documents of open families, and of open lists of several families, by blocks; lists: key, doc, n, comp, fam."""
    families = lists.select(F.xxhash64(F.lit("family"), "fam").alias("key"), F.lit(False).alias("cross"), "doc", "n", "comp", "fam").distinct()
    several = lists.groupBy("key").agg(F.min("fam").alias("_f1"), F.max("fam").alias("_f2")).filter("_f1 < _f2").select("key")
    across = lists.join(several, "key").select("key", F.lit(True).alias("cross"), "doc", "n", "comp", "fam").distinct()
    rows = families.union(across)
    parts = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts")
    sizes = rows.groupBy("key").agg(parts, F.min("comp").alias("_c1"), F.max("comp").alias("_c2")).filter("_c1 < _c2").select("key", "parts")
    dealt = rows.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("parts"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    block = F.least("mine", "other") * F.col("parts") + F.greatest("mine", "other")
    side = F.when(F.col("mine") == F.col("other"), 2).otherwise((F.col("mine") > F.col("other")).cast("int"))
    return materialize(dealt.select("key", block.alias("block"), side.alias("side"), "cross", "doc", "fam", "comp", "n"))


def linked(s: Sets, x: int, y: int, num: int, den: int) -> bool:
    """Whether rows x and y of the sets reach the similarity."""
    both = len(np.intersect1d(s.h[s.first[x]:s.first[x + 1]], s.h[s.first[y]:s.first[y + 1]], assume_unique=True))
    return (num + den) * both >= num * int(s.n[x] + s.n[y])


def unpacked(z: list[bytes], shingle: int) -> Sets:
    """Sets of compressed texts, made some texts at a time: what a set takes while it is made is many times itself."""
    unpack = zstandard.ZstdDecompressor().decompress
    parts, total = [], np.cumsum([len(x) for x in z])
    for a, b in cut(total, STEP_BYTES // 4):
        s = Sets(pa.array([unpack(x) for x in z[a:b]], pa.binary()).cast(pa.string()), shingle)
        parts.append((s.h, s.n))
    h, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return flat.revive(Sets, {"h": h, "n": n, "first": np.concatenate([[0], np.cumsum(n)])})


def _verify(shingle: int, num: int, den: int):
    """Pairs whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in flat.rounds(flat.rounds(batches, "za", STEP_BYTES), "zb", STEP_BYTES):
            k = batch.num_rows
            z, number = np.unique(np.array(batch.column("za").to_pylist() + batch.column("zb").to_pylist(), object), return_inverse=True)
            s = unpacked(list(z), shingle)
            keep = [linked(s, x, y, num, den) for x, y in zip(number[:k].tolist(), number[k:].tolist())]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


class Texts:
    """Whole texts, compressed, of the documents that are to be verified."""

    def __init__(self, docs: DataFrame, shingle: int, num: int, den: int):
        self.docs, self.shingle, self.num, self.den = docs, shingle, num, den

    def rows(self, ids: DataFrame) -> DataFrame:
        """(doc, z) of the documents among ``ids`` (doc); written."""
        return materialize(among(self.docs, "_id", ids).mapInArrow(_compressed, "doc long, z binary"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b), which are written already, that link; written."""
        some = self.rows(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct())
        left, right = (some.select(F.col("doc").alias(c), F.col("z").alias(f"z{c}")) for c in ("a", "b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "za", "zb")
        return materialize(both.mapInArrow(_verify(self.shingle, self.num, self.den), "a long, b long").distinct())


#: rows of blocks as arrays, their documents' sets, the set of each row -> candidate sets (x, y), their scores, and a row of each
Find = Callable[[dict[str, np.ndarray], "Sets", np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
#: the same from small columns (light) instead of sets
FindLight = Callable[[dict[str, np.ndarray], list[bytes], np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def may_meet(r: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether rows of one block are to be compared: different components, sizes that fit, in a block of two
    parts different parts, in one of a list different families."""
    n, m = r["n"][left], r["n"][right]
    ok = (r["comp"][left] != r["comp"][right]) & (num * np.maximum(n, m) <= den * np.minimum(n, m))
    ok &= (r["side"][left] != r["side"][right]) | (r["side"][left] == 2)
    return ok & (~r["cross"][left] | (r["fam"][left] != r["fam"][right]))


def block_heads(r: dict[str, np.ndarray]) -> np.ndarray:
    """Bounds of the blocks."""
    new = np.concatenate([[True], (np.diff(r["key"]) != 0) | (np.diff(r["block"]) != 0)])
    return np.append(np.flatnonzero(new), len(r["key"]))


NAMES = ("key", "block", "side", "cross", "doc", "fam", "comp", "n")


def _light_pairs(find: FindLight):
    """Rows sorted by key and block: candidate pairs (a, b), or only the block where they are many for its size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_blocks(batches):
            table = pa.Table.from_batches(rows)
            r = {c: table.column(c).to_numpy() for c in NAMES}
            docs, one, number = np.unique(r["doc"], return_index=True, return_inverse=True)
            x, y, _, row = find(r, table.column("light").take(pa.array(one)).to_pylist(), number)
            heads = block_heads(r)
            block = np.searchsorted(heads, row, "right") - 1
            dense = np.bincount(block, minlength=len(heads) - 1) > 2 * np.diff(heads) + 16
            send, where = ~dense[block], heads[:-1][dense]
            pairs = np.unique(np.stack([docs[x[send]], docs[y[send]]]), axis=1) if send.any() else np.zeros((2, 0), np.int64)
            none = pa.nulls(len(where), pa.int64())
            zero = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.chunked_array(c).combine_chunks() for c in (
                [pa.array(pairs[0]), none], [pa.array(pairs[1]), none], [zero, pa.array(r["key"][where])], [zero, pa.array(r["block"][where])])],
                ["a", "b", "key", "block"])

    return run


def _block_links(find: Find, shingle: int, num: int, den: int):
    """Rows sorted by key and block: links that join different components, best candidates first."""
    def links(rows: list[pa.RecordBatch]) -> tuple[list[int], list[int]]:
        table = pa.Table.from_batches(rows)
        r = {c: table.column(c).to_numpy() for c in NAMES}
        docs, one, number = np.unique(r["doc"], return_index=True, return_inverse=True)
        s = unpacked(table.column("z").take(pa.array(one)).to_pylist(), shingle)
        x, y, score, _ = find(r, s, number)
        both = np.minimum(x, y) * len(docs) + np.maximum(x, y)
        _, first = np.unique(both, return_index=True)  # a pair that meets in several lists is compared once
        x, y, score = x[first], y[first], score[first]
        comp = r["comp"][one].tolist()
        root = {c: c for c in comp}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out: tuple[list[int], list[int]] = [], []
        for i in np.argsort(-score, kind="stable").tolist():
            a, b = int(x[i]), int(y[i])
            ca, cb = top(comp[a]), top(comp[b])
            if ca != cb and linked(s, a, b, num, den):
                root[max(ca, cb)] = min(ca, cb)
                out[0].append(int(docs[a])), out[1].append(int(docs[b]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links(rows)], ["a", "b"])

    return run


def links_of(lists: DataFrame, texts: Texts, near: Callable[[DataFrame], DataFrame], find: Find,
             light: DataFrame | None = None, find_light: FindLight | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all links between documents that share a list.

    lists: key, doc, n, leader, w.  ``near`` sorts out written pairs that can't
    link, ``find`` names a block's candidates.  With ``light`` (doc, light), blocks are first searched
    with that column instead of whole texts, which only those with many candidates then need.
    """
    led = leaders(lists)
    of = led.select(F.col("a").alias("fam"), F.col("b").alias("doc"))
    links = texts.links(near(led))
    rest = open_lists(lists.select("key", "doc", "n"), components(links))
    members = rest.select("doc", "n", "comp").distinct().join(of, "doc", "left").withColumn("fam", F.coalesce("fam", "doc"))
    links = links.union(texts.links(near(materialize(pivots(members, texts.num, texts.den)))))
    rest = open_lists(rest, components(links)).join(of, "doc", "left").withColumn("fam", F.coalesce("fam", "doc"))
    partitions = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = block_rows(rest)
    dealt = lambda rows: rows.repartition(partitions, "key", "block").sortWithinPartitions("key", "block")
    if light is not None:
        hits = materialize(dealt(blocks.join(light, "doc")).mapInArrow(_light_pairs(find_light), "a long, b long, key long, block long"))
        links = links.union(texts.links(materialize(hits.filter("a is not null").select("a", "b").distinct())))
        blocks = blocks.join(hits.filter("a is null").select("key", "block").distinct(), ["key", "block"])
    rows = blocks.join(texts.rows(blocks.select("doc").distinct()), "doc")
    found = dealt(rows).mapInArrow(_block_links(find, texts.shingle, texts.num, texts.den), "a long, b long").distinct()
    return links.union(materialize(found))


def components(edges: DataFrame) -> DataFrame:
    """(doc, comp) for all documents of edges (a, b): the least one reachable.

    Alternating large and small stars: every document links its neighbours to
    the least one around, until nothing changes.
    """
    def seal(pairs: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(pairs.agg(F.count("*"), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first())

    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct().checkpoint()
    before = seal(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("v")).select(F.col("m").alias("a"), "b").filter("a < b").distinct())
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        now = (large.join(down, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x < y").distinct()
               .select(F.col("x").alias("a"), F.col("y").alias("b")).checkpoint())
        after = seal(now)
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("doc"), F.col("a").alias("comp")).union(now.select("a", "a").distinct())


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    from turnstile.session import ensure_checkpoint_dir

    flat.small_batches(docs.sparkSession)
    ensure_checkpoint_dir(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))


def oracle(words: int, num: int, den: int, columns: str) -> str:
    """SQL for the components of documents whose sets of shingles link; ``columns`` of n and comp."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS shingle FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE {num + den} * shared >= {num} * (x.n + y.n)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a),
least_reached AS (SELECT a, min(b) AS c FROM reached GROUP BY a),
grouped AS (
  SELECT doc_id, coalesce(n, 0) AS n, least(doc_id, coalesce(c, doc_id)) AS comp
  FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON a = doc_id)
SELECT doc_id, {columns} FROM grouped
"""
