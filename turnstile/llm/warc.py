"""WARC archives: written by Spark's text sink, read back with boundary-chain verification.

Writing: one record per page; of records with equal payloads of at least
``min_bytes`` the one with the least id is the response and the others revisit
it.  The record separator (two line ends) is the sink's line separator, so the
files are plain WARC, whole-file gzip by default.  Any store that Spark writes
to will do.

Reading: the text source splits files at the magic line, which also occurs
inside payloads.  Each task emits, for every magic, the offset of the record
that may begin there and the offset its header promises for the next one.
Candidates whose promise is kept by the very next magic form chains; chains
are linked where a promise jumps over magics.  Pointer jumping from the start
of each file, doubling the jump in each round, finds the chains that are
reached; all else is payload.  Records that contain magics are then put
together again from a second reading of just those pieces.

Defined cases: a null payload is empty; a null url has no header; records keep
the id's text form, null ids have none and come last in the choice of the
response; pages with equal id and payload are all responses if they are first;
an empty table gives archives without records, and an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.session import ensure_checkpoint_dir

MAGIC = "WARC/1.1\r\n"  # fixed by the format
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends inside values are escaped."""
    safe = F.replace(F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 100, compression: str = "gzip") -> None:
    """Write the archives to ``path``."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), body.alias("_body"))
    rows = rows.withColumns({"_sha": F.sha2(F.col("_body"), 256), "_n": F.octet_length("_body")})
    firsts = (rows.filter(F.col("_n") >= min_bytes).groupBy("_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("_c"))
              .filter("_c > 1").select(F.col("_sha").alias("_fsha"), "_first"))
    rows = rows.join(firsts, (F.col("_sha") == F.col("_fsha")) & (F.col("_n") >= min_bytes), "left")
    again = F.coalesce(~F.col("_first").eqNullSafe(F.col("_id")) & F.col("_first").isNotNull(), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_sha")))
    common = F.concat(_line("WARC-Record-ID", urn(F.col("_id"))), _line("WARC-Target-URI", F.col("_url")), digest)
    response = F.concat(F.lit(MAGIC + "WARC-Type: response\r\n"), common, F.lit("Content-Type: text/html\r\n"),
                        _line("Content-Length", F.col("_n").cast("string")), F.lit("\r\n"), F.col("_body"))
    revisit = F.concat(F.lit(MAGIC + "WARC-Type: revisit\r\n"), common, _line("WARC-Refers-To", urn(F.col("_first"))),
                       F.lit(f"WARC-Profile: {PROFILE}\r\n"), _line("WARC-Payload-Length", F.col("_n").cast("string")),
                       F.lit("Content-Length: 0\r\n\r\n"))
    rows.select(F.when(again, revisit).otherwise(response).alias("value")).write.option("lineSep", END).option(
        "compression", compression).text(path)


_HEADER = re.compile(rb"([A-Za-z-]+): ?(.*)")
_LENGTH = re.compile(rb"[0-9]{1,15}")


def _unescape(text: bytes) -> str:
    return text.replace(b"%0D", b"\r").replace(b"%0A", b"\n").replace(b"%25", b"%").decode(errors="replace")


def header(segment: bytes) -> tuple[dict[str, bytes], int] | None:
    """(fields, bytes up to the block) of what follows a magic; None unless it is a record's header."""
    stop = segment.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {}
    for line in segment[:stop].split(b"\r\n"):
        m = _HEADER.fullmatch(line)
        if not m:
            return None
        fields[m[1].decode().lower()] = m[2]
    if "warc-type" not in fields or not all(_LENGTH.fullmatch(fields.get(c, d)) for c, d in (("content-length", b""), ("warc-payload-length", b"0"))):
        return None
    return fields, stop + 4


PIECES = ("file string, block long, n long, at long, size long, next long, kind string, rid string, uri string, refers string, "
          "length long, digest string, skip long, promised long")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each magic promises, with offsets inside its block of the file."""
    place: dict[tuple, list[int]] = {}  # of the blocks this task reads: pieces and bytes so far
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.string() if c.split()[1] == "string" else pa.int64() for c in PIECES.split(", ")]
    for batch in batches:
        rows = []
        for file, block, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
            done = place.setdefault((file, block), [0, 0])
            n, start = done
            done[0], done[1] = n + 1, start + len(value) + len(MAGIC)
            row = dict.fromkeys(names) | {"file": file, "block": block, "n": n, "at": start - len(MAGIC),
                                          "size": len(value) + len(MAGIC)}
            got = None if n == 0 and block == 0 else header(value)
            if got:
                fields, skip = got
                size = int(fields["content-length"])
                body = value[skip:skip + size]
                row |= {"next": start + skip + size + len(END), "kind": fields["warc-type"].decode(errors="replace"),
                        "skip": skip, "promised": size}
                for name, key in (("rid", "warc-record-id"), ("refers", "warc-refers-to")):
                    if fields.get(key, b"").startswith(b"<urn:page:"):
                        row[name] = _unescape(fields[key][10:-1])
                if "warc-target-uri" in fields:
                    row["uri"] = _unescape(fields["warc-target-uri"])
                if row["kind"] == "revisit":
                    row["length"] = int(fields.get("warc-payload-length", b"0"))
                    row["digest"] = fields.get("warc-payload-digest", b"").decode(errors="replace").removeprefix("sha256:")
                elif len(body) == size:
                    row |= {"length": size, "digest": hashlib.sha256(body).hexdigest()}
            rows.append(row)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place: dict[tuple, int] = {}
    for batch in batches:
        n = []
        for key in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            place[key] = place.get(key, -1) + 1
            n.append(place[key])
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(n, pa.int64()), batch.column("value")],
                                         ["file", "block", "n", "value"])


def reached(links: DataFrame) -> DataFrame:
    """(file, head) of the chains reached from offset 0: pointer jumping over links (file, head, to)."""
    now = links.filter("head = 0").select("file", "head").distinct()
    jump = links.filter("to is not null").select("file", "head", "to")
    heads = links.select(F.col("file").alias("f2"), F.col("head").alias("h2"))
    jump = jump.join(heads, (F.col("file") == F.col("f2")) & (F.col("to") == F.col("h2"))).select("file", "head", "to").checkpoint()
    while not jump.isEmpty():  # in round k a jump covers 2 ** k chains
        more = now.join(jump, ["file", "head"]).select("file", F.col("to").alias("head"))
        now = now.union(more).distinct().checkpoint()
        then = jump.select(F.col("file").alias("f2"), F.col("head").alias("h2"), F.col("to").alias("t2"))
        jump = (jump.join(then, (F.col("file") == F.col("f2")) & (F.col("to") == F.col("h2")))
                .select("file", "head", F.col("t2").alias("to")).checkpoint())
    return now


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: file, at, kind, page, uri,
    refers, length and digest of the payload (a revisit's are its header's)."""
    ensure_checkpoint_dir(spark)
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))
    raw = lines.mapInArrow(_pieces, PIECES).checkpoint()
    sizes = raw.groupBy("file", "block").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    pieces = raw.join(base, ["file", "block"]).withColumns(
        {"at": F.col("at") + F.col("base"), "next": F.col("next") + F.col("base")})
    in_file = Window.partitionBy("file").orderBy("at")
    pieces = pieces.withColumn("after", F.lead("at").over(in_file))
    kept = F.col("next").eqNullSafe(F.coalesce("after", F.col("at") + F.col("size")))
    jumps = pieces.filter(~kept & F.col("next").isNotNull()).select(
        F.col("file").alias("f2"), F.col("next").alias("n2")).distinct()
    marked = (pieces.withColumn("kept", kept).join(jumps, (F.col("file") == F.col("f2")) & (F.col("at") == F.col("n2")), "left")
              .withColumn("starts", F.col("n2").isNotNull() | (F.col("at") == 0) | ~F.coalesce(F.lag("kept").over(in_file), F.lit(False)))
              .drop("f2", "n2"))
    chained = marked.filter("at >= 0").withColumn(
        "head", F.max(F.when(F.col("starts"), F.col("at"))).over(in_file)).checkpoint()
    links = chained.groupBy("file", "head").agg(F.max_by("next", "at").alias("to"))
    true = chained.join(reached(links), ["file", "head"], "left_semi").filter("next is not null")
    columns = ["file", "at", "kind", "rid", "uri", "refers", "length", "digest"]
    whole = true.filter("kept").select(columns)
    if true.filter("not kept").isEmpty():
        return whole
    return whole.unionByName(_joined(lines, chained, true.filter("not kept")).select(columns))


def _joined(lines: DataFrame, chained: DataFrame, long: DataFrame) -> DataFrame:
    """Records with magics inside: their pieces are read again and put together."""
    owner = long.select("file", F.col("at").alias("o_at"), F.col("next").alias("o_next"))
    marks = chained.join(owner.select("file", F.col("o_at").alias("at"), "o_at", "o_next"), ["file", "at"], "left")
    so_far = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    of = marks.withColumns({"o_at": F.last("o_at", True).over(so_far), "o_next": F.last("o_next", True).over(so_far)})
    of = of.filter(F.col("at") < F.col("o_next")).select("file", "block", "n", "at", "o_at")
    text = lines.mapInArrow(_numbered, "file string, block long, n long, value binary").join(of, ["file", "block", "n"])
    parts = text.groupBy("file", "o_at").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
    rest = parts.select("file", F.col("o_at").alias("at"), F.aggregate(
        F.slice("parts", 2, F.size("parts")), F.get("parts", 0)["value"],
        lambda done, p: F.concat(done, F.lit(MAGIC.encode()), p["value"])).alias("record"))
    body = F.expr("substring(record, cast(skip + 1 as int), cast(promised as int))")
    out = long.drop("length", "digest").join(rest, ["file", "at"]).withColumn("body", body)
    return out.filter(F.octet_length("body") == F.col("promised")).withColumns(
        {"length": F.octet_length("body").cast("long"), "digest": F.sha2("body", 256)})


def digest(pages: DataFrame, path: str | None = None) -> DataFrame:
    """op5: page_id, payload_bytes, payload_digest, record_type, refers_to, read back from archives."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    kind = pages.schema["page_id"].dataType
    return read(spark, path).select(
        F.col("rid").cast(kind).alias("page_id"), F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers").cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""
