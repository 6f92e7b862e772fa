"""Personal data: exact base patterns, and weakly supervised spans beyond them.

Base spans (email, ip, card, phone) are found by four patterns with checks of
their own and always stay.  Further candidates (phone numbers without a plus,
secrets) come from loose patterns and get three votes each: a stricter
pattern, a gazetteer of cue words right before the span, and its context
(what stands directly around it).  Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is and how likely a
candidate is real; these likelihoods then train the span classifier, a naive
Bayes model over votes and span features, which decides.

Only DataFrame functions are used: text is split at a pattern, and the lengths
of what lies between and of the matches give the positions.  Texts without a
digit or "@" can't hold a span and skip the patterns.  What the driver sees
are counts by vote pattern, of which there are at most 384.

The patterns are written so that Java's matcher neither recurses over long
runs nor tries every start inside one; the matches are those of the plain
patterns in the comments.

Defined cases: a null or empty text has no spans; null or repeated ids are
judged row by row; an empty table gives an empty result.  Other columns are
ignored, or kept if named in ``extra``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: fixed patterns of the base kinds, as matched
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ ; a lone digit also matches here and fails the check
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: loose patterns of the added kinds; group 0 is the span
LOOSE = {
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+",
}
STRICT = {"phone": r"^\([0-9]{3}\) [0-9]{3}-[0-9]{4}$", "secret": r"^(?:[0-9a-f]{16,}|AKIA[0-9A-Z]{12,}|(?:sk|ghp|gho|xox[bp])[-_][A-Za-z0-9]+)$"}
CUES = {"phone": r"(?i)(?:phone|tel|telephone|call|mobile|fax|cell)[ .:]*$",
        "secret": r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key|key|credential)[\"' ]*[=:]?[\"' ]*$"}
AROUND = {"phone": r"[ (:,]$", "secret": r"[=:][ \"']*$"}
BEFORE = 32  # characters before a span that labelers see


#: elements that a scan appends at a time, at least
STEP = 128
#: characters of a piece that masking cuts from
PIECE = 1024


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan(items: Column, state: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column],
          out: str, keep: Callable[[Column, Column], Column] | None = None) -> Column:
    """struct(state, out): the states run over the items; ``out`` (of type array ``out``) has what each
    item emits from the state before it.  Appends go to short arrays, so the work grows little more than the items."""
    none = F.array().cast(out)

    many = F.greatest(F.lit(STEP), F.sqrt(F.size(items)).cast("int"))  # taking a slice reads all items

    def one(done: Column, x: Column) -> Column:
        def with_state(t: Column) -> Column:
            more = F.concat(done["out"], F.array(emit(t, x)))
            return F.struct(step(t, x).alias("state"), (more if keep is None else F.when(keep(t, x), more).otherwise(done["out"])).alias("out"))

        return with_state(done["state"])

    def some(done: Column, at: Column) -> Column:
        inner = F.aggregate(F.slice(items, at + 1, many), F.struct(done["state"].alias("state"), none.alias("out")), one)
        return _bound(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(done["out"], F.array(r["out"])).alias("out")))

    start = F.struct(state.alias("state"), F.array().cast(f"array<{out}>").alias("out"))
    at = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), many)
    return F.aggregate(at, start, some, lambda done: F.struct(done["state"].alias("state"), F.flatten(done["out"]).alias("out")))


_BODIES = "array<struct<from: bigint, to: bigint, body: string, before: string>>"


def _spans(pattern: str) -> Column:
    """Matches of a pattern in _text: array of (from, to, body, before), code points, end exclusive;
    before: the characters before it."""
    both = F.arrays_zip(F.split("_text", pattern, -1).alias("gap"), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)).alias("body"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("tail"))
    seen = lambda t, x: F.right(F.concat(t["tail"], F.right(x["gap"], F.lit(BEFORE))), F.lit(BEFORE))

    def step(t: Column, x: Column) -> Column:
        to = t["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["body"]), F.lit(0))
        return F.struct(to.alias("at"), F.right(F.concat(seen(t, x), F.coalesce(x["body"], F.lit(""))), F.lit(BEFORE)).alias("tail"))

    def emit(t: Column, x: Column) -> Column:
        at = t["at"] + F.length(x["gap"])
        return F.struct(at.alias("from"), (at + F.length(x["body"])).alias("to"), x["body"].alias("body"), seen(t, x).alias("before"))

    return _bound(both, lambda b: _scan(b, start, step, emit, _BODIES, lambda t, x: x["body"].isNotNull())["out"])


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.try_element_at(F.split(digits, ""), -i).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, body: Column) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        small = lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).cast("int") <= 255).otherwise(False)
        return F.forall(F.split(body, r"\."), small)
    if kind == "card":
        digits = F.translate(body, " -", "")
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(body, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda s: _passes(kind, s["body"])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def _typed(spans: Column, kind: str, turn: int) -> Column:
    """(from, turn, kind, to), which sort as spans are listed."""
    return F.transform(spans, lambda s: F.struct(s["from"].alias("from"), F.lit(turn).alias("turn"), F.lit(kind).alias("kind"), s["to"].alias("to")))


_NONE = "array<struct<from: bigint, turn: int, kind: string, to: bigint>>"


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``base``: the sorted base spans of _text."""
    digit, at = F.col("_text").rlike("[0-9]"), F.contains("_text", F.lit("@"))
    guard = {"email": at, "ip": digit & F.contains("_text", F.lit(".")), "card": digit, "phone": digit & F.contains("_text", F.lit("+"))}
    empty = F.array().cast(_NONE)
    found = [F.when(guard[k], _typed(F.filter(_spans(BASE[k]), _check(k)), k, i)).otherwise(empty)
             for i, k in enumerate(KINDS)]
    return docs.withColumn("base", F.array_sort(F.concat(*found)))


def _votes(kind: str):
    def votes(s: Column) -> Column:
        before = s["before"]
        digits = F.length(F.regexp_replace(s["body"], "[^0-9]", ""))
        size = s["to"] - s["from"]
        return F.struct(s["from"].alias("from"), s["to"].alias("to"), F.lit(kind).alias("kind"),
                        s["body"].rlike(STRICT[kind]).cast("int").alias("strict"), before.rlike(CUES[kind]).cast("int").alias("cue"),
                        before.rlike(AROUND[kind]).cast("int").alias("around"), F.least(F.floor(size / 8), F.lit(5)).cast("int").alias("size"),
                        F.floor(F.lit(3) * digits / size).cast("int").alias("digits"))

    return votes


_LOOSE = "array<struct<from: bigint, to: bigint, kind: string, strict: int, cue: int, around: int, size: int, digits: int>>"


def _free(spans: Column) -> Column:
    """The spans that touch no base span, by a scan to each side over both kinds in order of their starts."""
    none = F.lit(None).cast(_LOOSE[6:-1])
    marks = F.array_sort(F.concat(
        F.transform("base", lambda b: F.struct(b["from"].alias("from"), b["to"].alias("to"), F.lit(None).cast("int").alias("turn"), none.alias("s"))),
        F.transform(spans, lambda s, i: F.struct(s["from"].alias("from"), s["to"].alias("to"), i.alias("turn"), s.alias("s")))))
    kind = "array<struct<from: bigint, to: bigint, turn: int, s: " + _LOOSE[6:-1] + ">>"
    far = F.lit(2**62).cast("long")

    def earlier(done: Column) -> Column:  # no base span that starts before it, or with it, ends after its start
        return _scan(done, F.lit(0).cast("long"), lambda t, x: F.when(x["s"].isNull(), F.greatest(t, x["to"])).otherwise(t), lambda t, x: x, kind,
                     lambda t, x: x["s"].isNull() | (t <= x["from"]))["out"]

    def later(done: Column) -> Column:  # none starts before its end
        return _scan(F.reverse(done), far, lambda t, x: F.when(x["s"].isNull(), x["from"]).otherwise(t), lambda t, x: x["s"], _LOOSE,
                     lambda t, x: x["s"].isNotNull() & (t >= x["to"]))["out"]

    return _bound(marks, lambda m: _bound(earlier(m), later))


def _candidates() -> Column:
    """Loose spans that touch no base span: array of (from, to, kind, strict, cue, around, size, digits)."""
    every = F.concat(*(F.transform(_spans(pattern), _votes(kind)) for kind, pattern in LOOSE.items()))
    return _bound(every, lambda spans: F.when(F.size(spans) == 0, spans).otherwise(_free(spans)))


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``base`` and ``loose``."""
    none = F.array().cast(_LOOSE)
    return base_spans(docs).withColumn("loose", F.when(F.col("_text").rlike("[0-9]"), _candidates()).otherwise(none))


VOTES, FEATURES = ("strict", "cue", "around"), ("strict", "cue", "around", "size", "digits")


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 60) -> tuple[float, list[tuple[float, float]]]:
    """EM over counts of vote patterns: (share of real spans, [(vote if real, vote if not)] by labeler)."""
    share, rate = 0.5, [(0.8, 0.2)] * len(next(iter(counts), ()))
    for _ in range(rounds):
        real = {v: posterior(v, share, rate) for v in counts}
        weight = sum(counts[v] * real[v] for v in counts)
        total = sum(counts.values())
        share = min(max(weight / total, 1e-4), 1 - 1e-4)
        rate = [((sum(counts[v] * real[v] * v[i] for v in counts) + 1) / (weight + 2),
                 (sum(counts[v] * (1 - real[v]) * v[i] for v in counts) + 1) / (total - weight + 2)) for i in range(len(rate))]
    return share, rate


def posterior(votes: tuple[int, ...], share: float, rate: list[tuple[float, float]]) -> float:
    yes, no = share, 1 - share
    for v, (p, q) in zip(votes, rate):
        yes, no = yes * (p if v else 1 - p), no * (q if v else 1 - q)
    return yes / (yes + no)


def train(docs: DataFrame) -> dict[str, tuple[float, list[dict[int, float]]]]:
    """Per kind the classifier: (bias, log odds of each feature's values).  docs: with ``loose``."""
    counts = (docs.select(F.explode("loose").alias("s")).groupBy("s.kind", *(f"s.{f}" for f in FEATURES))
              .agg(F.count("*").alias("n")).collect())  # at most 2 kinds, 2 ** 3 votes, 6 sizes, 4 shares
    model = {}
    for kind in LOOSE:
        rows = [r for r in counts if r["kind"] == kind]
        if not rows:
            continue
        by_votes: dict[tuple[int, ...], int] = {}
        for r in rows:
            key = tuple(r[v] for v in VOTES)
            by_votes[key] = by_votes.get(key, 0) + r["n"]
        share, rate = reliabilities(by_votes)
        real = [(r, r["n"] * posterior(tuple(r[v] for v in VOTES), share, rate)) for r in rows]
        yes, no = sum(w for _, w in real) + 1, sum(r["n"] - w for r, w in real) + 1
        odds = []
        for f in FEATURES:
            values = sorted({r[f] for r in rows})
            odds.append({v: math.log((sum(w for r, w in real if r[f] == v) + 1) / (yes + len(values)))
                         - math.log((sum(r["n"] - w for r, w in real if r[f] == v) + 1) / (no + len(values))) for v in values})
        model[kind] = math.log(yes / no), odds
    return model


def _accepted(model: dict[str, tuple[float, list[dict[int, float]]]]) -> Column:
    """The loose spans that the classifier takes, typed like base spans; of overlapping ones the leftmost."""
    def odds(s: Column) -> Column:
        by_kind = F.lit(-1.0)
        for kind, (bias, features) in model.items():
            total = F.lit(bias)
            for f, values in zip(FEATURES, features):
                score = F.lit(0.0)
                for value, weight in values.items():
                    score = F.when(s[f] == value, weight).otherwise(score)
                total = total + score
            by_kind = F.when(s["kind"] == kind, total).otherwise(by_kind)
        return by_kind

    turns = {k: i for i, k in enumerate([*KINDS, *(k for k in LOOSE if k not in KINDS)])}
    turn = lambda s: F.coalesce(*(F.when(s["kind"] == k, F.lit(i)) for k, i in turns.items()))
    typed = F.transform(F.filter("loose", lambda s: odds(s) > 0), lambda s: F.struct(
        s["from"].alias("from"), turn(s).alias("turn"), s["kind"].alias("kind"), s["to"].alias("to")))
    ends = lambda t, s: t <= s["from"]
    return _bound(F.array_sort(typed), lambda x: _scan(x, F.lit(0).cast("long"), lambda t, s: F.when(ends(t, s), s["to"]).otherwise(t),
                                                       lambda t, s: s, _NONE, ends)["out"])


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, the ``extra`` columns, base and spans (arrays of
    from, turn, kind, to; code points, end exclusive; spans has base and added ones)."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
                       *(F.col(c).alias(f"_x{i}") for i, c in enumerate(extra)))
    model = train(with_candidates(rows.select("_text").filter(F.col("_text").rlike("[0-9]"))))
    found = with_candidates(rows).withColumn("spans", F.array_sort(F.concat("base", _accepted(model))) if model else F.col("base"))
    return found.select(F.col("_id").alias(id_col), *(F.col(f"_x{i}").alias(c) for i, c in enumerate(extra)), "base", "spans")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are masked together."""
    def cut(pieces: Column, a: Column, b: Column) -> Column:
        """Characters [a, b) from pieces of PIECE each."""
        first, last = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
        part = lambda i, x, y: F.substring(F.coalesce(F.get(pieces, i), F.lit("")), (x - i * PIECE + 1).cast("int"), (y - x).cast("int"))
        whole = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(first == last, part(first, a, b)).otherwise(
            F.concat(part(first, a, (first + 1) * PIECE), whole, part(last, last * PIECE, b)))

    def joined(pieces: Column) -> Column:
        done = _scan(spans, F.lit(0).cast("long"), lambda t, s: F.greatest(t, s["to"]), lambda t, s: F.concat(
            cut(pieces, t, s["from"]), F.lit("<"), s["kind"], F.lit(">")), "array<string>", lambda t, s: s["from"] >= t)
        return _bound(done, lambda d: F.concat(F.array_join(d["out"], ""), cut(pieces, d["state"], F.length(text).cast("long"))))

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(_bound(pieces, joined))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["to"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """op10: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return find(docs).select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
