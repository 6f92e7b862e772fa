"""Column expressions with the semantics the staging jobs rely on.

All of them are compositions of ``pyspark.sql.functions``; none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def isnull(c: str | Column, default) -> Column:
    """``isnull(x, d)``: ``x`` when not NULL, else ``d``.

    The default is cast to the type of ``x`` at analysis time by ``coalesce``'s
    type coercion; pass a literal of the right kind (0 for ids, '' for text,
    a ``datetime`` for timestamps).
    """
    return F.coalesce(col_of(c), F.lit(default))


def collated(c: str | Column, collation: str = "UTF8_LCASE_RTRIM") -> Column:
    """String key compared case-insensitively and ignoring trailing blanks,
    the way the operational database's default collation does.  Grouping,
    DISTINCT and equi-joins on the result follow the collation."""
    return F.collate(col_of(c), collation)


def mask_card(c: str | Column, keep: int = 4) -> Column:
    """Card number with all but the last ``keep`` characters replaced by '*'."""
    x = col_of(c)
    n = F.length(x)
    return F.when(n > keep, F.concat(F.repeat(F.lit("*"), n - keep), F.substring(x, -keep, keep))
                  ).otherwise(x)


def zero_to_null(c: str | Column) -> Column:
    """``case when x = 0 then null else x end``."""
    return F.nullif(col_of(c), F.lit(0))


def label(c: str | Column, value, when_equal: str, otherwise: str) -> Column:
    """``case when x = value then A else B end`` -- NULL falls to ``B``."""
    return F.when(col_of(c) == F.lit(value), F.lit(when_equal)).otherwise(F.lit(otherwise))


def tsql_len(c: str | Column) -> Column:
    """``len(x)``: character count ignoring trailing spaces; NULL stays NULL."""
    return F.length(F.rtrim(col_of(c)))


def is_not_blank(c: str | Column) -> Column:
    """``len(ltrim(x)) <> 0``.  NULL yields NULL, i.e. the row is dropped by a
    filter -- a NULL name satisfies neither this nor :func:`is_blank`."""
    return tsql_len(F.ltrim(col_of(c))) != F.lit(0)


def is_blank(c: str | Column) -> Column:
    """``len(ltrim(x)) = 0``: empty or only spaces.  NULL yields NULL."""
    return tsql_len(F.ltrim(col_of(c))) == F.lit(0)


def plus_concat(*parts: str | Column) -> Column:
    """String ``+``: NULL if any part is NULL (``concat`` propagates NULL)."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def spaces_to_underscores(c: str | Column) -> Column:
    """``replace(x, ' ', '_')``."""
    return F.translate(col_of(c), " ", "_")


def hhmm(ts: str | Column) -> Column:
    """``convert(varchar(5), ts, 8)``: time of day as ``HH:mm`` (seconds cut)."""
    return F.date_format(col_of(ts), "HH:mm")


def mmddyyyy(ts: str | Column) -> Column:
    """``convert(varchar(10), ts, 101)``: ``MM/dd/yyyy``."""
    return F.date_format(col_of(ts), "MM/dd/yyyy")


def add_minutes(ts: str | Column, minutes: str | Column) -> Column:
    """``dateadd(n, m, ts)``; NULL minutes give NULL.  Stays timestamp_ntz."""
    return F.timestamp_add("MINUTE", col_of(minutes), col_of(ts))


def minutes_of_day(hhmm_text: str | Column) -> Column:
    """``datepart(hh, t) * 60 + datepart(mi, t)`` for an ``HH:mm`` string.

    Parsed from the text itself, so no time zone is involved."""
    t = col_of(hhmm_text)
    return F.substring(t, 1, 2).cast("int") * 60 + F.substring(t, 4, 2).cast("int")


# The five predefined XML entities and their characters.
_XML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#xD;")]
_XML_ENTITIES = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")]


def xml_escape(c: str | Column) -> Column:
    """Escape text for XML element content (``&``, ``<``, ``>``, carriage return).

    Control characters that XML 1.0 has no form for become U+FFFD."""
    out = F.regexp_replace(col_of(c), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "\ufffd")
    for raw, ent in _XML_ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(ent))
    return out


def _reference(piece: Column) -> Column:
    """What follows an ampersand, with its reference resolved; as it was if it is none."""
    hexa = F.conv(F.regexp_extract(piece, "^#x0*([0-9A-Fa-f]{1,6});", 1), 16, 10).cast("int")
    deci = F.regexp_extract(piece, "^#0*([0-9]{1,7});", 1)
    code = F.when(piece.startswith("#x"), hexa).when(F.length(deci) > 0, deci.cast("int"))
    is_char = (code.isin(9, 10, 13) | code.between(0x20, 0xD7FF) | code.between(0xE000, 0xFFFD) | code.between(0x10000, 0x10FFFF))
    sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    out = F.when(is_char, F.concat(sign, F.regexp_replace(piece, "^[^;]*;", "")))
    for name, char in _XML_ENTITIES:
        out = out.when(piece.startswith(f"{name};"), F.concat(F.lit(char), F.substring(piece, F.lit(len(name) + 2), F.length(piece))))
    return out.otherwise(F.concat(F.lit("&"), piece))


def xml_unescape(c: str | Column) -> Column:
    """Resolve references, each once and from left to right: the five named
    ones and decimal and hexadecimal characters that XML 1.0 allows; anything else stays."""
    pieces = F.split(col_of(c), "&", -1)
    return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _reference), ""))


def xml_attribute(name: str, text: str | Column) -> Column:
    """Value of the first ``name="..."`` attribute in an XML/HTML text.

    Contract of the attribute getter the payment roll-up calls: the attribute
    value (outside comments) with references resolved, NULL when the attribute is absent or empty
    or the text is NULL.  A regular expression is used instead of an XPath so
    a malformed document yields NULL for that row instead of failing the job.
    """
    if not name.replace("_", "").replace("-", "").isalnum():
        raise ValueError(f"invalid attribute name {name!r}")
    pattern = rf"""[ \t\r\n]{name}[ \t\r\n]*=[ \t\r\n]*("[^"]*"|'[^']*')"""
    raw = F.regexp_extract(F.regexp_replace(col_of(text), "(?s)<!--.*?(-->|$)", ""), pattern, 1)
    return xml_unescape(F.nullif(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit("")))
