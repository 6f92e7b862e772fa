"""Scalar column helpers.  Every helper returns a built-in Spark expression
(no Python UDFs), so it stays inside whole-stage codegen."""

from turnstile.functions.scalar import (  # noqa: F401
    add_minutes,
    col_of,
    collated,
    hhmm,
    is_blank,
    is_not_blank,
    isnull,
    label,
    mask_card,
    minutes_of_day,
    mmddyyyy,
    plus_concat,
    spaces_to_underscores,
    tsql_len,
    xml_attribute,
    xml_escape,
    xml_unescape,
    zero_to_null,
)
