"""HTML character references, resolved in one pass (so ``&amp;lt;`` gives ``&lt;``)."""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrain.functions.expressions import LookupTable, bind

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

# The HTML standard's names come from the Python standard library.
NAMED = LookupTable(html5, "string")
# Names that old pages may write without the closing semicolon, longest first.
BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
# Numbers below 160 follow the standard's replacement table.
LOW_NUMBERS = LookupTable({str(n): html.unescape(f"&#{n};") for n in range(160)}, "string")

UNKNOWN = "�"
LAST_CODE_POINT = 0x10FFFF


def _character(number: Column) -> Column:
    in_plane = number % 0x10000
    return (
        F.when(number < 160, LOW_NUMBERS(number.cast("string")))
        .when((number > LAST_CODE_POINT) | number.between(0xD800, 0xDFFF), F.lit(UNKNOWN))
        .when(number.between(0xFDD0, 0xFDEF) | (in_plane >= 0xFFFE), F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def _numeric(digits: Column, base: int) -> Column:
    # ``conv`` ends at the largest 64-bit number; far shorter numbers are out of range already.
    value = F.when(F.length(digits) > 12, F.lit(LAST_CODE_POINT + 1).cast("long")).otherwise(
        F.conv(digits, base, 10).cast("long")
    )
    return bind(F.least(value, F.lit(LAST_CODE_POINT + 1).cast("long")).cast("int"), _character)


def _digits(reference: Column, pattern: str) -> Column:
    return F.regexp_extract(reference, pattern, 1)


def _resolve(reference: Column) -> Column:
    name = F.substring(reference, 2, 64)
    prefix = F.regexp_extract(name, f"^({BARE_NAMES})", 1)
    by_prefix = F.when(
        prefix != "", F.concat(NAMED(prefix), F.substr(name, F.length(prefix) + 1))
    ).otherwise(reference)
    return (
        F.when(reference == "&amp;", F.lit("&"))
        .when(
            reference.rlike("^&#[0-9]"),
            _numeric(F.concat(F.lit("0"), F.regexp_replace(_digits(reference, "([0-9]+)"), "^0+", "")), 10),
        )
        .when(
            reference.startswith("&#"),
            _numeric(
                F.concat(
                    F.lit("0"), F.regexp_replace(_digits(reference, "^&#[xX]([0-9a-fA-F]+)"), "^0+", "")
                ),
                16,
            ),
        )
        .otherwise(F.coalesce(NAMED(name), by_prefix))
    )


def unescape_html(text: Column) -> Column:
    """Replace numeric and named references; everything else is kept as it is."""

    def rebuilt(raw: Column) -> Column:
        # One gap more than references: the last gap meets null. No lambda looks at a variable of an outer one two
        # levels up, because Spark leaves a Python function over such an expression where it cannot run.
        joined = F.array_join(
            F.zip_with(
                F.split(raw, REFERENCE, -1),
                F.regexp_extract_all(raw, F.lit(REFERENCE), F.lit(0)),
                lambda gap, reference: F.concat(gap, F.coalesce(bind(reference, _resolve), F.lit(""))),
            ),
            "",
        )
        candidate = F.contains(raw, F.lit("&")) & raw.rlike("&[#A-Za-z]")
        return F.when(candidate, joined).otherwise(raw)

    return bind(text, rebuilt)
