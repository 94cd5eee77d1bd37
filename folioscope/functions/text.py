"""Text functions with Unicode white space as Python's str methods see it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.shipping import ship

#: White space of str.strip() and str.split(): Unicode white space and the four separators. Fixed values.
SPACE = "[\\s\\x1c-\\x1f]"


def pytrim(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+\\z", "")


def pyrtrim(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U){SPACE}+\\z", "")


def pysplit(c: Column) -> Column:
    return F.array_remove(F.split(c, f"(?U){SPACE}+"), "")


def truthy(c: Column) -> Column:
    """The text, or null if it is empty: the left side of a Python `or`."""
    return F.nullif(c, F.lit(""))


def page_number(v: Column) -> Column:
    """int() of a JSON value: truncates numbers, reads digits in strings, true is 1; null where int() would fail."""
    text = pytrim(F.try_variant_get(v, "$", "string"))
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return (
        F.when(kind == "STRING", F.when(text.rlike("^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(text, "_", "").try_cast("int")))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int"))
        .otherwise(F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("int"))
    )


def stem(key: Column) -> Column:
    """Last path component without its suffix; a leading dot starts a name, not a suffix."""
    name = F.element_at(F.split(F.regexp_replace(key, "/+$", ""), "/"), -1)
    return F.regexp_replace(name, "(?<=.)\\.[^.]+$", "")


def strip_prefix(key: Column, prefix: str) -> Column:
    """key without leading slashes and without prefix, if it has it; null otherwise."""
    bare = prefix.strip("/")
    own = F.regexp_replace(key, "^/+", "")
    if not bare:
        return F.lit(None).cast("string")
    return F.when(F.startswith(own, F.lit(bare + "/")), F.substring(own, len(bare) + 2, 2**31 - 1))


def base64_line(c: Column) -> Column:
    """Base64 in one line: the built-in breaks lines every 76 characters."""
    return F.regexp_replace(F.base64(c), "[\\r\\n]", "")


def fixed(value: Column, digits: int) -> Column:
    """A double as %.nf of Python and C: its exact binary value rounded, ties to even; null if it is null.

    Java's formatter, behind format_string, rounds the shortest decimal that reads as the double: 0.39215, which
    is a little less than that, becomes 0.3922 there and 0.3921 here.
    """
    ship()

    def run(values: pd.Series) -> pd.Series:
        return pd.Series([f"{x:.{digits}f}" for x in values.tolist()], dtype=object)

    return F.when(value.isNotNull(), F.pandas_udf(run, "string")(value.cast("double")))


def json_lines(body: Column) -> Column:
    """Parsed lines of an NDJSON text as an array of variants; blank and malformed lines are skipped."""
    return F.filter(
        F.transform(F.filter(F.split(pytrim(body), "\n", -1), lambda x: pytrim(x) != ""), F.try_parse_json),
        lambda v: v.isNotNull(),
    )


# Page markers ----------------------------------------------------------------

MARKER = f"(?U)\\[PAGE{SPACE}+(\\d+)\\]"
#: Longest body of a chunk. A fixed value.
MAX_BODY = 8192


def strip_markers(fragment: Column) -> Column:
    c = F.regexp_replace(fragment, f"(?U){SPACE}*\\[PAGE{SPACE}+\\d+\\]{SPACE}*\\n?", "\n")
    return pytrim(F.regexp_replace(c, "\\n{3,}", "\n\n"))


def page_header(pages: Column) -> Column:
    """PAGES: unknown | n | first-last."""
    return (
        F.when(F.size(pages) == 0, F.lit("PAGES: unknown"))
        .when(F.size(pages) == 1, F.concat(F.lit("PAGES: "), F.get(pages, 0).cast("string")))
        .otherwise(F.concat(F.lit("PAGES: "), F.get(pages, 0).cast("string"), F.lit("-"), F.get(pages, F.size(pages) - 1).cast("string")))
    )


def chunk_body(pages: Column, fragment: Column, limit: int = MAX_BODY) -> Column:
    header = page_header(pages)
    body = pytrim(F.concat(header, F.lit("\n"), fragment))
    room = F.greatest(F.lit(0), F.lit(limit - 1) - F.char_length(header))
    short = pytrim(F.concat(header, F.lit("\n"), pyrtrim(F.substring(fragment, F.lit(1), room))))
    return F.when(F.char_length(body) > limit, short).otherwise(body)
