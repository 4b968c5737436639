"""Scalar column expressions. All are JVM-side built-ins (no Python UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns for a stringified one-element id list such as "['abc']".
# "single" needs the closing "']" right after the first id, so lists with two or
# more ids give an empty string; "first" takes the first id of any list.
PRIMARY_ID_PATTERNS = {
    "single": r"^\['([^']+)'\]",
    "first": r"^\['([^']+)'",
}

WHITESPACE = "[ \\t\\n\\x0B\\f\\r]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def primary_entity_id(col, mode: str = "single") -> Column:
    """First id of a stringified list; '' when the pattern does not match, NULL for NULL."""
    if mode not in PRIMARY_ID_PATTERNS:
        raise ValueError(f"unknown mode {mode!r}; use one of {sorted(PRIMARY_ID_PATTERNS)}")
    return F.regexp_extract(_c(col), PRIMARY_ID_PATTERNS[mode], 1)


def parse_list_string(col) -> Column:
    """"['a', 'b']" -> [a, b]; '[]' -> []; NULL -> NULL.

    A bracket at either end and all single quotes go; what is left is a comma
    list whose elements lose the white space around them. Nothing left: no element.
    """
    s = _c(col).cast("string")
    first = F.when(s.startswith("["), 2).otherwise(1)
    inner = F.substr(s, first, F.length(s) - first + 1 - F.when(s.endswith("]"), 1).otherwise(0))
    items = F.transform(F.split(F.translate(inner, "'", ""), ","), strip_blanks)
    none = F.array().cast(T.ArrayType(T.StringType()))
    return F.when(items == F.array(F.lit("")), none).otherwise(items)


#: All white space of Unicode, and the four separators of ASCII.
BLANKS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def strip_blanks(col) -> Column:
    """Text without white space at either end."""
    return F.regexp_replace(_c(col), f"^{BLANKS}+|{BLANKS}+$", "")


def normalize_label(col) -> Column:
    return F.lower(F.trim(_c(col)))


def release_year(col) -> Column:
    """Year from the first four characters; NULL when shorter or not a number."""
    c = _c(col)
    return F.when(F.length(c) >= 4, c.substr(1, 4).try_cast("int"))


def coalesce_existing(df: DataFrame, cols: list[str]) -> Column:
    """First non-NULL value among the listed columns that exist in ``df``."""
    present = [F.col(c) for c in cols if c in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return present[0] if len(present) == 1 else F.coalesce(*present)


def clean_list_value(df: DataFrame, col: str) -> Column:
    """List -> non-NULL elements trimmed and joined by a space; scalar -> trimmed text; NULL -> ''."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.ArrayType):
        kept = F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: strip_blanks(x.cast("string")))
        return F.coalesce(strip_blanks(F.array_join(kept, " ")), F.lit(""))
    return F.coalesce(strip_blanks(c.cast("string")), F.lit(""))


RESPONSE_SCHEMA = "array<struct<plainLyrics:string,syncedLyrics:string>>"


def pick_text(col) -> Column:
    """First element of a JSON array response: plain text, else synced text; empty, bad or no array -> NULL."""
    array = F.when(strip_blanks(col).startswith("["), _c(col))  # else a single object would be taken for an array
    first = F.get(F.from_json(array, RESPONSE_SCHEMA), 0)
    return F.coalesce(F.nullif(first["plainLyrics"], F.lit("")),
                      F.nullif(first["syncedLyrics"], F.lit("")))


def pick_text_variant(df: DataFrame, col: str) -> DataFrame:
    """Add ``lyrics`` (as ``pick_text``, but texts only) and ``reason``, which tells responses without one apart.

    Reasons: ``ok``; ``no_response`` (NULL); ``not_json``; ``no_array``; ``empty`` (no element, or no text in it);
    ``not_text`` (a value of another type where the text should be).
    """
    v = F.try_parse_json(F.col(col))

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("_v", path, "variant"))

    def text(path: str) -> Column:
        return F.when(kind(path) == "STRING", F.nullif(F.try_variant_get("_v", path, "string"), F.lit("")))
    fields = ("$[0].plainLyrics", "$[0].syncedLyrics")
    wrong = reduce(lambda a, b: a | b, [F.coalesce(~kind(f).isin("STRING", "VOID"), F.lit(False)) for f in fields])
    out = df.withColumn("_v", v).withColumn("lyrics", F.coalesce(*[text(f) for f in fields]))
    reason = (F.when(F.col(col).isNull(), "no_response").when(F.col("_v").isNull(), "not_json")
              .when(~F.schema_of_variant("_v").startswith("ARRAY"), "no_array").when(F.col("lyrics").isNotNull(), "ok")
              .when(wrong, "not_text").otherwise("empty"))
    out = out.withColumn("reason", reason)
    return out.withColumn("lyrics", F.when(F.col("reason") == "ok", F.col("lyrics"))).drop("_v")


def all_not_null(cols: list[str]) -> Column:
    """Conjunctive IS NOT NULL (unlike ``dropna`` it keeps NaN)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def sample_key(seed, salt: str, *id_cols) -> Column:
    """Reproducible pseudo-random order key: md5 of 'seed:salt:id...' (hex text)."""
    parts = [F.lit(str(seed)), F.lit(salt)] + [_c(c).cast("string") for c in id_cols]
    return F.md5(F.concat_ws(":", *parts))


def euclidean(left: list, right: list) -> Column:
    """sqrt of the sum of squared differences, terms summed in feature order."""
    terms = [(_c(a) - _c(b)) * (_c(a) - _c(b)) for a, b in zip(left, right)]
    return F.sqrt(reduce(lambda x, y: x + y, terms))


def dot(left: list, right: list) -> Column:
    terms = [_c(a) * _c(b) for a, b in zip(left, right)]
    return reduce(lambda x, y: x + y, terms)


def norm(cols: list) -> Column:
    return F.sqrt(reduce(lambda x, y: x + y, [_c(c) * _c(c) for c in cols]))


def array_euclidean(a, b) -> Column:
    """Euclidean distance of two numeric arrays (element pairs summed left to right)."""
    sq = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double"))
                    * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))
