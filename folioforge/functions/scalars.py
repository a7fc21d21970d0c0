"""Scalar rules of bibliographic records, as native column expressions.

A normalizer gives NULL for an absent or malformed value; its `bad_*` partner tells the malformed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Resolver prefixes and shapes of identifiers.
ID_PREFIX = "https://openalex.org/"
DOI_PREFIX = r"(?i)^https?://(dx\.)?doi\.org/"
ORCID_PREFIX = r"(?i)^https?://orcid\.org/"
ROR_PREFIX = r"(?i)^https://ror\.org/"
ID_SHAPE = r"^[WAISPTFC][0-9]+$"
KEYWORD_SHAPE = r"^keywords/[A-Za-z0-9][A-Za-z0-9_-]*$"
ORCID_SHAPE = r"^[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]$"
ROR_SHAPE = r"^0[a-zhj-km-np-tv-z0-9]{6}[0-9]{2}$"
ISSN_SHAPE = r"^[0-9]{4}-[0-9]{3}[0-9X]$"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# Letters whose case folding holds ASCII letters that lower case does not give (all there are in Unicode).
FOLDED = {
    "\u00df": "ss", "\u0149": "\u02bcn", "\u017f": "s", "\u01f0": "j\u030c", "\u1e96": "h\u0331", "\u1e97": "t\u0308", "\u1e98": "w\u030a", "\u1e99": "y\u030a", "\u1e9a": "a\u02be",
    "\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st",
}
EMAIL_SHAPE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def strip(c: Column) -> Column:
    """All surrounding white space away."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def optional_text(c: Column) -> Column:
    """Trimmed text; blank is NULL."""
    return F.nullif(strip(c), F.lit(""))


def _without_url(c: Column) -> Column:
    text = strip(c)
    return F.when(F.lower(F.left(text, F.lit(len(ID_PREFIX)))) == ID_PREFIX, F.substring(text, len(ID_PREFIX) + 1, 1_000_000)).otherwise(text)


def normalize_id(c: Column, prefix: str | None = None) -> Column:
    """Short entity id, such as W123; with prefix only ids of that entity."""
    short = _without_url(c)
    shape = ID_SHAPE if prefix is None else f"^{prefix}[0-9]+$"
    return F.when(short.rlike(shape), short)


def bad_id(c: Column, prefix: str | None = None, required: bool = False) -> Column:
    """True for a value that is no id; with required, absent values count as well."""
    bad = (optional_text(c).isNotNull() | F.lit(required)) & normalize_id(c, prefix).isNull()
    return F.coalesce(bad, F.lit(False))


def bad_present_id(c: Column, prefix: str) -> Column:
    """True for a value that is there (a blank one included) and is no id of that entity."""
    return c.isNotNull() & normalize_id(c, prefix).isNull()


def normalize_keyword(c: Column) -> Column:
    short = _without_url(c)
    return F.when(short.rlike(KEYWORD_SHAPE), short)


def entity_url(short_id: Column) -> Column:
    return F.concat(F.lit(ID_PREFIX), short_id)


def normalize_doi(c: Column) -> Column:
    """Bare lower-case DOI."""
    text = F.lower(strip(F.regexp_replace(strip(c), DOI_PREFIX, "")))
    return F.when((text != "") & ~text.contains(" ") & ~text.rlike("^https?://"), text)


def normalize_orcid(c: Column) -> Column:
    text = F.upper(F.regexp_replace(strip(c), ORCID_PREFIX, ""))
    return F.when(text.rlike(ORCID_SHAPE), text)


def normalize_ror(c: Column) -> Column:
    text = F.lower(F.regexp_replace(strip(c), ROR_PREFIX, ""))
    return F.when(text.rlike(ROR_SHAPE), text)


def normalize_issn(c: Column) -> Column:
    text = F.replace(F.upper(strip(c)), F.lit(" "), F.lit(""))
    return F.when(text.rlike(ISSN_SHAPE), text)


def malformed(c: Column, normalized: Column) -> Column:
    """True for a value that is there but did not normalize."""
    return c.isNotNull() & normalized.isNull()


def strict_date(c: Column) -> Column:
    """A real calendar date written exactly YYYY-MM-DD."""
    text = strip(c)
    return F.when(text.rlike(DATE_SHAPE), F.try_to_date(text, "yyyy-MM-dd"))


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _in_order(c: Column, kind: T.DataType) -> Column:
    """c with the fields of structs and the keys of maps in order, at every depth."""
    if isinstance(kind, T.StructType):
        fields = [_in_order(c[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _in_order(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("key"), _in_order(e["value"], kind.valueType).alias("value")))))
    return c


def canonical_json(df: DataFrame, *columns: str) -> Column:
    """The columns as one JSON object: NULL written, keys in order at every depth, no blanks, all but printable ASCII as lower-case escapes.

    Doubles are as Spark writes them, so of 10^7 and more they carry an exponent. Map keys are unique within their map.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    whole = F.struct(*[_in_order(F.col(f"`{c}`"), kinds[c]).alias(c) for c in sorted(columns)])
    text = F.replace(F.to_json(whole, {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}), F.lit("\x7f"), F.lit("\\u007f"))
    # Escapes are told from an escaped backslash before a "u" by cutting the text from its start.
    cut = F.regexp_extract_all(text, F.lit(r"\\u[0-9A-Fa-f]{4}|\\.|[^\\]+"), F.lit(0))
    return F.when(text.contains("\\u"), F.array_join(F.transform(cut, lambda x: F.when(F.startswith(x, F.lit("\\u")), F.lower(x)).otherwise(x)), "")).otherwise(text)


def canonical_digest(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of canonical_json."""
    return F.sha2(canonical_json(df, *columns), 256)


def float32(c: Column) -> Column:
    return c.cast("float").cast("double")


def millis_text(c: Column) -> Column:
    """UTC time to the millisecond, finer parts cut off."""
    return F.date_format(F.date_trunc("millisecond", c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def tokens(c: Column) -> Column:
    """Case-folded runs of ASCII letters and digits."""
    lower = F.lower(c)
    folded = lower
    for letter, plain in FOLDED.items():
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    folded = F.when(lower.rlike(f"[{''.join(FOLDED)}]"), folded).otherwise(lower)
    return F.filter(F.split(F.regexp_replace(folded, "[^0-9a-z]+", " "), " "), lambda w: w != "")


def has_email(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL_SHAPE), F.lit(False))


def sorted_set(c: Column) -> Column:
    """Sorted distinct values of a group; NULLs are left out, and a group of only NULLs gives an empty array."""
    return F.array_sort(F.collect_set(c))
