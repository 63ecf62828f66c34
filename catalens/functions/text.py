"""Text expressions: list parsing, tokens, match keys and search normalisation.

Everything is built from Spark expressions except Unicode NFKC, for which Spark has no function: an
Arrow function receives the non-ASCII strings only (ASCII rows hand it a null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ITEM = "array<struct<name:string,iso_639_1:string,iso_3166_1:string>>"
_SINGLE_QUOTES = {"allowSingleQuotes": "true"}
_NON_ASCII = r"[^\x00-\x7F]"
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u3000"
_BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Trim all kinds of whitespace, not only blanks."""
    return F.trim(c, F.lit(_BLANKS))


def trimmed(c: Column) -> Column:
    """Stripped text, blank as null."""
    return F.nullif(strip(c), F.lit(""))


def nfkc(c: Column) -> Column:
    @F.pandas_udf("string")
    def fold(s):
        return s.str.normalize("NFKC")

    return F.coalesce(fold(F.when(c.rlike(_NON_ASCII), c)), c)


def _names(items: Column) -> Column:
    picked = F.transform(
        items,
        lambda x: strip(
            F.coalesce(
                F.nullif(x["name"], F.lit("")), F.nullif(x["iso_639_1"], F.lit("")), F.nullif(x["iso_3166_1"], F.lit(""))
            )
        ),
    )
    return F.filter(picked, lambda x: x.isNotNull())


def _pieces(c: Column) -> Column:
    parts = F.transform(F.split(F.translate(c, "|", ","), ","), lambda x: strip(x))
    return F.filter(parts, lambda x: x != "")


def parse_list(c: Column) -> Column:
    """Tokens of a list-like cell: a list of dicts or of scalars as JSON or Python literal, else split
    at ``|`` and ``,``. Null and blank give an empty array.

    Cells holding bare ``None``/``True``/``False`` are re-read with these as JSON literals; scalar
    lists are read as arrays of strings; what still does not parse is split as delimited text.
    """
    text = strip(c.cast("string"))
    json_words = F.regexp_replace(text, r"(?<=[:\[,])\s*None\b", " null")
    json_words = F.regexp_replace(json_words, r"(?<=[:\[,])\s*True\b", " true")
    json_words = F.regexp_replace(json_words, r"(?<=[:\[,])\s*False\b", " false")
    bracketed = text.startswith("[") | text.startswith("{")
    has_dict = text.rlike(r"^\[?\s*\{")
    dicts = F.coalesce(F.from_json(text, _ITEM, _SINGLE_QUOTES), F.from_json(json_words, _ITEM, _SINGLE_QUOTES))
    scalars = F.from_json(json_words, "array<string>", _SINGLE_QUOTES)
    scalars = F.filter(F.transform(scalars, lambda x: strip(x)), lambda x: x.isNotNull() & (x != ""))
    empty = F.array().cast("array<string>")
    return (
        F.when(text.isNull() | (text == ""), empty)
        .when(~text.rlike(r"[|,]|^[\[{]"), F.array(text))  # most cells: one token, spared the functions on arrays
        .when(bracketed & has_dict, F.coalesce(_names(dicts), _pieces(text)))
        .when(bracketed, F.coalesce(scalars, _pieces(text)))
        .otherwise(_pieces(text))
    )


def first_token(c: Column) -> Column:
    return F.try_element_at(parse_list(c), F.lit(1))


def pipe_joined(c: Column) -> Column:
    """Tokens joined with ``|``; null stays null."""
    return F.when(c.isNotNull(), F.array_join(parse_list(c), "|"))


def category_tokens(c: Column) -> Column:
    """Split at the first separator kind present, ``|`` before ``,``; trimmed, blanks dropped."""
    text = c.cast("string")
    parts = (
        F.when(F.contains(text, F.lit("|")), F.split(text, r"\|"))
        .when(F.contains(text, F.lit(",")), F.split(text, ","))
        .when(text.isNotNull(), F.array(text))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.filter(F.transform(parts, lambda x: strip(x)), lambda x: x != "")


def match_key(c: Column, unicode: bool = True) -> Column:
    """Equality key: NFKC, lower case, whitespace collapsed; null gives ''. ``unicode=False`` skips the
    Arrow step when the caller knows the text is ASCII or normalised already."""
    folded = nfkc(c) if unicode else c
    return F.coalesce(F.trim(F.regexp_replace(F.lower(folded), _BLANK_RUN, " ")), F.lit(""))


def _spaced(c: Column, unicode: bool) -> Column:
    folded = F.lower(nfkc(c) if unicode else c)
    return F.regexp_replace(F.regexp_replace(folded, r"[\p{P}\p{S}]", " "), _BLANK_RUN, " ")


def search_text(c: Column, unicode: bool = True) -> Column:
    """Search form: NFKC, lower case, punctuation and symbols as spaces, whitespace collapsed."""
    return F.coalesce(F.trim(_spaced(c, unicode)), F.lit(""))


def _search_tokens(c: Column, unicode: bool) -> Column:
    # the tokens go through the normalisation as one string, joined by a character it leaves alone
    joined = F.array_join(category_tokens(c), "\x01")
    return F.transform(F.split(_spaced(joined, unicode), "\x01"), lambda x: F.trim(x))


def search_forms(title: Column, keyword: Column) -> Column:
    """The texts of a row that a search looks in, in search form: its title and each token of its keywords. The
    columns are folded already (``fold_unicode``)."""
    both = F.concat(F.array(search_text(title, unicode=False)), F.coalesce(_search_tokens(keyword, unicode=False), F.array().cast("array<string>")))
    return F.array_distinct(F.filter(both, lambda x: x != ""))


def search_needle(needle: str) -> str:
    """The search form of a query string, computed once on the driver."""
    import unicodedata

    folded = unicodedata.normalize("NFKC", needle).lower()
    return " ".join("".join(" " if unicodedata.category(ch)[0] in "PS" else ch for ch in folded).split())


def _has_words(text: Column, wanted: str) -> Column:
    # letters and digits are word characters; the cheap containment test spares most rows the regex
    pattern = rf"(?<![\p{{L}}\p{{N}}])\Q{wanted}\E(?![\p{{L}}\p{{N}}])"
    return F.contains(text, F.lit(wanted)) & text.rlike(pattern)


def word_match(c: Column, needle: str, unicode: bool = True) -> Column:
    """True where the needle occurs as whole word(s); both sides in search form. Null text and an empty
    needle match nothing."""
    wanted = search_needle(needle)
    return _has_words(search_text(c, unicode), wanted) if wanted else F.lit(False)


def same_text(c: Column, needle: str, unicode: bool = True) -> Column:
    wanted = search_needle(needle)
    return (search_text(c, unicode) == wanted) if wanted else F.lit(False)


def starts_with_words(c: Column, needle: str, unicode: bool = True) -> Column:
    wanted = search_needle(needle)
    if not wanted:
        return F.lit(False)
    return search_text(c, unicode).rlike(rf"^\Q{wanted}\E(?![\p{{L}}\p{{N}}])")


def token_word_match(c: Column, needle: str, unicode: bool = True) -> Column:
    """True where any delimited token contains the needle as whole word(s)."""
    wanted = search_needle(needle)
    if not wanted:
        return F.lit(False)
    return F.exists(_search_tokens(c, unicode), lambda x: _has_words(x, wanted))


def token_same_text(c: Column, needle: str, unicode: bool = True) -> Column:
    wanted = search_needle(needle)
    return F.array_contains(_search_tokens(c, unicode), wanted) if wanted else F.lit(False)


def contains_text(c: Column, needle: str | None) -> Column:
    """Literal case-insensitive containment; a blank or ``all`` needle lets everything pass."""
    wanted = (needle or "").strip().lower()
    if wanted in ("", "all"):
        return F.lit(True)
    return F.coalesce(F.contains(F.lower(c.cast("string")), F.lit(wanted)), F.lit(False))


def language_tokens(c: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(c.cast("string"), F.lit("")), ",", "|"), r"\|")
    return F.filter(F.transform(parts, lambda x: F.lower(F.trim(x))), lambda x: x != "")


def is_english(c: Column) -> Column:
    return F.arrays_overlap(language_tokens(c), F.array(F.lit("en"), F.lit("english")))


def is_us_production(c: Column) -> Column:
    return F.coalesce(F.contains(F.lower(c.cast("string")), F.lit("united states of america")), F.lit(False))
