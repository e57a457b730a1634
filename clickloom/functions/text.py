"""Text cleaning and tokenising as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
SYMBOLS = "-!.~&+_～:，/"
QUANTIFIERS = (
    "萬", "萬元", "點", "元", "億", "億元", "百萬", "千萬", "分", "分鐘", "樓", "成", "吋", "天",
    "號", "日", "月", "年", "輛", "種", "次", "人", "%", "g", "cc", "ml", "克糖", "倍", "個",
    "招", "kg", "jpg", "JPG", "折", "度", "公尺", "大", "例",
)
HAN = r"[一-鿿]+"
HAN_OR_LATIN = r"[一-鿿a-zA-Z]+"
TWO_DIGITS = "[0-9]{2}"
NUMBER_OR_EMPTY = "[0-9.]*"
SHORT_LATIN = "[a-z]{1,4}|[A-Z]{2}"
DECIMAL = "[0-9]*[.][0-9]+"
# ----------------------------------------------------------------------------


def strip_urls(c: Column, drop_path: bool = False) -> Column:
    """Drop ``https://``; the host and path stay unless ``drop_path`` asks for the whole URL."""
    if drop_path:
        return F.regexp_replace(c, "[https]{4,5}://[0-9a-zA-Z./]*", "")
    return F.regexp_replace(c, "https://([0-9a-zA-Z./]*)", "$1")


def strip_symbols(c: Column) -> Column:
    return F.translate(c, SYMBOLS, "")


def keep_runs(c: Column, run: str = HAN) -> Column:
    """Only the runs that match ``run``, joined by a blank."""
    return F.array_join(F.regexp_extract_all(c, F.lit(f"({run})"), 1), " ")


def drop_latin_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[A-Za-z0-9]+", "")


def drop_brackets(c: Column) -> Column:
    return F.translate(c, '[]"', "")


def short_pieces(c: Column) -> Column:
    """Comma pieces of a short text, full-width commas included, empties dropped."""
    return F.filter(F.split(F.translate(c, "，", ","), ","), lambda w: w != "")


def split_list(c: Column) -> Column:
    """Comma list to a trimmed array (empty pieces and duplicates stay)."""
    return F.transform(F.split(c, ","), lambda w: F.trim(w))


def map_chars(c: Column, table: Mapping[str, str]) -> Column:
    """Character-level script conversion from a one-to-one character table."""
    return F.translate(c, "".join(table), "".join(table.values()))


def has_han(c: Column) -> Column:
    return c.rlike(r"[一-龥]")


def traffic_number(c: Column) -> Column:
    """``5萬+`` -> 50000, ``200+`` -> 200, ``1,000+`` -> 1000; null when not a number."""
    plain = F.regexp_replace(F.regexp_replace(c, r"萬\+", "0000"), r"[+,]", "")
    return plain.try_cast("long")


def blank_free(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def without_term(text: Column, term: Column) -> Column:
    """Remove every literal occurrence of one column's value from another's."""
    return F.when(term == "", text).otherwise(F.replace(text, term, F.lit("")))


def title_key(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit('"'))


def latin_tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits, in text order."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def is_shaped(word: Column, pattern: str) -> Column:
    """The whole token has the shape ``pattern``."""
    return word.rlike(rf"\A(?:{pattern})\z")


def is_quantity(word: Column, quantifiers: Iterable[str] = QUANTIFIERS) -> Column:
    """Number plus quantifier, or a bare quantifier."""
    names = "|".join(rf"\Q{q}\E" for q in quantifiers)
    return word.rlike(rf"\A[0-9.]*(?:{names})\z")


def is_noise(word: Column, quantifiers: Iterable[str] = QUANTIFIERS) -> Column:
    """Token shapes the keyword cleaner drops: quantities, numbers, short Latin runs, blanks."""
    return (
        (word == " ")
        | (word == "")
        | is_quantity(word, quantifiers)
        | is_shaped(word, TWO_DIGITS)
        | is_shaped(word, NUMBER_OR_EMPTY)
        | is_shaped(word, SHORT_LATIN)
    )


def clean_word_array(words: Column, stopwords: Column | None = None) -> Column:
    """Cleaner for an array column; ``stopwords`` is an array column of lower-cased words."""
    kept = F.filter(words, lambda w: ~is_noise(w))
    if stopwords is None:
        return kept
    return F.filter(kept, lambda w: ~F.array_contains(stopwords, F.lower(w)))


def short_share(words: Column, limit: int = 4) -> Column:
    """Share of words with at most ``limit`` characters; null for an empty list."""
    short = F.size(F.filter(words, lambda w: F.char_length(w) <= limit))
    return F.try_divide(short.cast("double"), F.size(words))
