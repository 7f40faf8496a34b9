"""Text expressions: description cleaning, word splitting, TF-IDF tokens.

All of it is array/higher-order-function Catalyst code (``split``,
``filter``, ``array_join``, ``regexp_extract_all``); no Python per row.
The stop-word list is a parameter; its default is Spark's own public Spanish
list, a data file of the package that is read on first use, so that the DuckDB
oracle can use the very same words without a JVM.
"""

from __future__ import annotations

import functools
import os
import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
PUNCTUATION = string.punctuation          # the 32 ASCII punctuation characters
BREAKS_PATTERN = "[\n-]"                  # newline or dash -> space
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"      # words of 2+ letters/digits/underscore
# -----------------------------------------------------------------------------

_STOPWORDS_FILE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data",
                               "stopwords_{lang}.txt")


@functools.lru_cache(maxsize=None)
def default_stopwords(lang: str = "spanish") -> tuple[str, ...]:
    """Spark's public stop-word list (same as StopWordsRemover.loadDefaultStopWords), shipped with the package."""
    with open(_STOPWORDS_FILE.format(lang=lang), encoding="utf-8") as f:
        words = [w for line in f if not line.startswith("#") for w in line.split()]
    # punctuation inside stop words is deleted, as it is deleted from the text
    cleaned = ("".join(ch for ch in w if ch not in PUNCTUATION) for w in words)
    return tuple(dict.fromkeys(w for w in cleaned))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_breaks(c) -> Column:
    """What ``BREAKS_PATTERN`` matches becomes a space; both are single bytes, found in half a pattern's time."""
    return F.replace(F.replace(_c(c), F.lit("\n"), F.lit(" ")), F.lit("-"), F.lit(" "))


# every punctuation character escaped inside one character class (a regex
# class is much faster in the JVM than ``translate``'s per-character map)
_PUNCT_CLASS = "[" + "".join("\\" + ch for ch in PUNCTUATION) + "]"


def strip_punctuation(c) -> Column:
    return F.regexp_replace(_c(c), _PUNCT_CLASS, "")


def split_words(c) -> Column:
    """Split on single spaces (empty strings kept, as ``str.split(' ')``)."""
    return F.split(_c(c), " ", -1)


def remove_stopwords(tokens, stopwords=None) -> Column:
    """Drop stop words and empty tokens; order and duplicates are kept."""
    # ``isin`` over many literals is planned as a hash-set lookup (InSet)
    stop = list(stopwords if stopwords is not None else default_stopwords())
    return F.filter(_c(tokens), lambda t: (t != F.lit("")) & ~t.isin(stop))


def clean_text(c, stopwords=None) -> Column:
    """breaks -> punctuation -> split -> stop words -> joined with one space."""
    tokens = split_words(strip_punctuation(normalize_breaks(c)))
    return F.array_join(remove_stopwords(tokens, stopwords), " ")


def tfidf_tokens(c) -> Column:
    """Tokens of the TF-IDF vocabulary: lower-cased words of 2+ word characters."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_PATTERN), 0)


# --- oracle (DuckDB) text of the same expressions -----------------------------

def sql_quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def not_stopword_sql(token: str, stopwords=None) -> str:
    """True for a token that is neither empty nor a stop word (one linear-time pattern)."""
    words = stopwords if stopwords is not None else default_stopwords()
    return f"{token} <> '' AND NOT regexp_full_match({token}, {sql_quote('|'.join(re.escape(w) for w in words))})"


def clean_text_sql(expr: str, stopwords=None) -> str:
    stripped = f"translate(regexp_replace({expr}, '[\n-]', ' ', 'g'), {sql_quote(PUNCTUATION)}, '')"
    return (f"array_to_string(list_filter(string_split({stripped}, ' '), "
            f"lambda t: {not_stopword_sql('t', stopwords)}), ' ')")
