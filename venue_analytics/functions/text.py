"""Tokenizer and keyword normaliser as array expressions (no Python UDF).

``keyword_words`` is the whole keyword step: normalise a text into unique words, then split those
words on the tokenizer delimiters. It is a chain of built-in ``split``/``transform``/``filter``/
``array_distinct`` expressions evaluated in the JVM (the higher-order functions run interpreted,
not in generated code, but no row ever leaves the JVM for Python).
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from venue_analytics.sources.schemas import MAX_WORD, MIN_WORD, PUNCTUATION, TOKEN_DELIMITERS

_HERE = os.path.dirname(__file__)

# Tokenizer regex derived from the fixed delimiter set in sources.schemas.
TOKEN_SPLIT = "[" + "".join(re.escape(ch) for ch in TOKEN_DELIMITERS) + "]+"


@lru_cache(maxsize=None)
def stop_words(path: str | None = None) -> tuple[str, ...]:
    """The stop-word list (a parameter; default: the packaged fixed list)."""
    path = path or os.path.join(_HERE, "stop_words.txt")
    with open(path, encoding="utf-8") as fh:
        return tuple(w.rstrip("\n") for w in fh if w.strip() and not w.startswith("#"))


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def tokenize(s) -> Column:
    """Split on space, double quote, comma, parentheses and star; no empty tokens."""
    return F.filter(F.split(_c(s), TOKEN_SPLIT), lambda t: t != "")


def _strip_ends(w: Column, punc) -> Column:
    head = F.substring(w, 1, 1).isin(*punc).cast("int")
    tail = F.substring(w, -1, 1).isin(*punc).cast("int")
    return w.substr(head + 1, F.length(w) - head - tail)


def text_strip(text, stops=None) -> Column:
    """Normalise a post text into its keyword list (array, first-seen order, unique):

    split on single spaces; lowercase; keep words of length 3..16; drop one leading and one
    trailing punctuation character; keep length >= 3; drop words containing 'http'; drop stop
    words; drop repeats. '#tag' and '@name' keep their sign (neither is punctuation).

    The text is lowercased once before the split (a space is never changed by lowercasing, so
    this equals lowercasing each word); the end characters are tested with ``substring`` and an
    IN-set instead of a regex per word.
    """
    stops = list(stop_words() if stops is None else stops)
    punc = [F.lit(ch) for ch in PUNCTUATION]
    words = F.split(F.lower(_c(text)), " ")
    words = F.filter(words, lambda w: (F.length(w) >= MIN_WORD) & (F.length(w) <= MAX_WORD))
    # Raw length >= 3, so after dropping a leading sign the last character is still the raw
    # word's last character: both ends are tested on the raw word in one pass.
    words = F.transform(words, lambda w: _strip_ends(w, punc))
    # The stop words as an IN-list become one hash set built once per task (InSet); the
    # array_distinct after it keeps the first occurrence of each word.
    words = F.filter(words, lambda w: (F.length(w) >= MIN_WORD) & ~w.contains("http") & ~w.isin(*stops))
    return F.array_distinct(words)


def text_strip_joined(text, stops=None) -> Column:
    """String form of ``text_strip``: the kept words joined by single spaces."""
    return F.array_join(text_strip(text, stops), " ")


def keyword_words(text, stops=None) -> Column:
    """Keyword tokens of a text: ``tokenize(text_strip_joined(text))``.

    One tokenizer split per text on the space-joined words; a split part may repeat or be
    short (e.g. 'foo,bar' gives 'foo' and 'bar'), as in the original."""
    return tokenize(text_strip_joined(text, stops))
