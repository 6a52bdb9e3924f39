"""Text scalar functions: all built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# English stop words (the public NLTK English list, 179 words).
STOP_WORDS_EN = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him",
    "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's", "its",
    "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who",
    "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was",
    "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did",
    "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until",
    "while", "of", "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few",
    "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same",
    "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't",
    "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren",
    "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn",
    "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn",
    "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]

# Token delimiters of the title tokenizer, and the title clean pattern.
TITLE_DELIMITERS = ".,!?() "
TITLE_CLEAN_PATTERN = "[^a-zA-Z0-9 $.-]"
# Host pattern of the URL source label, and the trailer removed from articles.
URL_HOST_PATTERN = ".*://(.[^/]+)/"
ARTICLE_TRAILER = "\n Reuter\n\x03"


def delimiter_class(delims: str) -> str:
    """Regex character class matching any one of ``delims``."""
    esc = "".join("\\" + ch if ch in "\\^]-[" else ch for ch in delims)
    return f"[{esc}]"


def first_line(text: str | Column) -> Column:
    """Title = first line of the text."""
    return F.substring_index(_c(text), "\n", 1)


def clean_title(text: str | Column) -> Column:
    """Replace every char outside [a-zA-Z0-9 $.-] by a space."""
    return F.regexp_replace(_c(text), TITLE_CLEAN_PATTERN, " ")


def url_source(url: str | Column) -> Column:
    """Second-level host label, e.g. ``news.example.com`` -> ``example``."""
    host = F.regexp_extract(_c(url), URL_HOST_PATTERN, 1)
    return F.try_element_at(F.split(host, "[.]"), F.lit(-2))


def url_host(url: str | Column) -> Column:
    return F.regexp_extract(_c(url), URL_HOST_PATTERN, 1)


def strip_ws(text: str | Column) -> Column:
    """Remove leading/trailing whitespace (all whitespace chars, not only spaces)."""
    return F.regexp_replace(_c(text), "^\\s+|\\s+$", "")


def is_dot_com(host: str | Column) -> Column:
    """Host ends with '.com' (the dot escaped: 'xcom' does not match)."""
    return _c(host).rlike("\\.com$")


def clean_sms(text: str | Column) -> Column:
    """Remove tabs and double quotes, lower-case, strip surrounding whitespace."""
    return strip_ws(F.lower(F.translate(_c(text), '\t"', "")))


def tokenize(text: str | Column, delims: str = TITLE_DELIMITERS) -> Column:
    """Split on any delimiter char and drop empty tokens."""
    return F.filter(F.split(_c(text), delimiter_class(delims)), lambda t: t != "")


def clean_text_stopwords(text: str | Column, stop_words: list[str] | None = None) -> Column:
    """Lower, split on whitespace, keep letters/digits of each token, drop stop words and empties."""
    words = list(stop_words or STOP_WORDS_EN)
    toks = F.transform(F.split(F.lower(_c(text)), "\\s+"),
                       lambda t: F.regexp_replace(t, "[^\\p{L}\\p{N}]", ""))
    # isin over a literal list becomes a hashed InSet (O(1) per token), not a linear scan
    kept = F.filter(toks, lambda t: (t != "") & ~t.isin(*words))
    return F.array_join(kept, " ")


def sentence_split(text: str | Column) -> Column:
    """Newline-joined sentences: break after . ! ? followed by whitespace.

    A rule-based stand-in for a trained sentence splitter.
    """
    return F.regexp_replace(_c(text), "([.!?])\\s+", "$1\n")


def ascii_clean(text: str | Column, trailer: str = ARTICLE_TRAILER) -> Column:
    """Drop a fixed trailer, newlines to spaces, strip non-ASCII characters."""
    t = F.replace(_c(text), F.lit(trailer), F.lit(""))
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    return F.regexp_replace(t, "[^\\x00-\\x7F]", "")


def word_tokens(text: str | Column) -> Column:
    """Words of two or more letters/digits/underscores (the usual count-vectorizer rule)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit("[\\p{L}\\p{N}_]{2,}"), F.lit(0))


def ngrams(tokens: str | Column, n: int) -> Column:
    """Space-joined n-grams of a token array."""
    toks = _c(tokens)
    if n == 1:
        return toks
    if n == 2:
        # pair each token with its successor: no per-gram sub-array
        k = F.greatest(F.size(toks) - 1, F.lit(0))
        return F.zip_with(F.slice(toks, 1, k), F.slice(toks, 2, k), lambda a, b: F.concat(a, F.lit(" "), b))
    k = F.size(toks) - n + 1
    idx = F.sequence(F.lit(1), F.greatest(k, F.lit(0)))
    idx = F.when(k > 0, idx).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.array_join(F.slice(toks, i, n), " "))


def pad_or_cut(ids: str | Column, length: int, pad_id: int = 0) -> Column:
    """Pad an int array with ``pad_id`` up to ``length`` or cut it to ``length``."""
    arr = _c(ids)
    return F.slice(F.concat(arr, F.array_repeat(F.lit(pad_id), F.lit(length))), 1, length)
