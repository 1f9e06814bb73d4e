"""Text cleaning and token expressions.

All patterns use Unicode classes, so a letter with an accent is a word character and a
no-break space is white space, as in Python's ``re``.
"""

from __future__ import annotations

import functools
import json
import operator
import re
import unicodedata
import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import fixed

_SYMBOL_RUN = rf"[^{fixed.WORD_CHARS}{re.escape(fixed.KEPT_PUNCTUATION)}]+"
#: Size of a dictionary that is written into the plan.
PLAN_BYTES = 1 << 18
#: Keywords or words that are looked for one by one.
SEPARATE = 16
_SPACE_RUN = rf"[{fixed.SPACE_CHARS}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.btrim(_col(c), F.lit(fixed.BLANKS))


def replace_urls(c: Column | str, by: str = fixed.URL_PLACEHOLDER) -> Column:
    return F.regexp_replace(_col(c), fixed.URL_PATTERN, by)


def replace_mentions(c: Column | str, by: str = fixed.MENTION_PLACEHOLDER) -> Column:
    return F.regexp_replace(_col(c), fixed.MENTION_PATTERN, by)


def unwrap_hashtags(c: Column | str) -> Column:
    """Keep the word of a hashtag and drop its sign."""
    return F.regexp_replace(_col(c), fixed.HASHTAG_PATTERN, "$1")


def drop_hashtags(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), fixed.HASHTAG_PATTERN, "")


def replace_symbols(c: Column | str) -> Column:
    """Every character but word characters, white space and ``.,?!`` becomes a blank."""
    keep = fixed.WORD_CHARS + fixed.SPACE_CHARS + re.escape(fixed.KEPT_PUNCTUATION)
    return F.regexp_replace(_col(c), rf"[^{keep}]", " ")


def squeeze(c: Column | str) -> Column:
    """Collapse white space to single blanks and trim."""
    return F.trim(F.regexp_replace(_col(c), _SPACE_RUN, " "))


def map_of(token: Column, maps: int) -> Column:
    """Place of the map that holds a token, among so many."""
    return F.pmod(F.crc32(token), F.lit(maps)).cast("int")


def dictionary_bytes(lookup: Mapping[str, str] | None) -> int:
    """Size of a dictionary: its texts, and a fixed amount for each entry."""
    return sum(len(k.encode()) + len((v or "").encode()) + 8 for k, v in (lookup or {}).items())


def replace_tokens_by(c: Column | str, table: Column, maps: int) -> Column:
    """Replace blank-separated tokens by their form in an array of ``maps`` maps (``map_of``)."""

    def form_of(token: Column) -> Column:
        return F.coalesce(F.try_element_at(F.get(table, map_of(token, maps)), token), token)

    return strip(F.array_join(F.transform(F.split(_col(c), " "), form_of), " "))


def normalize_tokens(c: Column | str, lookup: Mapping[str, str] | None) -> Column:
    """Replace whole blank-separated tokens by their dictionary form, in one pass.

    A replacement is not looked up again and may be empty. The dictionary becomes one constant of
    the plan: entries are spread over as many small maps by ``crc32``, because a Spark map is
    searched from front to back. That is for up to ``PLAN_BYTES``; ``operators.lookup.with_forms``
    takes a dictionary of any size.
    """
    c = _col(c)
    entries = {k: v for k, v in (lookup or {}).items() if k}
    if not entries:
        return c
    if dictionary_bytes(entries) > PLAN_BYTES:
        raise ValueError(f"more than {PLAN_BYTES} bytes: use operators.lookup.with_forms")
    maps: list[dict[str, str]] = [{} for _ in entries]
    for token, form in entries.items():
        maps[zlib.crc32(token.encode("utf-8")) % len(maps)][token] = form
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")
    return replace_tokens_by(c, table, len(maps))


def clean_text(c: Column | str, lookup: Mapping[str, str] | None = None) -> Column:
    """Full cleaning: URL, mention, hashtag, symbols, white space, lower case, dictionary.

    Null text gives ''. Replacing symbols by blanks and collapsing the blanks is one pattern
    here: a run without word characters or kept punctuation becomes one blank. Texts without the
    signs of a URL, mention or hashtag skip those three patterns.
    """
    c = F.coalesce(_col(c), F.lit(""))
    marked = c.contains("://") | c.contains("@") | c.contains("#")
    c = F.when(marked, unwrap_hashtags(replace_mentions(replace_urls(c)))).otherwise(c)
    c = F.lower(F.trim(F.regexp_replace(c, _SYMBOL_RUN, " ")))
    return normalize_tokens(c, lookup)


def clean_light(c: Column | str) -> Column:
    """URL and mention placeholders, ``#`` to blank, white space; case and symbols stay."""
    c = replace_mentions(replace_urls(_col(c)))
    return squeeze(F.translate(c, "#", " "))


def normalize_for_dup(c: Column | str) -> Column:
    """Lower case without URLs, mentions and hashtags; nothing left gives null."""
    c = replace_mentions(replace_urls(F.lower(_col(c)), ""), "")
    return F.nullif(squeeze(drop_hashtags(c)), F.lit(""))


def tokenize(
    c: Column | str, stopwords: Sequence[str] = (), min_length: int = fixed.MIN_TERM_LENGTH
) -> Column:
    """Terms for statistics: runs of a-z in lower-case text without URLs, mentions, hashtags."""
    c = F.lower(F.coalesce(_col(c), F.lit("")))
    c = drop_hashtags(replace_mentions(replace_urls(c, ""), ""))
    stop = list(stopwords)

    def wanted(token: Column) -> Column:
        keep = F.length(token) >= max(1, min_length)
        return keep & ~token.isin(stop) if stop else keep

    return F.filter(F.split(c, "[^a-z]+"), wanted)


def token_count(c: Column | str) -> Column:
    """Tokens of cleaned text; an empty text counts as one token."""
    return F.size(F.split(_col(c), r"\s+"))


def word_count(c: Column | str) -> Column:
    """Words between white space; null and empty text count as zero."""
    text = strip(F.coalesce(_col(c), F.lit("")))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, _SPACE_RUN)))


def text_length(c: Column | str) -> Column:
    return F.length(F.coalesce(_col(c), F.lit("")))


def _literal(text: str) -> str:
    """Text in which a regular expression sees nothing but characters."""
    return "".join(c if c.isalnum() or ord(c) > 127 else f"\\x{ord(c):02x}" for c in text)


def any_of(texts: Sequence[str]) -> str:
    """One pattern that finds any of the texts; common beginnings are looked at once.

    A text that begins with another one adds nothing and is left out.
    """
    tree: dict = {}
    for text in sorted(set(texts)):
        node = tree
        for c in text:
            if node.get(c) == {} and c in node:
                break
            node = node.setdefault(c, {})
        else:
            node.clear()

    def pattern(node: dict) -> str:
        ends = sorted(c for c, below in node.items() if not below)
        parts = []
        for c, below in sorted(node.items()):
            if not below:
                continue
            run = c
            while len(below) == 1:
                (following, below), *_ = below.items()
                run += following
                if not below:
                    break
            parts.append(_literal(run) + (pattern(below) if below else ""))
        if ends:
            parts.append("[" + "".join(_literal(c) for c in ends) + "]")
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return pattern(tree)


def contains_any(c: Column | str, keywords: Sequence[str]) -> Column:
    """True where the lower-case text holds one of the keywords as a substring.

    A few keywords are looked for one by one, which is fastest for each; more than ``SEPARATE`` of
    them in one pass over the text.
    """
    c = F.lower(_col(c))
    if len(keywords) > SEPARATE and "" not in keywords:
        return c.rlike(any_of(keywords))
    return functools.reduce(operator.or_, [c.contains(k) for k in keywords], F.lit(False))


def contains_word(c: Column | str, words: Sequence[str] = (), phrases: Sequence[str] = ()) -> Column:
    """True where a whole word, or a phrase as a substring, occurs in the lower-case text.

    The text is split into words once, which are met with those asked for; those that hold other
    characters than letters, digits and ``_`` are one pattern.
    """
    c = F.lower(_col(c))
    edge = rf"[^{fixed.WORD_CHARS}]"
    plain = [w for w in words if all(_is_word_char(x) for x in w) and w]
    other = [w for w in words if w not in plain]
    tests = []
    if len(plain) > SEPARATE:
        tests.append(F.arrays_overlap(F.split(c, f"{edge}+"), F.array(*[F.lit(w) for w in plain])))
    else:
        other = list(words)
    if other:
        tests.append(c.rlike(rf"(?:^|{edge})(?:{'|'.join(map(_literal, other))})(?:{edge}|$)"))
    if phrases:
        tests.append(contains_any(c, phrases))
    return functools.reduce(operator.or_, tests, F.lit(False))


def _is_word_char(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


def mentions(c: Column | str, patterns: Sequence[str]) -> Column:
    """True where one of the regular expressions occurs in the lower-case text; null is false."""
    return F.lower(F.coalesce(_col(c), F.lit(""))).rlike("|".join(patterns))
