"""Text expressions: trimming, list checks, model JSON, model SQL and prompt lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statement keywords that make a model's SQL text unacceptable.
FORBIDDEN_KEYWORDS = (
    "insert", "update", "delete", "drop", "alter", "create",
    "attach", "copy", "pragma", "call", "export", "import",
)


def in_domain(value: Column, allowed: Sequence[str], default: str) -> Column:
    """The value where it is one of `allowed`, else the default (also for NULL)."""
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))


# Characters that words consist of. The range comes first, as it is the fastest to tell.
_INNER = r"a-z\p{L}\p{N}_"


def whole_word(lowered: Column, words: Sequence[str]) -> Column:
    """True where any of the words stands on its own in the lower-cased text.

    The plain search comes first, so that the slower pattern only meets texts that hold the word.
    """
    edge = f"[^{_INNER}]"
    found = [
        lowered.contains(word) & lowered.rlike(rf"(^|{edge}){word}($|{edge})") for word in words
    ]
    return reduce(lambda one, other: one | other, found)


def whole_words_in(lowered: Column, words: Sequence[str]) -> Column:
    """Those of the words that stand on their own in the lower-cased text, as they come, a line for each.

    One pass over the text, whatever the number of words; `whole_word` says the same of the result as of the text.
    Where several begin at one place the longest is taken, which holds the others. The words are plain text.
    """
    by_first: dict[str, list[str]] = {}
    for word in sorted(set(words), key=len, reverse=True):
        by_first.setdefault(word[0], []).append(word[1:])
    # Words of one first letter are tried together, and only the character before a word is used up.
    listed = "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in by_first.items())
    pattern = f"[^{_INNER}](?=({listed})(?![{_INNER}]))"
    return F.array_join(F.regexp_extract_all(F.concat(F.lit(" "), lowered), F.lit(pattern), 1), "\n")


def strip_space(text: Column) -> Column:
    """The text without white space at either end, line breaks included."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\f"))


def without_fences(text: Column) -> Column:
    """Drop a leading markdown fence (with or without `sql`) and a trailing one, and outer space."""
    opened = strip_space(F.regexp_replace(strip_space(text), r"^```(sql)?", ""))
    return strip_space(F.regexp_replace(opened, r"```$", ""))


def starts_with_select(sql: Column) -> Column:
    return sql.rlike(r"(?is)^\s*select")


def json_objects(text: Column, schema: str) -> Column:
    """The JSON objects between the first `{` and the last `}` of the text, comma-separated.

    They are parsed as the elements of one array: NULL if that is not valid, so that anything else
    after a complete object is not just ignored.
    """
    body = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    array = F.concat(F.lit("["), body, F.lit("]"))
    return F.from_json(array, f"array<{schema}>", {"allowSingleQuotes": "false"})


# Fixed value: how a retrieved review is written in a prompt.
EXCERPT = "[review %d] (rating %d/5): %s"


def excerpt_line(review_id: Column, rating: Column, text: Column) -> Column:
    """One line of the prompt that carries retrieved reviews."""
    return F.format_string(EXCERPT, review_id, rating, text)


def fill_template(template: Column, **values: Column) -> Column:
    """Put each value in the place of its `{name}`."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


def capitalized(text: Column) -> Column:
    """First letter upper case, all others lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def singular(noun: Column) -> Column:
    """The noun without one trailing `s`."""
    return F.regexp_replace(noun, "s$", "")
