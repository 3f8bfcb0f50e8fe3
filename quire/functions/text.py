"""Text normalization as column functions, in a fixed order.

All rules but NFKC run inside the JVM. Where the language's regular expressions
differ from those that define the rules (word characters, white space), the
character classes are spelled out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Rule = Callable[[Column], Column]

#: Any white space, and any word character, of Unicode; spelled out, since Java's Unicode classes are slow and not the same.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"[\p{L}\p{N}_]"
#: Punctuation that has a plain form, and bullet glyphs.
FANCY, PLAIN = "“”‘’–—−", "\"\"''---"
BULLETS = "●•▪■◦∙"
SOFT_HYPHEN, ZERO_WIDTH = "\u00ad", "\u200b"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.array_join(tokenize(c), " ")


def flatten_latex(c: Column) -> Column:
    """Inline math as the bare glyphs of a text layer."""
    bare = F.regexp_replace(F.replace(c, F.lit("\\$"), F.lit("$")), r"\\[A-Za-z]+", "")
    return F.regexp_replace(bare, rf"[{{}}^_{SPACE}]", "")


def strip_markup(c: Column) -> Column:
    return F.regexp_replace(c, "</?su[bp]>", "")


@F.pandas_udf(StringType())
def _nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _casefold(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(str.casefold, na_action="ignore")


def _non_ascii(c: Column) -> Column:
    return F.when(c.rlike(r"[^\x00-\x7F]"), c)


def nfkc(c: Column) -> Column:
    """Unicode NFKC. Spark has no function for it; ASCII texts reach the Python worker as null and come back as they were."""
    return F.coalesce(_nfkc(_non_ascii(c)), c)


def casefold(c: Column) -> Column:
    """Full Unicode case folding; ASCII texts stay in the JVM."""
    return F.coalesce(_casefold(_non_ascii(c)), F.lower(c))


def plain_punctuation(c: Column) -> Column:
    return F.translate(c, FANCY, PLAIN)


def drop_soft_hyphens(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, rf"{SOFT_HYPHEN}\n[{SPACE}]*", ""), F.lit(SOFT_HYPHEN), F.lit(""))


def dehyphenate(c: Column) -> Column:
    """Words broken at a line end are joined, then hyphens within words go."""
    joined = F.regexp_replace(c, rf"({WORD})-\n[{SPACE}]*({WORD})", "$1$2")
    return F.regexp_replace(joined, f"(?<={WORD})-(?={WORD})", "")


def drop_list_markers(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, BULLETS, " " * len(BULLETS)), r"(?md)^[ \t]*[-*][ \t]+", "")


def join_spaced_caps(c: Column) -> Column:
    """Runs of three or more tokens of one or two capitals lose their spaces."""
    run = r"(?:(?<!\S)(?=(?:[A-Z]{1,2}[ \t]+){2,}[A-Z]{1,2}(?!\S))|(?!^)\G)([A-Z]{1,2})[ \t]+(?=[A-Z]{1,2}(?!\S))"
    return F.regexp_replace(c, run, "$1")


def drop_zero_width(c: Column) -> Column:
    return F.replace(c, F.lit(ZERO_WIDTH), F.lit(""))


#: The order is part of the contract; rules are appended only.
PDF_RULES: tuple[Rule, ...] = (nfkc, plain_punctuation, drop_soft_hyphens, dehyphenate, drop_list_markers, join_spaced_caps, drop_zero_width)
MD_RULES: tuple[Rule, ...] = (strip_markup, *PDF_RULES)


def without_python(rules: Sequence[Rule]) -> tuple[Rule, ...]:
    """The rules without NFKC, for text that is in that form already."""
    return tuple(r for r in rules if r is not nfkc)


def normalize(c: Column, rules: Sequence[Rule]) -> Column:
    return reduce(lambda x, rule: rule(x), rules, c)


def tokenize(c: Column) -> Column:
    return F.filter(F.split(c, rf"[{SPACE}]+"), lambda t: t != "")


def fold(c: Column, exact: bool = True) -> Column:
    """White space collapsed, spaced capitals joined, case folded (without Python if not exact: lower case and ß as ss)."""
    joined = join_spaced_caps(collapse(c))
    return casefold(joined) if exact else F.replace(F.lower(joined), F.lit("ß"), F.lit("ss"))
