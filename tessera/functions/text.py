"""Text normal forms, tokens, shingles and statements, as columns.

Everything but Unicode's compatibility form runs in the JVM. White space is Unicode's, as Python's ``str`` methods see it,
so the patterns carry ``(?U)`` and the four ASCII separators that Java leaves out.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"(?U)[\s\x1C-\x1F]"
#: Words that are no tokens.
STOPWORDS = [
    "a", "an", "the", "and", "or", "of", "to", "in", "on", "for",
    "is", "are", "be", "with", "from", "by", "as", "at", "it", "this",
    "that", "you", "your", "we", "can", "will", "given", "find",
    "determine", "print", "output", "input",
]
#: The fields that define a problem, and their headings in a statement.
TEXT_FIELDS = ["title", "description", "input_format", "output_format", "interaction_format", "note"]
STATEMENT_HEADINGS = ["Title", "Problem", "Input", "Output", "Interaction", "Note"]
PROMPT_HEADINGS = ["Title", "Problem statement", "Input", "Output", "Interaction", "Note"]
#: An output format with one of these allows any case.
ANY_CASE = [
    "any case",
    "case does not matter",
    "case doesn't matter",
    "case-insensitive",
    "case insensitive",
    "uppercase or lowercase",
    "upper or lower case",
]


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or unicodedata.is_normalized("NFKC", x) else unicodedata.normalize("NFKC", x))


def nfkc(c: Column) -> Column:
    """Compatibility composition. ASCII texts, which it doesn't change, aren't sent to Python."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at its ends; a text that has none there isn't searched, as the pattern would try each space in it."""
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(ends.rlike(SPACE), F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")).otherwise(c)


def one_line(c: Column) -> Column:
    """Lower case, runs of white space squeezed, ends stripped."""
    return F.trim(F.regexp_replace(F.lower(c), f"{SPACE}+", " "))


def flat_code(c: Column) -> Column:
    """Lower case, runs of white space squeezed, ends kept."""
    return F.regexp_replace(F.lower(c), f"{SPACE}+", " ")


def unix_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def trimmed_lines(c: Column) -> Column:
    """null to empty, LF line ends, ends stripped."""
    return strip(unix_lines(empty_if_null(c)))


def canonical(c: Column, compose: bool = True) -> Column:
    """Compatibility form, LF line ends, blanks squeezed, lines stripped, runs of blank lines made one, all stripped."""
    text = empty_if_null(c)
    text = unix_lines(nfkc(text) if compose else text)
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"(?mdU)^[\s\x1C-\x1F&&[^\n]]+|[\s\x1C-\x1F&&[^\n]]+$", "")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def canonical_problem(compose: bool = True, **columns: Column) -> Column:
    """All defining fields under their names, blank line between; columns by field name, absent ones are empty."""
    part = lambda f: F.concat(F.lit(f"[{f}]\n"), canonical(columns[f], compose) if f in columns else F.lit(""))
    return F.concat_ws("\n\n", *map(part, TEXT_FIELDS))


def plain_words(c: Column, compose: bool = True) -> Column:
    """Compatibility form, lower case, anything but a-z, 0-9 and _ to one blank, stripped."""
    text = empty_if_null(c)
    return F.trim(F.regexp_replace(F.lower(nfkc(text) if compose else text), r"[^a-z0-9_]+", " "))


def tokens(plain: Column) -> Column:
    """Of plain words: those of two characters or more that aren't stop words.

    The column is one that holds plain_words() already: Spark takes no Python function inside a lambda.
    """
    return F.filter(F.split(plain, " "), lambda w: (F.length(w) > 1) & ~w.isin(STOPWORDS))


def shingles(words: Column, size: int = 5) -> Column:
    """The distinct runs of ``size`` words joined by blanks; all words as one if there are no more than that, none without words."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(words, i, size), " "))
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).when(F.size(words) <= size, F.array(F.array_join(words, " "))).otherwise(F.array_distinct(runs))


def shingle_hashes(words: Column, size: int = 5) -> Column:
    """The same shingles as 64-bit hashes, without building their texts."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(F.size(words) <= size, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array_distinct(runs))


def barrier(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns computed once: an optimiser doesn't copy an expression through a generator."""
    rest = [c for c in df.columns if c not in names]
    once = df.select(*rest, F.explode(F.array(F.struct(*names))).alias("once_"))
    return once.select(*[F.col(f"once_.{c}").alias(c) if c in names else F.col(c) for c in df.columns])


def joined_fields(*columns: Column) -> Column:
    return F.concat_ws("\n", *map(empty_if_null, columns))


def headed(headings: list[str], columns: list[Column]) -> Column:
    """Fields that aren't empty under their headings, blank line between."""
    return strip(F.concat_ws("\n\n", *[F.when(empty_if_null(c) != "", F.concat(F.lit(f"{h}:\n"), c.cast("string"))) for h, c in zip(headings, columns)]))


def statement(*columns: Column) -> Column:
    """For training examples: title, description, input, output, interaction, note."""
    return headed(STATEMENT_HEADINGS, list(columns))


def prompt_text(*columns: Column) -> Column:
    """For prompts: the same fields, trimmed, under other headings."""
    return headed(PROMPT_HEADINGS, [trimmed_lines(c) for c in columns])


def base_id(c: Column) -> Column:
    """1356/A1 to 1356/A."""
    return F.regexp_replace(c, r"([A-Z])\d+\z", "$1")


def first_hash(df: DataFrame) -> Column:
    """The first of canonical_hash, content_hash and hash that isn't empty, else the canonical record's own."""
    given = [F.when(F.col(c) != "", F.col(c)) for c in ("canonical_hash", "content_hash", "hash") if c in df.columns]
    return F.coalesce(*given, F.col("canonical.exact_hash") if "canonical" in df.columns else F.col("exact_hash"))


def language_family(c: Column) -> Column:
    """The compiler a language goes to; null if there is none. The order of the rules counts."""
    value = F.lower(c)
    out = None
    for part, name in (("pypy", "pypy"), ("python", "python"), ("c++20", "cpp20"), ("c++17", "cpp17"), ("c++14", "cpp14"), ("c++11", "cpp11"), ("c++", "cpp")):
        out = F.when(value.contains(part), name) if out is None else out.when(value.contains(part), name)
    return out


def any_case(output_format: Column) -> Column:
    text, out = F.lower(empty_if_null(output_format)), F.lit(False)
    for phrase in ANY_CASE:
        out = out | text.contains(phrase)
    return out


def output_tokens(c: Column, fold: Column | None = None) -> Column:
    c = c if fold is None else F.when(fold, F.lower(c)).otherwise(c)
    return F.filter(F.split(c, f"{SPACE}+"), lambda w: w != "")


def outputs_match(actual: Column, expected: Column, fold: Column | None = None) -> Column:
    """Whether two outputs have the same tokens."""
    return output_tokens(actual, fold) == output_tokens(expected, fold)


def unfenced(c: Column) -> Column:
    """Without a Markdown fence around it."""
    c = strip(c)
    inner = F.regexp_replace(F.regexp_replace(c, rf"\A```(?:json)?{SPACE}*", ""), rf"{SPACE}*```\z", "")
    return strip(F.when(c.startswith("```"), inner).otherwise(c))


def tail(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))
