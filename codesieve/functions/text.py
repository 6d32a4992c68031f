"""Text functions on code: stripping, cleaning, counting, splitting into lines and words.

Functions named ``with_*`` add columns to a table, so that a costly step feeds several of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What Python calls white space, as single characters and as a regex class that
# means the same in Java, RE2 and Python.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
BLANK_CLASS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WS = f"[{BLANK_CLASS}]"
WORD = r"[\p{L}\p{N}_]"

# Where Python's splitlines() ends a line.
RARE_LINE_ENDS = ("\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"

# Comment forms and white-lists of the two cleaning steps.
COMMENTS_HASH = r"#.*"
COMMENTS_ALL = r"#.*|//.*|/\*[\s\S]*?\*/"
KEEP_PYTHON = rf"[^A-Za-z0-9{BLANK_CLASS}()\[\]{{}}._=\-\"'+%*,]"
KEEP_MULTI = rf"[^A-Za-z0-9{BLANK_CLASS}()\[\]{{}}._=\-\"'+%*,<>&]"


def portable(pattern: str, ignore_case: bool = True) -> str:
    """Java form of a portable pattern: only a line feed ends a line, case folds as Unicode."""
    return ("(?diu)" if ignore_case else "(?d)") + pattern


def strip(text: Column) -> Column:
    """Cut all Unicode blanks from both ends (``trim`` alone cuts spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


def _clean(text: Column, comments: str, drop: str) -> Column:
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "(?d)" + comments, "")
    return F.regexp_replace(F.translate(bare, "\n\r\t", "   "), drop, "")


def clean_python(text: Column) -> Column:
    """Drop ``#`` comments and all characters outside the narrow white-list; null gives ''."""
    return _clean(text, COMMENTS_HASH, KEEP_PYTHON)


def clean_multi(text: Column) -> Column:
    """As :func:`clean_python`, with ``//`` and block comments and a white-list with ``<>&``."""
    return _clean(text, COMMENTS_ALL, KEEP_MULTI)


def lines(code: Column) -> Column:
    """Pieces between line feeds; a closing line feed leaves an empty last piece."""
    return F.split(code, "\n", -1)


def source_lines(code: Column) -> Column:
    """Lines as ``splitlines`` gives them, save that a closing line end leaves an empty last piece."""
    # Other line ends are rare: plain searches settle most texts and keep the split a simple one.
    rare = reduce(Column.__or__, [F.contains(code, F.lit(end)) for end in RARE_LINE_ENDS])
    return F.split(F.when(rare, F.regexp_replace(code, LINE_ENDS, "\n")).otherwise(code), "\n", -1)


def is_skipped(line: Column, marks: tuple[str, ...] = ("/", "*", "#")) -> Column:
    """True for a line that is blank or starts, after blanks, with one of ``marks``."""
    first = F.substring(lstrip(line), 1, 1)
    return first.isin("", *marks)


def occurrences(text: Column, word: Column | str) -> Column:
    """Number of non-overlapping occurrences of ``word``."""
    needle = F.lit(word) if isinstance(word, str) else word
    gone = F.replace(text, needle, F.lit(""))
    return ((F.length(text) - F.length(gone)) / F.length(needle)).cast("int")


def before_slashes(line: Column) -> Column:
    """Stripped text ahead of the first ``//``."""
    return strip(F.substring_index(line, "//", 1))


def words(text: Column) -> Column:
    """All runs of letters, digits and underscores."""
    return F.regexp_extract_all(text, F.lit(f"({WORD}+)"), F.lit(1))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """Put ``values`` in place of ``{name}``; doubled braces become single ones."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    out = F.replace(out, F.lit("{{"), F.lit("{"))
    return F.replace(out, F.lit("}}"), F.lit("}"))


def lstrip(text: Column) -> Column:
    """The text without leading blanks; cheaper than :func:`strip` where only its start matters."""
    return F.ltrim(text, F.lit(BLANKS))


def folded(text: Column) -> Column:
    """Lower-cased text in which every letter that a case-blind pattern takes for a, b … z is that
    letter. Meant for a quick search ahead of a pattern; make it a column, it is used many times."""
    plain = text
    for letter, base in (("\u017f", "s"), ("\u0131", "i"), ("\u0130", "i")):
        plain = F.replace(plain, F.lit(letter), F.lit(base))
    return F.lower(plain)


def with_line_metrics(df: DataFrame, code: str = "code") -> DataFrame:
    """Add loc, comments, blank_lines, code_lines, size_bytes and avg_line_length of a text."""
    rows = df.withColumn("_rows", F.transform(source_lines(F.col(code)), lstrip))
    # A closing line end opens no further line; an empty text has none at all.
    closed = F.substring(code, -1, 1).isin("", "\n", *RARE_LINE_ENDS).cast("int")
    counted = rows.withColumns(
        {
            "loc": F.size("_rows") - closed,
            "comments": F.size(F.filter("_rows", lambda row: row.startswith("#"))),
            "blank_lines": F.size(F.filter("_rows", lambda row: row == "")) - closed,
            "size_bytes": F.octet_length(F.col(code)),
        }
    ).drop("_rows")
    return counted.withColumns(
        {
            "code_lines": F.col("loc") - F.col("comments") - F.col("blank_lines"),
            "avg_line_length": F.when(F.col("loc") > 0, F.col("size_bytes") / F.col("loc")).otherwise(F.lit(0.0)),
        }
    )


def with_token_stats(df: DataFrame, code: str = "code") -> DataFrame:
    """Add total_tokens, unique_tokens and token_diversity of a text."""
    found = df.withColumn("_words", words(F.col(code)))
    counted = found.withColumns(
        {"total_tokens": F.size("_words"), "unique_tokens": F.size(F.array_distinct("_words"))}
    ).drop("_words")
    total, unique = F.col("total_tokens"), F.col("unique_tokens")
    return counted.withColumn("token_diversity", F.when(total > 0, unique / total).otherwise(F.lit(0.0)))


def md5_int(text: Column, digits: int = 8, start: int = 1) -> Column:
    """An evenly spread whole number from hex digits of the MD5 of ``text``."""
    return F.conv(F.substring(F.md5(text), start, digits), 16, 10).cast("bigint")
