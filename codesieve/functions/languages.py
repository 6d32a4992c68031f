"""Language names: from a dataset's own code, from file extensions and from the text itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extension -> language of the rules.
EXTENSION_LANGUAGE = {
    ".py": "python",
    ".java": "java",
    ".c": "c_cpp",
    ".cpp": "c_cpp",
    ".h": "c_cpp",
    ".js": "javascript",
    ".ts": "javascript",
    ".jsx": "javascript",
}

# Language code of a labelled dataset -> training group.
CODE_GROUP = {
    "py": "python",
    "c": "c_cpp",
    "cpp": "c_cpp",
    "h": "c_cpp",
    "hpp": "c_cpp",
    "java": "java",
    "php": "php",
}

# Names that count as JavaScript or TypeScript.
JAVASCRIPT_NAMES = ("js", "javascript", "ts", "typescript")

# Signs of a language, tried in this order on the lower-cased text.
# Every inner tuple must have one hit; the outer tuple needs all inner ones.
TEXT_SIGNS = (
    ("java", (("public class", "system.out.println", "import java."),)),
    ("c_cpp", (("#include <", "int main(", "void *"),)),
    ("php", (("<?php", "$_"),)),
    ("python", (("def ",), ("import ", "print("))),
)


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def from_path(path: Column) -> Column:
    """Language by the lower-cased extension of the last path part; null when unmapped."""
    extension = F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1))
    return _lookup(EXTENSION_LANGUAGE, extension)


def from_code(code_name: Column) -> Column:
    """Training group of a dataset's own language code; null when it belongs to none."""
    return _lookup(CODE_GROUP, F.lower(code_name))


def from_text(text: Column) -> Column:
    """Language guessed from the text, ``unknown`` when nothing speaks for one."""
    lowered = F.lower(text)
    guess = F.lit("unknown")
    for name, signs in reversed(TEXT_SIGNS):
        tests = [reduce(Column.__or__, [F.contains(lowered, F.lit(s)) for s in group]) for group in signs]
        guess = F.when(reduce(Column.__and__, tests), F.lit(name)).otherwise(guess)
    return guess


def is_javascript(language: Column) -> Column:
    return F.lower(language).isin(*JAVASCRIPT_NAMES)
