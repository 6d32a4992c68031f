"""Keyword and stop-word profiles per language, and the columns that count them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.functions.text import occurrences

# Risk keywords and stop words of each training group.
KEYWORDS = {
    "python": (
        "exec", "eval", "os.system", "subprocess", "shell=True", "pickle.load", "yaml.load", "input",
        "cursor.execute", "md5", "token",
    ),
    "java": (
        "Runtime.exec", "ProcessBuilder", "Statement.execute", "executeQuery", "ObjectInputStream",
        "readObject", "MD5", "SHA-1", "password", "get parameter", "createStatement", "jdbc",
    ),
    "c_cpp": (
        "strcpy", "strcat", "sprintf", "gets", "system", "popen", "memcpy", "execl", "execv", "scanf",
        "printf", "malloc", "free", "buffer",
    ),
    "php": (
        "eval", "exec", "system", "shell_exec", "passthru", "mysql_query", "unserialize", "md5",
        "base64_decode", "$_GET", "$_POST",
    ),
    "js": (
        "eval", "innerHTML", "document.write", "setTimeout", "setInterval", "exec", "spawn", "serialize",
        "unserialize", "child_process", "dangerouslySetInnerHTML", "__proto__", "prototype",
    ),
}
STOP_WORDS = {
    "python": ("def", "class", "import", "return", "self"),
    "java": ("public", "class", "void", "static", "import", "package", "new"),
    "c_cpp": ("int", "void", "char", "include", "return", "struct", "const"),
    "php": ("function", "echo", "return", "class", "public", "private"),
    "js": (
        "var", "const", "let", "function", "return", "class", "import", "export", "default", "console", "log",
    ),
}

# The case-sensitive words of the Python-only model.
PYTHON_WORDS = (
    "exec", "eval", "os.system", "subprocess", "shell=True", "pickle.load", "yaml.load", "input",
    "raw_input", "cursor.execute", "md5", "sha1", "tmp", "password", "token", "admin", "debug=True",
)


def profile_of(group: Column) -> Column:
    """Profile name of a training group or rule language: JavaScript goes by ``js``."""
    return F.when(group == "javascript", "js").otherwise(group)


def profile_table(spark: SparkSession) -> DataFrame:
    """(language, kind, pos, word) of all profiles."""
    rows = [
        (language, kind, pos, word)
        for kind, table in (("keyword", KEYWORDS), ("stopword", STOP_WORDS))
        for language, words in table.items()
        for pos, word in enumerate(words, 1)
    ]
    return spark.createDataFrame(rows, "language string, kind string, pos int, word string")


def words_of(language: Column, table: dict[str, tuple[str, ...]]) -> Column:
    """The words of a row's profile as an array, null without a profile."""
    out = F.lit(None).cast("array<string>")
    for name, words in table.items():
        out = F.when(language == name, F.array(*map(F.lit, words))).otherwise(out)
    return out


def keyword_vector(text: Column, words: tuple[str, ...], ignore_case: bool = True) -> Column:
    """Occurrences of each word and, last, the length in thousands of characters; zeros for null."""

    # The text is folded once, and a plain search spares texts without a word the replacement that counts it.
    def count(haystack: Column, word: str) -> Column:
        return F.when(F.contains(haystack, F.lit(word)), occurrences(haystack, word).cast("double")).otherwise(F.lit(0.0))

    def counts(haystack: Column) -> Column:
        return F.array(*[count(haystack, w.lower() if ignore_case else w) for w in words], F.length(text) / F.lit(1000.0))

    row = F.get(F.transform(F.array(F.lower(text) if ignore_case else text), counts), F.lit(0))
    return F.when(text.isNotNull(), row).otherwise(F.array(*[F.lit(0.0)] * (len(words) + 1)))


def keyword_rows(files: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """One row per text and keyword of its language: word, n; files without a profile drop out."""
    lowered = files.select(*keep, F.lower("code").alias("_text"), "language")
    words = lowered.withColumn("word", F.explode_outer(words_of(F.col("language"), KEYWORDS))).where("word IS NOT NULL")
    n = F.coalesce(occurrences(F.col("_text"), F.lower("word")), F.lit(0))
    return words.select(*keep, "language", "word", n.alias("n"))


def python_word_rows(files: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """One row per text and word of the Python-only model, counted with case."""
    words = files.select(*keep, "code", F.explode(F.array(*map(F.lit, PYTHON_WORDS))).alias("word"))
    n = F.coalesce(occurrences(F.col("code"), F.col("word")), F.lit(0))
    return words.select(*keep, "word", n.alias("n"))
