import pytest

LONG = " ".join(f"w{k % 700}x{k * k % 911}" for k in range(30_000))
BASE = " ".join(f"alpha{k * 7 % 113} beta{k}" for k in range(60))
LINE = "this very line stands in many documents of the corpus"

DOCUMENTS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),  # a copy
    (3, BASE.replace("beta5 ", "gamma "), "en", "b"),  # a near copy
    (3, BASE.replace("beta5 ", "gamma "), "en", "b"),  # a repeated row
    (4, None, "en", "a"),
    (5, "", None, None),
    (6, " \t\r\n\x0b\x0c ", "de", ""),
    (7, LONG, "en", "a"),
    (8, "Some other text. " + LONG[:9000], "en", None),
    (None, "no name here " + BASE, "en", "a"),
    (None, None, None, None),
    (9, "two words", "fr", "a"),
    (10, "Two WORDS", "fr", "a"),
    (11, "öäü éè\n" * 40, "de", "b"),
    (12, "one\u00a0word \u2003 and # * $ % & | < >\n\nx\nx\n", "en", "b"),
    (9, "the same id with another text " + BASE[50:400], "en", "c"),
] + [
    (100 + k, f"{LINE}\nunique{k} " + " ".join(f"u{k}v{j}" for j in range(60 if k % 2 else 5)) + f"\n{LINE}", "en", "hot")
    for k in range(40)
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with everything that may go wrong, and columns whose names the operators use themselves."""
    rows = [(*r, len(r[1] or ""), "x", 1, 2, "y") for r in DOCUMENTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, host string, row int, n int, label string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def documents():
    return DOCUMENTS


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
