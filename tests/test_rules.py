"""Rules on texts written for these tests: a hit, a near miss and a comment for each."""

import pytest
from pyspark.sql import functions as F

from codesieve.operators import rule_index, rules, scan

CASES = [
    ("a.py", 'subprocess.call("rm " + p)', ["cmd_injection"]),
    ("a.py", 'subprocess.call(["rm", p])', []),
    ("a.py", '# os.system("a" + b)', []),
    ("a.py", "PASSWORD = 'x'", ["hardcoded_pass"]),
    ("a.py", "pa\u017f\u017fword = 'x'", ["hardcoded_pass"]),
    ("a.py", "password = x", []),
    ("a.py", "import a\n\n  pickle.load(f)  ", ["deserialize"]),
    ("A.java", 'Runtime.getRuntime().exec("a" + b);', ["cmd_injection"]),
    ("A.java", 's.executeQuery("x" + y);', ["sql_injection"]),
    ("A.java", 'String password = "a";', ["hardcoded_pass"]),
    ("A.java", "in.readObject();", ["unsafe_deserialize"]),
    ("A.java", "// in.readObject();", []),
    ("b.c", "fgets(b, 3, f);", ["buffer_overflow"]),
    ("b.c", "*p = strcpy(a, b);", []),
    ("b.h", 'system("a %s");', ["cmd_injection"]),
    ("b.cpp", "printf(x);", ["format_string"]),
    ("b.cpp", 'printf("%d", x);', []),
    ("c.js", "el.outerHTML = x", ["dom_xss"]),
    ("c.ts", "setTimeout (f, 1)", ["eval_injection"]),
    ("c.jsx", "spawn(`ls ${x}`)", ["cmd_injection"]),
    ("c.js", "a.prototype = b", ["prototype_pollution"]),
    ("c.js", "dangerouslySetInnerHTML", ["xss_react"]),
    ("c.tsx", "eval(x)", []),
    ("noext", "eval(x)", []),
]


@pytest.fixture(scope="module")
def scanned(spark):
    rows = [(i, path, code) for i, (path, code, _) in enumerate(CASES)]
    report = scan.scan(spark.createDataFrame(rows, "file_id bigint, path string, code string"))
    return {r.file_id: r for r in report.collect()}


@pytest.mark.parametrize("at", range(len(CASES)))
def test_rule(scanned, at):
    assert [f.type for f in scanned[at].findings] == CASES[at][2]


def test_verdicts(scanned):
    by_case = {CASES[i][1]: (r.verdict, r.score) for i, r in scanned.items()}
    assert by_case['subprocess.call("rm " + p)'] == ("CRITICAL", 1.0)
    assert by_case["PASSWORD = 'x'"] == ("HIGH", 0.8)
    assert by_case["password = x"] == ("SAFE", 0.0)


def test_line_numbers_and_snippets(scanned):
    at = next(i for i, c in enumerate(CASES) if "pickle" in c[1])
    (found,) = scanned[at].findings
    assert (found.line, found.snippet) == (3, "pickle.load(f)")


@pytest.mark.parametrize("uses, severity", [(3, None), (4, "MEDIUM"), (10, "MEDIUM"), (11, "HIGH")])
def test_var_rule(spark, uses, severity):
    code = "\n".join(f"var a{i} = 1" for i in range(uses)) + "\nvariable = 2"
    found = spark.range(1).select(rules.var_finding(F.lit(code)).alias("f")).first().f
    assert (found and found.severity) == severity
    assert found is None or f" {uses - 1} usos" in found.snippet


@pytest.mark.parametrize("times", [1, 40])
def test_rule_join_equals_built_in_sets(spark, times):
    rows = [(i, path, code) for i, (path, code, _) in enumerate(CASES)]
    files = scan.route(spark.createDataFrame(rows, "file_id bigint, path string, code string"))
    table = rules.rules_table(spark, {k: group * times for k, group in rules.LANGUAGE_RULES.items()})
    result = rule_index.join_rules(files, table)
    joined = result.select("file_id", "type").distinct().collect()
    wanted = [(i, t) for i, (_, _, types) in enumerate(CASES) for t in types]
    assert sorted(map(tuple, joined)) == sorted(wanted)


@pytest.mark.parametrize(
    "pattern, literals",
    [
        (r"pickle\.load", {"pickle.load"}),
        (r"(os\.system|subprocess\.call).*(\+|%|format)", {"os.system", "subprocess.call"}),
        (r"(?diu)Runtime\.getRuntime\(\)\.exec\(.*(\+|%s)", {"runtime.getruntime().exec("}),
        (r"abc?def", {"def"}),
        (r"abcd+ef", {"abcd"}),
        (r"x{2,}yyy", {"yyy"}),
        (r"(?:abc)?", None),
        (r"(abc|d*)", None),
        (r"[a-z\]]+", None),
        (r"\p{L}foo\bbar", {"foo"}),
        (r"(?<!a)bcd", None),
        (r"(?x) a b c", None),
        (r"\Qa.b\E", None),
        (r"(abc", None),
        (r"", None),
        (r"äöü.*abc", {"abc"}),
    ],
)
def test_literals_that_every_hit_holds(pattern, literals):
    assert rule_index.needs(pattern) == (frozenset(literals) if literals else None)


def test_rule_index_tests_few_pairs(spark):
    """600 rules of one language: the built-in ones, many that ask for a word, some without literals."""
    words = [f"call_{chr(97 + k % 26)}{chr(97 + k // 26)}x{k}" for k in range(580)]
    group = rules.LANGUAGE_RULES["python"] + tuple(rules.Rule(f"r{k}", "LOW", rf"{w}\s*\(") for k, w in enumerate(words))
    group += tuple(rules.Rule(f"any{k}", "LOW", rf"[{k}]{{3}}|z{k}") for k in range(10))
    group += tuple(rules.Rule(f"pair{k}", "LOW", rf"({words[k]}|{words[k + 1]}).*;") for k in range(7))
    code = [
        "\n".join([f"{words[(7 * f + k) % 580]} (a{k}); {words[(f + k) % 580].upper()}(b)" for k in range(20)] + ["", "# call_aax0(", "111 zz z3", "x"])
        for f in range(40)
    ]
    rows = [(f, f"{f}.py", text) for f, text in enumerate(code)] + [(1000, "e.py", ""), (1001, "n.py", None), (1002, "CAPS.py", "PICKLE.LOAD(")]
    files = scan.route(spark.createDataFrame(rows, "file_id bigint, path string, code string"))
    table = rules.rules_table(spark, {"python": group, "java": rules.LANGUAGE_RULES["java"]})
    assert len(group) == 600
    got = rule_index.join_rules(files, table).select("file_id", "line", "rule_order").collect()
    split = files.select("file_id", F.posexplode(F.split("code", "\n")).alias("at", "text"))
    live = split.where(~F.substring(F.ltrim("text"), 1, 1).isin("", "#", "/", "*"))
    every = live.crossJoin(table.where("language = 'python'").select("rule_order", "pattern")).where(F.rlike("text", F.col("pattern")))
    want = every.select("file_id", (F.col("at") + 1).alias("line"), "rule_order").collect()
    assert len(want) > 1500
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert rule_index.candidates(files, table).count() < 0.1 * 600 * live.count()
