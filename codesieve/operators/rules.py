"""Rule sets, and the columns and joins that apply them to texts and lines."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.functions.text import BLANK_CLASS, WORD, WS, folded, is_skipped, lines, portable, strip
from codesieve.functions.unnest import unnest
from codesieve.operators.scoring import OTHER_POINTS, SEVERITY_POINTS


class Rule(NamedTuple):
    name: str
    severity: str
    pattern: str
    detail: str | None = None


# The line rules of each language (severity and pattern as search, case folded).
LANGUAGE_RULES: dict[str, tuple[Rule, ...]] = {
    "python": (
        Rule("cmd_injection", "CRITICAL", r"(os\.system|subprocess\.call).*(\+|%|format)"),
        Rule("hardcoded_pass", "HIGH", rf"(password|secret){WS}*={WS}*[\"'].+[\"']"),
        Rule("deserialize", "HIGH", r"pickle\.load"),
    ),
    "java": (
        Rule("cmd_injection", "CRITICAL", r"Runtime\.getRuntime\(\)\.exec\(.*(\+|%s)"),
        Rule("sql_injection", "CRITICAL", rf"(executeQuery|prepareStatement){WS}*\(.*(\+|%s)"),
        Rule("hardcoded_pass", "HIGH", rf"String{WS}+(password|secret){WS}*={WS}*\".+\""),
        Rule("unsafe_deserialize", "HIGH", r"readObject\(\)"),
    ),
    "c_cpp": (
        Rule("buffer_overflow", "CRITICAL", rf"(strcpy|strcat|gets|sprintf){WS}*\("),
        Rule("cmd_injection", "CRITICAL", rf"system{WS}*\(.*(\+|%s)"),
        Rule("format_string", "HIGH", rf"printf{WS}*\([^,]+\)"),
    ),
    "javascript": (
        Rule("dom_xss", "CRITICAL", rf"(innerHTML|outerHTML|document\.write){WS}*="),
        Rule("eval_injection", "CRITICAL", rf"(eval|setTimeout|setInterval){WS}*\("),
        Rule("cmd_injection", "CRITICAL", r"(child_process|exec|spawn).*(\+|%|`|\$\{)"),
        Rule("prototype_pollution", "HIGH", r"__proto__|prototype"),
        Rule("xss_react", "HIGH", r"dangerouslySetInnerHTML"),
    ),
}

# The line rules of the Python-only report.
PYTHON_LINE_RULES = (
    Rule(
        "hardcoded_secret",
        "HIGH",
        rf"(password|secret|api_key|token|auth){WS}*={WS}*[\"'][A-Za-z0-9@#$%^&+=]{{8,}}[\"']",
        "Credencial hardcodeada.",
    ),
    Rule(
        "sql_injection",
        "CRITICAL",
        rf"(execute|execute_script){WS}*\({WS}*[\"'].*[\"']{WS}*(\+|%).*",
        "Inyección SQL (concatenación).",
    ),
    Rule(
        "command_injection",
        "CRITICAL",
        rf"(os\.system|subprocess\.call|popen){WS}*\(.*(\+|%|format).*",
        "Inyección de Comandos (concatenación).",
    ),
    Rule("insecure_deserialization", "HIGH", r"pickle\.(load|loads)", "Deserialización insegura (Pickle)."),
    Rule("dangerous_eval", "CRITICAL", rf"(eval|exec){WS}*\(", "Uso peligroso de eval/exec."),
    Rule("weak_hashing", "MEDIUM", r"hashlib\.(md5|sha1)", "Hashing débil (MD5/SHA1)."),
    Rule("debug_mode", "LOW", rf"debug{WS}*={WS}*True", "Debug mode habilitado."),
)

# Patterns tried on whole texts. The details print the patterns in their first spelling.
SECRET_TEXT_RULES = (
    Rule(
        "hardcoded_secret",
        "HIGH",
        rf"(secret|token|api[_-]?key|password|pwd|passphrase)[\"'{BLANK_CLASS}:=]+{WORD}+",
        r"Secret o token hardcodeado detectado: "
        r"(secret|token|api[_-]?key|password|pwd|passphrase)[\"'\s:=]+\w+",
    ),
    Rule(
        "hardcoded_secret",
        "HIGH",
        rf"secret[_-]?key{WS}*={WS}*['\"].+['\"]",
        r"Secret o token hardcodeado detectado: secret[_-]?key\s*=\s*['\"].+['\"]",
    ),
)
XSS_TEXT_RULE = Rule(
    "xss_reflected",
    "MEDIUM",
    rf"return{WS}+f?['\"].*\{{.*\}}.*['\"]",
    "Salida dinámica no sanitizada enviada al cliente.",
)
DEBUG_TEXT_SIGNS = ("app.run(", "debug=True")
DEBUG_TEXT_RULE = Rule("debug_mode_enabled", "MEDIUM", "", "Modo debug habilitado en producción.")

# 0/1 flags of risky and of protective code.
DANGER_FLAGS = {
    "pickle_usage": rf"pickle\.(load|loads){WS}*\(",
    "yaml_unsafe_load": rf"yaml\.load{WS}*\(",
    "marshal_usage": rf"marshal\.loads?{WS}*\(",
    "weak_hash": rf"hashlib\.(md5|sha1){WS}*\(",
    "des_crypto": r"DES\.(new|MODE)",
    "eval_usage": rf"\beval{WS}*\(",
    "exec_usage": rf"\bexec{WS}*\(",
    "compile_usage": rf"\bcompile{WS}*\(",
    "shell_true": rf"shell{WS}*={WS}*True",
    "weak_random": r"random\.(random|randint|choice)",
    "xml_unsafe": r"(etree\.fromstring|parseString|xml\.dom)",
}
SANITISE_FLAGS = {
    "has_validation": r"(validate|check|verify|sanitize|escape|clean)",
    "has_try_except": rf"try{WS}*:",
    "has_isinstance": rf"isinstance{WS}*\(",
    "has_assert": rf"assert{WS}+",
    "has_raise": rf"raise{WS}+",
    "parameterized_query": rf"(execute|cursor\.execute){WS}*\([^)]*\?|%s[^)]*\)",
    "html_escape": r"(escape|html\.escape|cgi\.escape)",
}

# Every match of a rule set holds one of these texts, once lower-cased: a cheap test ahead of the patterns.
STEMS: dict[tuple[Rule, ...], tuple[str, ...]] = {
    LANGUAGE_RULES["python"]: ("os.system", "subprocess.call", "password", "secret", "pickle.load"),
    LANGUAGE_RULES["java"]: ("runtime.getruntime", "executequery", "preparestatement", "password", "secret", "readobject"),
    LANGUAGE_RULES["c_cpp"]: ("strcpy", "strcat", "gets", "system", "printf"),
    LANGUAGE_RULES["javascript"]: (
        "innerhtml", "outerhtml", "document.write", "eval", "settimeout", "setinterval",
        "child_process", "exec", "spawn", "__proto__", "prototype",
    ),
    PYTHON_LINE_RULES: (
        "password", "secret", "api_key", "token", "auth", "execute", "os.system", "subprocess.call",
        "popen", "pickle.load", "eval", "exec", "hashlib.", "debug",
    ),
}
FLAG_STEMS = {
    "pickle_usage": ("pickle.load",),
    "yaml_unsafe_load": ("yaml.load",),
    "marshal_usage": ("marshal.load",),
    "weak_hash": ("hashlib.",),
    "des_crypto": ("des.",),
    "eval_usage": ("eval",),
    "exec_usage": ("exec",),
    "compile_usage": ("compile",),
    "shell_true": ("shell",),
    "weak_random": ("random.",),
    "xml_unsafe": ("etree.fromstring", "parsestring", "xml.dom"),
    "has_validation": ("validate", "check", "verify", "sanitize", "escape", "clean"),
    "has_try_except": ("try",),
    "has_isinstance": ("isinstance",),
    "has_assert": ("assert",),
    "has_raise": ("raise",),
    "parameterized_query": ("execute", "%s"),
    "html_escape": ("escape",),
}
SECRET_STEMS = ("secret", "token", "api", "password", "pwd", "passphrase")

# The file-wide rule on old-style declarations.
VAR_PATTERN = rf"\bvar{WS}+"
VAR_MEDIUM_ABOVE = 3
VAR_HIGH_ABOVE = 10
VAR_MESSAGE = (
    "GLOBAL CHECK: Se detectaron ",
    " usos de 'var'. Use 'let' o 'const' para seguridad de alcance.",
)
VAR_RULE_ORDER = 1_000_000

#: One finding inside a file row.
FINDING = "struct<line:int,rule_order:int,type:string,severity:string,snippet:string,detail:string>"


def _match(text: Column, rule: Rule, ignore_case: bool = True) -> Column:
    return text.rlike(portable(rule.pattern, ignore_case))


def _any_stem(lowered: Column, stems: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(lowered, F.lit(stem)) for stem in stems])


def _may_hit(lowered: Column, rules: tuple[Rule, ...]) -> Column:
    """False only where no rule of the set can match: plain search in folded text, far cheaper than
    patterns. Rule sets without stems may hit anywhere."""
    return _any_stem(lowered, STEMS.get(rules, ("",)))


def line_hits(
    files: DataFrame,
    rules: tuple[Rule, ...],
    keep: tuple[str, ...] = ("file_id",),
    skip: tuple[str, ...] = ("/", "*", "#"),
    snippet: int = 80,
) -> DataFrame:
    """One row per line and matching rule, for files that all obey the same rule set.

    All patterns are literals of one projection, so each is compiled once per task, and lines
    without any hit leave before the rules are told apart. Nothing is shuffled.
    """
    likely = files.withColumn("lowered", folded(F.col("code"))).where(_may_hit(F.col("lowered"), rules))
    split = unnest(likely, keep, lines(F.col("code")), "text", "at")
    lowered = split.withColumn("lowered", folded(F.col("text")))
    live = lowered.where(_may_hit(F.col("lowered"), rules) & ~is_skipped(F.col("text"), skip))
    hits = F.array(
        *[
            F.when(
                _match(F.col("text"), rule),
                F.struct(
                    F.lit(order).alias("rule_order"),
                    F.lit(rule.name).alias("type"),
                    F.lit(rule.severity).alias("severity"),
                    F.lit(rule.detail).cast("string").alias("detail"),
                ),
            )
            for order, rule in enumerate(rules, 1)
        ]
    )
    return (
        live.select(
            *keep,
            (F.col("at") + 1).alias("line"),
            F.substring(strip(F.col("text")), 1, snippet).alias("snippet"),
            F.explode_outer(hits).alias("hit"),
        )
        .where("hit IS NOT NULL")
        .select(*keep, "line", "hit.rule_order", "hit.type", "hit.severity", "snippet", "hit.detail")
    )


def _findings_in_row(
    code: Column, lowered: Column, rules: tuple[Rule, ...], skip: tuple[str, ...], snippet: int
) -> Column:
    """All findings of one text as an array, in order of line and rule."""

    def of_line(text: Column, at: Column) -> Column:
        bare = strip(text)
        hits = [
            F.when(
                _match(text, rule),
                F.struct(
                    (at + 1).cast("int").alias("line"),
                    F.lit(order).cast("int").alias("rule_order"),
                    F.lit(rule.name).alias("type"),
                    F.lit(rule.severity).alias("severity"),
                    F.substring(bare, 1, snippet).alias("snippet"),
                    F.lit(rule.detail).cast("string").alias("detail"),
                ),
            )
            for order, rule in enumerate(rules, 1)
        ]
        return F.when(~is_skipped(text, skip), F.array(*hits)).otherwise(F.lit(None).cast(f"array<{FINDING}>"))

    numbered = F.transform(
        lines(code),
        lambda text, at: F.struct(text.alias("text"), folded(text).alias("lowered"), at.alias("at")),
    )
    likely = F.filter(numbered, lambda row: _may_hit(row["lowered"], rules))
    per_line = F.filter(F.transform(likely, lambda row: of_line(row["text"], row["at"])), F.isnotnull)
    found = F.filter(F.flatten(per_line), F.isnotnull)
    # Most texts hold none of the stems and are settled here.
    return F.when(_may_hit(lowered, rules), found).otherwise(no_findings())


def no_findings() -> Column:
    return F.array().cast(f"array<{FINDING}>")


def var_count(code: Column) -> Column:
    counted = F.regexp_count(code, F.lit(portable(VAR_PATTERN, ignore_case=False)))
    return F.when(F.contains(code, F.lit("var")), counted).otherwise(0)


def var_finding(code: Column) -> Column:
    """The finding on old-style declarations, null up to the first limit. Prints the count less one."""
    count = var_count(code)
    severity = F.when(count > VAR_HIGH_ABOVE, "HIGH").otherwise("MEDIUM")
    message = F.concat(F.lit(VAR_MESSAGE[0]), (count - 1).cast("string"), F.lit(VAR_MESSAGE[1]))
    return F.when(
        count > VAR_MEDIUM_ABOVE,
        F.struct(
            F.lit(1).cast("int").alias("line"),
            F.lit(VAR_RULE_ORDER).cast("int").alias("rule_order"),
            F.lit("deprecated_syntax_var").alias("type"),
            severity.alias("severity"),
            message.alias("snippet"),
            F.lit(None).cast("string").alias("detail"),
        ),
    )


def with_language_findings(files: DataFrame) -> DataFrame:
    """Add ``findings``: all hits in ``code`` under the rules of its ``language``, as one array column.

    The array is built inside the row: a file is never exploded, shuffled and gathered again.
    Languages without rules, and null, give an empty array.
    """
    code, lowered = F.col("code"), F.col("_lowered")
    out = no_findings()
    for name, rules in LANGUAGE_RULES.items():
        found = _findings_in_row(code, lowered, rules, ("/", "*", "#"), 80)
        if name == "javascript":
            found = F.concat(found, F.filter(F.array(var_finding(code)), F.isnotnull))
        out = F.when(F.col("language") == name, found).otherwise(out)
    lowered_files = files.withColumn("_lowered", folded(F.col("code")))
    return lowered_files.withColumn("findings", F.coalesce(out, no_findings())).drop("_lowered")


def with_python_findings(files: DataFrame) -> DataFrame:
    """Add ``findings`` of the Python-only rule set; only ``#`` lines are skipped, snippets are longer."""
    found = _findings_in_row(F.col("code"), F.col("_lowered"), PYTHON_LINE_RULES, ("#",), 100)
    return files.withColumn("_lowered", folded(F.col("code"))).withColumn("findings", found).drop("_lowered")


def with_flags(files: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Add a 0/1 column per pattern, searched in the whole text; its stems are looked for first."""
    lowered = files.withColumn("_lowered", folded(F.col("code")))
    flags = {
        name: (_any_stem(F.col("_lowered"), FLAG_STEMS[name]) & F.col("code").rlike(portable(pattern))).cast("int")
        for name, pattern in patterns.items()
    }
    return lowered.withColumns(flags).drop("_lowered")


def text_findings(code: Column, lowered: Column) -> dict[str, Column]:
    """Whole-text findings by heuristic: arrays of ``struct<name,severity,detail>``.

    ``lowered`` is the folded text, as a column of its own.
    """

    def entry(rule: Rule, hit: Column) -> Column:
        return F.when(
            hit,
            F.struct(
                F.lit(rule.name).alias("name"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.detail).alias("detail"),
            ),
        )

    def present(*entries: Column) -> Column:
        return F.filter(F.array(*entries), lambda hit: hit.isNotNull())

    debug = reduce(Column.__and__, [F.contains(code, F.lit(sign)) for sign in DEBUG_TEXT_SIGNS])
    return {
        "secrets": F.when(
            _any_stem(lowered, SECRET_STEMS),
            present(*[entry(rule, _match(code, rule)) for rule in SECRET_TEXT_RULES]),
        ).otherwise(present(F.lit(None).cast("struct<name:string,severity:string,detail:string>"))),
        "debug": present(entry(DEBUG_TEXT_RULE, debug)),
        "xss": present(entry(XSS_TEXT_RULE, _match(code, XSS_TEXT_RULE, ignore_case=False))),
    }


def rules_table(spark, rules: dict[str, tuple[Rule, ...]] | None = None) -> DataFrame:
    """Rules as rows whose size the planner knows, the form in which users hand in their own."""
    rows = [
        F.struct(
            F.lit(language).alias("language"),
            F.lit(order).alias("rule_order"),
            F.lit(rule.name).alias("type"),
            F.lit(rule.severity).alias("severity"),
            F.lit(portable(rule.pattern)).alias("pattern"),
        )
        for language, group in (rules or LANGUAGE_RULES).items()
        for order, rule in enumerate(group, 1)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def text_points(language: str, code: str) -> Column:
    """Points of the additive score: every rule counts once when found anywhere in the whole text."""
    out = F.lit(0)
    for name, rules in LANGUAGE_RULES.items():
        points = [
            F.when(_match(F.col(code), rule), SEVERITY_POINTS.get(rule.severity, OTHER_POINTS)).otherwise(0)
            for rule in rules
        ]
        out = F.when(F.col(language) == name, reduce(Column.__add__, points)).otherwise(out)
    return out
