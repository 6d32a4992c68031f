"""Rules on lines and texts, scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.functions.unnest import unnest_structs
from codesieve.functions.text import folded
from codesieve.operators import aggregates, rule_index, rules, scan, scoring
from codesieve.plans import sql, views
from codesieve.plans.registry import query
from codesieve.plans.sql import q, with_views


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.route(views.code_files(spark, sf_dir))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.scan(views.code_files(spark, sf_dir))


def flat_findings(findings="findings"):
    """Findings as one text, the form in which nested results are compared."""
    entry = lambda f: F.concat_ws("|", f["line"].cast("string"), f["type"], f["severity"], f["snippet"])
    return F.array_join(F.transform(F.col(findings), entry), "\n")


def _register_language(name: str, language: str) -> None:
    @query(
        name,
        with_views(
            f"""SELECT file_id, line, CAST(rule_order AS INTEGER) AS rule_order, type, severity, snippet FROM findings
            WHERE language = {q(language)} AND type != 'deprecated_syntax_var'""",
            "findings",
        ),
    )
    def run(spark, sf_dir):
        files = _routed(spark, sf_dir).where(F.col("language") == language)
        return rules.line_hits(files, rules.LANGUAGE_RULES[language]).drop("detail")


for _name, _language in (
    ("rul_lang_python", "python"),
    ("rul_lang_java", "java"),
    ("rul_lang_c", "c_cpp"),
    ("rul_lang_js", "javascript"),
):
    _register_language(_name, _language)


@query(
    "rel_rules_join",
    with_views(
        """SELECT file_id, line, CAST(rule_order AS INTEGER) AS rule_order, type, severity, snippet FROM findings
        WHERE type != 'deprecated_syntax_var'""",
        "findings",
    ),
)
def rel_rules_join(spark, sf_dir):
    return rule_index.join_rules(_routed(spark, sf_dir), rules.rules_table(spark))


@query(
    "rul_js_var",
    with_views(
        f"""SELECT file_id, CASE WHEN n > 10 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, 1 AS line,
        {q(rules.VAR_MESSAGE[0])} || (n - 1) || {q(rules.VAR_MESSAGE[1])} AS snippet FROM vars WHERE n > 3""",
        "vars",
    ),
)
def rul_js_var(spark, sf_dir):
    files = _routed(spark, sf_dir).where("language = 'javascript'")
    found = files.select("file_id", rules.var_finding(F.col("code")).alias("f")).where("f IS NOT NULL")
    return found.select("file_id", "f.severity", "f.line", "f.snippet")


def _py_lines_sql() -> str:
    parts = [
        f"SELECT file_id, line, {i} AS rule_order, {q(r.name)} AS type, {q(r.severity)} AS severity, "
        f"substr(bare, 1, 100) AS snippet, {q(r.detail)} AS detail FROM c WHERE {sql.hits('text', r.pattern)}"
        for i, r in enumerate(rules.PYTHON_LINE_RULES, 1)
    ]
    return with_views(
        "SELECT * FROM (WITH c AS (SELECT * FROM code_lines WHERE language = 'python' AND bare != '' "
        "AND substr(bare, 1, 1) != '#') " + " UNION ALL ".join(parts) + ")",
        "code_lines",
    )


@query("rul_py_lines", _py_lines_sql())
def rul_py_lines(spark, sf_dir):
    files = _routed(spark, sf_dir).where("language = 'python'")
    return rules.line_hits(files, rules.PYTHON_LINE_RULES, skip=("#",), snippet=100)


@query(
    "rep_python_files",
    with_views(
        f"""SELECT file_id, path, language, score, ml_prob, coalesce(findings, '') AS findings,
        CASE WHEN score > 0.8 THEN 'CRITICAL' WHEN score > 0.6 THEN 'HIGH' WHEN score > 0.4 THEN 'MEDIUM' ELSE 'SAFE' END AS verdict
        FROM (SELECT file_id, path, language, CAST(0.0 AS DOUBLE) AS ml_prob, findings, coalesce(score, CAST(0 AS DOUBLE)) AS score
        FROM routed LEFT JOIN (SELECT file_id, string_agg(line || '|' || type || '|' || severity || '|' || snippet, chr(10) ORDER BY line, rule_order) AS findings,
        max(CAST(CASE severity WHEN 'CRITICAL' THEN 1.0 WHEN 'HIGH' THEN 0.8 WHEN 'MEDIUM' THEN 0.5 WHEN 'LOW' THEN 0.2 ELSE 0 END AS DOUBLE)) AS score
        FROM ({_py_lines_sql()}) GROUP BY file_id) USING (file_id) WHERE language = 'python')""",
        "routed",
    ),
)
def rep_python_files(spark, sf_dir):
    files = _routed(spark, sf_dir).where("language = 'python'").withColumn("ml_prob", F.lit(0.0))
    return scoring.with_verdict(rules.with_python_findings(files), scan.REPORT_KEY).withColumn("findings", flat_findings())


def _text_rule(name: str, key: str, pieces: list[tuple[str, rules.Rule]]) -> None:
    body = " UNION ALL ".join(
        f"SELECT file_id, {q(r.name)} AS name, {q(r.severity)} AS severity, {q(r.detail)} AS detail "
        f"FROM code_files WHERE {test}"
        for test, r in pieces
    )

    @query(name, with_views(body, "code_files"))
    def run(spark, sf_dir):
        files = views.code_files(spark, sf_dir).withColumn("lowered", folded(F.col("code")))
        found = rules.text_findings(F.col("code"), F.col("lowered"))[key]
        return unnest_structs(files, ["file_id"], found)


_text_rule("rul_secret_text", "secrets", [(sql.hits("code", r.pattern), r) for r in rules.SECRET_TEXT_RULES])
_text_rule(
    "rul_debug_text",
    "debug",
    [(" AND ".join(f"contains(code, {q(s)})" for s in rules.DEBUG_TEXT_SIGNS), rules.DEBUG_TEXT_RULE)],
)
_text_rule("rul_xss_text", "xss", [(sql.hits("code", rules.XSS_TEXT_RULE.pattern, False), rules.XSS_TEXT_RULE)])


def _flags(name: str, patterns: dict[str, str]) -> None:
    columns = ", ".join(f"CAST({sql.hits('code', p)} AS INTEGER) AS {n}" for n, p in patterns.items())

    @query(name, with_views(f"SELECT file_id, {columns} FROM code_files", "code_files"))
    def run(spark, sf_dir):
        return rules.with_flags(views.code_files(spark, sf_dir), patterns).select("file_id", *patterns)


_flags("rul_flags_danger", rules.DANGER_FLAGS)
_flags("rul_flags_sanitise", rules.SANITISE_FLAGS)


@query(
    "scr_hybrid",
    with_views(
        """SELECT file_id, round(raw, 4) AS score, round(p, 4) AS ml_prob, max_severity,
        CASE WHEN raw > 0.8 THEN 'CRITICAL' WHEN raw > 0.6 THEN 'HIGH' WHEN raw > 0.4 THEN 'MEDIUM' ELSE 'SAFE' END AS verdict
        FROM (SELECT file_id, max_severity, coalesce(prob, CAST(0 AS DOUBLE)) AS p,
        greatest(coalesce(prob, CAST(0 AS DOUBLE)), max_severity) AS raw FROM report LEFT JOIN predictions ON file_id = key)""",
        "report",
        "predictions",
    ),
)
def scr_hybrid(spark, sf_dir):
    probs = views.predictions(spark, sf_dir).select(F.col("key").alias("file_id"), "prob")
    weights = report(spark, sf_dir).select("file_id", scoring.max_weight(F.col("findings")).alias("max_severity"))
    both = weights.join(probs, "file_id", "left")
    score = scoring.hybrid_score(F.col("prob"), F.col("max_severity"))
    return both.select(
        "file_id",
        "max_severity",
        scoring.verdict(score).alias("verdict"),
        F.round(score, 4).alias("score"),
        F.round(F.coalesce("prob", F.lit(0.0)), 4).alias("ml_prob"),
    )


_TEXT_RULE_TESTS = [
    (language, rule) for language, group in rules.LANGUAGE_RULES.items() for rule in group
]


def _additive_sql() -> str:
    points = " + ".join(
        f"CASE WHEN language = {q(language)} AND {sql.hits('code', rule.pattern)} "
        f"THEN {scoring.SEVERITY_POINTS.get(rule.severity, scoring.OTHER_POINTS)} ELSE 0 END"
        for language, rule in _TEXT_RULE_TESTS
    )
    return with_views(
        f"""SELECT file_id, CAST(points AS INTEGER) AS points, round(s, 2) AS score, round(p, 3) AS ml_prob,
        CASE WHEN s > 8 THEN 'CRITICAL' WHEN s > 5 THEN 'HIGH' WHEN s > 3 THEN 'MEDIUM' ELSE 'LOW' END AS verdict
        FROM (SELECT *, p * 10 + points AS s FROM (SELECT file_id, coalesce(prob, CAST(0 AS DOUBLE)) AS p, {points} AS points
        FROM routed LEFT JOIN predictions ON file_id = key))""",
        "routed",
        "predictions",
    )


@query("scr_additive", _additive_sql())
def scr_additive(spark, sf_dir):
    probs = views.predictions(spark, sf_dir).select(F.col("key").alias("file_id"), "prob")
    points = _routed(spark, sf_dir).select("file_id", rules.text_points("language", "code").alias("points"))
    p = F.coalesce("prob", F.lit(0.0))
    score = p * 10 + F.col("points")
    return points.join(probs, "file_id", "left").select(
        "file_id",
        "points",
        F.round(score, 2).alias("score"),
        F.round(p, 3).alias("ml_prob"),
        scoring.additive_verdict(score).alias("verdict"),
    )


@query("rep_files", with_views("SELECT file_id, path, language, verdict, score, ml_prob, findings FROM report", "report"))
def rep_files(spark, sf_dir):
    return report(spark, sf_dir).withColumn("findings", flat_findings())


@query(
    "agg_max_severity", with_views("SELECT file_id, max_severity FROM report", "report")
)
def agg_max_severity(spark, sf_dir):
    return aggregates.max_severity(report(spark, sf_dir))


@query(
    "agg_findings_per_file",
    with_views("SELECT file_id, n_findings AS findings_count FROM report", "report"),
)
def agg_findings_per_file(spark, sf_dir):
    return aggregates.findings_per_file(report(spark, sf_dir))


@query(
    "agg_severity_counts",
    with_views(
        "SELECT file_id, "
        + ", ".join(
            f"CAST(count(*) FILTER (severity = '{s}') AS INTEGER) AS {s.lower()}_count" for s in aggregates.SEVERITIES
        )
        + """, CAST(count(type) AS INTEGER) AS total, CAST(count(type) > 0 AS INTEGER) AS has_any
        FROM routed LEFT JOIN findings USING (file_id) GROUP BY file_id""",
        "findings",
    ),
)
def agg_severity_counts(spark, sf_dir):
    return aggregates.severity_counts(report(spark, sf_dir))


_KINDS = tuple(dict.fromkeys(rule.name for group in rules.LANGUAGE_RULES.values() for rule in group))


@query(
    "agg_type_counts",
    with_views(
        "SELECT file_id, "
        + ", ".join(f"CAST(count(*) FILTER (type = '{k}') AS INTEGER) AS n_{k}" for k in _KINDS)
        + " FROM routed LEFT JOIN findings USING (file_id) GROUP BY file_id",
        "findings",
    ),
)
def agg_type_counts(spark, sf_dir):
    return aggregates.kind_counts(report(spark, sf_dir), _KINDS)


@query(
    "agg_verdict_counts",
    with_views(
        """SELECT verdict, count(r.file_id) AS n FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('SAFE')) v(verdict)
        LEFT JOIN report r USING (verdict) GROUP BY verdict""",
        "report",
    ),
)
def agg_verdict_counts(spark, sf_dir):
    return aggregates.verdict_counts(report(spark, sf_dir))


@query(
    "agg_files_per_language",
    with_views("SELECT language, count(*) AS n FROM report GROUP BY language", "report"),
)
def agg_files_per_language(spark, sf_dir):
    return aggregates.files_per_language(report(spark, sf_dir))


@query("agg_languages", with_views("SELECT DISTINCT language FROM report", "report"))
def agg_languages(spark, sf_dir):
    return report(spark, sf_dir).select("language").distinct()


@query(
    "agg_correlation",
    with_views(
        "SELECT round(corr(n_findings, target), 9) AS correlation FROM report JOIN routed USING (file_id)", "report"
    ),
)
def agg_correlation(spark, sf_dir):
    files = rules.with_language_findings(_routed(spark, sf_dir))
    counted = files.select("target", F.size("findings").alias("total"))
    return aggregates.correlation(counted, "total", "target").select(F.round("correlation", 9).alias("correlation"))


@query(
    "rep_filter",
    with_views(
        """SELECT 'critical' AS view, path, verdict, language FROM report WHERE verdict = 'CRITICAL'
        UNION ALL SELECT 'python', path, verdict, language FROM report WHERE language = 'python'
        UNION ALL SELECT 'search', path, verdict, language FROM report WHERE contains(lower(path), 'src1/f')
        UNION ALL SELECT 'all', path, verdict, language FROM report
        UNION ALL SELECT 'three', path, verdict, language FROM report WHERE verdict = 'SAFE' AND language = 'c_cpp' AND contains(lower(path), '.h')""",
        "report",
    ),
)
def rep_filter(spark, sf_dir):
    rows = report(spark, sf_dir).select("path", "verdict", "language")
    picks = {
        "critical": scoring.filter_report(rows, severity="CRITICAL"),
        "python": scoring.filter_report(rows, language="python"),
        "search": scoring.filter_report(rows, search="SRC1/F"),
        "all": scoring.filter_report(rows),
        "three": scoring.filter_report(rows, "SAFE", "c_cpp", ".H"),
    }
    out = None
    for name, part in picks.items():
        part = part.select(F.lit(name).alias("view"), "path", "verdict", "language")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "rep_gate",
    with_views("SELECT path AS file, verdict, score FROM report WHERE verdict = 'CRITICAL' OR score >= 0.7", "report"),
)
def rep_gate(spark, sf_dir):
    return scoring.gate(report(spark, sf_dir))


@query(
    "rep_summary_lines",
    with_views(
        """SELECT format('- `{}` → **{}** ({:.1f}%)', path, verdict, score * 100) AS line
        FROM report WHERE verdict = 'CRITICAL' OR score >= 0.7""",
        "report",
    ),
)
def rep_summary_lines(spark, sf_dir):
    blocked = scoring.gate(report(spark, sf_dir))
    return blocked.select(scoring.summary_line(F.col("file"), F.col("verdict"), F.col("score")).alias("line"))


@query(
    "rep_notification",
    with_views(
        """SELECT count(*) AS total, count(*) FILTER (verdict = 'CRITICAL') AS critical, count(*) FILTER (verdict = 'HIGH') AS high,
        count(*) FILTER (verdict = 'MEDIUM') AS medium, count(*) FILTER (verdict = 'SAFE') AS safe FROM report""",
        "report",
    ),
)
def rep_notification(spark, sf_dir):
    return scoring.verdict_totals(report(spark, sf_dir))
