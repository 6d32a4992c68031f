"""Syntax facts, taint and feature tables of the Python files.

SQL cannot parse Python, but it can name what each fixed body holds: the twins join the expected rows on the slot. Tests
compare the facts of other texts with a walk of the tree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from codesieve.functions import labels
from codesieve.functions.unnest import unnest
from codesieve.operators import aggregates, facts, features, heuristics, rules
from codesieve.plans import syntax_expected as expected
from codesieve.plans import views
from codesieve.plans.registry import query
from codesieve.plans.sql import SLOTS, hits, q, with_views
from codesieve.plans.text_queries import LINE_METRICS_SQL, TOKEN_STATS_SQL


def _value(value) -> str:
    return q(value) if isinstance(value, str) else "NULL" if value is None else str(value).upper()


def slot_sql(rows, more: str = "", **columns: str) -> str:
    """Expected rows of each slot, for every document of it."""
    values = ", ".join(f"({', '.join(map(_value, row))})" for row in rows)
    shown = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns.items())
    return (
        f"SELECT doc_id AS file_id, {shown}{more} FROM documents "
        f"JOIN (VALUES {values}) v(slot, {', '.join(columns)}) ON doc_id % {SLOTS} = slot"
    )


_FINDING = {"seq": "INTEGER", "name": "VARCHAR", "severity": "VARCHAR", "detail": "VARCHAR"}


def python_files(spark, sf_dir):
    return views.code_files(spark, sf_dir).where("language = 'py'")


def known(spark, sf_dir):
    return facts.with_facts(python_files(spark, sf_dir).select("file_id", "code"))


def tainted(spark, sf_dir):
    return heuristics.with_taint(known(spark, sf_dir))


@query(
    "ast_facts",
    slot_sql(
        expected.AST_FACTS,
        ", CASE WHEN parse_ok THEN CAST(len(string_split(text, chr(10))) + (slot = 0)::INTEGER AS INTEGER) END AS comment_tokens",
        parse_ok="BOOLEAN", nodes="INTEGER", assigns="INTEGER", calls="INTEGER", operators="INTEGER", statements="INTEGER",
        source_lines="INTEGER",
    ),
)
def ast_facts(spark, sf_dir):
    return known(spark, sf_dir).select(
        "file_id",
        "parse_ok",
        *[F.coalesce(F.size(c), F.lit(0)).alias(c) for c in ("nodes", "assigns", "calls", "operators")],
        "statements",
        "comment_tokens",
        "source_lines",
    )


@query(
    "ast_counts",
    slot_sql(
        expected.AST_COUNTS,
        functions="INTEGER", classes="INTEGER", imports="INTEGER", ast_nodes="INTEGER", control_structures="INTEGER",
    ),
)
def ast_counts(spark, sf_dir):
    columns = facts.node_counts()
    return known(spark, sf_dir).where("parse_ok").select("file_id", *[c.alias(n) for n, c in columns.items()])


@query("ast_depth", slot_sql(expected.AST_DEPTH, ast_depth="INTEGER"))
def ast_depth(spark, sf_dir):
    return known(spark, sf_dir).where("parse_ok").select("file_id", facts.depth().alias("ast_depth"))


@query("ast_cyclomatic", slot_sql(expected.AST_CYCLOMATIC, cyclomatic_complexity="INTEGER"))
def ast_cyclomatic(spark, sf_dir):
    value = F.when(F.col("parse_ok"), facts.cyclomatic()).otherwise(0)
    return known(spark, sf_dir).select("file_id", value.alias("cyclomatic_complexity"))


def _structure_sql() -> str:
    """All that hangs on the slot of a parsable body, and the maintainability index, for which the tail's comments are counted."""
    facts_of = {row[0]: row for row in expected.AST_FACTS if row[1]}
    counts_of, depth_of, complexity_of = (dict((r[0], r[1:]) for r in t) for t in (expected.AST_COUNTS, expected.AST_DEPTH, expected.AST_CYCLOMATIC))
    rows = [
        (slot, *counts_of[slot], *depth_of[slot], *complexity_of[slot], length, vocabulary, facts_of[slot][6], facts_of[slot][7])
        for slot, length, vocabulary in expected.AST_HALSTEAD
    ]
    names = (
        "functions classes imports ast_nodes control_structures ast_depth cyclomatic_complexity n_signs n_distinct statements source_lines"
    ).split()
    comments = ", len(string_split(text, chr(10))) + (slot = 0)::INTEGER AS comment_tokens"
    inner = slot_sql(rows, comments, **{name: "INTEGER" for name in names})
    index = (
        "100 * (171 - 5.2::DOUBLE * ln(n_signs * log2(n_distinct)) - 0.23::DOUBLE * (cyclomatic_complexity + 1) - 16.2::DOUBLE * ln(statements) "
        "+ 50 * sin(sqrt(2.46::DOUBLE * radians(100 * comment_tokens::DOUBLE / source_lines)))) / 171"
    )
    return (
        f"SELECT *, round(CASE WHEN n_distinct > 1 AND statements > 0 THEN least(greatest({index}, 0), 100) ELSE 100 END, 6)::DOUBLE "
        f"AS maintainability_index FROM ({inner})"
    )


@query(
    "ast_maintainability",
    "SELECT file_id, maintainability_index AS maintainability, maintainability_index AS with_docstrings FROM (" + _structure_sql() + ")",
)
def ast_maintainability(spark, sf_dir):
    return known(spark, sf_dir).where("parse_ok").select(
        "file_id",
        F.round(facts.maintainability(False), 6).alias("maintainability"),
        F.round(facts.maintainability(True), 6).alias("with_docstrings"),
    )


@query("ast_taint", slot_sql(expected.AST_TAINT, name="VARCHAR"))
def ast_taint(spark, sf_dir):
    return unnest(tainted(spark, sf_dir), ["file_id"], "tainted", "name")


@query("ast_taint_flags", slot_sql(expected.AST_TAINT_FLAGS, tainted_vars_count="INTEGER", has_tainted_vars="INTEGER"))
def ast_taint_flags(spark, sf_dir):
    return tainted(spark, sf_dir).where("parse_ok").select(
        "file_id",
        F.size("tainted").alias("tainted_vars_count"),
        (F.size("tainted") > 0).cast("int").alias("has_tainted_vars"),
    )


@query("ast_contains_taint", slot_sql(expected.AST_CONTAINS_TAINT, seq="INTEGER", func="VARCHAR", pos="INTEGER", reached="BOOLEAN"))
def ast_contains_taint(spark, sf_dir):
    args = facts.calls_table(tainted(spark, sf_dir), ("file_id", "tainted"))
    return args.where("pos IS NOT NULL").select(
        "file_id", "seq", "func", "pos", F.arrays_overlap("names", "tainted").alias("reached")
    )


@query("ast_sqli", slot_sql(expected.AST_SQLI, **_FINDING))
def ast_sqli(spark, sf_dir):
    return heuristics.findings_rows(tainted(spark, sf_dir), heuristics.sql_injection())


@query("ast_cmdi", slot_sql(expected.AST_CMDI, match="VARCHAR", **_FINDING))
def ast_cmdi(spark, sf_dir):
    forms = [
        F.struct(F.lit(match).alias("match"), heuristics.command_injection(match).alias("found"))
        for match in ("literal", "intended")
    ]
    both = tainted(spark, sf_dir).select("file_id", F.inline(F.array(*forms)))
    return heuristics.findings_rows(both, F.col("found"), ("file_id", "match"))


@query("ast_path", slot_sql(expected.AST_PATH, **_FINDING))
def ast_path(spark, sf_dir):
    return heuristics.findings_rows(tainted(spark, sf_dir), heuristics.path_traversal())


def _run_all_sql() -> str:
    """Findings on the whole text, searched in SQL, then those that hang on the slot; numbered anew in each file."""
    signs = " AND ".join(f"contains(code, {q(s)})" for s in rules.DEBUG_TEXT_SIGNS)
    tests = [(hits("code", r.pattern), r) for r in rules.SECRET_TEXT_RULES]
    tests += [(signs, rules.DEBUG_TEXT_RULE), (hits("code", rules.XSS_TEXT_RULE.pattern, False), rules.XSS_TEXT_RULE)]
    parsed = ", ".join(str(row[0]) for row in expected.AST_FACTS if row[1])
    parts = [
        f"SELECT file_id, 0 AS part, {k} AS seq, {q(r.name)} AS name, {q(r.severity)} AS severity, {q(r.detail)} AS detail "
        f"FROM code_files WHERE language = 'py' AND file_id % {SLOTS} IN ({parsed}) AND {test}"
        for k, (test, r) in enumerate(tests)
    ]
    literal = tuple((row[0], *row[2:]) for row in expected.AST_CMDI if row[1] == "literal")
    for part, rows in enumerate((expected.AST_SQLI, literal, expected.AST_PATH, expected.AST_UNPARSABLE), 1):
        if rows:
            parts.append(f"SELECT file_id, {part} AS part, seq, name, severity, detail FROM ({slot_sql(rows, **_FINDING)})")
    return with_views(
        "SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY part, seq) - 1 AS INTEGER) AS seq, name, severity, "
        f"detail FROM ({' UNION ALL '.join(parts)})",
        "code_files",
    )


@query("ast_run_all", _run_all_sql())
def ast_run_all(spark, sf_dir):
    judged = heuristics.with_heuristics(tainted(spark, sf_dir))
    return heuristics.findings_rows(judged, F.col("heuristics"))


def _features_sql(keep: str, names: tuple[str, ...], *more: str) -> str:
    tables = " ".join(f"JOIN ({table}) USING (file_id)" for table in (LINE_METRICS_SQL, *more))
    return with_views(
        f"SELECT {keep}, {', '.join(names)} FROM (SELECT file_id, path, target AS label, safety, code FROM code_files) "
        f"JOIN ({_structure_sql()}) USING (file_id) {tables}",
        "code_files",
    )


def _rounded(table):
    return table.withColumn("maintainability_index", F.round("maintainability_index", 6))


@query("feat_9", _features_sql("file_id, label AS target", features.FEATURES_9))
def feat_9(spark, sf_dir):
    files = python_files(spark, sf_dir).withColumn("target", labels.binary(F.col("safety")))
    return _rounded(features.structural(files, ("file_id", "target"), features.FEATURES_9))


@query("feat_10", _features_sql("file_id, path AS file_path, split_part(path, '/', 2) AS repo", features.FEATURES_10))
def feat_10(spark, sf_dir):
    files = python_files(spark, sf_dir).select(
        "file_id", F.col("path").alias("file_path"), F.split_part("path", F.lit("/"), F.lit(2)).alias("repo"), "code"
    )
    return _rounded(features.structural(files, ("file_id", "file_path", "repo")))


def _found_sql() -> str:
    """Findings of each file by severity and kind, zeros where it has none."""
    counted = ", ".join(
        [f"count(seq) FILTER (severity = {q(s)})::INTEGER AS vuln_{s.lower()}_count" for s in aggregates.SEVERITIES]
        + [f"count(seq) FILTER (name = {q(k)})::INTEGER AS vuln_{k}" for k in aggregates.FINDING_KINDS]
    )
    return (
        f"SELECT file_id, {counted}, count(seq)::INTEGER AS total_vulnerabilities, (count(seq) > 0)::INTEGER AS has_vulnerabilities "
        f"FROM code_files LEFT JOIN ({_run_all_sql()}) USING (file_id) GROUP BY file_id"
    )


_FLAGS_SQL = "SELECT file_id, {} FROM code_files".format(
    ", ".join(f"CAST({hits('code', p)} AS INTEGER) AS {n}" for n, p in {**rules.DANGER_FLAGS, **rules.SANITISE_FLAGS}.items())
)


@query(
    "feat_49",
    _features_sql(
        "file_id, label, safety AS original_safety",
        features.FEATURES_49,
        TOKEN_STATS_SQL,
        slot_sql(expected.AST_TAINT_FLAGS, tainted_vars_count="INTEGER", has_tainted_vars="INTEGER"),
        _found_sql(),
        _FLAGS_SQL,
    ),
)
def feat_49(spark, sf_dir):
    files = python_files(spark, sf_dir).select("file_id", F.col("safety").alias("original_safety"), "code")
    labelled = files.withColumn("label", labels.normalise(F.col("original_safety"))).where("label IS NOT NULL")
    return _rounded(features.full(labelled, ("file_id", "label", "original_safety")))


@query(
    "agg_parse_failures",
    f"""SELECT count(*) FILTER (parse_ok) AS parsed, count(*) FILTER (NOT parse_ok) AS failed
    FROM ({slot_sql(expected.AST_FACTS, parse_ok="BOOLEAN", a="INTEGER", b="INTEGER", c="INTEGER", d="INTEGER", e="INTEGER", f="INTEGER")})""",
)
def agg_parse_failures(spark, sf_dir):
    return aggregates.parse_failures(known(spark, sf_dir))


@query(
    "lbl_risk_rule",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity / 4 > 10 OR l_discount * 1000 < 60 OR l_partkey > 1000 AS INTEGER) AS risk_label FROM lineitem""",
)
def lbl_risk_rule(spark, sf_dir):
    label = labels.risk_rule(F.col("l_quantity") / 4, F.col("l_discount") * 1000, F.col("l_partkey"))
    return views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("risk_label"))
