"""The derived views in plain SQL, for the comparison engine."""

from __future__ import annotations

from codesieve.functions import languages, text
from codesieve.operators import rules
from codesieve.plans.views import MARKED_BODY, TEMPLATES

SLOTS = len(TEMPLATES)


def q(value: str | None) -> str:
    """A quoted SQL text."""
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"trim({expr}, {q(text.BLANKS)})"


def hits(expr: str, pattern: str, ignore_case: bool = True) -> str:
    return f"regexp_matches({expr}, {q(pattern)}, '{'i' if ignore_case else 'c'}')"


def clean(expr: str, comments: str, drop: str) -> str:
    bare = f"regexp_replace(coalesce({expr}, ''), {q(comments)}, '', 'g')"
    return f"regexp_replace(translate({bare}, chr(10) || chr(13) || chr(9), '   '), {q(drop)}, '', 'g')"


def occurrences(expr: str, word: str) -> str:
    return f"CAST((length({expr}) - length(replace({expr}, {word}, ''))) / length({word}) AS INTEGER)"


def lookup(expr: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"(CASE {expr} {cases} END)"


def from_path(expr: str) -> str:
    return lookup(rf"lower(regexp_extract({expr}, '[^/](\.[^./]*)$', 1))", languages.EXTENSION_LANGUAGE)


def from_code(expr: str) -> str:
    return lookup(f"lower({expr})", languages.CODE_GROUP)


def draw(key: str, seed: str, field: int) -> str:
    return f"CAST('0x' || substr(md5({q(seed + ':')} || {key}), {1 + 8 * field}, 8) AS BIGINT)"


def _slots() -> str:
    return ", ".join(
        f"({slot}, {q(ext)}, {target}, {q(prefix)}, {q(body)})"
        for slot, (ext, target, prefix, body) in enumerate(TEMPLATES)
    )


def _language_hits() -> str:
    parts = []
    for language, group in rules.LANGUAGE_RULES.items():
        for order, rule in enumerate(group, 1):
            parts.append(
                f"SELECT file_id, path, language, line, {order} AS rule_order, {q(rule.name)} AS type, "
                f"{q(rule.severity)} AS severity, substr(bare, 1, 80) AS snippet FROM live "
                f"WHERE language = {q(language)} AND {hits('text', rule.pattern)}"
            )
    return " UNION ALL ".join(parts)


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "code_files": (
        (),
        f"""SELECT doc_id AS file_id, 'src/' || source || '/f' || doc_id || '.' || ext AS path, ext,
        ext AS language, CAST(target AS INTEGER) AS target,
        CASE WHEN target = 1 THEN 'vulnerable' ELSE 'safe' END AS safety,
        replace(replace(body, '¶', chr(10)), '{{id}}', CAST(doc_id AS VARCHAR)) || chr(10)
          || prefix || replace(text, chr(10), chr(10) || prefix) AS code
        FROM documents JOIN (VALUES {_slots()}) AS s(slot, ext, target, prefix, body) ON doc_id % {SLOTS} = slot""",
    ),
    "routed": (
        ("code_files",),
        f"SELECT file_id, path, ext, target, safety, code, {from_path('path')} AS language FROM code_files",
    ),
    "code_lines": (
        ("routed",),
        f"""SELECT *, {strip('text')} AS bare FROM (
        SELECT file_id, path, language, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS line, unnest(l) AS text
        FROM (SELECT *, string_split(code, chr(10)) AS l FROM routed))""",
    ),
    "live": (("code_lines",), "SELECT * FROM code_lines WHERE bare != '' AND substr(bare, 1, 1) NOT IN ('/', '*', '#')"),
    "vars": (
        ("routed",),
        f"""SELECT *, len(regexp_extract_all(code, {q(rules.VAR_PATTERN)})) AS n
        FROM routed WHERE language = 'javascript'""",
    ),
    "findings": (
        ("live", "vars"),
        _language_hits()
        + f""" UNION ALL SELECT file_id, path, language, 1, {rules.VAR_RULE_ORDER}, 'deprecated_syntax_var',
        CASE WHEN n > 10 THEN 'HIGH' ELSE 'MEDIUM' END,
        {q(rules.VAR_MESSAGE[0])} || (n - 1) || {q(rules.VAR_MESSAGE[1])} FROM vars WHERE n > 3""",
    ),
    "report": (
        ("findings",),
        """SELECT file_id, path, language, findings, n_findings, max_severity,
        CASE WHEN raw > 0.8 THEN 'CRITICAL' WHEN raw > 0.6 THEN 'HIGH' WHEN raw > 0.4 THEN 'MEDIUM' ELSE 'SAFE' END AS verdict,
        round(raw, 4) AS score, CAST(0.0 AS DOUBLE) AS ml_prob FROM (
        SELECT r.file_id, r.path, r.language, coalesce(f.findings, '') AS findings,
        CAST(coalesce(f.n, 0) AS INTEGER) AS n_findings, coalesce(f.m, CAST(0 AS DOUBLE)) AS max_severity,
        greatest(coalesce(f.m, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS raw
        FROM routed r LEFT JOIN (
          SELECT file_id, count(*) AS n,
          max(CAST(CASE severity WHEN 'CRITICAL' THEN 1.0 WHEN 'HIGH' THEN 0.8 WHEN 'MEDIUM' THEN 0.5 WHEN 'LOW' THEN 0.2 ELSE 0 END AS DOUBLE)) AS m,
          string_agg(line || '|' || type || '|' || severity || '|' || snippet, chr(10) ORDER BY rule_order = 1000000, line, rule_order) AS findings
          FROM findings GROUP BY file_id) f USING (file_id))""",
    ),
    "train_raw": (
        ("code_files",),
        """SELECT *, CAST(CASE WHEN safety = 'vulnerable' THEN 1 ELSE 0 END AS INTEGER) AS target FROM (
        SELECT file_id AS row_id, 0 AS src_priority, CASE WHEN ext != 'md' THEN code END AS code, language, safety FROM code_files
        UNION ALL SELECT file_id + 1000000000, 1, code, language, CASE WHEN quality = 0 THEN 'vulnerable' ELSE 'safe' END
        FROM code_files JOIN labels ON file_id = doc_id
        UNION ALL SELECT page_id + 2000000000, 2, html, 'js', NULL FROM pages)""",
    ),
    "train": (
        ("train_raw",),
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY src_priority, row_id) AS rn
        FROM train_raw WHERE code IS NOT NULL) WHERE rn = 1""",
    ),
    "safety_words": (
        (),
        """SELECT doc_id AS key, CASE WHEN quality = 1 THEN 'safe' WHEN quality = 0 THEN ' Vulnerable ' WHEN source = 'src0' THEN 'high'
        WHEN source = 'src1' THEN NULL WHEN lang = 'en' THEN 'unsafe' WHEN lang = 'de' THEN 'not vulnerable' WHEN lang = 'fr' THEN 'yes'
        ELSE 'unknown' END AS safety FROM documents LEFT JOIN labels USING (doc_id)""",
    ),
    "fix_pairs": (
        ("code_files",),
        """SELECT b.file_id AS pair_id, b.code AS vulnerable_code, g.code AS fixed_code FROM code_files b
        LEFT JOIN code_files g ON g.file_id = b.file_id + 1 AND g.target = 0 WHERE b.target = 1""",
    ),
    "changed_list": (
        ("code_files",),
        """SELECT '  ' || path || chr(9) AS line FROM code_files JOIN labels ON file_id = doc_id
        UNION ALL SELECT '  ' FROM benchmark
        UNION ALL SELECT 'src/gone/c' || conv_id || '_' || turn || '.py' FROM conversations""",
    ),
    "predictions": (
        (),
        """SELECT *, CAST(prob >= 0.5 AS INTEGER) AS pred FROM (SELECT doc_id AS key, 1 - quality AS label,
        ((n_chars * 7 + doc_id * 13) % 101) / CAST(100 AS DOUBLE) AS prob FROM labels JOIN documents USING (doc_id))""",
    ),
    "marked_files": (
        (),
        f"""SELECT doc_id AS file_id, 'rules/javascript/m' || doc_id || '.js' AS path,
        replace(replace({q(MARKED_BODY)}, '¶', chr(10)), '{{id}}', CAST(doc_id AS VARCHAR)) || chr(10) || text AS code FROM documents""",
    ),
}


def with_views(body: str, *views: str) -> str:
    """``body`` behind the named views and all they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for parent in VIEWS[name][0]:
            need(parent)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        need(name)
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered) + "\n" + body
