"""Projections, labels, languages and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from codesieve.functions.unnest import unnest
from codesieve.functions import labels, languages, profiles, text
from codesieve.operators import aggregates, rules, scan, sets, synthesis
from codesieve.plans import sql, views
from codesieve.plans.registry import query
from codesieve.plans.sql import q, with_views


@query("prj_code_target", with_views("SELECT code, target FROM train_raw", "train_raw"))
def prj_code_target(spark, sf_dir):
    return views.train_raw(spark, sf_dir).select("code", "target")


@query("flt_language_eq", with_views("SELECT row_id, code FROM train_raw WHERE language = 'py'", "train_raw"))
def flt_language_eq(spark, sf_dir):
    return views.train_raw(spark, sf_dir).where(F.col("language") == "py").select("row_id", "code")


@query(
    "flt_language_in",
    with_views(
        "SELECT row_id, language FROM train_raw WHERE lower(language) IN ('js', 'javascript', 'ts', 'typescript')",
        "train_raw",
    ),
)
def flt_language_in(spark, sf_dir):
    rows = views.train_raw(spark, sf_dir)
    return rows.where(languages.is_javascript(F.col("language"))).select("row_id", "language")


@query(
    "flt_python_records",
    with_views(
        """SELECT 'by language' AS rule, file_id FROM code_files WHERE ext = 'py'
        UNION ALL SELECT 'by file name', file_id FROM code_files WHERE path LIKE '%.py'""",
        "code_files",
    ),
)
def flt_python_records(spark, sf_dir):
    files = views.code_files(spark, sf_dir)
    named = files.select(
        "file_id",
        F.when(F.col("ext") == "py", "PYTHON").otherwise(F.col("ext")).alias("programming_language"),
        F.col("code").alias("code_before"),
    )
    unnamed = files.select("file_id", F.col("path").alias("file_name"), F.col("code").alias("code_after"))
    parts = [
        sets.python_records(table).select(F.lit(rule).alias("rule"), "file_id")
        for rule, table in (("by language", named), ("by file name", unnamed))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "flt_drop_null_code",
    with_views("SELECT row_id, code, safety FROM train_raw WHERE code IS NOT NULL AND safety IS NOT NULL", "train_raw"),
)
def flt_drop_null_code(spark, sf_dir):
    return views.train_raw(spark, sf_dir).dropna(subset=["code", "safety"]).select("row_id", "code", "safety")


@query(
    "flt_drop_any_null",
    with_views(
        "SELECT * FROM fix_pairs WHERE vulnerable_code IS NOT NULL AND fixed_code IS NOT NULL", "fix_pairs"
    ),
)
def flt_drop_any_null(spark, sf_dir):
    return views.fix_pairs(spark, sf_dir).dropna("any")


@query("flt_min_length", "SELECT conv_id, turn, text FROM conversations WHERE length(text) > 10")
def flt_min_length(spark, sf_dir):
    return views.table(spark, sf_dir, "conversations").where(F.length("text") > 10).select("conv_id", "turn", "text")


@query(
    "lbl_binary",
    with_views(
        "SELECT row_id, CAST(CASE WHEN safety = 'vulnerable' THEN 1 ELSE 0 END AS INTEGER) AS target FROM train_raw",
        "train_raw",
    ),
)
def lbl_binary(spark, sf_dir):
    return views.train_raw(spark, sf_dir).select("row_id", labels.binary(F.col("safety")).alias("target"))


def _label_sql() -> str:
    word = sql.strip("lower(safety)")
    edge = text.WORD.replace("[", "[^", 1)

    def any_of(words, test):
        return " OR ".join(test(w) for w in words)

    sub = lambda w: f"contains({word}, {q(w)})"
    whole = lambda w: f"regexp_matches({word}, {q(f'(^|{edge}){w}({edge}|$)')})"
    cases = [
        f"CAST(CASE WHEN {any_of(labels.SAFE_WORDS, t)} THEN 0 WHEN {any_of(labels.UNSAFE_WORDS, t)} THEN 1 END AS INTEGER)"
        for t in (sub, whole)
    ]
    return with_views(
        f"""SELECT mode, key, label FROM (SELECT 'substring' AS mode, key, {cases[0]} AS label FROM safety_words
        UNION ALL SELECT 'exact', key, {cases[1]} FROM safety_words) WHERE label IS NOT NULL""",
        "safety_words",
    )


@query("lbl_normalise", _label_sql())
def lbl_normalise(spark, sf_dir):
    words = views.safety_words(spark, sf_dir)
    modes = F.array(
        *[
            F.struct(F.lit(mode).alias("mode"), labels.normalise(F.col("safety"), mode).alias("label"))
            for mode in ("substring", "exact")
        ]
    )
    both = words.select("key", F.inline(modes)).where("label IS NOT NULL")
    return both.select("mode", "key", "label")


@query("lbl_synthetic", "SELECT page_id, CAST(('0x' || substr(md5('42:' || page_id), 1, 1))::INTEGER % 2 AS INTEGER) AS label FROM pages")
def lbl_synthetic(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select("page_id", labels.drawn(F.col("page_id")).alias("label"))


@query(
    "lng_from_code",
    with_views(
        f"""SELECT * FROM (SELECT row_id, {sql.from_code('language')} AS language FROM train_raw) WHERE language IS NOT NULL""",
        "train_raw",
    ),
)
def lng_from_code(spark, sf_dir):
    grouped = views.train_raw(spark, sf_dir).select("row_id", languages.from_code(F.col("language")).alias("language"))
    return grouped.where("language IS NOT NULL")


def _detect_sql(expr: str) -> str:
    cases = []
    for name, signs in languages.TEXT_SIGNS:
        groups = [" OR ".join(f"contains(lower({expr}), {q(s)})" for s in group) for group in signs]
        cases.append(f"WHEN ({') AND ('.join(groups)}) THEN {q(name)}")
    return f"CASE {' '.join(cases)} ELSE 'unknown' END"


@query(
    "lng_detect",
    with_views(
        f"""SELECT row_id, {_detect_sql('code')} AS language FROM train_raw
        UNION ALL SELECT conv_id * 1000 + turn, {_detect_sql('text')} FROM conversations""",
        "train_raw",
    ),
)
def lng_detect(spark, sf_dir):
    talk = views.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), F.col("text").alias("code")
    )
    rows = views.train_raw(spark, sf_dir).select("row_id", "code").unionByName(talk)
    return rows.select("row_id", languages.from_text(F.col("code")).alias("language"))


@query(
    "lng_from_ext",
    with_views(
        """SELECT 'keep' AS policy, file_id, language FROM routed
        UNION ALL SELECT 'skip', file_id, language FROM routed WHERE language IS NOT NULL""",
        "routed",
    ),
)
def lng_from_ext(spark, sf_dir):
    files = views.code_files(spark, sf_dir).select("file_id", "path")
    parts = [
        scan.route(files, policy).select(F.lit(policy).alias("policy"), "file_id", "language")
        for policy in ("keep", "skip")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "prf_code_columns",
    """SELECT name, n FROM (SELECT count(code) AS code, count(func_code) AS func_code, count(file_name) AS file_name
    FROM (SELECT text AS code, nullif(lang, 'en') AS file_name, nullif(source, 'src1') AS func_code FROM documents))
    UNPIVOT (n FOR name IN (code, func_code, file_name))""",
)
def prf_code_columns(spark, sf_dir):
    table = views.table(spark, sf_dir, "documents").select(
        F.col("text").alias("code"),
        F.nullif("source", F.lit("src1")).alias("func_code"),
        F.nullif("lang", F.lit("en")).alias("file_name"),
        "lang",
        F.col("text").alias("Snippet"),
    )
    return aggregates.filled_code_columns(table)


@query(
    "txt_clean_py",
    with_views(f"SELECT row_id, {sql.clean('code', text.COMMENTS_HASH, text.KEEP_PYTHON)} AS clean FROM train_raw", "train_raw"),
)
def txt_clean_py(spark, sf_dir):
    return views.train_raw(spark, sf_dir).select("row_id", text.clean_python(F.col("code")).alias("clean"))


@query(
    "txt_clean_multi",
    with_views(f"SELECT row_id, {sql.clean('code', text.COMMENTS_ALL, text.KEEP_MULTI)} AS clean FROM train_raw", "train_raw"),
)
def txt_clean_multi(spark, sf_dir):
    return views.train_raw(spark, sf_dir).select("row_id", text.clean_multi(F.col("code")).alias("clean"))


@query("txt_lines", with_views("SELECT file_id, line, bare FROM code_lines", "code_lines"))
def txt_lines(spark, sf_dir):
    split = unnest(views.code_files(spark, sf_dir), ["file_id"], text.lines(F.col("code")), "text", "at")
    return split.select("file_id", (F.col("at") + 1).alias("line"), text.strip(F.col("text")).alias("bare"))


@query(
    "txt_skip_lines",
    with_views(
        """SELECT 'all marks' AS marks, file_id, line, bare FROM live
        UNION ALL SELECT 'hash', file_id, line, bare FROM code_lines WHERE bare != '' AND substr(bare, 1, 1) != '#'""",
        "live",
    ),
)
def txt_skip_lines(spark, sf_dir):
    rows = txt_lines(spark, sf_dir)
    bare = F.col("bare")
    every = rows.where(~text.is_skipped(bare)).select(F.lit("all marks").alias("marks"), "*")
    hash_only = rows.where(~text.is_skipped(bare, ("#",))).select(F.lit("hash").alias("marks"), "*")
    return every.unionByName(hash_only)


@query(
    "txt_snippet",
    with_views("SELECT file_id, line, substr(bare, 1, 80) AS short, substr(bare, 1, 100) AS long FROM code_lines", "code_lines"),
)
def txt_snippet(spark, sf_dir):
    rows = txt_lines(spark, sf_dir)
    return rows.select("file_id", "line", F.substring("bare", 1, 80).alias("short"), F.substring("bare", 1, 100).alias("long"))


def _profile_values(table, kind):
    return ", ".join(
        f"({q(lang)}, {q(kind)}, {pos}, {q(word)})" for lang, words in table.items() for pos, word in enumerate(words, 1)
    )


@query(
    "txt_keyword_counts",
    with_views(
        f"""SELECT file_id, p.language, word, {sql.occurrences('lower(code)', 'lower(word)')} AS n FROM
        (SELECT file_id, code, CASE language WHEN 'javascript' THEN 'js' ELSE language END AS language FROM routed) r
        JOIN (VALUES {_profile_values(profiles.KEYWORDS, 'keyword')}) p(language, kind, pos, word) ON r.language = p.language
        UNION ALL SELECT row_id, 'php', w, coalesce({sql.occurrences('lower(code)', 'lower(w)')}, 0) FROM train_raw,
        (SELECT unnest([{', '.join(q(w) for w in profiles.KEYWORDS['php'])}]) AS w) WHERE language = 'php'""",
        "routed",
        "train_raw",
    ),
)
def txt_keyword_counts(spark, sf_dir):
    files = scan.route(views.code_files(spark, sf_dir))
    known = files.withColumn("language", profiles.profile_of(F.col("language"))).select("file_id", "code", "language")
    php = views.train_raw(spark, sf_dir).where("language = 'php'")
    return profiles.keyword_rows(known.unionByName(php.select(F.col("row_id").alias("file_id"), "code", "language")))


@query(
    "txt_keyword_counts_cs",
    with_views(
        f"""SELECT row_id, word, coalesce({sql.occurrences('code', 'word')}, 0) AS n FROM train_raw,
        (SELECT unnest([{', '.join(q(w) for w in profiles.PYTHON_WORDS)}]) AS word)""",
        "train_raw",
    ),
)
def txt_keyword_counts_cs(spark, sf_dir):
    return profiles.python_word_rows(views.train_raw(spark, sf_dir), ("row_id",))


@query(
    "txt_risk_profiles",
    with_views(
        f"""SELECT p.*, coalesce(n_files, 0) AS n_files FROM (VALUES {_profile_values(profiles.KEYWORDS, 'keyword')},
        {_profile_values(profiles.STOP_WORDS, 'stopword')}) p(language, kind, pos, word)
        LEFT JOIN (SELECT CASE language WHEN 'javascript' THEN 'js' ELSE language END AS language, count(*) AS n_files
        FROM routed GROUP BY 1) USING (language)""",
        "routed",
    ),
)
def txt_risk_profiles(spark, sf_dir):
    files = scan.route(views.code_files(spark, sf_dir).select("path"))
    counted = files.groupBy(profiles.profile_of(F.col("language")).alias("language")).agg(F.count("*").alias("n_files"))
    table = profiles.profile_table(spark).join(counted, "language", "left")
    return table.fillna(0, ["n_files"])


LINE_METRICS = ("loc", "comments", "blank_lines", "code_lines", "size_bytes", "avg_line_length")
TOKEN_STATS = ("total_tokens", "unique_tokens", "token_diversity")
_LINES = f"string_split_regex(code, {q(text.LINE_ENDS)})"
_ROWS = f"list_transform(CASE WHEN l[-1] = '' THEN l[:-2] ELSE l END, lambda x: {sql.strip('x')})"
LINE_METRICS_SQL = f"""SELECT *, loc - comments - blank_lines AS code_lines,
    CASE WHEN loc > 0 THEN size_bytes / CAST(loc AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS avg_line_length FROM (
    SELECT file_id, CAST(len(r) AS INTEGER) AS loc, CAST(len(list_filter(r, lambda x: starts_with(x, '#'))) AS INTEGER) AS comments,
    CAST(len(list_filter(r, lambda x: x = '')) AS INTEGER) AS blank_lines, CAST(octet_length(encode(code)) AS INTEGER) AS size_bytes
    FROM (SELECT file_id, code, {_ROWS} AS r FROM (SELECT file_id, code, {_LINES} AS l FROM code_files)))"""


@query("txt_line_metrics", with_views(LINE_METRICS_SQL, "code_files"))
def txt_line_metrics(spark, sf_dir):
    return text.with_line_metrics(views.code_files(spark, sf_dir)).select("file_id", *LINE_METRICS)


TOKEN_STATS_SQL = f"""SELECT file_id, total_tokens, unique_tokens,
    CASE WHEN total_tokens > 0 THEN unique_tokens / CAST(total_tokens AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS token_diversity
    FROM (SELECT file_id, CAST(len(t) AS INTEGER) AS total_tokens, CAST(len(list_distinct(t)) AS INTEGER) AS unique_tokens
    FROM (SELECT file_id, regexp_extract_all(code, {q(text.WORD + '+')}) AS t FROM code_files))"""


@query("txt_token_stats", with_views(TOKEN_STATS_SQL, "code_files"))
def txt_token_stats(spark, sf_dir):
    return text.with_token_stats(views.code_files(spark, sf_dir)).select("file_id", *TOKEN_STATS)


@query(
    "feat_lexical",
    with_views(
        "SELECT * FROM (" + LINE_METRICS_SQL + ") JOIN (" + TOKEN_STATS_SQL + ") USING (file_id) JOIN (SELECT file_id, "
        + ", ".join(
            f"CAST({sql.hits('code', p)} AS INTEGER) AS {n}"
            for n, p in {**rules.DANGER_FLAGS, **rules.SANITISE_FLAGS}.items()
        )
        + " FROM code_files) USING (file_id)",
        "code_files",
    ),
)
def feat_lexical(spark, sf_dir):
    files = views.code_files(spark, sf_dir).select("file_id", "code")
    measured = text.with_token_stats(text.with_line_metrics(files))
    return rules.with_flags(measured, {**rules.DANGER_FLAGS, **rules.SANITISE_FLAGS}).drop("code")


@query(
    "txt_strip_comment",
    with_views(
        f"SELECT file_id, line, {sql.strip('split_part(text, ' + q('//') + ', 1)')} AS ahead FROM code_lines", "code_lines"
    ),
)
def txt_strip_comment(spark, sf_dir):
    split = unnest(views.code_files(spark, sf_dir), ["file_id"], text.lines(F.col("code")), "text", "at")
    return split.select("file_id", (F.col("at") + 1).alias("line"), text.before_slashes(F.col("text")).alias("ahead"))


@query(
    "txt_template_fill",
    f"""SELECT page_id, target, replace(replace(replace(replace(code, '{{func}}', 'page_' || page_id), '{{size}}', CAST(length(html) AS VARCHAR)),
    '{{{{', '{{'), '}}}}', '}}') AS code FROM pages, (VALUES {', '.join(f'({t}, {q(c)})' for t, c in synthesis.C_TEMPLATES)}) v(target, code)""",
)
def txt_template_fill(spark, sf_dir):
    templates = F.array(
        *[F.struct(F.lit(t).alias("target"), F.lit(c).alias("template")) for t, c in synthesis.C_TEMPLATES]
    )
    rows = views.table(spark, sf_dir, "pages").select("page_id", F.length("html").alias("size"), F.inline(templates))
    values = {
        "func": F.concat(F.lit("page_"), F.col("page_id").cast("string")),
        "size": F.col("size").cast("string"),
    }
    return rows.select("page_id", "target", text.fill_template(F.col("template"), values).alias("code"))
