"""Unions, duplicates, harvest, synthesis, samples, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from codesieve.functions import languages
from codesieve.functions.text import with_line_metrics, with_token_stats
from codesieve.operators import aggregates, harvest, metrics, sampling, scan, sets, synthesis
from codesieve.plans import sql, views
from codesieve.plans.registry import query
from codesieve.plans.sql import draw, q, with_views
from codesieve.plans.text_queries import LINE_METRICS_SQL, TOKEN_STATS_SQL
from codesieve.session import materialise


def train(spark, sf_dir, keep=None):
    """Distinct snippets, each with the label it had first."""
    rows = views.train_raw(spark, sf_dir).where("code IS NOT NULL")
    return sets.dedupe_first(rows, ["src_priority", "row_id"], keep=keep)


def train_keys(spark, sf_dir):
    """Keys and labels of the distinct snippets, written once: a split reads them several times."""
    return materialise(train(spark, sf_dir, keep=("row_id", "target")), "train_keys")


# ---- set operations -------------------------------------------------------------------------


@query(
    "set_union_all",
    """SELECT doc_id, text, CAST(NULL AS BIGINT) AS item_id, lang FROM documents
    UNION ALL SELECT NULL, text, item_id, NULL FROM benchmark""",
)
def set_union_all(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return sets.union_all(docs, views.table(spark, sf_dir, "benchmark"))


@query("set_dedupe_first", with_views("SELECT row_id, src_priority, target, language, md5(code) AS code_md5 FROM train", "train"))
def set_dedupe_first(spark, sf_dir):
    return train(spark, sf_dir).select("row_id", "src_priority", "target", "language", F.md5("code").alias("code_md5"))


@query(
    "set_label_conflicts",
    with_views(
        """SELECT md5(code) AS text_md5, count(*) AS n_rows, count(*) FILTER (target = 1) AS n_vulnerable,
        count(*) FILTER (target = 0) AS n_safe FROM train_raw WHERE code IS NOT NULL
        GROUP BY code HAVING count(DISTINCT target) > 1""",
        "train_raw",
    ),
)
def set_label_conflicts(spark, sf_dir):
    return sets.label_conflicts(views.train_raw(spark, sf_dir))


def _pairs_sql() -> str:
    from codesieve.plans.text_queries import _detect_sql

    return with_views(
        f"""SELECT 'plain' AS form, pair_id, NULL AS language, code, target FROM (
        SELECT pair_id, vulnerable_code AS code, 1 AS target FROM fix_pairs UNION ALL SELECT pair_id, fixed_code, 0 FROM fix_pairs) WHERE code IS NOT NULL
        UNION ALL SELECT 'by language', pair_id, language, code, target FROM (
        SELECT pair_id, {_detect_sql('vulnerable_code')} AS language, vulnerable_code AS code, 1 AS target FROM fix_pairs
        UNION ALL SELECT pair_id, {_detect_sql('vulnerable_code')}, fixed_code, 0 FROM fix_pairs) WHERE code IS NOT NULL AND language != 'unknown'""",
        "fix_pairs",
    )


@query("rel_unpivot_pairs", _pairs_sql())
def rel_unpivot_pairs(spark, sf_dir):
    pairs = views.fix_pairs(spark, sf_dir)
    plain = sets.pairs_to_rows(pairs).withColumn("language", F.lit(None).cast("string"))
    routed = sets.pairs_by_language(pairs)
    order = ["form", "pair_id", "language", "code", "target"]
    return (
        plain.withColumn("form", F.lit("plain")).select(order).unionByName(routed.withColumn("form", F.lit("by language")).select(order))
    )


@query(
    "rel_changed_semi",
    with_views(
        f"""SELECT path, 'present' AS status FROM code_files WHERE path IN (SELECT {sql.strip('line')} FROM changed_list)
        UNION ALL SELECT DISTINCT {sql.strip('line')}, 'absent' FROM changed_list
        WHERE {sql.strip('line')} != '' AND {sql.strip('line')} NOT IN (SELECT path FROM code_files)""",
        "changed_list",
    ),
)
def rel_changed_semi(spark, sf_dir):
    files = views.code_files(spark, sf_dir).select("path")
    paths = sets.listed_paths(views.changed_list(spark, sf_dir), "line")
    present = sets.only_listed(files, paths).withColumn("status", F.lit("present"))
    return present.unionByName(sets.absent_paths(paths, files).withColumn("status", F.lit("absent")))


# ---- harvest and synthesis ------------------------------------------------------------------

_HARVEST_LINES = """hl AS (SELECT file_id, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS line_no, unnest(l) AS text, unnest(list_append(l[2:], NULL)) AS after
    FROM (SELECT file_id, string_split(code, chr(10)) AS l FROM marked_files))"""
_AHEAD = sql.strip("split_part(text, '//', 1)")
_NEXT_SQL = f"""hn AS (SELECT file_id, line_no, code, target, 'semgrep_real' AS source FROM (
    SELECT file_id, line_no, CASE WHEN length(ahead) > 5 THEN ahead WHEN next != '' AND NOT starts_with(next, '//') THEN next END AS code,
    contains(text, 'ruleid:') AS bad, contains(text, 'ok:') AS good
    FROM (SELECT *, {_AHEAD} AS ahead, {sql.strip('after')} AS next FROM hl)),
    (VALUES (1), (0)) v(target) WHERE code IS NOT NULL AND ((target = 1 AND bad) OR (target = 0 AND good)))"""


def _any_mark(marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(text), {q(m)})" for m in marks) + ")"


_INLINE_SQL = f"""hi AS (SELECT file_id, line_no, code, target, 'codeql' AS source FROM (
    SELECT file_id, line_no, {_AHEAD} AS code, {sql.strip('text')} AS bare,
    CASE WHEN {_any_mark(harvest.INLINE_VULNERABLE)} THEN 1 WHEN {_any_mark(harvest.INLINE_SAFE)} THEN 0 END AS target FROM hl)
    WHERE length(bare) >= 5 AND NOT starts_with(bare, '*') AND NOT starts_with(bare, '//') AND NOT starts_with(bare, '/*')
    AND target IS NOT NULL AND code != '')"""


def harvest_sql(body: str) -> str:
    base = with_views("", "marked_files")
    return f"{base.rstrip()}, {_HARVEST_LINES}, {_NEXT_SQL}, {_INLINE_SQL} {body}"


def marked(spark, sf_dir):
    return harvest.script_files(views.marked_files(spark, sf_dir), ("rules/javascript/", "rules/typescript/"))


@query("hrv_next_line", harvest_sql("SELECT * FROM hn"))
def hrv_next_line(spark, sf_dir):
    return harvest.from_next_line(marked(spark, sf_dir))


@query("hrv_inline_mark", harvest_sql("SELECT * FROM hi"))
def hrv_inline_mark(spark, sf_dir):
    return harvest.from_inline_marks(marked(spark, sf_dir))


@query(
    "hrv_files",
    with_views(
        """SELECT path FROM code_files WHERE (starts_with(path, 'src/src1') OR starts_with(path, 'src/src2'))
        AND (path LIKE '%.js' OR path LIKE '%.ts' OR path LIKE '%.jsx' OR path LIKE '%.tsx')""",
        "code_files",
    ),
)
def hrv_files(spark, sf_dir):
    return harvest.script_files(views.code_files(spark, sf_dir), ("src/src1", "src/src2")).select("path")


@query(
    "hrv_finish",
    harvest_sql(
        """SELECT code, target, source, file_id, line_no FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY file_id, line_no, -target) AS rn
        FROM hn) WHERE rn = 1 AND length(code) > 10
        UNION ALL SELECT code, target, source, file_id, line_no FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY file_id, line_no, -target) AS rn
        FROM hi) WHERE rn = 1 AND length(code) > 10"""
    ),
)
def hrv_finish(spark, sf_dir):
    files = marked(spark, sf_dir)
    return harvest.finish(harvest.from_next_line(files)).unionByName(harvest.finish(harvest.from_inline_marks(files)))


def _pick_sql(values, number: str) -> str:
    return f"([{', '.join(q(v) for v in values)}])[CAST({number} % {len(values)} AS INTEGER) + 1]"


def _target_sql(templates, number: str) -> str:
    return f"([{', '.join(str(t) for t, _ in templates)}])[CAST({number} % {len(templates)} AS INTEGER) + 1]"


def _c_sql(key: str, table: str) -> str:
    number = draw(key, "c", 0)
    name = f"{_pick_sql(synthesis.C_WORDS, draw(key, 'c', 1))} || '_' || (1000 + {draw(key, 'c', 2)} % 9000)"
    filled = (
        f"replace(replace({_pick_sql([t for _, t in synthesis.C_TEMPLATES], number)}, '{{func}}', {name}), "
        f"'{{size}}', {_pick_sql(synthesis.C_SIZES, draw(key, 'c', 3))})"
    )
    return (
        f"SELECT {key} AS key, replace(replace({filled}, '{{{{', '{{'), '}}}}', '}}') AS code, "
        f"CAST({_target_sql(synthesis.C_TEMPLATES, number)} AS INTEGER) AS target FROM {table}"
    )


@query("syn_c", _c_sql("o_orderkey", "orders"))
def syn_c(spark, sf_dir):
    return synthesis.c_rows(views.table(spark, sf_dir, "orders"), "o_orderkey")


def _js_sql(key: str, table: str) -> str:
    number = draw(key, "js", 0)
    text = _pick_sql([t for _, t in synthesis.JS_TEMPLATES], number)
    name = f"{_pick_sql(synthesis.JS_WORDS, draw(key, 'js', 1))} || '_' || (100 + {draw(key, 'js', 2)} % 900)"
    constant = f"'const v' || (1 + {draw(key, 'js', 3)} % 99) || ' = '"
    return (
        f"SELECT {key} AS key, replace(replace({text}, 'function ', 'function ' || {name}), 'const ', {constant}) AS code, "
        f"CAST({_target_sql(synthesis.JS_TEMPLATES, number)} AS INTEGER) AS target FROM {table}"
    )


@query("syn_js", _js_sql("event_id", "events"))
def syn_js(spark, sf_dir):
    return synthesis.js_rows(views.table(spark, sf_dir, "events"), "event_id")


@query(
    "syn_append",
    with_views("", "train").rstrip()
    + f""", new AS ({_c_sql('o_orderkey', 'orders')}), both_rows AS (
    SELECT src_priority, row_id, code, target FROM train WHERE {sql.from_code('language')} = 'c_cpp'
    UNION ALL SELECT 2147483647, key, code, target FROM new)
    SELECT src_priority, row_id, code, target FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY src_priority, row_id) AS rn FROM both_rows) WHERE rn = 1""",
)
def syn_append(spark, sf_dir):
    old = train(spark, sf_dir).where(languages.from_code(F.col("language")) == "c_cpp")
    return synthesis.append(old, syn_c(spark, sf_dir))


# ---- blocks, samples, splits ----------------------------------------------------------------


@query(
    "src_chunked",
    with_views("SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 10000 AS block FROM train_raw", "train_raw"),
)
def src_chunked(spark, sf_dir):
    return sampling.with_block(views.train_raw(spark, sf_dir).select("row_id"), "row_id")


@query(
    "smp_blocks",
    with_views(
        """SELECT row_id, code, target FROM train_raw WHERE row_id IN (SELECT row_id FROM (
        SELECT row_id, row_number() OVER (PARTITION BY block ORDER BY md5('42:' || row_id)) AS rn FROM (
        SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 10000 AS block FROM train_raw))
        WHERE rn <= 100 ORDER BY md5('42b:' || row_id) LIMIT 100)""",
        "train_raw",
    ),
)
def smp_blocks(spark, sf_dir):
    return sampling.block_sample(views.train_raw(spark, sf_dir), "row_id").select("row_id", "code", "target")


@query(
    "smp_oversample",
    with_views(
        "SELECT row_id, target, copy FROM (SELECT row_id, target, CAST(unnest(range(1, 21)) AS INTEGER) AS copy FROM train_raw WHERE target = 1)",
        "train_raw",
    ),
)
def smp_oversample(spark, sf_dir):
    return sampling.oversample(views.train_raw(spark, sf_dir).where("target = 1").select("row_id", "target"))


def _split_sql(share: float, by: str) -> str:
    over = f"PARTITION BY {by} " if by else ""
    return with_views(
        f"""SELECT row_id, target, row_number() OVER ({over}ORDER BY md5('42:' || row_id)) <=
        ceil(CAST({share} AS DOUBLE) * count(*) OVER ({over})) AS is_test FROM train""",
        "train",
    )


@query("spl_stratified", _split_sql(0.2, "target"))
def spl_stratified(spark, sf_dir):
    return sampling.split(train_keys(spark, sf_dir), "row_id", 0.2, ["target"])


@query("spl_plain", _split_sql(0.25, ""))
def spl_plain(spark, sf_dir):
    return sampling.split(train_keys(spark, sf_dir), "row_id", 0.25)


_SCALED = ("loc", "comments", "size_bytes", "avg_line_length", "total_tokens")


def lexical(spark, sf_dir):
    files = views.code_files(spark, sf_dir).select("file_id", "target", "code")
    return with_token_stats(with_line_metrics(files)).drop("code")


@query(
    "prp_scale",
    with_views("", "code_files").rstrip()
    + f""", f AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || file_id)) <= ceil(CAST(0.3 AS DOUBLE) * count(*) OVER ()) AS is_test
    FROM ({LINE_METRICS_SQL}) JOIN ({TOKEN_STATS_SQL}) USING (file_id)),
    s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}' for c in _SCALED)} FROM f WHERE NOT is_test)
    SELECT file_id, is_test, {', '.join(f'round(({c} - m_{c}) / d_{c}, 7) AS {c}' for c in _SCALED)} FROM f, s""",
)
def prp_scale(spark, sf_dir):
    rows = sampling.split(lexical(spark, sf_dir), "file_id", 0.3)
    scaler = sampling.fit_scaler(rows.where("NOT is_test"), _SCALED)
    return scaler.transform(rows).select("file_id", "is_test", *[F.round(c, 7).alias(c) for c in _SCALED])


@query(
    "prp_class_weight",
    with_views(
        """SELECT row_id, target, (SELECT count(*) FROM train) / CAST((SELECT count(DISTINCT target) FROM train) * count(*) OVER (PARTITION BY target) AS DOUBLE) AS weight
        FROM train""",
        "train",
    ),
)
def prp_class_weight(spark, sf_dir):
    rows = train_keys(spark, sf_dir)
    return sampling.with_class_weight(rows, "target").select("row_id", "target", "weight")


# ---- dataset aggregates ---------------------------------------------------------------------


@query("agg_label_counts", with_views("SELECT target, count(*) AS n FROM train_raw GROUP BY target", "train_raw"))
def agg_label_counts(spark, sf_dir):
    return aggregates.label_counts(views.train_raw(spark, sf_dir))


@query(
    "agg_language_topk",
    with_views("SELECT language, count(*) AS n FROM train_raw GROUP BY language ORDER BY n DESC, language LIMIT 10", "train_raw"),
)
def agg_language_topk(spark, sf_dir):
    return aggregates.top_languages(views.train_raw(spark, sf_dir))


@query(
    "agg_python_total",
    with_views("SELECT count(*) FILTER (language = 'py') AS python_total FROM train_raw", "train_raw"),
)
def agg_python_total(spark, sf_dir):
    named = views.train_raw(spark, sf_dir).select(
        F.when(F.col("language") != "py", F.col("language"))
        .when(F.col("target") == 1, "Python")
        .otherwise("python")
        .alias("programming_language")
    )
    return aggregates.python_total(named)


@query(
    "agg_vuln_safe",
    with_views(
        """SELECT language, count(*) AS n, CAST(sum(target) AS BIGINT) AS vulnerable, CAST(count(*) - sum(target) AS BIGINT) AS safe
        FROM train GROUP BY language""",
        "train",
    ),
)
def agg_vuln_safe(spark, sf_dir):
    return aggregates.vulnerable_and_safe(train(spark, sf_dir, keep=("language", "target")))


@query("agg_distinct_labels", with_views("SELECT DISTINCT safety FROM safety_words", "safety_words"))
def agg_distinct_labels(spark, sf_dir):
    return aggregates.distinct_labels(views.safety_words(spark, sf_dir))


PROFILE_SQL = with_views(
    """SELECT part, language, n, 'row_id,src_priority,code,language,safety,target' AS columns, 'code' AS code_columns FROM (
    SELECT 'all' AS part, NULL AS language, count(*) AS n FROM train_raw UNION ALL
    SELECT 'language', language, count(*) FROM train_raw WHERE language IS NOT NULL GROUP BY language)""",
    "train_raw",
)


def flat_profile(profile):
    return profile.select(
        "part",
        "language",
        "n",
        F.array_join("columns", ",").alias("columns"),
        F.array_join("code_columns", ",").alias("code_columns"),
    )


@query("agg_profile", PROFILE_SQL)
def agg_profile(spark, sf_dir):
    return flat_profile(aggregates.profile(views.train_raw(spark, sf_dir)))


# ---- metrics --------------------------------------------------------------------------------

_COUNTS = """c AS (SELECT count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
    count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 0 AND pred = 0) AS tn FROM predictions)"""


def _metric_sql(body: str) -> str:
    return with_views("", "predictions").rstrip() + f", {_COUNTS} {body}"


def _share(over: str, under: str) -> str:
    return f"CASE WHEN {under} > 0 THEN ({over}) / CAST({under} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _f1_sql(p: str, r: str) -> str:
    return _share(f"2 * {p} * {r}", f"({p} + {r})")


def _rounded(df, *names, places=9):
    return df.withColumns({n: F.round(n, places) for n in names})


@query(
    "met_binary",
    _metric_sql(
        f"""SELECT round(a, 9) AS accuracy, round(p, 9) AS precision, round(r, 9) AS recall, round({_f1_sql('p', 'r')}, 9) AS f1
        FROM (SELECT {_share('tp + tn', '(tp + tn + fp + fn)')} AS a, {_share('tp', '(tp + fp)')} AS p, {_share('tp', '(tp + fn)')} AS r FROM c)"""
    ),
)
def met_binary(spark, sf_dir):
    return _rounded(metrics.binary(views.predictions(spark, sf_dir)), "accuracy", "precision", "recall", "f1")


@query(
    "met_class_report",
    _metric_sql(
        f"""SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, n AS support FROM (
        WITH b AS (SELECT *, {_f1_sql('p0', 'r0')} AS f0, {_f1_sql('p1', 'r1')} AS f1 FROM (SELECT {_share('tn', '(tn + fn)')} AS p0, {_share('tn', '(tn + fp)')} AS r0,
        {_share('tp', '(tp + fp)')} AS p1, {_share('tp', '(tp + fn)')} AS r1, tn + fp AS n0, tp + fn AS n1 FROM c))
        SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, n0 AS n FROM b UNION ALL SELECT '1', p1, r1, f1, n1 FROM b
        UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM b
        UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM b)"""
    ),
)
def met_class_report(spark, sf_dir):
    return _rounded(metrics.class_report(views.predictions(spark, sf_dir)), "precision", "recall", "f1")


@query(
    "met_confusion",
    with_views(
        """SELECT CAST(g.label AS INTEGER) AS label, CAST(g.pred AS INTEGER) AS pred, count(p.key) AS n FROM
        (SELECT * FROM (VALUES (0), (1)) a(label), (VALUES (0), (1)) b(pred)) g LEFT JOIN predictions p USING (label, pred) GROUP BY ALL""",
        "predictions",
    ),
)
def met_confusion(spark, sf_dir):
    return metrics.confusion(views.predictions(spark, sf_dir))


@query(
    "met_auc",
    with_views(
        """SELECT round((sum(r) FILTER (label = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 9) AS auc FROM (
        SELECT label, avg(rn) OVER (PARTITION BY prob) AS r, CAST(count(*) FILTER (label = 1) OVER () AS DOUBLE) AS n1,
        CAST(count(*) FILTER (label = 0) OVER () AS DOUBLE) AS n0 FROM (SELECT *, row_number() OVER (ORDER BY prob) AS rn FROM predictions))
        GROUP BY n1, n0""",
        "predictions",
    ),
)
def met_auc(spark, sf_dir):
    return _rounded(metrics.auc(views.predictions(spark, sf_dir)), "auc")


@query(
    "met_roc_points",
    with_views(
        """SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / CAST(sum(pos) OVER () AS DOUBLE), 9) AS tpr, round(fp / CAST(sum(neg) OVER () AS DOUBLE), 9) AS fpr FROM (
        SELECT prob AS threshold, pos, neg, sum(pos) OVER (ORDER BY prob DESC) AS tp, sum(neg) OVER (ORDER BY prob DESC) AS fp FROM (
        SELECT prob, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM predictions GROUP BY prob))""",
        "predictions",
    ),
)
def met_roc_points(spark, sf_dir):
    return _rounded(metrics.roc_points(views.predictions(spark, sf_dir)), "tpr", "fpr")


@query(
    "mdl_select",
    with_views("", "predictions").rstrip()
    + f""", m AS (SELECT name, rank, {_share('2 * tp', '(2 * tp + fp + fn)')} AS f1 FROM (SELECT name, rank,
    count(*) FILTER (label = 1 AND prob >= cut) AS tp, count(*) FILTER (label = 0 AND prob >= cut) AS fp, count(*) FILTER (label = 1 AND prob < cut) AS fn
    FROM predictions, (VALUES ('Decision Tree', 1, 0.5), ('Random Forest', 2, 0.3), ('SVM', 3, 0.3)) v(name, rank, cut) GROUP BY name, rank))
    SELECT name, round(f1, 9) AS score FROM m WHERE f1 > 0 ORDER BY f1 DESC, rank LIMIT 1""",
)
def mdl_select(spark, sf_dir):
    rows = views.predictions(spark, sf_dir)
    table = None
    for rank, (name, cut) in enumerate((("Decision Tree", 0.5), ("Random Forest", 0.3), ("SVM", 0.3)), 1):
        scored = metrics.binary(rows.withColumn("pred", (F.col("prob") >= cut).cast("int")))
        one = scored.select(F.lit(name).alias("name"), F.lit(rank).alias("rank"), F.round("f1", 9).alias("score"))
        table = one if table is None else table.unionByName(one)
    return metrics.select_best(table)


@query(
    "rel_model_route",
    with_views(
        """SELECT file_id, language, CASE WHEN language = 'java' THEN 'java' WHEN language = 'python' THEN 'hybrid' END AS model,
        CASE WHEN language = 'java' THEN (length(code) % 100) / CAST(100 AS DOUBLE) WHEN language = 'python' THEN (length(code) % 50) / CAST(50 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ml_prob
        FROM routed""",
        "routed",
    ),
)
def rel_model_route(spark, sf_dir):
    files = scan.route(views.code_files(spark, sf_dir))
    length = F.length("code")
    stand_ins = {
        "java": (length % 100) / F.lit(100.0),
        "hybrid": (length % 50) / F.lit(50.0),
    }
    return scan.route_models(files, stand_ins).select("file_id", "language", "model", "ml_prob")
