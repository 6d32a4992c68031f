"""Round trips through readers, writers and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from codesieve import schemas
from codesieve.operators import aggregates, harvest, scoring, sets
from codesieve.plans import rule_queries, set_queries, sql, views
from codesieve.plans.registry import query
from codesieve.plans.sql import with_views
from codesieve.session import scratch_path
from codesieve.sources import readers, writers
from codesieve.streaming import streams


@query("src_labelled_csv", with_views("SELECT code, language, safety FROM code_files", "code_files"))
def src_labelled_csv(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    writers.csv_table(views.code_files(spark, sf_dir).select("code", "language", "safety"), path)
    return readers.labelled_csv(spark, path)


@query(
    "src_fix_pairs",
    with_views(
        """SELECT 'both' AS form, pair_id, vulnerable_code, fixed_code FROM fix_pairs
        UNION ALL SELECT 'code only', pair_id, vulnerable_code, NULL FROM fix_pairs""",
        "fix_pairs",
    ),
)
def src_fix_pairs(spark, sf_dir):
    pairs = views.fix_pairs(spark, sf_dir)
    path, lone = scratch_path(spark, "pairs"), scratch_path(spark, "lone")
    writers.csv_table(pairs, path)
    writers.csv_table(pairs.select("pair_id", F.col("vulnerable_code").alias("code")), lone)
    both = readers.fix_pairs_csv(spark, path)
    one = readers.fix_pairs_csv(spark, lone, "pair_id bigint, code string")
    return both.select(F.lit("both").alias("form"), "*").unionByName(one.select(F.lit("code only").alias("form"), "*"))


@query(
    "src_partitioned",
    set_queries.harvest_sql(
        """, """ + sql.with_views("", "train").removeprefix("WITH ").rstrip()
        + """ SELECT code, target, NULL AS source FROM train WHERE language = 'js'
        UNION ALL SELECT code, target, source FROM hi"""
    ).replace(" , code_files", ", code_files"),
)
def src_partitioned(spark, sf_dir):
    base, extra = scratch_path(spark, "base"), scratch_path(spark, "extra")
    writers.language_parquet(set_queries.train(spark, sf_dir).select("code", "target", "language"), base)
    writers.features(harvest.from_inline_marks(set_queries.marked(spark, sf_dir)).select("code", "target", "source"), extra)
    missing = scratch_path(spark, "missing")
    return readers.training_table(spark, base, "js", [extra, missing])


@query(
    "src_preview",
    with_views("SELECT file_id, path, language, code FROM code_files ORDER BY file_id LIMIT 5", "code_files"),
)
def src_preview(spark, sf_dir):
    return views.code_files(spark, sf_dir).orderBy("file_id").limit(5).select("file_id", "path", "language", "code")


def _tree(spark, sf_dir):
    root = scratch_path(spark, "tree")
    writers.source_files(views.code_files(spark, sf_dir), root)
    return root


def _below(path, root):
    return F.element_at(F.split(path, root.rsplit("/", 1)[-1] + "/"), -1)


@query(
    "src_file_manifest",
    with_views(
        """SELECT 'sample' AS repo, path AS file_path, split_part(path, '/', 3) AS file_name, octet_length(encode(code)) AS size_bytes
        FROM code_files WHERE ext = 'py'""",
        "code_files",
    ),
)
def src_file_manifest(spark, sf_dir):
    root = _tree(spark, sf_dir)
    listed = readers.file_manifest(spark, root, "sample")
    return listed.withColumn("file_path", _below(F.col("file_path"), root))


@query("src_tree_py", with_views("SELECT path, code FROM code_files WHERE ext = 'py'", "code_files"))
def src_tree_py(spark, sf_dir):
    root = _tree(spark, sf_dir)
    return readers.source_tree(spark, root).withColumn("path", _below(F.col("path"), root))


@query(
    "src_folder_scan",
    with_views(
        "SELECT split_part(path, '/', 3) AS path, language, code FROM routed WHERE language IS NOT NULL", "routed"
    ),
)
def src_folder_scan(spark, sf_dir):
    files = views.code_files(spark, sf_dir).withColumn("path", F.element_at(F.split("path", "/"), -1))
    root = scratch_path(spark, "flat")
    writers.source_files(files, root)
    return readers.source_folder(spark, root).withColumn("path", _below(F.col("path"), root))


@query(
    "src_changed_files",
    with_views(
        f"SELECT path, code FROM code_files WHERE path IN (SELECT {sql.strip('line')} FROM changed_list)", "changed_list"
    ),
)
def src_changed_files(spark, sf_dir):
    path = scratch_path(spark, "changed")
    views.changed_list(spark, sf_dir).write.text(path)
    listed = sets.listed_paths(readers.path_list(spark, path))
    return sets.only_listed(views.code_files(spark, sf_dir), listed).select("path", "code")


@query(
    "src_decode_ignore",
    with_views("SELECT file_id, code || '�' || chr(10) AS code FROM code_files", "code_files"),
)
def src_decode_ignore(spark, sf_dir):
    # Bytes with \r\n line ends, a real U+FFFD, an invalid byte, a cut sequence and a lone \r.
    windows = F.replace(F.col("code"), F.lit("\n"), F.lit("\r\n"))
    broken = F.concat(F.encode(windows, "UTF-8"), F.unhex(F.lit("FFEFBFBDC30D")))
    raw = views.code_files(spark, sf_dir).select("file_id", broken.alias("content"))
    return raw.select("file_id", readers.decode(F.col("content")).alias("code"))


@query(
    "src_commits_json",
    "SELECT role AS repo, md5(conv_id || ':' || turn) AS sha, text AS message FROM conversations",
)
def src_commits_json(spark, sf_dir):
    path = scratch_path(spark, "commits")
    sha = F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    commits = views.table(spark, sf_dir, "conversations").select(
        F.col("role").alias("repo"), sha.alias("sha"), F.col("text").alias("message")
    )
    writers.commits_json(commits, path)
    return readers.commits_json(spark, path)


@query("snk_language_csv", with_views("SELECT row_id, code, target, language FROM train", "train"))
def snk_language_csv(spark, sf_dir):
    path = scratch_path(spark, "by_language")
    writers.language_csv(set_queries.train(spark, sf_dir).select("row_id", "code", "target", "language"), path)
    return readers.labelled_csv(spark, path, "row_id bigint, code string, target int, language string")


@query(
    "snk_features",
    with_views(
        f"""SELECT file_id, target, loc, comments, blank_lines, code_lines, size_bytes, avg_line_length, total_tokens, unique_tokens, token_diversity
        FROM ({set_queries.LINE_METRICS_SQL}) JOIN ({set_queries.TOKEN_STATS_SQL}) USING (file_id) JOIN code_files USING (file_id)""",
        "code_files",
    ),
)
def snk_features(spark, sf_dir):
    path = scratch_path(spark, "features")
    table = set_queries.lexical(spark, sf_dir)
    writers.features(table, path)
    return spark.read.schema(table.schema).parquet(path)


@query(
    "snk_report_json",
    with_views("SELECT file_id, path, language, verdict, score, ml_prob, findings FROM report", "report"),
)
def snk_report_json(spark, sf_dir):
    path = scratch_path(spark, "report")
    writers.report_json(rule_queries.report(spark, sf_dir), path)
    return readers.report_json(spark, path).withColumn("findings", rule_queries.flat_findings())


@query("snk_profile_json", set_queries.PROFILE_SQL)
def snk_profile_json(spark, sf_dir):
    path = scratch_path(spark, "profile")
    writers.report_json(aggregates.profile(views.train_raw(spark, sf_dir)), path)
    return set_queries.flat_profile(spark.read.schema(schemas.PROFILE).json(path))


@query(
    "snk_gate_summary",
    with_views("SELECT path AS file, verdict, score FROM report WHERE verdict = 'CRITICAL' OR score >= 0.7", "report"),
)
def snk_gate_summary(spark, sf_dir):
    path = scratch_path(spark, "gate")
    writers.report_json(scoring.gate(rule_queries.report(spark, sf_dir)), path)
    return spark.read.schema(schemas.GATE).json(path)


# ---- streams --------------------------------------------------------------------------------


#: Rows of one arriving file, about, and the fewest files.
ARRIVING_ROWS, ARRIVING_FILES = 10_000, 4


def arriving_files(rows: int) -> int:
    return max(ARRIVING_FILES, -(-rows // ARRIVING_ROWS))


@query(
    "str_scan_new_files",
    with_views("SELECT file_id, path, language, verdict, score, ml_prob, findings FROM report", "report"),
)
def str_scan_new_files(spark, sf_dir):
    arriving, out, state = (scratch_path(spark, n) for n in ("arriving", "scanned", "state"))
    files = views.code_files(spark, sf_dir).select("file_id", "path", "code")
    # As many files as the table needs, so that no task writes or reads a share of it that grows with it.
    parts = arriving_files(files.count())
    files.repartition(parts).write.parquet(arriving)
    per_batch = max(2, min(parts // 2, spark.sparkContext.defaultParallelism))
    stream = streams.read_files(spark, arriving, files.schema, per_batch=per_batch)
    scanned = streams.scan_new_files(stream)
    streams.run_batches(scanned, out, state)
    done = streams.written_batches(spark, out, scanned.schema).drop("batch")
    return done.withColumn("findings", rule_queries.flat_findings())


def _timed(events):
    """Watermarks need a time with a zone; the driver's table has one without."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "str_dedupe",
    with_views("SELECT DISTINCT md5(code) AS code_md5 FROM events JOIN code_files ON user_id = file_id", "code_files"),
)
def str_dedupe(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    files = views.code_files(spark, sf_dir).select(F.col("file_id").alias("user_id"), "code")
    stream = streams.read_files(spark, sf_dir, events.schema, "events.parquet")
    submitted = lambda s: streams.dedupe(_timed(s).join(files, "user_id"), within="60 days").select("code_md5")
    return streams.through_stream(spark, stream, submitted, scratch_path(spark, "deduped"), scratch_path(spark, "state"))


@query(
    "str_event_windows",
    """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n,
    CASE WHEN window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)
    THEN 'closed' ELSE 'open' END AS state FROM (
    SELECT date_trunc('hour', ts) AS window_start, event_type FROM events) GROUP BY ALL
    UNION ALL SELECT NULL, NULL, NULL, 0, 'late'""",
)
def str_event_windows(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    stream = streams.read_files(spark, sf_dir, events.schema, "events.parquet")
    run = streams.run_windows(spark, _timed(stream), scratch_path(spark, "windows"), scratch_path(spark, "state"))
    return run.rows().withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
