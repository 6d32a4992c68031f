"""Synthetic training rows from templates, one per key, repeatable from the key alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.functions.text import fill_template, md5_int
from codesieve.operators.sets import dedupe_first, union_all

# Number of rows made by default.

# C templates (target, text), words, sizes.
C_TEMPLATES = (
    (1, "void {func}(char *in) {{ char buf[{size}]; strcpy(buf, in); }}"),
    (0, "void {func}(char *in) {{ char buf[{size}]; strncpy(buf, in, {size}-1); }}"),
    (1, 'void {func}(char *arg) {{ char cmd[256]; sprintf(cmd, "cat %s", arg); system(cmd); }}'),
    (0, 'void {func}(char *arg) {{ char *args[] = {{"cat", arg, NULL}}; execvp(args[0], args); }}'),
    (1, "void {func}(char *user_data) {{ printf(user_data); }}"),
    (0, 'void {func}(char *user_data) {{ printf("%s", user_data); }}'),
    (1, "void {func}(int n) {{ char *p = malloc(n * sizeof(char)); }}"),
    (0, "void {func}(int n) {{ if(n > 0 && n < MAX) {{ char *p = malloc(n * sizeof(char)); }} }}"),
    (1, "void {func}() {{ char buf[100]; gets(buf); }}"),
    (0, "void {func}() {{ char buf[100]; fgets(buf, 100, stdin); }}"),
)
C_WORDS = ("handle_req", "parse_input", "log_error", "copy_mem", "run_cmd", "init_service")
C_SIZES = ("64", "128", "256", "512", "1024")

# JavaScript templates (target, text) and words. Braces stay doubled in the result.
JS_TEMPLATES = (
    (1, "function updateUI(userInput) {{ const el = document.getElementById('msg'); el.innerHTML = userInput; }}"),
    (0, "function updateUI(userInput) {{ const el = document.getElementById('msg'); el.textContent = userInput; }}"),
    (1, "function calc(expr) {{ const result = eval(expr); return result; }}"),
    (0, "function calc(expr) {{ const result = parseInt(expr); return result; }}"),
    (1, "const { exec } = require('child_process'); function run(cmd) {{ exec('ls ' + cmd, (err)=>{{}}); }}"),
    (0, "const { execFile } = require('child_process'); function run(arg) {{ execFile('ls', [arg], (err)=>{{}}); }}"),
    (1, "function merge(target, input) {{ for (let key in input) {{ target[key] = input[key]; }} }}"),
    (0, "function merge(target, input) {{ for (let key in input) {{ if (key !== '__proto__') target[key] = input[key]; }} }}"),
    (1, "app.get('/search', (req, res) => {{ res.send('Results for: ' + req.query.q); }});"),
    (0, "app.get('/search', (req, res) => {{ res.send('Results for: ' + escapeHTML(req.query.q)); }});"),
)
JS_WORDS = ("render", "init", "handleRequest", "processData", "loadConfig")


def _draw(key: str, seed: str, field: int) -> Column:
    """A whole number from the MD5 of seed and key; each field uses other digits of it."""
    return md5_int(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 8, 1 + 8 * field)


def _pick(values: tuple, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int") + 1)


def c_rows(keys: DataFrame, key: str = "key", seed: str = "c") -> DataFrame:
    """(key, code, target): a C function with a drawn name and buffer size."""
    template = _draw(key, seed, 0)
    name = F.concat(_pick(C_WORDS, _draw(key, seed, 1)), F.lit("_"), (1000 + _draw(key, seed, 2) % 9000).cast("string"))
    size = _pick(C_SIZES, _draw(key, seed, 3))
    code = fill_template(_pick(tuple(t for _, t in C_TEMPLATES), template), {"func": name, "size": size})
    target = _pick(tuple(t for t, _ in C_TEMPLATES), template)
    return keys.select(F.col(key).alias("key"), code.alias("code"), target.alias("target"))


def js_rows(keys: DataFrame, key: str = "key", seed: str = "js") -> DataFrame:
    """(key, code, target): a JavaScript text; the drawn name is glued onto the function's own name
    and each ``const`` gets a drawn variable in front."""
    template = _draw(key, seed, 0)
    name = F.concat(_pick(JS_WORDS, _draw(key, seed, 1)), F.lit("_"), (100 + _draw(key, seed, 2) % 900).cast("string"))
    constant = F.concat(F.lit("const v"), (1 + _draw(key, seed, 3) % 99).cast("string"), F.lit(" = "))
    text = _pick(tuple(t for _, t in JS_TEMPLATES), template)
    named = F.replace(text, F.lit("function "), F.concat(F.lit("function "), name))
    code = F.replace(named, F.lit("const "), constant)
    target = _pick(tuple(t for t, _ in JS_TEMPLATES), template)
    return keys.select(F.col(key).alias("key"), code.alias("code"), target.alias("target"))


def append(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old rows, then new ones whose text is not among them; the old table must exist.

    ``old`` has (src_priority, row_id, code, target); new rows come after all of them.
    """
    if old is None:
        raise FileNotFoundError("the table to extend does not exist")
    late = new.select(
        F.lit(2**31 - 1).alias("src_priority"), F.col("key").cast("bigint").alias("row_id"), "code", "target"
    )
    both = union_all(old.select("src_priority", "row_id", "code", "target"), late)
    return dedupe_first(both, ["src_priority", "row_id"])
