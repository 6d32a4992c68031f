"""Source files and tables derived from the driver's prose tables.

The texts of the driver hold no code, so each document becomes a small source file: a fixed body by
its number, followed by the whole document as comments. Every row and the whole text is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.functions import labels

# Extension, target, comment prefix and body by slot (doc_id modulo their number).
# ¶ stands for a line feed, {id} for the document number.
TEMPLATES = (
    ("py", 1, "# ", 'import os¶def run_{id}(path):¶    # list it¶    os.system("ls " + path)'),
    ("py", 0, "# ", 'import math¶¶def area_{id}(r):¶    if r < 0:¶        raise ValueError("r")¶    return math.pi * r ** 2'),
    ("py", 1, "# ", 'import pickle¶def load_{id}(request, cur):¶    name = request.args.get("n")¶    alias = name¶    cur.execute(alias)¶    password = "Sup3rSecret{id}"¶    with open(name) as f:¶        return pickle.load(f)'),
    ("java", 1, "// ", 'import java.io.*;¶public class A{id} {¶  void go(String c) throws Exception {¶    Runtime.getRuntime().exec("sh -c " + c);¶  }¶}'),
    ("java", 0, "// ", "public class B{id} {¶  int twice(int x) { return 2 * x; }¶}"),
    ("c", 1, "// ", "#include <string.h>¶void copy_{id}(char *in) {¶  char b[64];¶  strcpy(b, in);¶  printf(in);¶}"),
    ("h", 0, "// ", "/* header {id} */¶int add_{id}(int a, int b);"),
    ("js", 1, "// ", "var a = 1;¶var b = 2;¶var c = 3;¶var d = 4;¶function show_{id}(t) {¶  document.body.innerHTML = t;¶}"),
    ("ts", 0, "// ", "export const id{id}: number = {id};¶// ok: plain-constant¶const twice = id{id} * 2; // GOOD"),
    ("php", 1, "// ", '<?php¶$q = $_GET["q"];¶eval($q);'),
    ("md", 0, "", "Notes {id}"),
    ("py", 0, "", "def broken_{id}(:"),
    ("py", 1, "# ", 'import hashlib, marshal, random, subprocess, yaml¶class Job_{id}:¶    """Runs jobs."""¶    def run(self, cmd):¶        subprocess.call("x " + cmd, shell=True)¶        return hashlib.md5(cmd).hexdigest()¶    async def load(self, data):¶        yaml.load(data)¶        marshal.loads(data)¶        pick = random.choice(data)¶        eval(pick)¶        exec(pick)¶        return compile(pick, "f", "eval")'),
    ("py", 1, "# ", 'from flask import request¶token = "abcdef123456"¶secret_key = \'k\'¶def page_{id}(cur):¶    user = request.form.get("u")¶    cur.execute("SELECT \'" + user + "\'")¶    cur.execute(f"SELECT {user}")¶    cur.executemany(user, [])¶    os.system(user)¶    open(user)¶    return f\'<p>{user}</p>\'¶app.run(debug=True)'),
    ("py", 0, "# ", 'import html¶def show_{id}(value, cur):¶    assert value¶    if not isinstance(value, str):¶        raise TypeError("x")¶    try:¶        safe = html.escape(value)¶        cur.execute("SELECT ?", (safe,))¶    except ValueError as problem:¶        safe = ""¶    for part in safe.split():¶        while part and value:¶            part = part[1:]¶    def inner(x):¶        return [y for y in x if y or not x]¶    return inner(safe)'),
    ("py", 1, "# ", 'from Crypto.Cipher import DES¶from xml.etree import ElementTree as etree¶def read_{id}(text, key):¶    cipher = DES.new(key, DES.MODE_ECB)¶    etree.fromstring(text)¶    name = input("n")¶    other = name¶    subprocess.run(other)¶    with open(key) as f:¶        os.remove(other)¶    return cipher if name else lambda x: x + 1'),
    ("py", 0, "# ", 'pickled_{id} = 1¶executed = "no"¶print("os_system " + executed)¶debugging = True¶names = [n.upper() for n in ("a", "b")]¶match = {1: 2}¶open("fixed.txt")¶cursor.execute("SELECT 1")'),
    ("java", 1, "// ", 'public class C{id} {¶  String password = "hunter";¶  void q(String x) throws Exception {¶    stmt.executeQuery("SELECT " + x);¶    Object o = in.readObject();¶  }¶}'),
    ("java", 0, "// ", 'public class D{id} {¶  void q(String passwords) throws Exception {¶    con.prepareStatement("SELECT ?");¶    Runtime.getRuntime().exec("ls");¶  }¶}'),
    ("c", 1, "// ", 'void list_{id}(char *d) {¶  system("ls " + d);¶  sprintf(b, "%s", d);¶}'),
    ("c", 0, "// ", 'void show_{id}(char *d) {¶  printf("%s", d);¶  strncpy(b, d, 4);¶  ecosystem_of(d);¶}'),
    ("js", 1, "// ", 'const run{id} = (x) => eval(x);¶child_process.exec("ls " + run{id});¶o.__proto__.y = 1;¶const d = <p dangerouslySetInnerHTML={x} />;'),
    ("js", 1, "// ", 'var v0 = 0;¶var v1 = 1;¶var v2 = 2;¶var v3 = 3;¶var v4 = 4;¶var v5 = 5;¶var v6 = 6;¶var v7 = 7;¶var v8 = 8;¶var v9 = 9;¶var v10 = 10;¶var v11 = 11;'),
    ("js", 0, "// ", 'var w0 = 0;¶var w1 = 1;¶var w2 = 2;¶var w3 = 3;¶var w4 = 4;'),
    ("js", 0, "// ", 'let a{id} = 1;¶const variable = "evaluate";¶respawned(a{id});'),
    ("php", 0, "// ", '<?php¶$q = "fixed {id}";¶echo htmlspecialchars($q);'),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_id, path, ext, language (the snippet table's code), target, safety, code."""
    slot = (F.col("doc_id") % len(TEMPLATES)).cast("int") + 1
    pick = lambda at: F.element_at(F.array(*[F.lit(row[at]) for row in TEMPLATES]), slot)
    number = F.col("doc_id").cast("string")
    body = F.replace(F.translate(pick(3), "¶", "\n"), F.lit("{id}"), number)
    prefix = pick(2)
    tail = F.concat(prefix, F.replace(F.col("text"), F.lit("\n"), F.concat(F.lit("\n"), prefix)))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("src/"), "source", F.lit("/f"), number, F.lit("."), pick(0)).alias("path"),
        pick(0).alias("ext"),
        pick(0).alias("language"),
        pick(1).alias("target"),
        F.when(pick(1) == 1, "vulnerable").otherwise("safe").alias("safety"),
        F.concat(body, F.lit("\n"), tail).alias("code"),
    )


def train_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled snippets of three sources with repeated texts, conflicting labels and null texts.

    Source 0 is every file (notes without code have a null text), source 1 the files named in
    ``labels`` under the label given there, source 2 the pages as scripts without a label.
    """
    files = code_files(spark, sf_dir)
    own = files.select(
        F.col("file_id").alias("row_id"),
        F.lit(0).alias("src_priority"),
        F.when(F.col("ext") != "md", F.col("code")).alias("code"),
        "language",
        "safety",
    )
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id"), "quality")
    reviewed = files.join(marks, "file_id").select(
        (F.col("file_id") + 1_000_000_000).alias("row_id"),
        F.lit(1).alias("src_priority"),
        "code",
        "language",
        F.when(F.col("quality") == 0, "vulnerable").otherwise("safe").alias("safety"),
    )
    pages = table(spark, sf_dir, "pages").select(
        (F.col("page_id") + 2_000_000_000).alias("row_id"),
        F.lit(2).alias("src_priority"),
        F.col("html").alias("code"),
        F.lit("js").alias("language"),
        F.lit(None).cast("string").alias("safety"),
    )
    return own.unionByName(reviewed).unionByName(pages).withColumn("target", labels.binary(F.col("safety")))


def safety_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A free-form label word per document, from its label, language and source."""
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    word = (
        F.when(F.col("quality") == 1, "safe")
        .when(F.col("quality") == 0, " Vulnerable ")
        .when(F.col("source") == "src0", "high")
        .when(F.col("source") == "src1", F.lit(None).cast("string"))
        .when(F.col("lang") == "en", "unsafe")
        .when(F.col("lang") == "de", "not vulnerable")
        .when(F.col("lang") == "fr", "yes")
        .otherwise("unknown")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return docs.join(marks, "doc_id", "left").select(F.col("doc_id").alias("key"), word.alias("safety"))


def fix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vulnerable file beside the next file where that one is safe, else beside null."""
    files = code_files(spark, sf_dir)
    bad = files.where("target = 1").select(F.col("file_id").alias("pair_id"), F.col("code").alias("vulnerable_code"))
    good = files.where("target = 0").select((F.col("file_id") - 1).alias("pair_id"), F.col("code").alias("fixed_code"))
    return bad.join(good, "pair_id", "left")


def changed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a changed-file list: the files named in ``labels`` with blanks around them, one blank
    line per benchmark item, and one path that does not exist per conversation turn."""
    paths = code_files(spark, sf_dir).select("file_id", "path")
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id"))
    real = paths.join(marks, "file_id").select(F.concat(F.lit("  "), "path", F.lit("\t")).alias("line"))
    blank = table(spark, sf_dir, "benchmark").select(F.lit("  ").alias("line"))
    gone = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("src/gone/c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit(".py")).alias("line")
    )
    return real.unionByName(blank).unionByName(gone)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for model output: label, probability in hundredths (with ties) and prediction."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    prob = ((F.col("n_chars") * 7 + F.col("doc_id") * 13) % 101) / F.lit(100.0)
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .select(F.col("doc_id").alias("key"), (1 - F.col("quality")).alias("label"), prob.alias("prob"))
        .withColumn("pred", (F.col("prob") >= 0.5).cast("int"))
    )


# Lines with every form of mark, put ahead of each document's own text.
MARKED_BODY = (
    "// ruleid: sink-{id}¶document.write(q{id});¶  handle(q{id}); // ruleid: same-line¶"
    "x; // ruleid: short¶run(x{id});¶// ok: plain ruleid: both¶const c{id} = escape(q{id});¶// ok: no code¶// next¶"
    "// ok: blank¶¶eval(q{id}); // BAD¶html(q{id}); // NOT OK // ok¶safe(q{id}); // GOOD¶"
    "y = {id}; // fixed¶a; // bad¶* star // bad¶  // unsafe¶tail(q{id}) // Flaw ok: x¶run(1, 'same'); // BAD"
)


def marked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script files with marked lines, one per document."""
    number = F.col("doc_id").cast("string")
    body = F.replace(F.lit(MARKED_BODY.replace("¶", "\n")), F.lit("{id}"), number)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("rules/javascript/m"), number, F.lit(".js")).alias("path"),
        F.concat(body, F.lit("\n"), "text").alias("code"),
    )
