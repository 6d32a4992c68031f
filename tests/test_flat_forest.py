"""Flattened forests and text models against Spark's own, and the one scan."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from codesieve.functions import profiles, text
from codesieve.operators import flat_forest, models, scan, vectors


def test_flat_forest_equals_transform(spark, monkeypatch):
    monkeypatch.setattr(flat_forest, "CELLS", 100)
    draw = np.random.default_rng(1)
    values = np.round(draw.normal(size=(400, 6)), 1)
    labels = (values[:, 0] * values[:, 1] + draw.normal(size=400) > 0).astype(float)
    rows = [(k, v.tolist(), float(y), float(1 + k % 3)) for k, (v, y) in enumerate(zip(values, labels))]
    table = spark.createDataFrame(rows, "id long, v array<double>, label double, weight double").withColumn("features", array_to_vector("v"))
    model = RandomForestClassifier(numTrees=17, maxDepth=7, seed=5, weightCol="weight").fit(table)
    want = dict(model.transform(table).select("id", vector_to_array("probability")[1]).collect())
    got = flat_forest.flatten(model, spark).probability(values)
    assert np.abs(got - [want[k] for k in range(400)]).max() < 1e-9
    single = RandomForestClassifier(numTrees=1, maxDepth=0, seed=5).fit(table)
    assert np.ptp(flat_forest.flatten(single, spark).probability(values)) == 0


CODE = {
    "a.py": "import os\nos.system('ls ' + name)\neval(data)\n",
    "b.py": "def add(a, b):\n    return a + b\n",
    "c.java": "public class A { void run(String s) { Runtime.getRuntime().exec(s + x); } }",
    "d.java": "class B { int add(int a, int b) { return a + b; } }",
    "e.txt": "no language",
    "f.py": "",
    "g.java": None,
}


@pytest.fixture(scope="module")
def files(spark):
    rows = [(40 * k + i, f"{k}/{path}", code if code is None else code + f"\nint x{k} = {k};") for k in range(30) for i, (path, code) in enumerate(CODE.items())]
    return scan.route(spark.createDataFrame(rows, "file_id long, path string, code string").repartition(3))


def fitted(files, language, profile):
    own = files.where(F.col("language") == language).where("code IS NOT NULL")
    shaped = vectors.with_model_input(own, text.clean_multi(F.col("code")), profiles.KEYWORDS[profile], profiles.STOP_WORDS[profile])
    shaped = shaped.withColumn("label", F.when(F.col("code").rlike("exec|system") != (F.col("file_id") % 3 == 0), 1.0).otherwise(0.0))
    stages = vectors.fit_vectoriser(shaped, min_docs=2).stages()
    forest = RandomForestClassifier(numTrees=20, maxDepth=6, seed=3, subsamplingRate=0.6, labelCol="label").fit(stages.transform(shaped))
    return PipelineModel([*stages.stages, forest])


def test_one_scan_scores_all_languages(spark, files, tmp_path):
    names = {"hybrid": ("python", "python"), "java": ("java", "java")}
    chains, flat = {}, {}
    for name, (language, profile) in names.items():
        models.save(fitted(files, language, profile), str(tmp_path), name)
        chains[name] = models.load(str(tmp_path), name)
        flat[name] = flat_forest.flat_text_model(chains[name], spark)
    words = {name: profiles.KEYWORDS[p] for name, (_, p) in names.items()}
    stop = {name: profiles.STOP_WORDS[p] for name, (_, p) in names.items()}
    scored = scan.route_text_models(files, flat, words, stop)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1 and "Union" not in plan
    assert scored.columns == [*files.columns, "model", "ml_prob"]
    got = {r.file_id: r.ml_prob for r in scored.collect()}
    assert len(got) == files.count()
    seen = 0
    for name, (language, profile) in names.items():
        own = files.where(F.col("language") == language)
        shaped = vectors.with_model_input(own, text.clean_multi(F.col("code")), words[name], stop[name])
        for row in models.with_probability(chains[name], shaped).select("file_id", "prob").collect():
            assert abs(got[row.file_id] - row.prob) < 1e-9
            seen += 1
    assert seen == 180
    assert all(got[r.file_id] == 0.0 for r in files.where("language IS NULL").collect())
    assert len({round(p, 6) for p in got.values()}) > 3


def test_missing_models_give_zero(files):
    routed = scan.route_models(files, {"hybrid": F.lit(None).cast("double"), "java": F.length("code") * F.lit(0.001)})
    rows = routed.select("model", "ml_prob", "code").collect()
    assert {r.ml_prob for r in rows if r.model is None or r.model == "hybrid" or r.code is None} == {0.0}
    assert all(r.ml_prob > 0 for r in rows if r.model == "java" and r.code)
