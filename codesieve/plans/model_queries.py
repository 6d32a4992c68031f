"""Trained models and what they say. Results depend on the learner, so there is no SQL twin."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesieve.functions import labels, languages, profiles, text
from codesieve.operators import anomaly, features, flat_forest, heuristics, metrics, models, sampling, scan, vectors
from codesieve.operators.facts import with_facts
from codesieve.plans import set_queries, syntax_queries, views
from codesieve.plans.registry import query
from codesieve.session import materialise, scratch_path

COLUMNS = features.FEATURES_9


def structural(spark, sf_dir, label: str = "target"):
    """(file_id, nine or ten columns, label, is_test), written once: training reads it many times."""
    files = syntax_queries.python_files(spark, sf_dir).withColumn("target", labels.binary(F.col("safety")))
    table = features.structural(files, ("file_id", "target"))
    risk = labels.risk_rule(*[F.col(c) for c in ("cyclomatic_complexity", "maintainability_index", "ast_nodes")])
    rows = table.withColumn("label", F.col("target") if label == "target" else risk)
    rows = materialise(rows, "structural")
    return sampling.split(rows, "file_id", 0.3, ["label"])


def parts(rows):
    return rows.where("NOT is_test"), rows.where("is_test")


def scaled(rows, columns=COLUMNS):
    """Train and test rows with scaled columns as ``features``."""
    train, test = parts(rows)
    scaler = sampling.fit_scaler(train, columns)
    return [models.assemble(scaler.transform(part), columns) for part in (train, test)]


def judged(scored, name: str):
    """Quality of one model as a row."""
    result = metrics.binary(scored).select(F.lit(name).alias("model"), "*")
    return result


@query("mdl_tree")
def mdl_tree(spark, sf_dir):
    train, test = parts(models.assemble(structural(spark, sf_dir), COLUMNS))
    return judged(models.with_probability(models.tree().fit(train), test), "Decision Tree")


@query("mdl_forest")
def mdl_forest(spark, sf_dir):
    train, test = parts(models.assemble(structural(spark, sf_dir), COLUMNS))
    weighted = sampling.with_class_weight(train, "label")
    plain = judged(models.with_probability(models.forest("structural").fit(train), test), "100 trees")
    risk = judged(models.with_probability(models.forest("risk").fit(train), test), "120 trees, depth 12")
    deep = models.forest("notebook", "weight").fit(weighted)
    return plain.unionByName(risk).unionByName(judged(models.with_probability(deep, test), "300 trees, balanced"))


@query("mdl_svm_rbf")
def mdl_svm_rbf(spark, sf_dir):
    train, test = scaled(structural(spark, sf_dir))
    return judged(models.fit_kernel_machine(train).transform(test), "SVM")


#: Rows of a part of the table that the search trains on.
SEARCH_PART = 20_000


def in_parts(rows, key: str, most: int):
    """``rows`` in the order of a hash of ``key``, in as many parts as hold about ``most`` rows each."""
    order = (F.xxhash64(key), key)
    return rows.repartitionByRange(max(1, -(-rows.count() // most)), *order).sortWithinPartitions(*order)


@query("mdl_search")
def mdl_search(spark, sf_dir):
    """Random search over both kinds of model, 20 settings and 5 folds each; report of both classes, accuracy and AUC of both
    winners on held-out rows, and the one that is picked by AUC, the forest if both are equal. All rows that are not held out train the models."""
    train, test = scaled(structural(spark, sf_dir), features.FEATURES_10)
    train = materialise(in_parts(train, "file_id", SEARCH_PART).select("features", "label"), "train")
    forest, forest_settings, forest_accuracy = models.search_forest(train)
    machine, machine_settings, machine_accuracy = models.search_machine(train)
    found, reports = [], []
    for name, settings, accuracy, scored in (
        ("forest", {p.name: v for p, v in forest_settings.items()}, forest_accuracy, models.with_probability(forest, test)),
        ("machine", machine_settings, machine_accuracy, machine.transform(test)),
    ):
        shown = "; ".join(f"{key}={value}" for key, value in sorted(settings.items()))
        scored = materialise(scored.select("label", "pred", "prob"), "scored")
        judged, auc = metrics.binary(scored).first(), metrics.auc(scored).first()
        found.append((name, shown, float(accuracy), judged.accuracy, auc.auc if auc else None))
        reports.append(metrics.class_report(scored).select(F.lit(name).alias("model"), "*"))
    picked = models.pick({row[0]: row[4] for row in found})
    schema = "model string, settings string, fold_accuracy double, test_accuracy double, auc double, picked boolean"
    winners = spark.createDataFrame([(*row, row[0] == picked) for row in found], schema)
    return reports[0].unionByName(reports[1]).join(F.broadcast(winners), "model")


def risk_model(spark, sf_dir, rows):
    """A forest on ten columns, as one stored-and-loadable chain of stages."""
    train, _ = parts(rows)
    assembler = VectorAssembler(inputCols=list(features.FEATURES_10), outputCol="features")
    return PipelineModel([assembler, models.forest("risk").fit(assembler.transform(train))])


def predict(spark, sf_dir):
    """(file_id, ml_probability) of every Python file, 0.0 where it does not parse."""
    rows = structural(spark, sf_dir)
    model = risk_model(spark, sf_dir, rows)
    files = syntax_queries.python_files(spark, sf_dir).select("file_id")
    scored = models.with_probability(model, rows).select("file_id", "prob")
    return files.join(scored, "file_id", "left").select("file_id", F.coalesce("prob", F.lit(0.0)).alias("ml_probability"))


@query("mdl_predict")
def mdl_predict(spark, sf_dir):
    return predict(spark, sf_dir)


@query("rep_repo")
def rep_repo(spark, sf_dir):
    files = syntax_queries.python_files(spark, sf_dir).select("file_id", "path", "code")
    found = heuristics.with_heuristics(heuristics.with_taint(with_facts(files)))
    entry = lambda h: F.concat_ws("|", h["name"], h["severity"], h["detail"])
    flat = found.select("file_id", "path", F.array_join(F.transform("heuristics", entry), "\n").alias("heuristics"))
    return flat.join(predict(spark, sf_dir), "file_id")


@query("cls_kmeans")
def cls_kmeans(spark, sf_dir):
    train, test = scaled(structural(spark, sf_dir))
    fit = models.fit_best_kmeans(materialise(train.select("features"), "train"))
    return fit.transform(test).groupBy("prediction").agg(F.count("*").alias("n"))


@query("ano_iforest")
def ano_iforest(spark, sf_dir):
    train, test = parts(structural(spark, sf_dir))
    grown = anomaly.fit(train, "file_id", COLUMNS)
    flagged = grown.flag(train.unionByName(test))
    return flagged.groupBy("is_test").agg(F.count("*").alias("n"), F.count_if("is_anomaly").alias("anomalies"))


# ---- text models ----------------------------------------------------------------------------


def text_rows(spark, sf_dir):
    """Model input of all training groups (``language``): cleaned, deduplicated, split.

    One pass for all: the snippets are deduplicated and shaped once and written by group, so that what follows reads
    its own group only.
    """
    rows = set_queries.train(spark, sf_dir)
    group = F.when(languages.is_javascript(F.col("language")), F.lit("js")).otherwise(languages.from_code(F.col("language")))
    own = rows.withColumn("profile", group).where(F.col("profile").isin(*MODEL_NAMES))
    words, stop = ({profile: table[profile] for profile in MODEL_NAMES} for table in (profiles.KEYWORDS, profiles.STOP_WORDS))
    shaped = vectors.with_routed_input(own, "profile", text.clean_multi(F.col("code")), words, stop)
    keywords = array_to_vector("keywords").alias("keywords")
    kept = shaped.select("row_id", F.col("target").alias("label"), "terms", keywords, F.col("profile").alias("language"))
    return sampling.split(materialise(kept, "text_rows", by="language"), "row_id", 0.2, ["language", "label"])


def of_profile(rows, profile: str):
    return rows.where(F.col("language") == profile)


def fit_text_model(train, fitted: vectors.TextVectoriser):
    """A balanced forest behind a fitted vocabulary of one language."""
    vectoriser = fitted.stages()
    ready = materialise(sampling.with_class_weight(vectoriser.transform(train), "label").select("features", "label", "weight"), "ready")
    return PipelineModel([*vectoriser.stages, models.forest("text", "weight").fit(ready)])


#: Training group and the name its model is stored under.
MODEL_NAMES = {"java": "java", "c_cpp": "c_cpp", "php": "php", "js": "javascript", "python": scan.GENERIC_MODEL}


def vectorised(spark, sf_dir) -> dict[str, DataFrame]:
    """Rows of each training group with vectors whose vocabulary comes from the part to train on."""
    rows = text_rows(spark, sf_dir)
    fitted = vectors.fit_vectorisers(rows.where("NOT is_test"), MODEL_NAMES)
    return {profile: fitted[profile].stages().transform(of_profile(rows, profile)) for profile in MODEL_NAMES}


def side_by_side(make) -> list:
    """What ``make`` gives for each training group, in their order; their jobs share the cores, so that none waits for the
    last task of another."""
    with ThreadPoolExecutor(len(MODEL_NAMES)) as pool:
        return list(pool.map(make, MODEL_NAMES))


def every_profile(make):
    return reduce(DataFrame.unionByName, [make(profile) for profile in MODEL_NAMES])


@query("vec_hybrid")
def vec_hybrid(spark, sf_dir):
    rows = vectorised(spark, sf_dir)

    def shape(profile):
        array = models.vector_to_array("features")
        filled = F.size(F.array_remove(array, 0.0))
        return rows[profile].select("language", "row_id", F.size(array).alias("width"), filled.alias("filled"))

    return every_profile(shape)


@query("rel_feature_union")
def rel_feature_union(spark, sf_dir):
    rows = vectorised(spark, sf_dir)

    def part(profile):
        array = models.vector_to_array("features")
        words = len(profiles.KEYWORDS[profile]) + 1
        tail = F.slice(array, F.size(array) - words + 1, F.lit(words)).alias("keyword_part")
        return rows[profile].select("language", "row_id", tail)

    return every_profile(part)


def store_models(spark, sf_dir) -> str:
    """Train and store one model per language; the folder they are in."""
    registry = scratch_path(spark, "registry")
    train, _ = parts(text_rows(spark, sf_dir))
    fitted = vectors.fit_vectorisers(train, MODEL_NAMES)
    side_by_side(lambda profile: models.save(fit_text_model(of_profile(train, profile), fitted[profile]), registry, MODEL_NAMES[profile]))
    return registry


def scored_files(spark, sf_dir):
    """All files with the probability of the stored model of their language, in one scan."""
    registry = store_models(spark, sf_dir)
    loaded = {name: flat_forest.flat_text_model(models.load(registry, name), spark) for name in MODEL_NAMES.values()}
    words = {name: profiles.KEYWORDS[profile] for profile, name in MODEL_NAMES.items()}
    stop = {name: profiles.STOP_WORDS[profile] for profile, name in MODEL_NAMES.items()}
    return scan.route_text_models(scan.route(views.code_files(spark, sf_dir)), loaded, words, stop)


@query("mdl_persist")
def mdl_persist(spark, sf_dir):
    """Train, store and load one model per language, then score all files by their own model."""
    return scored_files(spark, sf_dir).select("file_id", "language", "model", F.round("ml_prob", 6).alias("ml_prob"))


@query("rep_files_model")
def rep_files_model(spark, sf_dir):
    """The scan of all files with the probability of each language's model."""
    report = scan.scan(scored_files(spark, sf_dir).drop("model"), F.col("ml_prob"))
    return report.select("file_id", "language", "verdict", F.round("score", 4).alias("score"), F.round("ml_prob", 6).alias("ml_prob"))


def judged_text_model(model, test, name: str):
    """Report of both classes with the AUC beside it."""
    scored = materialise(models.with_probability(model, test).select("label", "pred", "prob"), "scored")
    auc = metrics.auc(scored).first()
    return metrics.class_report(scored).select(F.lit(name).alias("model"), "*", F.lit(auc.auc if auc else None).cast("double").alias("auc"))


@query("mdl_language_reports")
def mdl_language_reports(spark, sf_dir):
    """Each language's model on its held-out rows: precision, recall and F1 of both classes, and the AUC."""

    train, test = parts(text_rows(spark, sf_dir))
    fitted = vectors.fit_vectorisers(train, MODEL_NAMES)

    def judge(profile):
        model = fit_text_model(of_profile(train, profile), fitted[profile])
        return judged_text_model(model, of_profile(test, profile), MODEL_NAMES[profile])

    return reduce(DataFrame.unionByName, side_by_side(judge))


@query("mdl_python_only")
def mdl_python_only(spark, sf_dir):
    """The Python-only model: narrow cleaning, keywords as spelled, terms of two texts or more, vulnerable rows of the
    part to train on 20 times, a balanced forest. Rows are repeated after the split, so no copy is judged.

    The copies of a row are one row that counts and weighs as all of them, so the forest draws them for a tree together."""
    rows = set_queries.train(spark, sf_dir).where(languages.from_code(F.col("language")) == "python")
    shaped = vectors.with_model_input(
        rows, text.clean_python(F.col("code")), profiles.PYTHON_WORDS, profiles.STOP_WORDS["python"], ignore_case=False
    )
    kept = shaped.select("row_id", F.lit("python").alias("language"), F.col("target").alias("label"), "terms", "keywords")
    train, test = parts(sampling.split(materialise(kept, "python_rows"), "row_id", 0.2, ["label"]))
    more = sampling.oversample_counted(train.where("label IN (0, 1)"), F.col("label") == 1)
    vectoriser = vectors.fit_vectoriser(more, min_docs=vectors.MIN_DOCS_PYTHON, copies="copies").stages()
    ready = sampling.with_class_weight(vectoriser.transform(more), "label", "copies").select("features", "label", "weight")
    fitted = models.forest("text", "weight").fit(materialise(ready, "ready"))
    return judged_text_model(PipelineModel([*vectoriser.stages, fitted]), test, "python_only")
