"""What keeps the cost of large tables in proportion: steps that run once, and lists that are paired by size."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from codesieve.operators import features, models, sampling, vectors
from codesieve.plans import model_queries, set_queries, source_queries

TEXTS = [
    (1, "x", 1, ["a", "b", "a"]),
    (2, "x", 0, ["a", "c"]),
    (3, "x", 0, ["c", "d", "d"]),
    (4, "y", 1, ["a", "q"]),
    (5, "y", 0, ["q", "r"]),
]


@pytest.fixture
def texts(spark):
    rows = spark.createDataFrame(TEXTS, "row_id long, language string, label int, terms array<string>")
    return rows.withColumn("keywords", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))


def test_rows_that_count_as_their_copies(texts):
    own = texts.where("language = 'x'")
    spelled = sampling.oversample(own.where("label = 1")).drop("copy").unionByName(own.where("label = 0"))
    counted = sampling.oversample_counted(own, F.col("label") == 1)
    assert counted.count() == 3
    assert vectors.fit_vectoriser(counted, min_docs=2, copies="copies") == vectors.fit_vectoriser(spelled, min_docs=2)
    sums = [
        {r.row_id: pytest.approx(r.w) for r in weighted.groupBy("row_id").agg(F.sum("weight").alias("w")).collect()}
        for weighted in (sampling.with_class_weight(spelled, "label"), sampling.with_class_weight(counted, "label", "copies"))
    ]
    assert {k: v.expected for k, v in sums[0].items()} == sums[1]


def test_vocabularies_of_all_groups_in_one_job(texts):
    found = vectors.fit_vectorisers(texts, ["x", "y"], min_docs=1)
    assert found == {g: vectors.fit_vectoriser(texts.where(F.col("language") == g), min_docs=1) for g in ("x", "y")}


def test_terms_are_counted_in_batches_not_row_by_row(texts, monkeypatch):
    docs = vectors.with_term_counts(texts.unionByName(texts.where("row_id < 3").withColumn("terms", F.lit(None).cast("array<string>"))))
    want = vectors.vocabulary(docs, 3, 1).collect()
    batched = vectors.most_frequent(vectors.term_totals(docs.repartition(2)), 3, 1)
    assert batched.schema.simpleString() == vectors.vocabulary(docs, 3, 1).schema.simpleString()
    assert sorted(batched.collect()) == sorted(want) and len(want) == 6
    assert vectors.term_totals(texts.where("false")).count() == 0
    calls = []
    monkeypatch.setattr(vectors, "with_term_counts", lambda *a, **k: calls.append(1) or 1 / 0)
    vectors.fit_vectorisers(texts, ["x", "y"], min_docs=1)
    assert not calls


def test_keywords_are_searched_in_a_text_that_is_folded_once(spark):
    from codesieve.functions import profiles

    texts = ["", None, "EVAL(eval) evaleval", "İeval md5", "aaa"]
    table = spark.createDataFrame([(t,) for t in texts], "code string")
    for ignore_case in (True, False):
        row = profiles.keyword_vector(F.col("code"), ("eval", "MD5", "aa"), ignore_case).alias("counts")
        found = [r[0] for r in table.select(row).collect()]
        fold = (lambda t: t.lower()) if ignore_case else (lambda t: t)
        want = [[float(fold(t).count(fold(w))) for w in ("eval", "MD5", "aa")] + [len(t) / 1000] if t is not None else [0.0] * 4 for t in texts]
        assert found == want
        plan = table.select(row)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("lower(code") == ignore_case


@pytest.mark.parametrize("name", ["vec_hybrid", "rel_feature_union"])
def test_snippets_are_gathered_once_for_all_models(spark, small, monkeypatch, name):
    calls, train = [], set_queries.train
    monkeypatch.setattr(set_queries, "train", lambda *a, **k: calls.append(1) or train(*a, **k))
    getattr(model_queries, name)(spark, small)
    assert len(calls) == 1


def test_arriving_files_grow_with_the_table():
    assert [source_queries.arriving_files(n) for n in (0, 1_000, 3_000_000)] == [4, 4, 300]


def test_clusters_of_unlike_sizes_are_not_paired(spark):
    from codesieve.llm.jaccard_join import Join

    join = Join.__new__(Join)
    join.percent = 90
    sizes = [(7, k, int(10 * 1.5**k)) for k in range(20)] + [(7, 20, 100), (7, 21, 91)]
    probes = spark.createDataFrame(sizes, "token long, label_a long, n_a int")
    met = join._clusters_met(probes, probes.toDF("token", "label_b", "n_b")).where("least(label_a, label_b) >= 20")
    assert {(r.label_a, r.label_b) for r in met.collect()} == {(20, 21), (21, 20)}
    assert join._clusters_met(probes, probes.toDF("token", "label_b", "n_b")).count() < 10


def test_search_trains_on_every_row_that_is_not_held_out(spark, monkeypatch):
    columns = [((F.col("id") * (k + 3)) % 17).alias(name) for k, name in enumerate(features.FEATURES_10)]
    rows = spark.range(60).select(F.col("id").alias("file_id"), *columns, (F.col("id") % 2).alias("label"), (F.col("id") % 5 == 0).alias("is_test"))
    seen = []
    monkeypatch.setattr(model_queries, "structural", lambda *_: rows)
    monkeypatch.setattr(model_queries, "SEARCH_ROWS", 10, raising=False)
    monkeypatch.setattr(model_queries, "SEARCH_PART", 10, raising=False)
    monkeypatch.setattr(models, "search_forest", lambda train: (seen.append(train), {}, 0.0))
    monkeypatch.setattr(models, "search_machine", lambda train: seen.append(train) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        model_queries.mdl_search(spark, "")
    assert [train.count() for train in seen] == [48, 48]
    assert len(list(seen[0].inputFiles())) == 5


def test_fits_of_a_large_table_run_one_by_one():
    assert [models._side_by_side(n, 16) for n in (0, 20_000, 100_000, 3_000_000)] == [16, 16, 4, 1]


def test_driver_does_not_hold_the_files_of_a_flat_folder(spark, tmp_path):
    from codesieve.functions import languages
    from codesieve.sources import readers

    names = ["a.py", "B.JAVA", "c d.js", "e%20f.ts", "_g.py", "_h=1.py", ".i.py", "j.md", "k", "l.h.cpp", "x._COPYING_"]
    names += [f"n{k}.py" for k in range(40)]
    for name in names:
        (tmp_path / name).write_bytes(f"x = '{name}'\r\n".encode() + b"\xff")
    (tmp_path / "empty.py").touch()
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "o.py").write_text("deep")
    spelled = spark.read.format("binaryFile").load(str(tmp_path)).withColumn("language", languages.from_path(F.col("path")))
    want = spelled.where("language IS NOT NULL").select("path", "language", readers.decode(F.col("content")).alias("code"))
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        found = readers.source_folder(spark, root)
        assert found.schema.simpleString() == want.schema.simpleString()
        assert sorted(found.collect()) == sorted(want.collect()) and found.count() == 46
        assert len(found.inputFiles()) < 10


@pytest.mark.parametrize("name", ["mdl_language_reports", "mdl_persist", "rep_files_model"])
def test_models_of_all_groups_are_trained_side_by_side(spark, monkeypatch, name):
    import threading

    together = threading.Barrier(len(model_queries.MODEL_NAMES), timeout=20)
    table = spark.createDataFrame([], "language string, is_test boolean")
    monkeypatch.setattr(model_queries, "text_rows", lambda *_: table)
    monkeypatch.setattr(vectors, "fit_vectorisers", lambda *_: dict.fromkeys(model_queries.MODEL_NAMES))

    class Met(Exception):
        pass

    def fit(*_):
        together.wait()
        raise Met

    monkeypatch.setattr(model_queries, "fit_text_model", fit)
    with pytest.raises(Met):
        getattr(model_queries, name)(spark, "")
