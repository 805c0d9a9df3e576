import json
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelens import queries
from hirelens.catalog import Snapshot, SnapshotCollection
from hirelens.cli import health, main
from hirelens.config import Config
from hirelens.functions import clean
from hirelens.functions import text as T
from hirelens.operators import features, information, sampling, scoring
from hirelens.plans import load, predict, report, train
from hirelens.sources import tables


def tokens(spark, s, **k):
    return spark.createDataFrame([(s,)], "v string").select(T.clean_text("v", **k)).first()[0]


def test_tokens(spark):
    assert tokens(spark, "Mail me at bob@example.com or www.x.org. It's £30 for 12 C++ jobs! Don't wait", remove_stop=False) == ["mail", "me", "at", "or", "it", "s", "for", "c++", "jobs", "don", "t", "wait"]
    assert tokens(spark, "The engineers, engineers work.") == ["engineers", "engineers", "work"]
    assert tokens(spark, "nan 1_000 1e5 inf word", remove_stop=False) == ["word"]
    assert "£" not in "".join(tokens(spark, "pay £ 100£ five", remove_stop=False))
    assert tokens(spark, "see http://a.b now", remove_stop=False)[0] == "see"
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(T.ngrams(F.col("t"))).collect()] == [["a", "b", "c", "a b", "b c"], ["a"], []]


def plain_tokens(text):
    """The same rules, a token at a time."""
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+(?=[^\W\d_a-z]|[\d\"'(])|\n\s*\n", text):
        sentence = re.sub(T.EMAIL, "", sentence)
        sentence = re.sub(T.SPLIT.replace("(?U:\\s)", "\\s"), " ", sentence)
        sentence = re.sub(r'(^|(?<=[ (\[{<]))"', " `` ", sentence)
        for t in re.sub(T.MARKS, r" \1 ", sentence).split():
            t = {"'s": "", "'ll": "will", "n't": "not"}.get(t, t)
            t = "".join(x for x in t if not unicodedata.category(x).startswith("P"))
            try:
                float(t)
                continue
            except ValueError:
                t = t.lower()
            if t and t != "`" and "Sc" not in (unicodedata.category(t[0]), unicodedata.category(t[-1])) and not t.startswith(("www", "http")) and t not in T.STOP_WORDS:
                out.append(t)
    return out


def test_tokens_of_a_table_like_a_plain_version(spark):
    rows = queries.QUERIES["cleaned_text"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r.cleaned == " ".join(plain_tokens(texts[r.doc_id])), r.doc_id
    odd = ['He said "go (now)" at 10:30: C++, C#; a_b [x]<y> 50% off!! e.g. "quoted"', "“Curly” ‘q’ … 1e5 nan 12. £30k $40k 5£ ``x`` www.a.b/c http://d.e", "Line one\n\nLine two. 3 more? Yes! (and) b&c *d* f@g it's we'll", ""]
    for t in odd:
        assert tokens(spark, t) == plain_tokens(t), t


def test_training_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text('job_title,extra,aggregate_tags,in_uk,description,placed_on,tag_count,salary_max\n"a, b",x,1,True,"two\nlines",2020-01-31,2.0,n/a\nc,y,0,False,d,,,10.5\n')
    first, second = tables.read_training(spark, str(tmp_path / "t.csv")).collect()
    assert (first.job_title, first.aggregate_tags, first.in_uk, first.description, str(first.placed_on), first.tag_count, first.salary_max, first.jobid) == ("a, b", 1, True, "two\nlines", "2020-01-31", 2, None, None)
    assert (second.job_title, second.aggregate_tags, second.placed_on, second.tag_count, second.salary_max) == ("c", 0, None, None, 10.5)
    (tmp_path / "u.csv").write_text("job_title,description\na,b\n")
    assert tables.read_training(spark, str(tmp_path / "u.csv")).first().aggregate_tags is None


def test_contracts_of_training_rows(spark):
    names = ["Fixed-Term", "a permanent post", "TEMPORARY", "Casual work", "fixed", "funding", None]
    df = spark.createDataFrame([("No", "Most", "normal", c) for c in names], "tags_1 string, tags_2 string, enhanced string, contract string")
    assert [r[0] for r in df.select(clean.valid_training()).collect()] == [True, True, True, False, False, False, False]


@pytest.mark.parametrize("seed", [None, 4])
def test_ranks_in_parts_are_the_ranks(spark, seed):
    for key, kind in ((lambda i: (i * 7919) % 1009 - 300, "long"), (lambda i: f"k{(i * 7919) % 1009}", "string"), (lambda i: ((i * 7919) % 1009) / 7, "double")):
        df = spark.createDataFrame([(key(i), None if i % 3 == 0 else i % 2, i) for i in range(1009)], f"k {kind}, label int, _c int")
        w = W.partitionBy("label")
        order = ["k"] if seed is None else [F.xxhash64(F.lit(seed), "k"), "k"]
        want = df.withColumns({"_place": F.row_number().over(w.orderBy(*order)), "_n": F.count("*").over(w)})
        assert sorted(map(str, sampling.placed(df, ["label"], "k", seed).collect())) == sorted(map(str, want.collect()))
    assert sampling.placed(df.limit(0), ["label"], "k", seed).count() == 0
    assert sorted(r._place for r in sampling.placed(df, [], "k", seed).collect()) == list(range(1, 1010))


def test_run_counts_and_repeated_jobs(spark):
    jobs = spark.createDataFrame([("a", "t", "d"), ("b", None, "d"), ("c", "t", "d")], "jobid string, job_title string, description string")
    assert predict.run_counts(jobs, None, "s") == {"scored": 2, "invalid": 1, "skipped": 0}
    stored = spark.createDataFrame([("a", "s"), ("c", "other")], "jobid string, snapshot string")
    assert predict.run_counts(jobs, stored, "s") == {"scored": 1, "invalid": 1, "skipped": 1}
    pages = spark.createDataFrame([("a", "z"), ("a", "y"), (None, "x"), ("b", "w")], "jobid string, html string")
    assert sorted(map(tuple, load.insert_new(pages, None).collect())) == [("a", "y"), ("b", "w")]
    assert [tuple(r) for r in load.insert_new(pages, stored).collect()] == [("b", "w")]


def test_information_and_ranks(spark):
    df = spark.createDataFrame([(0.2, "a"), (0.2, "b"), (0.5, "c"), (0.9, "d")], "information double, ngram string")
    ranked = information.ranked(df)
    assert {r.ngram for r in information.till_rank(ranked, 1).collect()} == {"a", "b"}
    assert {r.ngram for r in information.till_rank(ranked, -1).collect()} == {"d"}
    assert {r.ngram for r in information.at_rank(ranked, 2).collect()} == {"c"}
    with pytest.raises(ValueError):
        information.till_rank(ranked, 0)


def test_range_language():
    assert train.expand("=10:101:10") == list(range(10, 101, 10))
    assert len(train.expand("=e-3:8:12")) == 12
    assert train.expand("=e-3:8:12")[0] == pytest.approx(1e-3)
    assert train.expand([1, 2]) == [1, 2]
    assert train.expand("balanced") == ["balanced"]
    assert [len(train.grid(m)) for m in ("LogReg", "RandomForest", "CART")] == [40, 60, 17]
    assert train.get_model("none", {}, 1) is None


def test_forests_are_deep_and_the_boosted_grid_whole(spark):
    assert train.get_model("RandomForest", {}, 1).getMaxDepth() == 30
    assert len(train.grid("GradientBoosting")) == 7 * 2 * 3 * 2 * 7
    assert train.get_model("GradientBoosting", {"min_samples_leaf": 21}, 1).getMinInstancesPerNode() == 21


def test_bootstrap_equals_the_draws(spark):
    rows = [(i, np.random.RandomState(i).rand(20).tolist()) for i in range(5)] + [(9, None)]
    got = {r.i: r.ci for r in spark.createDataFrame(rows, "i int, m array<double>").select("i", scoring.bootstrap_interval("m", 20, 50).alias("ci")).collect()}
    for i, m in rows[:5]:
        means = [np.mean(np.array(m)[np.random.RandomState(k).randint(0, 20, 20)]) for k in range(50)]
        assert [got[i]["probability"], got[i]["lower"], got[i]["upper"]] == pytest.approx([np.mean(means), *np.percentile(means, [2.5, 97.5])])


def test_folds_are_contiguous_and_samples_repeat(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(31)], "k int, y boolean")
    folds = sampling.stratified_folds(df, "y", "k", 4).orderBy("k").collect()
    assert [r.fold for r in folds if r.y] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3]
    a = {r.k for r in sampling.stratified_split(df, "y", "k", 0.2, 7).where("is_test").collect()}
    b = {r.k for r in sampling.stratified_split(df.repartition(5), "y", "k", 0.2, 7).where("is_test").collect()}
    assert a == b and len(a) == 4 + 3


def test_nested_cross_validation(spark):
    r = np.random.RandomState(0)
    rows = [(i, float(i % 2), Vectors.dense((r.randn(3) + (i % 2) * 2).tolist())) for i in range(80)]
    df = spark.createDataFrame(rows, ["_row", "label", "features"])
    scores, best, params = train.nested_cross_validation(df, ["LogReg"], "f1", 2, True, 0, {"LogReg": [{"C": [1.0]}]})
    s = scores.first()
    assert best == "LogReg" and params == {"C": 1.0}
    assert s.mean_roc_auc > 0.9 and s.mean_f1 == pytest.approx((s.f1_1 + s.f1_2) / 2)


def test_text_features_keep_all_terms(spark, tmp_path):
    """Words and word pairs of both blocks beyond 500, as a plain version weighs them."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "q" + letters[n // 26 % 26] + letters[n % 26] + "z"
    texts = [" ".join([word(40 * i + k) for k in range(40)] + [word(0)] * (i % 3)) for i in range(16)]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(16)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def block(column):
        counts = []
        for text in column:
            words = [w for w in re.findall(r"\w\w+", text)]
            counts.append(Counter(words + [" ".join(p) for p in zip(words, words[1:])]))
        df = Counter(t for c in counts for t in c)
        raw = [{t: (1 + np.log(n)) * (np.log(17 / (1 + df[t])) + 1) for t, n in c.items()} for c in counts]
        return sorted(df), [{t: w / np.sqrt(sum(x * x for x in r.values())) for t, w in r.items()} for r in raw]

    terms, weights = block(texts)
    title_terms, title_weights = block([t[:60] for t in texts])
    assert len(terms) > 500
    got = {r.jobid: r for r in queries.queries()["text_features"](spark, str(tmp_path)).collect()}
    assert len(got) == 16
    for i, r in got.items():
        assert r["size"] == len(terms) + len(title_terms)
        want = {("d", t): w for t, w in weights[i].items()} | {("t", t): w for t, w in title_weights[i].items()}
        found = {("d", terms[at]) if at < len(terms) else ("t", title_terms[at - len(terms)]): w for at, w in zip(r["indices"], r["weights"])}
        assert found == pytest.approx(want, abs=2e-6)


@pytest.fixture
def embeddings(spark, tmp_path):
    r = np.random.RandomState(1)
    rows = [(i, (r.randn(4) + i % 2).tolist(), i % 2) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


@pytest.fixture
def fitted(monkeypatch):
    """The parameters of every model made."""
    made, plain = [], train.get_model
    monkeypatch.setattr(train, "get_model", lambda name, params, *a: made.append(params) or plain(name, params, *a))
    return made


def test_train_logreg_searches_its_grid_in_five_folds(spark, embeddings, fitted, monkeypatch):
    monkeypatch.setitem(train.GRIDS, "LogReg", [{"C": [0.001, 1.0], "class_weight": ["balanced"]}])
    row = queries.queries()["train_logreg"](spark, embeddings).first()
    assert {f"f1_{k}" for k in range(1, 6)} <= set(row.asDict())
    # Two points in five inner folds, for each of five outer folds and the final choice, and five fits of the outer folds.
    assert len(fitted) == 6 * 10 + 5 and {p["C"] for p in fitted} == {0.001, 1.0}


def test_ensemble_predict_fits_a_hundred_members(spark, embeddings, fitted):
    rows = queries.queries()["ensemble_predict"](spark, embeddings).collect()
    assert len(fitted) == 100 and len(rows) == 60
    assert all(r.lower < r.probability < r.upper for r in rows)


class Small(features.TextFeatures):
    required = ["description", "job_title"]
    blocks = [("description", 50), ("job_title", None)]


def test_train_predict_report(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(features.FEATURE_SETS, "small", Small)
    rows = [(str(i), "software code testing python" if i % 2 else "history essay archive letters", f"Post {i % 3}", i % 2) for i in range(40)]
    data = spark.createDataFrame(rows, "jobid string, description string, job_title string, aggregate_tags int").withColumn("_row", F.col("jobid").cast("long"))
    folder = train.train(data, str(tmp_path), "t1", featureset="small", models=["LogReg"], folds=2, members=2, grids={"LogReg": [{"C": [10.0]}]})
    metadata = json.loads((folder / "metadata.json").read_text())
    assert metadata["best_model"] == "LogReg" and json.loads((folder / "members" / "members.json").read_text())["members"] == 2
    ensemble = train.train_ensemble(data, "aggregate_tags", "small", 2)
    jobs = data.drop("_row", "aggregate_tags").withColumns({"salary_median": F.lit(30000.0), "date": F.lit("2020-03-01").cast("date"), "contract": F.lit("Permanent"), "extra_location": F.lit("Wales")})
    predictions = predict.predict(jobs, None, ensemble, "s1", 50)
    found = {r.jobid: r for r in predictions.collect()}
    assert len(found) == 40
    assert all((r.probability > 0.5) == (int(j) % 2 == 1) and r.probability_lower <= r.probability_upper for j, r in found.items())
    assert predict.predict(jobs, predictions, ensemble, "s1", 50).count() == 0
    target = report.write_report(predictions, None, str(tmp_path / "report"))
    by_year = json.loads((target / "by_year.json").read_text())
    assert by_year[0]["group"] == "2020" and by_year[0]["npos"] == 20 and by_year[0]["nloc_wales"] == 20
    assert set(report.CHARTS) <= set(by_year[0])


@pytest.mark.parametrize(("model", "params"), [("CART", {"max_depth": 2}), ("LogReg", {"C": 10.0})])
def test_members_are_the_model_that_the_search_chose(spark, tmp_path, monkeypatch, model, params):
    monkeypatch.setitem(features.FEATURE_SETS, "small", Small)
    made, plain = [], train.get_model
    monkeypatch.setattr(train, "get_model", lambda *a: made.append(plain(*a)) or made[-1])
    rows = [(i, "software code testing python" if i % 2 else "history essay archive letters", f"Post {i % 3}", i % 2) for i in range(40)]
    data = spark.createDataFrame(rows, "_row long, description string, job_title string, aggregate_tags int")
    folder = train.train(data, str(tmp_path), "t1", featureset="small", models=[model], folds=2, members=1, grids={model: [{k: [v] for k, v in params.items()}]})
    chosen = json.loads(next((folder / "model" / "metadata").glob("part-*")).read_text())
    if model == "CART":
        member = json.loads(next((folder / "member_000" / "metadata").glob("part-*")).read_text())
        assert member["class"] == chosen["class"] and member["paramMap"]["maxDepth"] == 2
    else:
        # Logistic members are one model; four fifths of 40 rows.
        about = json.loads((folder / "members" / "members.json").read_text())
        assert chosen["class"].endswith("LogisticRegressionModel") and about["model"] == "LogReg" and about["parameters"] == params
        assert made[-1].getRegParam() == pytest.approx(1 / (10 * 32))


def test_a_saved_ensemble_predicts(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(features.FEATURE_SETS, "small", Small)
    rows = [(str(i), "software code testing python" if i % 2 else "history essay archive letters", f"Post {i % 3}", i % 2, i) for i in range(40)]
    data = spark.createDataFrame(rows, "jobid string, description string, job_title string, aggregate_tags int, _row long")
    folder = train.train(data, str(tmp_path / "models"), "t1", featureset="small", models=["LogReg"], folds=2, members=2, grids={"LogReg": [{"C": [10.0]}]})
    jobs = data.select("jobid", "description", "job_title")
    jobs.write.parquet(str(tmp_path / "jobs"))
    config = Config(tmp_path / "c.json")
    for key, value in {"common.snapshots": tmp_path, "db.jobs": tmp_path / "jobs", "db.prediction": tmp_path / "prediction"}.items():
        config.set(key, value)
    config.save()
    for _ in range(2):
        main(["--config", str(tmp_path / "c.json"), "predict"])
    got = {r.jobid: (r.snapshot, r.probability) for r in spark.read.parquet(str(tmp_path / "prediction")).collect()}
    assert spark.read.parquet(str(tmp_path / "prediction")).count() == 40
    kept = train.train_ensemble(data, "aggregate_tags", "small", 2, model="LogReg", params={"C": 10.0})
    want = {r.jobid: (folder.name, pytest.approx(r.probability)) for r in predict.predict(jobs, None, kept, folder.name).collect()}
    assert got == want


def test_cli_train(tmp_path, monkeypatch):
    called = []
    monkeypatch.setattr(train, "train", lambda data, folder, name, **k: called.append((data.columns, folder, name, k)))
    (tmp_path / "t.csv").write_text("a\n1\n")
    config = Config(tmp_path / "c.json")
    config.set("common.snapshots", tmp_path)
    config.save()
    main(["--config", str(tmp_path / "c.json"), "train", str(tmp_path / "t.csv")])
    columns, *rest = called[0]
    assert {"description", "job_title", "aggregate_tags"} <= set(columns) and rest == [str(tmp_path / "models"), str(tmp_path / "t.csv"), {"folds": 5}]


def test_predictions_file(spark, tmp_path):
    good = {"jobid": "1", "snapshot": "s", "job_title": "t", "probability": 0.5, "lower_ci": 0.4, "upper_ci": 0.6, "contract": "Casual", "posted": None, "placed_on": {"$date": "2020-03-01T00:00:00Z"}}
    (tmp_path / "p.jsonl").write_text(json.dumps(good) + "\n" + json.dumps(good | {"jobid": "2", "upper_ci": 1.5}) + "\n")
    raw = spark.read.schema(tables.PREDICTION).json(str(tmp_path / "p.jsonl"))
    kept = tables.typed_predictions(raw, strict=False).collect()
    assert [(r.jobid, r.contract, str(r.date)) for r in kept] == [("1", "FixedTerm", "2020-03-01")]
    with pytest.raises(Exception, match="out of range"):
        tables.typed_predictions(raw).collect()


def test_catalog_config_cli(tmp_path, capsys):
    for name in ("2020-01-01_a", "2020-02-01_b"):
        Snapshot(tmp_path, "models", name).create()
    (tmp_path / "models" / "2020-01-01_a" / "metadata.json").write_text('{"x": 1}')
    c = SnapshotCollection(tmp_path, "models")
    assert c.keys() == ["2020-01-01_a", "2020-02-01_b"] and c.latest().name == "2020-02-01_b" and c["none"] is None
    assert json.loads(str(c["2020-01-01_a"])) == {"x": 1}
    config = tmp_path / "c.json"
    main(["--config", str(config), "config", "common.snapshots", str(tmp_path)])
    assert Config(config)["common.snapshots"] == tmp_path
    with pytest.raises(ValueError):
        Config(config).set("one", 1)
    main(["--config", str(config), "snapshots", "models"])
    assert "2020-02-01_b" in capsys.readouterr().out
    assert health(Config(config))["models"]


def test_vectors_are_made_without_python(spark):
    df = spark.createDataFrame([(1, "red green red", "blue sky"), (2, "green leaf", None), (3, "", "red"), (4, "zz", "")], "_row long, description string, job_title string").withColumn("more", F.lit(1))
    found = features.ResearchSoftware(clean=False).fit(df.where("_row < 4"))
    got = found.transform(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "more" in got.columns
    want = {r._row: (r["size"], r.indices, r.weights) for r in found.parts(df).collect()}
    assert {r._row: (r.features.size, r.features.indices.tolist(), r.features.values.tolist()) for r in got.collect()} == want


def test_large_vocabularies_meet_the_terms_in_a_shuffled_join(spark, monkeypatch):
    df = spark.createDataFrame([(1, "red green red", "blue sky"), (2, "green leaf", None), (3, "", "red"), (4, "zz", "")], "_row long, description string, job_title string")
    found = features.ResearchSoftware(clean=False).fit(df.where("_row < 4"))
    assert sum(found.bytes.values()) > 0
    rows = {r._row: (r.size, r.indices, r.weights) for r in found.parts(df).collect()}
    monkeypatch.setattr(features, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r._row: (r.size, r.indices, r.weights) for r in found.parts(df).collect()} == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    size = sum(found.sizes.values())
    assert rows[4] == (size, [], []) and all(len(i) == len(w) and i == sorted(i) and n == size for n, i, w in rows.values())
    # description: green, green leaf, green red, leaf, red, red green; job_title: blue, blue sky, red, sky
    assert size == 10 and rows[1][1] == [0, 2, 4, 5, 6, 7, 9] and rows[2][1] == [0, 1, 3] and rows[3] == (10, [8], [1.0])
    assert sum(w * w for w in rows[1][2]) == pytest.approx(2)
