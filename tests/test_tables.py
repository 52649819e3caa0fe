import pytest
from pyspark.sql import functions as F

from opinara.functions import labels
from opinara.operators import metrics, numeric, rows
from opinara.sources import tables


def test_csv_with_quotes_and_newlines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('content,score\n"a, ""b""\nc",5\nplain,1\n', encoding="utf-8")
    got = tables.load_csv(spark, str(path), "score", group_sentiment=True, schema="content string, score int").collect()
    assert [tuple(r) for r in got] == [('a, "b"\nc', "POSITIVO"), ("plain", "NEGATIVO")]


def test_tab_separator_and_missing_target(spark, tmp_path):
    path = tmp_path / "in.tsv"
    path.write_text("label\ttext\nspam\thi, you\n", encoding="utf-8")
    assert tables.load_csv(spark, str(path), "label", "\t").columns == ["text", "label"]
    with pytest.raises(ValueError):
        tables.load_csv(spark, str(path), "score", "\t")


def test_class_folders_prune(spark, tmp_path):
    df = spark.createDataFrame([(1, "no good"), (2, "ok"), (3, None)], "k int, c string")
    tables.split_by_class(df, "c", str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("class_part=*")) == ["class_part=NO_GOOD", "class_part=OK"]
    assert [r["k"] for r in tables.read_class(spark, str(tmp_path / "out"), "no good").collect()] == [1]


def test_sentiments(spark):
    df = spark.createDataFrame([("4",), ("4.0",), (" 3 ",), ("positivo",), (None,), ("7",)], "t string")
    got = [r[0] for r in df.select(labels.sentiment_normalize(F.col("t"))).collect()]
    assert got == ["POSITIVO", "4.0", "NEUTRO", "POSITIVO", None, "7"]
    nums = spark.createDataFrame([(1,), (3,), (5,), (7,), (None,)], "r int")
    assert [r[0] for r in nums.select(labels.sentiment_bucket(F.col("r"))).collect()] == ["NEGATIVO", "NEUTRO", "POSITIVO", "7", None]


def test_years(spark):
    df = spark.createDataFrame([("31/12/2019",), ("01-02-2020",), ("garbage",), (None,), ("1/1/2016",)], "date string")
    df = df.withColumn("score", F.lit("NEGATIVO"))
    got = {r["date"] for r in rows.filter_class_years(df, "score", "NEGATIVO", "date", 2016, 2019).collect()}
    assert got == {"31/12/2019", "1/1/2016"}


NUMBERS = [(1.0, 5.0, None), (3.0, 5.0, None), (3.0, 5.0, None), (None, 5.0, None), (9.0, 5.0, None), (1.0, 5.0, None)]


def test_impute_and_scale_edge_cases(spark):
    df = spark.createDataFrame(NUMBERS, "a double, b double, c double")
    cols = ["a", "b", "c", "absent"]
    mode = numeric.fit_impute(df, cols, "most_frequent")
    assert mode.params["a"]["fill"] == 1.0 and mode.params["c"]["fill"] is None
    assert numeric.fit_impute(df, ["a"], "median").params["a"]["fill"] == 3.0
    scaled = numeric.fit_scale(df, ["a", "b"], "max-min").transform(df)
    assert {r["b"] for r in scaled.collect()} == {0.0}
    assert {r["b"] for r in numeric.fit_scale(df, ["b"], "standard").transform(df).collect()} == {0.0}
    unseen = spark.createDataFrame([(100.0, 5.0), (-4.0, 6.0), (None, 5.0)], "a double, b double")
    binned = numeric.fit_discretize(df, ["a", "b"], 4).transform(unseen).collect()
    assert [r["a_disc"] for r in binned] == [3.0, 0.0, None] and {r["b_disc"] for r in binned} == {0.0}
    with pytest.raises(ValueError):
        numeric.fit_impute(df, ["a"], "delete")


@pytest.mark.parametrize("values", [
    [7.0], [2.0, 2.0], [-0.0, 0.0], [-0.0, 0.0, -5e-324, 5e-324], [float("inf"), 1.0, float("-inf")], [1e308, 1e308, 3.0, 3.0],
    [-1.5, -1.5000000000000002, -1.4999999999999998, 4.0], [((i * 7919) % 13 + 0.5 * (i % 3 == 0)) * (-1) ** i for i in range(501)],
])
def test_medians_by_digits_are_exact(spark, values):
    """Ties, both zeros, neighbours in the last bit, several columns at once, nulls left out."""
    rows = [(v, -v, None, int(i)) for i, v in enumerate(values)] + [(None, None, None, 3)] * 2
    df = spark.createDataFrame(rows, "x double, y double, z double, w int").repartition(3)
    got = numeric.exact_medians(df, ["x", "y", "z", "w"])

    def middle(some):
        some = sorted(some)
        return (some[(len(some) - 1) // 2] + some[len(some) // 2]) / 2
    assert got == {"x": middle(values), "y": middle([-v for v in values]), "z": None, "w": middle([r[3] for r in rows])}
    assert numeric.exact_medians(df.limit(0), ["x"]) == {"x": None}


def test_metrics_with_labels_on_one_side_only(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "x"), ("b", "a"), ("c", "c")], "real string, pred string")
    counts = metrics.confusion_counts(df, "real", "pred")
    wide = {r["real"]: r.asDict() for r in metrics.confusion_matrix(counts).collect()}
    assert wide["x"]["pred_a"] == 0 and wide["a"]["pred_x"] == 1 and len(wide) == 4
    macro = metrics.prf(counts, "macro").first()
    assert macro["f1"] == pytest.approx((0.5 + 0 + 1 + 0) / 4)
    assert metrics.prf(counts, "micro").first()["f1"] == pytest.approx(0.5)
    assert metrics.prf(counts, "binary", positive="c").first()["f1"] == 1.0
    assert metrics.prf(counts, "binary", positive="zzz").first()["f1"] == 0.0


def test_best_trial_prefers_the_first(spark):
    df = spark.createDataFrame([(2, 0.5), (1, 0.7), (0, 0.7)], "trial_id int, f1 double")
    assert metrics.best_trial(df).first()["trial_id"] == 0


def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = lambda *rows: spark.createDataFrame(list(rows), "name string, score double")
    tables.write_run(frame(("a", 1.0), ("b", 2.0)), path, "first")
    tables.write_run(frame(("c", 3.0)), path, "second")
    tables.write_run(frame(("d", 4.0)).withColumn("more", F.lit(1)), path, "first")
    got = {(r["name"], r["score"], r["more"], r["run_id"]) for r in tables.read_runs(spark, path).collect()}
    assert got == {("d", 4.0, 1, "first"), ("c", 3.0, None, "second")}
    assert [r["name"] for r in tables.read_runs(spark, path, ["second"]).collect()] == ["c"]
    # Rows that no manifest line names (a job that died) are not read.
    frame(("lost", 0.0)).write.parquet(path + "/rows/half")
    assert tables.read_runs(spark, path).count() == 2
    with pytest.raises(ValueError):
        tables.read_runs(spark, path, ["third"])


def test_csv_without_newlines_in_fields_is_cut(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    with open(path, "w") as file:
        file.write("k,t\n" + "".join(f'{i},"a, ""b"" {i}"\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        split = tables.read_csv(spark, path, "k int, t string", multi_line=False)
        whole = tables.read_csv(spark, path, "k int, t string")
        assert split.rdd.getNumPartitions() > 2 and whole.rdd.getNumPartitions() == 1
        assert split.exceptAll(whole).count() == 0 and split.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
