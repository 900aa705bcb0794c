import pytest

from shelfrank.plans.semantic_index import build_index
from shelfrank.plans.supervised import train_quality_model
from shelfrank.sources import files
from workload.registry import clean

CSV = """names,date_x,score,genre,overview,crew,orig_title,status,orig_lang,budget_x,revenue,country
"Say ""Hi"", now",03/02/2023 ,71,"Action, Drama","two
lines","A, B",x,Released,English,10,20,US
NA, ,,n/a,"  ",null,,,French, ,"1,000",FR
"""


def test_csv_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    rows = files.scan_csv(spark, str(tmp_path)).orderBy("orig_lang").collect()
    assert rows[0]["names"] == 'Say "Hi", now' and rows[0]["overview"] == "two\nlines" and rows[0]["genre"] == "Action, Drama"
    assert [rows[1][c] for c in ("names", "date_x", "score", "genre", "crew", "budget_x")] == [None] * 6
    assert rows[1]["revenue"] == "1,000" and rows[1]["overview"] == "  "


def test_loaders_build_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    path, saved = str(tmp_path / "clean"), str(tmp_path / "view")
    with pytest.raises(ValueError, match="no raw CSV"):
        files.load_clean(spark, path)
    first = files.load_supervised(spark, path, str(tmp_path / "a.csv"))
    assert first.count() == 1 and "item_id" in first.columns
    assert files.load_clean(spark, path).count() == 1
    assert files.load_clustering(spark, path, save_to=saved).columns == ["item_id", "year", "score", "budget_x", "revenue"]
    assert spark.read.parquet(saved).count() == 1
    assert files.load_semantic(spark, path).first()["year"] == 2023


def test_materialize_keeps_an_existing_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.materialize(spark, path, lambda: spark.range(3)).count() == 3
    again = files.materialize(spark, path, lambda: spark.range(9), in_memory=True)
    assert again.count() == 3
    again.unpersist()


def test_semantic_index(spark, small, tmp_path):
    index, embedder = build_index(clean(spark, small, "names", "overview", "genre", "score", "year"), str(tmp_path / "index"))
    assert index.count() > 0 and embedder.model is not None


def test_supervised_flow(spark, small, tmp_path):
    model, comparison = train_quality_model(
        clean(spark, small), 2025, kinds=("linear", "ridge"), grids={"ridge": {"alpha": (1.0, 10.0)}}, save_to=str(tmp_path / "m")
    )
    assert comparison.count() == 6
    assert {"r2", "rmse", "mae", "train_within_10", "test_within_10"} <= set(model.metrics)


def test_an_aborted_write_is_built_again(spark, tmp_path):
    from shelfrank.sources.files import materialize

    path = tmp_path / "half"
    (path / "_temporary").mkdir(parents=True)
    assert materialize(spark, str(path), lambda: spark.range(3)).count() == 3
    assert materialize(spark, str(path), lambda: spark.range(9)).count() == 3


def test_wide_layout_needs_the_right_length(spark):
    from shelfrank.sources.vectors import array_to_wide

    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None)], "item_id int, embedding array<float>")
    assert array_to_wide(df, 3).orderBy("item_id").collect()[1].embed_0 is None
    with pytest.raises(Exception, match="expected 2 components, found 3"):
        array_to_wide(df, 2).collect()
