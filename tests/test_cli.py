"""The end-to-end runner on the landed crash CSV."""

import tempfile

from roadframe.__main__ import run
from roadframe.plans import catalog
from roadframe.sources.fixture import landed_fixture_path


def test_run_workflow(spark, sf_dir):
    out = tempfile.mkdtemp(prefix="cli-out-")
    written = run(spark, landed_fixture_path(spark, sf_dir, "csv"), out, ["4", "3"])
    assert {"profile_counts", "factor_values", "clean", "clean_rows", "metrics", "pairs_3", "pairs_4",
            "predictions_3", "predictions_4"} <= set(written)
    n_clean = spark.read.parquet(written["clean_rows"]).first()["n_rows"]
    assert n_clean == catalog.QUERIES["row_count"](spark, sf_dir).first()["n_rows"]
    metrics = spark.read.parquet(written["metrics"]).collect()
    assert sorted((r.model, r.metric) for r in metrics) == [("3", "accuracy"), ("4", "r2"), ("4", "rmse")]
    assert spark.read.parquet(written["pairs_3"]).count() == 10


def test_removed_and_rejected_rows(spark, sf_dir, tmp_path):
    path = landed_fixture_path(spark, sf_dir, "csv")
    written = run(spark, path, str(tmp_path / "out"), [], reject_bad_rows=True)
    removed = {r.reason: r.rows for r in spark.read.parquet(written["removed"]).collect()}
    assert removed["kept"] == spark.read.parquet(written["clean"]).count()
    assert sum(removed.values()) == spark.read.parquet(written["raw"]).count()
    assert spark.read.parquet(written["rejected"]).count() == 0
    good = spark.read.text(path).where("value NOT LIKE 'CRASH DATE%'").limit(5).collect()
    header = spark.read.text(path).where("value LIKE 'CRASH DATE%'").first()[0]
    mixed = tmp_path / "mixed.csv"
    mixed.write_text("\n".join([header, *(r[0] for r in good), "short,row", good[0][0] + ",one more"]) + "\n")
    written = run(spark, str(mixed), str(tmp_path / "out2"), [], reject_bad_rows=True, multi_line=True)
    assert spark.read.parquet(written["raw"]).count() == 5 and spark.read.parquet(written["rejected"]).count() == 2


def test_metrics_from_written_predictions_equal_direct(spark, sf_dir):
    from roadframe.plans import recipes
    clean = catalog.clean(spark, sf_dir)
    run_ = recipes.run_recipe(clean, "5")
    direct = sorted((r.metric, round(r.value, 9)) for r in run_.metrics().collect())
    via = sorted((r.metric, round(r.value, 9)) for r in recipes.recipe_metrics(
        run_.recipe, run_.predictions(), run_.label_col).collect())
    assert direct == via


def test_cli_rejects_unknown_recipe(capsys):
    import pytest
    from roadframe.__main__ import main
    with pytest.raises(SystemExit):
        main(["--csv", "/nonexistent", "--out", "/nonexistent", "--recipes", "9z", "--master", "local[1]"])
    assert "unknown recipes" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        main(["--csv", "/nonexistent", "--out", "/nonexistent", "--multi-line", "--master", "local[1]"])
    assert "--reject-bad-rows" in capsys.readouterr().err
