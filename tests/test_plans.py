"""The whole run on the small tables, from raw file to exports."""

import pytest
from pyspark.sql import functions as F

from contract.queries import _raw_file
from tillroll.__main__ import main
from tillroll.functions.flags import genuine_sale
from tillroll.plans import anomaly_detection, exports, load, narration, segmentation
from tillroll.session import new_path
from tillroll.sources import tables


@pytest.fixture(scope="module")
def run(spark, sf):
    out = {"raw": _raw_file(spark, sf), "facts_path": new_path(spark, "facts")}
    out["report"] = load.load_invoices(spark, out["raw"], out["facts_path"]).first()
    facts = out["facts"] = tables.read_table(spark, out["facts_path"])
    out["segments"] = segmentation.build_segments(facts, new_path(spark, "segments"), starts=2)
    out["scores"] = anomaly_detection.build_scores(facts, new_path(spark, "scores"), trees=40)
    out["drafts"] = narration.drafts(facts, out["segments"], out["scores"])
    now = F.lit("2026-01-01").cast("timestamp_ntz")
    out["texts_path"] = new_path(spark, "texts")
    out["history"] = narration.save_drafts(spark, out["drafts"], now, out["texts_path"])
    return out


def test_load(spark, run):
    assert run["facts"].count() == run["report"].rows_kept
    assert run["report"].rows_read == run["report"].rows_kept + run["report"].rows_dropped == 6016


def test_loading_again_doubles_the_rows_under_new_ids(spark, run):
    path = new_path(spark, "facts")
    load.load_invoices(spark, run["raw"], path)
    load.load_invoices(spark, run["raw"], path)
    twice = tables.read_table(spark, path)
    row = twice.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    assert row.n == row.ids == 2 * run["report"].rows_kept


def test_result_tables_say_when(run):
    for name in ("segments", "scores"):
        assert run[name].filter("updated_at is null").isEmpty()
    assert dict(run["segments"].dtypes)["monetary"] == "decimal(12,2)"


def test_a_half_written_version_is_not_read(spark):
    path = new_path(spark, "versions")
    for n in (1, 2):
        tables.append_version(spark.range(n), path)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(
        f"{path}/version=3"
    )
    assert tables.read_last_version(spark, path, spark.range(1).schema).count() == 2
    tables.append_version(spark.range(3), path)
    assert tables.read_last_version(spark, path, spark.range(1).schema).count() == 3


def test_segments(run):
    customers = run["facts"].filter(genuine_sale()).select("customer_id").distinct().count()
    assert run["segments"].count() == customers
    by_spend = run["segments"].groupBy("cluster").agg(F.avg("monetary").alias("m"))
    assert [r.cluster for r in by_spend.orderBy(F.desc("m")).collect()] == [0, 1, 2]


def test_scores(run):
    row = run["scores"].agg(
        F.count("*").alias("n"),
        F.count_if("is_anomaly").alias("flagged"),
        F.count_if((F.col("anomaly_score") > 0) & ~F.col("is_anomaly")).alias("wrong"),
    ).first()
    assert row.n == run["facts"].filter(genuine_sale()).count()
    assert abs(row.flagged - 0.01 * row.n) <= 5 and row.wrong == 0


def test_scoring_again_gives_the_same_table(spark, run):
    again = anomaly_detection.build_scores(run["facts"], new_path(spark, "scores"), trees=40)
    same = run["scores"].drop("updated_at")
    assert again.drop("updated_at").exceptAll(same).count() == 0


def test_narratives(spark, run):
    kinds = [r.narrative_type for r in run["history"].orderBy("id").collect()]
    assert kinds[-2:] == ["anomaly", "executive"] and set(kinds[:-2]) == {"segment"}
    one = narration.drafts(run["facts"], run["segments"], run["scores"], only="anomaly")
    now = F.lit("2026-02-02").cast("timestamp_ntz")
    again = narration.save_drafts(spark, one, now, run["texts_path"])
    assert again.count() == len(kinds) == run["history"].count()
    assert again.filter(F.col("generated_at") == now).count() == 1
    with pytest.raises(ValueError):
        narration.drafts(run["facts"], run["segments"], run["scores"], only="executive")


def test_exports(spark, run):
    folder = new_path(spark, "exports")
    exports.export_reports(
        run["facts"], run["segments"], run["scores"], run["history"], folder
    )

    def back(name):
        return spark.read.option("header", True).csv(f"{folder}/{name}")

    assert back("cleaning_summary").count() == 7
    assert back("top_products").columns == ["stock_code", "description", "units_sold", "revenue"]
    assert back("transaction_anomalies_top50").count() == 50
    assert back("customer_segments").count() == run["segments"].count()
    assert back("anomaly_detail").count() == run["scores"].filter("is_anomaly").count()


def test_the_command_line_runs_every_step(spark, run, capsys):
    root = new_path(spark, "warehouse")
    main(["load", root, run["raw"]])
    main(["summary", root])
    main(["segment", root, "--starts", "1", "--sweep", "2", "3"])
    main(["detect", root, "--trees", "10"])
    main(["narrate", root])
    main(["narrate", root, "segment"])
    main(["export", root])
    printed = capsys.readouterr().out
    assert "rows_dropped" in printed and "stock_adjustments" in printed
    assert "silhouette" in printed and "pct_anomalous" in printed and "executive" in printed
    assert spark.read.csv(f"{root}/exports/top_products", header=True).count() == 20
