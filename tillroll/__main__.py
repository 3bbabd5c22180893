"""Run one step of the work on a warehouse folder.

spark-submit a script that calls ``main``, or: python -m tillroll load WAREHOUSE invoices.csv
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.operators import anomalies, quality, segments
from tillroll.operators.clustering import k_sweep
from tillroll.operators.rfm import rfm, scaled_features
from tillroll.plans import anomaly_detection, exports, load, narration, segmentation
from tillroll.schema import NARRATIVES
from tillroll.sources import tables


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillroll")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, text: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=text)
        sub.add_argument("warehouse")
        return sub

    sub = step("load", "append a raw invoice file")
    sub.add_argument("raw")
    sub.add_argument("--once", action="store_true", help="leave out files that were loaded before")
    step("summary", "counts of what is odd about the rows")
    sub = step("segment", "rebuild the customer segments")
    sub.add_argument("--k", type=int, default=3)
    sub.add_argument("--starts", type=int, default=10)
    sub.add_argument("--sweep", type=int, nargs="*", help="first show quality for these k")
    sub = step("detect", "rebuild the anomaly scores")
    sub.add_argument("--trees", type=int, default=200)
    sub.add_argument("--contamination", type=float, default=anomalies.CONTAMINATION)
    step("narrate", "render the narratives anew").add_argument(
        "only", nargs="?", choices=("segment", "anomaly"), help="only those of this type"
    )
    step("export", "write the reports as CSV")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"tillroll {args.step}").getOrCreate()
    root = args.warehouse.rstrip("/")
    facts_path = f"{root}/transactions"
    segments_path = f"{root}/customer_segments"
    scores_path = f"{root}/transaction_anomalies"
    history_path = f"{root}/narratives"

    def read(path: str):
        return tables.read_table(spark, path)

    if args.step == "load":
        load.load_invoices(spark, args.raw, facts_path, args.once).show()
    elif args.step == "summary":
        quality.cleaning_summary(read(facts_path)).show(truncate=False)
    elif args.step == "segment":
        facts = read(facts_path)
        if args.sweep:
            k_sweep(scaled_features(rfm(facts)), args.sweep).show()
        table = segmentation.build_segments(facts, segments_path, args.k, args.starts)
        segments.segment_stats(table).show(truncate=False)
    elif args.step == "detect":
        scores = anomaly_detection.build_scores(
            read(facts_path), scores_path, args.contamination, args.trees
        )
        anomalies.anomaly_overview(scores).show()
    elif args.step == "narrate":
        drafted = narration.drafts(
            read(facts_path), read(segments_path), read(scores_path), args.only
        )
        now = F.current_timestamp().cast("timestamp_ntz")
        history = narration.save_drafts(spark, drafted, now, history_path)
        history.select("narrative_type", "reference_key", "narrative_text").show(truncate=80)
    elif args.step == "export":
        history = tables.read_last_version(spark, history_path, NARRATIVES)
        exports.export_reports(
            read(facts_path), read(segments_path), read(scores_path), history, f"{root}/exports"
        )


if __name__ == "__main__":
    main()
