"""Command-line jobs, for spark-submit.

    spark-submit run_job.py prepare     --attempts A.csv --logs DIR --subject NAME --team CODE --out DIR
                                        [--bad-rows DIR]
    spark-submit run_job.py train-zones --attempts A.csv --model DIR [--regressor forest|small-forest|boosted]
    spark-submit run_job.py train-clusters --attempts A.csv --model DIR [--rates DIR]
    spark-submit run_job.py train-rates --rates DIR --model DIR [--csv]
    spark-submit run_job.py score       --model DIR --requests R.csv --out DIR [--as-sql]
    spark-submit run_job.py export-sql  --model DIR --out DIR
    spark-submit run_job.py count-lines --text FILE [--needles a b]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate import schemas
from tallyrate.operators import evaluate, models, text, trees
from tallyrate.operators.cells import incomplete_counts, with_cells
from tallyrate.operators.split import with_split
from tallyrate.plans import learned_zones, named_zones, prep, scoring, training
from tallyrate.session import build_session
from tallyrate.sources import files, quarantine
from tallyrate.storage import drop_written_tables, written_table

REGRESSORS = {"forest": models.forest, "small-forest": models.small_forest,
              "boosted": models.boosted}


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    """Attempts with their score margins, and the games whose counts differ. With a folder for bad
    rows, files may differ in their headers, and rows that cannot be read go there."""
    if args.bad_rows:
        found = {"attempts": quarantine.split_attempts(spark, args.attempts),
                 "logs": quarantine.split_result_set(spark, args.logs)}
        for name, split in found.items():
            files.write_csv(split.bad, f"{args.bad_rows}/{name}")
            split.counts().show(truncate=False)
        attempts, log = found["attempts"].good, found["logs"].good
    else:
        attempts = files.read_attempts(spark, args.attempts)
        log = written_table(files.read_result_set(spark, args.logs), "event-log")
    margins = prep.subject_margins(attempts, log, args.subject, args.team)
    merged = prep.merge_margins(attempts, margins).drop(prep.TIME)
    files.write_csv(merged, f"{args.out}/attempts")
    incomplete_counts(merged, [prep.MARGIN]).show(truncate=False)
    files.write_csv(prep.reconcile(attempts, margins), f"{args.out}/differing_games")


def train_zones(spark: SparkSession, args: argparse.Namespace) -> None:
    attempts = files.read_attempts(spark, args.attempts)
    incomplete_counts(with_cells(attempts), named_zones.REQUIRED).show(truncate=False)
    rates = named_zones.zone_rates(attempts, args.seed, ["index"],
                                   split_level=args.split_level)
    _finish(args, *training.train_zone_model(rates, REGRESSORS[args.regressor](args.seed)))


def train_clusters(spark: SparkSession, args: argparse.Namespace) -> None:
    attempts = files.read_attempts(spark, args.attempts)
    incomplete_counts(learned_zones.binned(attempts), learned_zones.REQUIRED).show(truncate=False)
    rates = written_table(learned_zones.cluster_rates(attempts, args.seed), "rates")
    if args.rates:
        files.write_rates(rates, args.rates)
    _finish(args, *training.train_cluster_model(rates, REGRESSORS[args.regressor](args.seed)))


def train_rates(spark: SparkSession, args: argparse.Namespace) -> None:
    rates = files.read_rates_csv(spark, args.rates) if args.csv else files.read_rates(spark, args.rates)
    if "is_train" not in rates.columns:
        rates = with_split(rates, learned_zones.CELL, args.seed)
    _finish(args, *training.train_cluster_model(rates, REGRESSORS[args.regressor](args.seed)))


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    model = models.load(args.model)
    schema = schemas.REQUESTS if scoring.expected_by(model).scaled else schemas.RAW_REQUESTS
    requests = files.read_csv(spark, args.requests, schema)
    predict = (lambda df: trees.with_prediction(df, model)) if args.as_sql else None
    files.write_csv(scoring.score(model, requests, predict), args.out)


def export_sql(spark: SparkSession, args: argparse.Namespace) -> None:
    """The model's prediction as one SQL expression over its input columns, on one line."""
    files.write_text(spark, trees.prediction_sql(models.load(args.model)), args.out)


def count_lines(spark: SparkSession, args: argparse.Namespace) -> None:
    text.contains_counts(files.read_lines(spark, args.text), args.needles).show(truncate=False)


def _finish(args: argparse.Namespace, model: PipelineModel, predicted: DataFrame) -> None:
    models.save(model, args.model)
    evaluate.rmse(predicted).select(
        F.lit(args.regressor).alias("regressor"), "rmse", "n").show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyrate", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        added.set_defaults(run=run)
        for option in required:
            added.add_argument(f"--{option}", required=True)
        return added

    job("prepare", prepare, "attempts", "logs", "subject", "team", "out").add_argument("--bad-rows")
    job("score", score, "model", "requests", "out").add_argument("--as-sql", action="store_true")
    job("export-sql", export_sql, "model", "out")
    job("count-lines", count_lines, "text").add_argument("--needles", nargs="+", default=["a", "b"])
    trainers = [job("train-zones", train_zones, "attempts", "model"),
                job("train-clusters", train_clusters, "attempts", "model"),
                job("train-rates", train_rates, "rates", "model")]
    trainers[0].add_argument("--split-level", choices=["attempt", "cell"], default="attempt")
    trainers[1].add_argument("--rates")
    trainers[2].add_argument("--csv", action="store_true")
    for trainer in trainers:
        trainer.add_argument("--regressor", choices=sorted(REGRESSORS), default="forest")
        trainer.add_argument("--seed", type=int, default=models.SEED)
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session()
    try:
        args.run(spark, args)
    finally:
        drop_written_tables(spark)


if __name__ == "__main__":
    main()
