"""Command line: `python -m riskspark report|diff|score|run ...`."""

from __future__ import annotations

import argparse
import sys


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("riskspark").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="riskspark")
    sub = parser.add_subparsers(dest="command", required=True)
    report = sub.add_parser("report", help="model report of a scored sample")
    report.add_argument("-d", "--data", required=True)
    report.add_argument("-o", "--output", required=True, help=".xlsx or .md")
    report.add_argument("-m", "--scorecard")
    report.add_argument("--metadata")
    report.add_argument("--target", default="mob6_30")
    diff = sub.add_parser("diff", help="online against offline values")
    given = diff.add_mutually_exclusive_group(required=True)
    given.add_argument("--config")
    given.add_argument("--var-list")
    given.add_argument("--model")
    diff.add_argument("--online", required=True)
    diff.add_argument("--offline", required=True)
    diff.add_argument("--pk", action="append", default=[])
    diff.add_argument("--score")
    diff.add_argument("--score-offline")
    diff.add_argument("--sep")
    diff.add_argument("-o", "--output", required=True)
    score = sub.add_parser("score", help="score a table with a tree model")
    score.add_argument("--model", required=True)
    score.add_argument("-d", "--data", required=True)
    score.add_argument("--keep", required=True)
    score.add_argument("-o", "--output", required=True)
    score.add_argument("--sql", help="also write the SQL here")
    run = sub.add_parser("run", help="assemble the wide table of a model and score it")
    run.add_argument("--config", required=True)
    run.add_argument("--model-config")
    run.add_argument("--model", required=True)
    run.add_argument("--metadata", required=True)
    run.add_argument("--sample", required=True, help="a table of the catalog, or a parquet or csv path")
    run.add_argument("--table", action="append", default=[], help="name=path of a parquet table that the catalog does not hold")
    run.add_argument("-o", "--output", required=True)
    run.add_argument("--report")
    run.add_argument("--sql")
    args = parser.parse_args(argv)
    return {"report": _report, "diff": _diff, "score": _score, "run": _run}[args.command](args)


def _report(args) -> int:
    from .reports.model_report import ReportConfig, ReportGenerator
    from .reports.sinks import save_text
    from .sources import readers
    from .sources.scorecards import StoredScorecard

    spark = _session()
    df = readers.read_sample(spark, args.data)
    dictionary = spark.createDataFrame([(r["name"], r.get("source") or "unknown") for r in readers.dictionary_rows(spark, args.metadata)], "name string, source string") if args.metadata else None
    made = ReportGenerator(ReportConfig(target=args.target), StoredScorecard.load(args.scorecard) if args.scorecard else None, dictionary)
    if args.output.endswith(".xlsx"):
        made.to_excel(df, args.output)
    else:
        save_text(args.output, made.to_markdown(df))
    return 0


def _diff(args) -> int:
    from .reports import diff_report
    from .reports.sinks import save_text
    from .sources import model_text, readers

    spark = _session()
    if args.config:
        spec = readers.load_diff_config(args.config)
    else:
        if not args.pk or not args.score:
            print("--pk and --score are needed without --config", file=sys.stderr)
            return 2
        names = readers.variable_list(args.var_list) if args.var_list else model_text.valid_features_of(args.model)
        spec = readers.diff_from_names(names, args.pk, args.score)
    a, b = (readers.read_csv(spark, p, args.sep) for p in (args.online, args.offline))
    save_text(args.output, diff_report.markdown(a, b, spec, args.score_offline))
    return 0


def _score(args) -> int:
    from .operators.scoring import full_sql, score
    from .reports.sinks import save_text
    from .sources import model_text, readers

    spark = _session()
    model, keep = model_text.load_model(args.model), args.keep.split(",")
    score(readers.read_sample(spark, args.data), model, keep).write.mode("overwrite").parquet(args.output)
    if args.sql:
        save_text(args.sql, full_sql(model, "input_table", keep) + ";\n")
    return 0


def _run(args) -> int:
    from .pipeline import ScoringPipeline
    from .plans import metadata as md
    from .plans import planner
    from .reports.sinks import save_text
    from .sources import model_text, readers

    spark = _session()
    config = readers.load_config(args.config, args.model_config)
    made = ScoringPipeline(model_text.load_model(args.model), md.load(args.metadata), config)
    sample = readers.read_sample(spark, args.sample) if "/" in args.sample or args.sample.endswith((".csv", ".parquet")) else spark.table(args.sample)
    paths = dict(x.split("=", 1) for x in args.table)
    alias = (config.get("project") or {}).get("platform_alias", "")
    made.run(sample, planner.catalog(spark, paths, alias)).write.mode("overwrite").parquet(args.output)
    if args.report:
        save_text(args.report, made.report())
    if args.sql:
        made.save_sql(args.sql, args.sample, sample.columns)
    return 0


if __name__ == "__main__":
    sys.exit(main())
