"""Command line: python -m hirelens.cli COMMAND."""

from __future__ import annotations

import argparse
import datetime
import json
import logging
import logging.handlers
from pathlib import Path

from . import __version__
from .catalog import KINDS, SnapshotCollection
from .config import Config
from .operators.features import list_features


def logger(folder: Path) -> logging.Logger:
    """A logger with files of a megabyte, five of them."""
    folder.mkdir(parents=True, exist_ok=True)
    log = logging.getLogger("hirelens")
    if not log.handlers:
        handler = logging.handlers.RotatingFileHandler(folder / "hirelens.log", maxBytes=1 << 20, backupCount=5)
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
        log.setLevel(logging.INFO)
    return log


def health(config: Config) -> dict[str, bool]:
    """Whether the jobs table and a training snapshot are there."""
    root = config["common.snapshots"]
    return {"jobs": Path(config["db.jobs"]).exists(), "training": not SnapshotCollection(root, "training").is_empty(), "models": not SnapshotCollection(root, "models").is_empty()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hirelens")
    p.add_argument("--config", default="~/.config/hirelens/config.json")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("version", "setup", "features"):
        sub.add_parser(name)
    for name, options in {"config": ["key?", "value?"], "snapshots": ["kind", "instance?"], "readjob": ["file"], "load": ["folder?"], "distribution": ["kind"], "report": ["predictions"], "information-gain": ["training", "text", "label"], "sample": ["predictions", "n"], "view-report": ["name?"], "train": ["training"], "predict": ["model?"]}.items():
        one = sub.add_parser(name)
        for o in options:
            one.add_argument(o.rstrip("?"), nargs="?" if o.endswith("?") else None)
        one.add_argument("--save", action="store_true")
        one.add_argument("--dry-run", action="store_true")
        one.add_argument("--as-of", default=datetime.date.today().isoformat())
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    config = Config(Path(args.config).expanduser())
    root = config["common.snapshots"]
    if args.command == "version":
        print(__version__)
    elif args.command == "setup":
        print(json.dumps(health(config), indent=2))
    elif args.command == "features":
        print("\n".join(list_features()))
    elif args.command == "config":
        if args.value is not None:
            config.set(args.key, args.value)
            config.save()
        print(json.dumps(config.as_dict(), indent=2, default=str) if args.key is None else config[args.key])
    elif args.command == "snapshots":
        kinds = SnapshotCollection(root, args.kind) if args.kind in KINDS else parser().error(f"kind: {', '.join(KINDS)}")
        print(kinds[args.instance] if args.instance else kinds)
    else:
        _spark_command(args, config)


def _spark_command(args: argparse.Namespace, config: Config) -> None:
    from pyspark.sql import functions as F

    from .functions.clean import job_date
    from .functions.html import parse_adverts
    from .functions.text import clean_text, ngrams
    from .operators import information, metrics, sampling
    from .plans import load, predict, report, train
    from .session import session
    from .sources import pages, tables

    log = logger(Path(config["common.snapshots"]) / "logs")
    log.info("%s", args.command)
    spark, jobs = session(), config["db.jobs"]
    if args.command == "readjob":
        row = parse_adverts(pages.read_pages(spark, args.file), args.as_of)
        text = tables.sorted_json(row).first()["value"]
        if args.save:
            Path(f"{args.file}.json").write_text(text)
        print(text)
    elif args.command == "load":
        found = pages.read_pages(spark, args.folder or str(config["scrape.folder"]))
        if args.dry_run:
            load.dry_run(found, args.as_of).show(100, truncate=False)
        else:
            stored = spark.read.parquet(jobs) if Path(jobs).exists() else None
            print(load.load(found, stored, jobs, args.as_of))
    elif args.command == "distribution":
        dated = spark.read.parquet(jobs).select(job_date("date", "placed_on", "closes").alias("date"))
        metrics.distribution(dated, args.kind).show(1000)
    elif args.command == "report":
        print(report.write_report(tables.read_predictions(spark, args.predictions), None, str(config["common.snapshots"] / "reports" / Path(args.predictions).name)))
    elif args.command == "information-gain":
        rows = tables.read_training(spark, args.training).withColumn("terms", ngrams(clean_text(args.text)))
        ranked = information.information(information.term_counts(rows, "terms", args.label))
        ranked.select("information", "ngram").orderBy("information", "ngram").write.mode("overwrite").csv(f"informationgain_{args.text}__{args.label}.csv", header=True)
    elif args.command == "sample":
        chosen = sampling.partition_jobs(tables.read_predictions(spark, args.predictions), int(args.n))
        tables.write_sample(tables.with_description(chosen.drop("hours"), spark.read.parquet(jobs)), "random_sample.csv")
    elif args.command == "train":
        print(train.train(tables.read_training(spark, args.training), str(config["common.snapshots"] / "models"), args.training, folds=int(config["model.k-fold"])))
    elif args.command == "predict":
        models = SnapshotCollection(config["common.snapshots"], "models")
        chosen = models[args.model] if args.model else models.latest()
        if chosen is None:
            raise SystemExit("no such model")
        target = config["db.prediction"]
        stored = spark.read.parquet(target) if Path(target).exists() else None
        counts = predict.run_counts(spark.read.parquet(jobs), stored, chosen.name)
        if counts["invalid"]:
            log.warning("%d jobs without a title or description are not scored", counts["invalid"])
        predict.predict(spark.read.parquet(jobs), stored, train.load_ensemble(spark, chosen.path), chosen.name).write.mode("append").parquet(target)
        print(json.dumps({"snapshot": chosen.name} | counts))
    elif args.command == "view-report":
        view_report(config["common.snapshots"], args.name)


def view_report(root: Path, name: str | None = None, port: int = 8000) -> None:
    """Serves a report's folder on this machine until interrupted."""
    import functools
    import http.server

    found = SnapshotCollection(root, "reports")
    chosen = found[name] if name else found.latest()
    if chosen is None:
        raise SystemExit("no such report")
    handler = functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(chosen.path))
    http.server.ThreadingHTTPServer(("127.0.0.1", port), handler).serve_forever()


if __name__ == "__main__":
    main()
