"""Entry points for spark-submit: one job an index strategy, the evaluation, and the backup with its retention.

    spark-submit jobs.py index --contents C --store S --strategy idx_markdown_minilm [--config F] [--limit N] [--errors]
    spark-submit jobs.py evaluate --queries Q --store S --out O [--config F] [--lone N]
    spark-submit jobs.py backup --source D --to B [--keep N] NAME...

--contents is a table in Parquet or a SQLite file (.db). Every job prints one line of JSON. A job that leaves something
out still ends well: the line names collections and counts databases that aren't there and, with --errors, what couldn't be indexed.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera import config
from tessera.operators import backup, contents
from tessera.operators.collections import Store
from tessera.operators.evaluation import preflight
from tessera.plans import indexing, report
from tessera.sources import evaluation_set, sqlite


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    if not path.endswith(".db"):
        return spark.read.parquet(path)
    sqlite.register(spark)
    return contents.decode(spark.read.format("sqlite").option("path", path).load())


def index(spark: SparkSession, a: argparse.Namespace) -> dict:
    strategy, store, rows = a.settings.strategy(a.strategy), Store(spark, a.store), read_contents(spark, a.contents)
    indexing.build_index(store, rows, strategy, a.limit)
    done = {"strategy": strategy.name, "collection": strategy.collection, "chunk_count": store.count(strategy.collection)}
    return done | ({"errors": indexing.indexing_errors(rows, strategy).count()} if a.errors else {})


def evaluate(spark: SparkSession, a: argparse.Namespace) -> dict:
    store = Store(spark, a.store)
    queries, version = evaluation_set.load(spark, a.queries)
    missing = preflight(queries, store.names(), a.settings.combos)
    files = report.run(store, queries, a.out, version, a.settings.combos, model=a.settings.model_of, lone=a.lone)
    return {"report": [str(f) for f in files], "missing": missing}


def back_up(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Copies first, so that a failing copy deletes nothing."""
    results = backup.back_up(spark, a.source, a.to, a.names)
    return backup.backup_summary(results).first().asDict() | {"removed": backup.clean_up(spark, a.to, a.keep)}


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="jobs")
    jobs = parser.add_subparsers(required=True)
    for job, needed in ((index, ("contents", "store", "strategy")), (evaluate, ("queries", "store", "out")), (back_up, ("source", "to"))):
        own = jobs.add_parser("backup" if job is back_up else job.__name__)
        own.set_defaults(job=job)
        for name in needed:
            own.add_argument(f"--{name}", required=True)
        if job is back_up:
            own.add_argument("--keep", type=int, default=backup.KEEP)
            own.add_argument("names", nargs="+")
        else:
            own.add_argument("--config")
        if job is index:
            own.add_argument("--limit", type=int, default=0)
            own.add_argument("--errors", action="store_true", help="chunk and embed all contents once more to count what failed")
        if job is evaluate:
            own.add_argument("--lone", type=int, default=report.LONE)
    found = parser.parse_args(arguments)
    if found.job is not back_up:
        found.settings = config.load(found.config) if found.config else config.DEFAULT
    return found


def main(arguments: Sequence[str] | None = None) -> dict:
    found = parse(arguments)
    done = found.job(SparkSession.builder.appName("tessera").getOrCreate(), found)
    print(json.dumps(done, ensure_ascii=False))
    return done


if __name__ == "__main__":
    main()
