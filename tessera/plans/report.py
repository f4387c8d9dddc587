"""The evaluation report as JSON and markdown. It holds one row a combination and category, so the driver writes it."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EVAL_COMBOS, model_of_collection, parse_combo
from ..operators.backup import STAMP
from ..operators.evaluation import categories, evaluate, preflight, rollup
from ..operators.lexical_index import BlockIndex
from ..operators.retrieval import K, build_strategy
from ..sources.shared import shared_dir

METRICS = ("recall", "precision", "mrr")


def report(combos: DataFrame, totals: DataFrame, version: str, num_queries: int, latency_ms: dict[str, float] | None = None, now: datetime | None = None, order: Iterable[str] = ()) -> dict:
    """combos: collection, strategy, status, chunk_count; totals: what rollup() gives. latency_ms: mean by combination.

    order: categories in the order that they are reported in; others follow by name.
    """
    place = {c: i for i, c in enumerate(order)}
    out: dict = {"query_set_version": version, "timestamp": (now or datetime.now(UTC)).strftime(STAMP), "num_queries": num_queries, "combos": {}}
    for r in combos.orderBy("collection", "strategy").collect():
        out["combos"][f"{r.collection}__{r.strategy}"] = {"collection": r.collection, "strategy": r.strategy, "status": r.status, "chunk_count": r.chunk_count}
    rows = totals.orderBy("collection", "strategy", "category").collect()
    for r in sorted(rows, key=lambda r: place.get(r.category, len(place))):
        name = f"{r.collection}__{r.strategy}"
        own = {m: r[m] for m in METRICS} | {"queries": r.queries}
        if r.is_overall:
            out["combos"][name]["overall"] = own | {"latency_ms": (latency_ms or {}).get(name, 0.0)}
        else:
            out["combos"][name].setdefault("by_category", {})[r.category] = own
    return out


def markdown(found: dict) -> str:
    """A table of all combinations, then one of each combination's categories."""
    lines = [f"# Evaluation {found['query_set_version']}", "", f"{found['timestamp']}, {found['num_queries']} queries", "", "| combination | chunks | recall | precision | MRR | latency |", "|-|-|-|-|-|-|"]
    for name, c in found["combos"].items():
        if c["status"] != "ok":
            lines.append(f"| {name} | {c['status']} | — | — | — | — |")
        else:
            o = c["overall"]
            lines.append(f"| {name} | {c['chunk_count']} | {o['recall']:.3f} | {o['precision']:.3f} | {o['mrr']:.3f} | {o['latency_ms']:.0f}ms |")
    for name, c in found["combos"].items():
        if c.get("by_category"):
            lines += ["", f"## {name}", "", "| category | queries | recall | precision | MRR |", "|-|-|-|-|-|"]
            lines += [f"| {k} | {v['queries']} | {v['recall']:.3f} | {v['precision']:.3f} | {v['mrr']:.3f} |" for k, v in c["by_category"].items()]
    return "\n".join(lines) + "\n"


def write_report(found: dict, folder: str | Path) -> tuple[Path, Path]:
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    stem = folder / f"eval_{found['timestamp']}"
    stem.with_suffix(".json").write_text(json.dumps(found, indent=2, ensure_ascii=False), encoding="utf-8")
    stem.with_suffix(".md").write_text(markdown(found), encoding="utf-8")
    return stem.with_suffix(".json"), stem.with_suffix(".md")


#: Queries that are run alone to measure latencies.
LONE = 5


def lone_latencies(store, queries: DataFrame, combos: Iterable[str] = EVAL_COMBOS, k: int = K, model: Callable[[str], str] = model_of_collection, most: int = LONE) -> dict[str, float]:  # noqa: ANN001
    """Milliseconds that one query takes, by combination: the mean over the first `most` queries, each run alone.

    Collections and indexes are there before: a collection's lexical index is written first, and a first query that
    isn't counted warms up what the session keeps. Combinations whose collection has no rows are left out.
    """
    spark, lexical, found = queries.sparkSession, {}, {}
    ids = [r.query_id for r in queries.select("query_id").orderBy("query_id").limit(most).collect()]
    for combo in combos:
        collection, strategy = parse_combo(combo)
        if not ids or not store.count(collection):
            continue
        rows, how = store.read(collection), {}
        if "hybrid" in strategy:
            if collection not in lexical:
                lexical[collection] = BlockIndex.build(rows, f"{shared_dir(spark)}/latency-{uuid.uuid4().hex}")
            how = {"lexical": lexical[collection], "in_step": True}
        retriever, took = build_strategy(rows, strategy, model(collection), **how), []
        for i in (ids[0], *ids):
            alone = queries.where(F.col("query_id") == i)
            began = time.perf_counter()
            retriever.retrieve(alone, k).collect()
            took.append((time.perf_counter() - began) * 1000)
        found[combo] = sum(took[1:]) / len(ids)
    return found


def run(store, queries: DataFrame, folder: str | Path, version: str, combos: Iterable[str] = EVAL_COMBOS, k: int = K, model: Callable[[str], str] = model_of_collection, lone: int = LONE) -> tuple[Path, Path]:  # noqa: ANN001
    """The whole evaluation: preflight, all combinations at once, roll-ups, latencies of lone queries, and the report's two files.

    queries with a position have their categories reported in the order in which these first come.
    """
    combos = tuple(combos)
    preflight(queries, store.names(), combos)
    by_query, status = evaluate(store, queries, combos, k, model)
    order = [r.category for r in categories(queries).orderBy("first").collect()] if "position" in queries.columns else []
    latencies = lone_latencies(store, queries, combos, k, model, lone)
    return write_report(report(status, rollup(by_query), version, queries.count(), latencies, order=order), folder)
