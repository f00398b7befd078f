"""Command line: python -m lexquarry.plans.cli FOLDER extract|chunk|embed|load|search|diagnose|repair|reprocess ..."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from lexquarry.operators import health
from lexquarry.plans.config import chunk_config, embed_config
from lexquarry.plans.pipeline import Pipeline

OK, FAILED, INTERRUPTED = 0, 1, 130


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexquarry", description=__doc__)
    p.add_argument("folder")
    p.add_argument("--log-file")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("extract")
    c.add_argument("source")
    c.add_argument("--flat", action="store_true")
    c.add_argument("--sample", type=int)
    c = sub.add_parser("chunk")
    c.add_argument("--max-tokens", type=int)
    c.add_argument("--overlap-tokens", type=int)
    c.add_argument("--min-words", type=int)
    c.add_argument("--sample", type=int)
    c = sub.add_parser("embed")
    c.add_argument("--dimensions", type=int)
    c.add_argument("--batch-size", type=int)
    c.add_argument("--sample", type=int)
    c = sub.add_parser("load")
    c.add_argument("--mode", choices=("insert_ignore", "upsert"), default="insert_ignore")
    c = sub.add_parser("search")
    c.add_argument("query")
    c.add_argument("--limit", type=int, default=5)
    c.add_argument("--namespace")
    c = sub.add_parser("diagnose")
    c.add_argument("--json", action="store_true")
    c.add_argument("--threshold", type=float, default=0.1)
    c = sub.add_parser("repair")
    c.add_argument("--stage", choices=health.STAGES)
    c = sub.add_parser("reprocess")
    c.add_argument("source")
    c.add_argument("--flat", action="store_true")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    logging.basicConfig(filename=a.log_file, level=logging.DEBUG if a.log_file else logging.WARNING)
    spark = spark or SparkSession.builder.appName("lexquarry").config("spark.sql.mapKeyDedupPolicy", "LAST_WIN").getOrCreate()
    given = {k: v for k, v in vars(a).items() if k in ("max_tokens", "overlap_tokens", "min_words", "dimensions", "batch_size") and v is not None}
    config = replace(chunk_config(), **given) if a.command == "chunk" else chunk_config()
    embedding = replace(embed_config(), **given) if a.command == "embed" else embed_config()
    p = Pipeline(spark, a.folder, config, embedding)
    try:
        if a.command in ("extract", "chunk", "embed", "load", "reprocess"):
            run = {"reprocess": lambda: p.reprocess_empty(a.source, flat=a.flat), "extract": lambda: p.extract(a.source, flat=a.flat, sample=a.sample), "chunk": lambda: p.chunk(a.sample), "embed": lambda: p.embed(a.sample), "load": lambda: p.load(a.mode)}
            result = run[a.command]()
            print(f"{result.stage}: {', '.join(f'{v} {k}' for k, v in result.counts.items())} in {result.seconds:.1f} s")
            return OK if result.ok else FAILED
        if a.command == "search":
            print(p.answer(a.query, a.limit, {"namespace": a.namespace} if a.namespace else None))
            return OK
        stages = p.stages()
        if a.command == "repair":
            for r in health.repairs(stages, stage=a.stage).toLocalIterator():
                print(f"{r.stage}\t{r.key}\t{r.action}")
            return OK
        if a.json:
            print(health.report(stages).first().report)
            return OK
        row = health.verdict(stages).first()
        print(", ".join(f"{k}: {v}" for k, v in row.asDict().items()))
        return OK if row.healthy else FAILED
    except KeyboardInterrupt:
        return INTERRUPTED
    except Exception:
        logging.exception("%s failed", a.command)
        print(f"{a.command} failed: {sys.exc_info()[1]}", file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
