"""Command line: extract, translate, splice, docs, verify and run over a source tree; results go to --out."""

from __future__ import annotations

import argparse
import importlib
import re
import sys

from pyspark.sql import SparkSession

from .durable import kept
from .operators import checks, memory
from .plans import pipeline
from .sources import readers

STEPS = {"extract": ("occurrences",), "translate": ("memory",), "splice": ("rewritten",), "docs": ("moves", "files"), "verify": ("findings",), "run": ("occurrences", "memory", "moves", "files", "findings")}


def repo_root(root: str, name: str | None) -> str:
    """The folder of a source tree; a name below root is a plain one: no separators, no dots alone."""
    if name is None:
        return root
    if not name or name in (".", "..") or re.search(r"[/\\]", name):
        raise ValueError(f"not a repository name: {name!r}")
    return f"{root.rstrip('/')}/{name}"


def plugin(place: str):
    """An engine from ``module:attribute`` (an engine, or a function that makes one)."""
    module, _, attribute = place.partition(":")
    found = getattr(importlib.import_module(module), attribute)
    return found if hasattr(found, "translate") or hasattr(found, "resolve") else found()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="polyseg", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("root", help="folder of the tree, or of several trees with --repo")
    parser.add_argument("--repo", help="name of one tree below root")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--memory", help="translation memory (JSON lines)")
    parser.add_argument("--dictionary", help="tab-separated dictionary")
    parser.add_argument("--glossary", help="terms that engines leave alone, one a line")
    parser.add_argument("--engine", default="dictionary", help="what follows the dictionary: module:attribute of a plug-in")
    parser.add_argument("--baseline", help="findings to leave out")
    parser.add_argument("--dry-run", action="store_true", help="plan the moves only")
    parser.add_argument("--skip-build", action="store_true", help="accepted for scripts: builds are never run here")
    args = parser.parse_args(argv)
    tree = repo_root(args.root, args.repo)
    spark = SparkSession.builder.appName("polyseg").getOrCreate()
    known = readers.read_memory(spark, args.memory) if args.memory else spark.createDataFrame([], readers.MEMORY)
    words = readers.read_dictionary(spark, args.dictionary) if args.dictionary else spark.createDataFrame([], "src_norm string, en string")
    engines = [memory.get_engine("dictionary", words)]
    if args.engine != "dictionary":
        engines.append(plugin(args.engine))
        if args.glossary and hasattr(engines[-1], "glossary"):
            engines[-1].glossary = readers.read_glossary(spark, args.glossary)
    out = {"findings": pipeline.verify(spark, tree)} if args.step == "verify" else pipeline.run(spark, tree, known, engines, args.dry_run)
    if args.dry_run and "moves" in out:
        out["moves"].show(1000, truncate=False)
        return 0
    if args.baseline:
        # once, as the baseline may stand where the findings go
        out["findings"] = kept(checks.against_baseline(out["findings"], readers.read_findings(spark, args.baseline)))
    for name in STEPS[args.step]:
        write = readers.write_memory if name == "memory" else readers.write_records
        write(out[name], f"{args.out}/{name}")
    if "findings" in STEPS[args.step]:
        checks.top_findings(out["findings"]).show(100, truncate=False)
        return int(not checks.verdict(out["findings"]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
