"""Command line, configuration and log of the jobs."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from dataclasses import fields
from typing import Any

from pyspark.sql import SparkSession

log = logging.getLogger("jobs")


def read_config(kind: type, text: str, **given: Any):
    """``kind``, a dataclass, from JSON text; what is given (and not None) goes first.  An unknown key is an error."""
    raw = json.loads(text) | {k: v for k, v in given.items() if v is not None}
    if extra := set(raw) - {f.name for f in fields(kind)}:
        raise ValueError(f"unknown settings: {', '.join(sorted(extra))}")
    return kind(**raw)


def command_line(kind: type, run: Callable[[SparkSession, Any], Any], description: str, argv: list[str] | None = None) -> None:
    """Settings from ``--config`` and flags of the same names; starts a session, runs, and stops it."""
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--config", required=True, help="a JSON file of settings; flags go first")
    for f in fields(kind):
        parser.add_argument(f"--{f.name.replace('_', '-')}", type={"int": int, "float": float}.get(str(f.type), str))
    given = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(description.split(".")[0]).getOrCreate()
    try:
        where = given.pop("config")
        text = "\n".join(r["value"] for r in spark.read.text(where, wholetext=True).collect())  # one file
        run(spark, read_config(kind, text, **given))
    finally:
        spark.stop()
