"""Commands ``config-check`` and ``setup-local`` of this machine's configuration."""

from __future__ import annotations

import argparse
import itertools
import platform
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from brindle import __version__
from brindle.functions import record
from brindle.operators import config, local_setup
from brindle.sources import env_file as sources

#: The prefix of the keys that are no credentials.
PREFIX = "BRINDLE"


def _session() -> SparkSession:
    builder = SparkSession.builder.master("local[1]").appName("brindle").config("spark.ui.enabled", "false")
    return builder.config("spark.sql.shuffle.partitions", "1").getOrCreate()


def _resolve(spark: SparkSession, prefix: str, env_file: str | None, **overrides) -> dict[str, str | None]:
    rows = sources.source_rows("local", prefix, env_file, **overrides) or [("local", "override", "worker_id", None)]
    records = config.resolve(spark.createDataFrame(rows, config.SOURCES), prefix)
    return records.first().asDict()


def config_check(spark: SparkSession, prefix: str, env_file: str | None, strict: bool) -> int:
    """Print the report of the local configuration; its outcome code."""
    values = _resolve(spark, prefix, env_file)
    facts = (__version__, platform.python_version(), platform.system(), platform.platform(), values["worker_id"] or record.MISSING)
    for line, fact in zip(record.FACTS, facts):
        print(line.format(fact))
    fields = spark.createDataFrame([tuple(values[f] for f in ("cfg", *record.FIELDS))], ", ".join(f"{f} string" for f in ("cfg", *record.FIELDS)))
    probes = spark.createDataFrame(sources.probe_rows("local", values), config.PROBES)
    row = config.report(fields, probes, strict).first()
    for f in record.PATHS:
        print(row[f"{f}_line"])
    for c in record.CREDENTIALS:
        print(f"{c.upper()}: {row[f'{c}_label']}")
    if row["warns"]:
        print(record.WARNING)
    print(row["message"], file=sys.stderr if row["code"] else sys.stdout)
    return row["code"]


def setup_local(spark: SparkSession, prefix: str, env_file: str | None, create: bool, **overrides) -> int:
    """Create the local folders, and the env file if asked to; the outcome code."""
    there = env_file is not None and Path(env_file).exists()
    if env_file is not None and not there and not create:
        raise sources.ConfigurationError(record.NO_ENV_FILE, env_file)
    values = _resolve(spark, prefix, env_file if there else None, **overrides)
    local_setup.check_preconditions(values)
    local_setup.make_folders(values)
    created = False
    if create:
        if env_file is None:
            raise sources.ConfigurationError(record.SETUP_NO_TARGET)
        created = local_setup.create_env_file(env_file, values, prefix)
    for line, field in itertools.zip_longest(record.SETUP_LINES, record.REQUIRED):
        print(line.format(values.get(field)))
    if env_file is not None:
        print(record.ENV_CREATED if created else record.ENV_KEPT)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("brindle", description="Setup and check of a local configuration.")
    top.add_argument("--prefix", default=PREFIX, help="prefix of the configuration's keys")
    commands = top.add_subparsers(dest="command")
    check = commands.add_parser("config-check", help="validate the configuration without showing credentials")
    check.add_argument("--env-file")
    check.add_argument("--require-service-credentials", action="store_true")
    setup = commands.add_parser("setup-local", help="create the local output folders")
    for name in ("--worker-id", "--data-root", "--pdf-source-dir", "--env-file"):
        setup.add_argument(name)
    setup.add_argument("--create-env-if-missing", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command is None:
        parser().print_help()
        return 0
    try:
        spark = spark or _session()
        if args.command == "config-check":
            return config_check(spark, args.prefix, args.env_file, args.require_service_credentials)
        names = ("worker_id", "data_root", "pdf_source_dir")
        return setup_local(spark, args.prefix, args.env_file, args.create_env_if_missing, **{n: getattr(args, n) for n in names})
    except sources.ConfigurationError as error:
        print(error, file=sys.stderr)
        return error.code
