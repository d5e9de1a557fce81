"""Configuration records: merging sources, deriving paths, reporting and judging.

Any number of configurations is resolved at once: one shuffle on their names, with partial aggregation before it."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import record

#: Precedence of sources: the smallest number wins.
PRIORITY = {"override": 0, "environment": 1, "env_file": 2}
SOURCES = "cfg string, source string, key string, value string"
PROBES = "cfg string, field string, exists boolean, is_dir boolean, accessible boolean"


def known_values(sources: DataFrame, prefix: str) -> DataFrame:
    """(cfg, field, rank, value), a row per row of ``sources``. A null field does not count: unknown keys, overrides that are null,
    and what is empty in the environment and in env files. The smallest rank wins."""
    names = record.aliases(prefix)
    field = F.create_map(*(F.lit(x) for key, (f, _) in names.items() for x in (key, f)))
    alias = F.create_map(*(F.lit(x) for key, (_, rank) in names.items() for x in (key, rank)))
    priority = F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv))
    value = F.when(F.col("source") == "override", F.col("value")).otherwise(F.nullif(F.col("value"), F.lit("")))
    counts = F.col("key").isin(*names) & F.col("source").isin(*PRIORITY) & value.isNotNull()
    rank = priority[F.col("source")] * 2 + alias[F.col("key")]
    return sources.select("cfg", F.when(counts, field[F.col("key")]).alias("field"), F.when(counts, rank).alias("rank"), value.alias("value"))


def merge(sources: DataFrame, prefix: str) -> DataFrame:
    """(cfg, fields...): one record per configuration that has any source row, be it of unknown keys alone; values by precedence,
    paths in normal form. One aggregation."""
    own = lambda f, x: F.when(F.col("field") == f, F.col(x))
    best = {f: F.min_by(own(f, "value"), own(f, "rank")) for f in record.FIELDS}
    paths = {f: record.normal_path(x) if f in record.PATHS else x for f, x in best.items()}
    return known_values(sources, prefix).groupBy("cfg").agg(*(x.alias(f) for f, x in paths.items()))


def derive_paths(records: DataFrame) -> DataFrame:
    """Null output paths follow from ``data_root``, if that is set."""
    root = F.col("data_root")
    return records.withColumns({f: F.coalesce(F.col(f), record.join_path(root, name)) for f, name in record.DERIVED.items()})


def resolve(sources: DataFrame, prefix: str) -> DataFrame:
    """Records from their sources, with derived paths."""
    return derive_paths(merge(sources, prefix))


def report(records: DataFrame, probes: DataFrame, strict: bool = False) -> DataFrame:
    """Per configuration: labels of credentials, states and lines of paths, the three verdicts, code and message.

    ``probes`` (:data:`PROBES`) says what was found at each path, on the machine that the configuration is for."""
    facts = probes.groupBy("cfg").agg(
        *(F.first(F.when(F.col("field") == f, F.struct("exists", "is_dir", "accessible")), ignorenulls=True).alias(f"p_{f}") for f in record.PATHS)
    )
    met = records.join(facts, "cfg", "left")
    states = {
        f"{f}_state": record.path_state(F.col(f), F.col(f"p_{f}.exists"), F.col(f"p_{f}.is_dir"), F.col(f"p_{f}.accessible"), access)
        for f, (_, access) in record.PATHS.items()
    }
    met = met.withColumns(states)
    lines = {
        f"{f}_line": F.concat(F.lit(f"{label}: "), F.coalesce(F.col(f), F.lit(record.MISSING)), F.lit(" ("), F.col(f"{f}_state.state"), F.lit(")"))
        for f, (label, _) in record.PATHS.items()
    }
    any_null = lambda fields: functools.reduce(lambda a, b: a | b, (F.col(f).isNull() for f in fields))
    met = met.withColumns(lines | {f"{c}_label": record.present(F.col(c)) for c in record.CREDENTIALS})
    met = met.withColumns({
        "missing_local": any_null(record.REQUIRED),
        "paths_ok": functools.reduce(lambda a, b: a & b, (F.col(f"{f}_state.ok") for f in record.PATHS)),
        "missing_services": any_null(record.CREDENTIALS),
    })
    result = record.outcome(F.col("missing_local"), F.col("paths_ok"), F.col("missing_services"), F.lit(strict))
    met = met.withColumn("result", result)
    return met.select(
        "cfg", *(f"{c}_label" for c in record.CREDENTIALS), *(F.col(f"{f}_state.state").alias(f"{f}_state") for f in record.PATHS),
        *lines, "missing_local", "paths_ok", "missing_services", F.col("result.code").alias("code"), F.col("result.message").alias("message"),
        ((F.col("result.code") == 0) & F.col("missing_services")).alias("warns"),
    )
