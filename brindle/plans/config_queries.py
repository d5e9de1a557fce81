"""Queries over configuration records, with inline rows: the driver's tables hold no configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import record
from brindle.operators import config

PREFIX = "APP"
SOURCES = [
    ("full", "env_file", "APP_WORKER_ID", "from-file"),
    ("full", "environment", "APP_WORKER_ID", "from-environment"),
    ("full", "override", "worker_id", "from-argument"),
    ("full", "env_file", "APP_DATA_ROOT", "/d/"),
    ("full", "env_file", "APP_PDF_SOURCE_DIR", "/pdfs"),
    ("full", "env_file", "APP_RUNS_DIR", "/special/runs"),
    ("full", "env_file", "GEMINI_API_KEY", "set"),
    ("full", "env_file", "OPENAI_API_KEY", "set"),
    ("full", "env_file", "NCBI_API_KEY", "set"),
    ("full", "env_file", "NCBI_EMAIL", "set"),
    ("partial", "override", "worker_id", None),
    ("partial", "environment", "APP_WORKER_ID", ""),
    ("partial", "env_file", "APP_WORKER_ID", "from-file"),
    ("partial", "env_file", "worker_id", "second-name"),
    ("partial", "env_file", "APP_DATA_ROOT", "/e"),
    ("partial", "env_file", "APP_PDF_SOURCE_DIR", "/pdfs"),
    ("partial", "env_file", "GEMINI_API_KEY", "set"),
    ("partial", "env_file", "UNKNOWN", "x"),
    ("rootless", "env_file", "app_data_root", "/wrong-case"),
    ("rootless", "override", "worker_id", ""),
    ("unknown", "env_file", "UNKNOWN", "x"),
    ("no-name root", "override", "data_root", ""),
    ("here", "env_file", "APP_DATA_ROOT", "."),
    ("dots", "env_file", "APP_DATA_ROOT", "/a/./b/."),
    ("slashes", "environment", "APP_DATA_ROOT", "///a//b/"),
    ("two slashes", "environment", "APP_DATA_ROOT", "//a"),
    ("top", "environment", "APP_DATA_ROOT", "/"),
    ("up", "override", "data_root", "./x/../y"),
    ("up", "override", "logs_dir", "l//m/./"),
]
PROBES = [
    *(("full", f, True, True, True) for f in record.PATHS),
    ("partial", "data_root", True, True, True),
    ("partial", "pdf_source_dir", True, True, False),
    ("partial", "runs_dir", False, False, False),
    ("partial", "cache_dir", True, False, False),
    ("partial", "exports_dir", None, None, None),
    ("partial", "logs_dir", True, True, False),
]


def _sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, config.SOURCES)


def _records(spark: SparkSession) -> DataFrame:
    return config.resolve(_sources(spark), PREFIX)


def _report(spark: SparkSession, strict: bool = False) -> DataFrame:
    return config.report(_records(spark), spark.createDataFrame(PROBES, config.PROBES), strict)


def r1_resolve_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge, override, unknown key, empty value, alias and derivation rules together."""
    return _records(spark).select("cfg", *record.FIELDS)


def r7_path_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, path states and report lines."""
    return _report(spark).select("cfg", *(f"{c}_label" for c in record.CREDENTIALS), *(f"{f}_state" for f in record.PATHS), *(f"{f}_line" for f in record.PATHS))


def r13_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts and outcome codes, with and without required credentials."""
    both = [_report(spark, strict).withColumn("strict", F.lit(strict)) for strict in (False, True)]
    return both[0].unionByName(both[1]).select("cfg", "strict", "missing_local", "paths_ok", "missing_services", "code", "message", "warns")


def _literal(x) -> str:
    return "NULL" if x is None else str(x).upper() if isinstance(x, bool) else "'" + str(x).replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)


def _resolved_sql() -> str:
    names = [(k, f, rank) for k, (f, rank) in record.aliases(PREFIX).items()]
    pick = ", ".join(f"(SELECT value FROM known k WHERE k.cfg = c.cfg AND k.field = '{f}' ORDER BY prio, alias_rank LIMIT 1) AS {f}" for f in record.FIELDS)
    body = "array_to_string(list_filter(string_split_regex({0}, '/+'), lambda x: x <> '' AND x <> '.'), '/')"
    lead = "CASE WHEN regexp_matches({0}, '^//([^/]|$)') THEN '//' WHEN {0} LIKE '/%' THEN '/' ELSE '' END"
    whole = f"coalesce(nullif(({lead}) || {body}, ''), '.')"
    normal = ", ".join(f"CASE WHEN {f} IS NOT NULL THEN {whole.format(f)} END AS {f}" if f in record.PATHS else f for f in record.FIELDS)
    under = "CASE WHEN data_root = '.' THEN '{0}' WHEN data_root LIKE '%/' THEN data_root || '{0}' ELSE data_root || '/{0}' END"
    derive = ", ".join(f"coalesce({f}, {under.format(record.DERIVED[f])}) AS {f}" if f in record.DERIVED else f for f in record.FIELDS)
    return f"""
    sources(cfg, source, key, value) AS (VALUES {_values(SOURCES)}),
    names(key, field, alias_rank) AS (VALUES {_values(names)}),
    prios(source, prio) AS (VALUES ('override', 0), ('environment', 1), ('env_file', 2)),
    known AS (
        SELECT s.cfg, n.field, p.prio, n.alias_rank, s.value
        FROM sources s JOIN names n ON n.key = s.key JOIN prios p ON p.source = s.source
        WHERE s.value IS NOT NULL AND (s.source = 'override' OR s.value <> '')
    ),
    picked AS (SELECT c.cfg, {pick} FROM (SELECT DISTINCT cfg FROM sources) c),
    paths AS (SELECT cfg, {normal} FROM picked),
    resolved AS (SELECT cfg, {derive} FROM paths)
    """


def _report_sql(strict: str = "FALSE") -> str:
    states, lines = [], []
    for f, (label, access) in record.PATHS.items():
        probe = lambda x, f=f: f"coalesce((SELECT {x} FROM probes p WHERE p.cfg = r.cfg AND p.field = '{f}'), FALSE)"
        states.append(
            f"CASE WHEN r.{f} IS NULL THEN 'fehlt' WHEN NOT {probe('exists')} THEN 'existiert nicht' WHEN NOT {probe('is_dir')} THEN 'ist kein Verzeichnis' "
            f"WHEN NOT {probe('accessible')} THEN '{record.DENIED[access]}' ELSE '{record.GOOD[access]}' END AS {f}_state"
        )
        lines.append(f"'{label}: ' || coalesce({f}, 'fehlt') || ' (' || {f}_state || ')' AS {f}_line")
    labels = ", ".join(f"CASE WHEN {c} IS NULL THEN 'fehlt' ELSE 'gesetzt' END AS {c}_label" for c in record.CREDENTIALS)
    ok = " AND ".join(f"{f}_state LIKE 'vorhanden%'" for f in record.PATHS)
    null = lambda fields: " OR ".join(f"{f} IS NULL" for f in fields)
    return f"""WITH {_resolved_sql()},
    probes(cfg, field, exists, is_dir, accessible) AS (VALUES {_values(PROBES)}),
    states AS (SELECT r.*, {", ".join(states)} FROM resolved r),
    verdicts AS (SELECT *, {labels}, {", ".join(lines)}, ({null(record.REQUIRED)}) AS missing_local, ({ok}) AS paths_ok,
                 ({null(record.CREDENTIALS)}) AS missing_services FROM states)
    """


def _outcome_sql() -> str:
    code = "CASE WHEN missing_local THEN 2 WHEN NOT paths_ok THEN 3 WHEN strict AND missing_services THEN 2 ELSE 0 END"
    text = (
        f"CASE WHEN missing_local THEN '{record.MISSING_LOCAL[1]}' WHEN NOT paths_ok THEN '{record.BAD_PATH[1]}' "
        f"WHEN strict AND missing_services THEN '{record.MISSING_CREDENTIALS[1]}' ELSE '{record.VALID[1]}' END"
    )
    return f"""{_report_sql()} SELECT cfg, strict, missing_local, paths_ok, missing_services, {code} AS code, {text} AS message,
        ({code} = 0 AND missing_services) AS warns FROM verdicts, (VALUES (FALSE), (TRUE)) s(strict)"""


QUERIES = {"r1_resolve_records": r1_resolve_records, "r7_path_report": r7_path_report, "r13_outcome": r13_outcome}
ORACLE_SQL = {
    "r1_resolve_records": f"WITH {_resolved_sql()} SELECT cfg, {', '.join(record.FIELDS)} FROM resolved",
    "r7_path_report": f"""{_report_sql()} SELECT cfg, {", ".join([*(f"{c}_label" for c in record.CREDENTIALS), *(f"{f}_state" for f in record.PATHS), *(f"{f}_line" for f in record.PATHS)])} FROM verdicts""",
    "r13_outcome": _outcome_sql(),
}
