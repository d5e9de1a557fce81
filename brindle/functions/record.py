"""The configuration record and the expressions over it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields of a record, in order; those that derive from data_root when null; credentials, in report order.
PREFIXED_FIELDS = ("worker_id", "data_root", "pdf_source_dir", "runs_dir", "cache_dir", "exports_dir", "logs_dir")
CREDENTIALS = ("gemini_api_key", "openai_api_key", "ncbi_api_key", "ncbi_email")
FIELDS = PREFIXED_FIELDS + CREDENTIALS
REQUIRED = ("worker_id", "data_root", "pdf_source_dir")
DERIVED = {"runs_dir": "runs", "cache_dir": "cache", "exports_dir": "exports", "logs_dir": "logs"}

# Labels, and the report's names of the six paths with the access that each needs.
SET, MISSING = "gesetzt", "fehlt"
ABSENT, NO_DIRECTORY = "existiert nicht", "ist kein Verzeichnis"
DENIED = {"w": "nicht beschreibbar", "r": "nicht lesbar"}
GOOD = {"w": "vorhanden, beschreibbar", "r": "vorhanden, lesbar"}
PATHS = {
    "data_root": ("Datenwurzel", "w"),
    "pdf_source_dir": ("PDF-Quellordner", "r"),
    "runs_dir": ("Runs-Verzeichnis", "w"),
    "cache_dir": ("Cache-Verzeichnis", "w"),
    "exports_dir": ("Export-Verzeichnis", "w"),
    "logs_dir": ("Log-Verzeichnis", "w"),
}

# Outcome codes and messages, in the order in which they are decided.
MISSING_LOCAL = (2, "Erforderliche lokale Konfiguration fehlt.")
BAD_PATH = (3, "Mindestens ein lokaler Pfad ist ungültig.")
MISSING_CREDENTIALS = (2, "Erforderliche Service-Zugangsdaten fehlen.")
VALID = (0, "Lokale Grundkonfiguration ist gültig.")
WARNING = "Warnung: Externe Service-Zugangsdaten sind teilweise nicht gesetzt."

# What stops loading and setup, with exit codes.
NO_ENV_FILE = (2, "Konfigurationsfehler: env-Datei nicht gefunden: {}")
INVALID_SETTINGS = (2, "Konfigurationsfehler: ungültige lokale Einstellungen.")
SETUP_NEEDS = (2, "Worker-ID, Datenwurzel und PDF-Quellordner sind erforderlich.")
SETUP_NO_SOURCE = (3, "PDF-Quellordner fehlt oder ist nicht lesbar.")
SETUP_NO_ROOT = (3, "Datenwurzel ist nicht beschreibbar.")
SETUP_NO_TARGET = (2, "--create-env-if-missing erfordert --env-file.")

# Further lines of the two commands.
FACTS = ("Version: {}", "Python-Version: {}", "Betriebssystem: {}", "Plattform: {}", "Worker-ID: {}")
SETUP_LINES = ("Worker-ID: {}", "Datenwurzel: {}", "PDF-Quellordner: {}", "Lokale Verzeichnisse sind bereit: runs, cache, exports, logs.")
ENV_CREATED, ENV_KEPT = "Lokale env-Datei wurde erstellt.", "Vorhandene env-Datei blieb unverändert."


def aliases(prefix: str) -> dict[str, tuple[str, int]]:
    """Accepted keys, case-sensitive: the field that each names, and its rank among that field's keys.

    ``prefix`` stands before the names of the fields that are no credentials."""
    out = {}
    for field in FIELDS:
        upper = field.upper() if field in CREDENTIALS else f"{prefix}_{field.upper()}"
        out |= {upper: (field, 0), field: (field, 1)}
    return out


def present(value: Column) -> Column:
    """Label of a value that is set or missing."""
    return F.when(value.isNotNull(), F.lit(SET)).otherwise(F.lit(MISSING))


def normal_path(path: Column) -> Column:
    """A path as ``pathlib`` writes it: without empty and "." parts and without a slash at its end; "." if nothing is left. Two slashes
    at its beginning stay, more are one."""
    parts = F.filter(F.split(path, "/+"), lambda x: (x != "") & (x != "."))
    lead = F.when(path.rlike("^//([^/]|$)"), F.lit("//")).when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    whole = F.concat(lead, F.array_join(parts, "/"))
    return F.when(whole == "", F.lit(".")).otherwise(whole)


def join_path(root: Column, name: str) -> Column:
    """``name`` in the folder ``root``, a normal path."""
    return F.when(root == ".", F.lit(name)).when(root.endswith("/"), F.concat(root, F.lit(name))).otherwise(F.concat(root, F.lit(f"/{name}")))


def path_state(path: Column, exists: Column, is_dir: Column, accessible: Column, access: str) -> Column:
    """struct(state, ok) of a path from what a probe found; the first condition that holds decides. A null finding
    counts as false."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    state = (
        F.when(path.isNull(), MISSING).when(no(exists), ABSENT).when(no(is_dir), NO_DIRECTORY).when(no(accessible), DENIED[access]).otherwise(GOOD[access])
    )
    return F.struct(state.alias("state"), (state == GOOD[access]).alias("ok"))


def outcome(missing_local: Column, paths_ok: Column, missing_services: Column, strict: Column) -> Column:
    """struct(code, message): the first of the outcomes that applies."""
    pair = lambda x: F.struct(F.lit(x[0]).alias("code"), F.lit(x[1]).alias("message"))
    return (
        F.when(missing_local, pair(MISSING_LOCAL)).when(~paths_ok, pair(BAD_PATH)).when(strict & missing_services, pair(MISSING_CREDENTIALS)).otherwise(pair(VALID))
    )
