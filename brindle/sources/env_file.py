"""Configuration sources of this machine: overrides, the process environment, an env file. Driver-side only.

Credentials never enter a DataFrame: plans, logs and the UI print literals. Their values become the word ``set`` here."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from pathlib import Path

from brindle.functions import record

_LINE = re.compile(
    r"""^\s*(?:export\s+)?(?P<key>[^\s=#'"]+)\s*=\s*(?:'(?P<single>[^']*)'|"(?P<double>(?:[^"\\]|\\.)*)"|(?P<plain>[^\r\n]*?))\s*(?:(?<=\s|'|")\#.*)?$"""
)


class ConfigurationError(Exception):
    """A configuration that cannot be used: one of the (exit code, message) of ``record``, whose place is filled with ``what``."""

    def __init__(self, reason: tuple[int, str], what: object = ""):
        super().__init__(reason[1].format(what))
        self.code = reason[0]


def read_env_file(path: str | Path) -> dict[str, str]:
    """Keys and values of an env file; of repeated keys the last counts. Fails where there is no such file, where it cannot be
    read, and where it is no UTF-8."""
    path = Path(path)
    if not path.is_file():
        raise ConfigurationError(record.NO_ENV_FILE, path)
    try:
        text = path.read_text(encoding="utf-8")
    except (OSError, UnicodeDecodeError) as error:
        raise ConfigurationError(record.INVALID_SETTINGS) from error
    out = {}
    for line in text.splitlines():
        if line.lstrip().startswith("#") or not (m := _LINE.match(line)):
            continue
        if m["single"] is not None:
            value = m["single"]
        elif m["double"] is not None:
            value = re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t", "r": "\r"}.get(e[1], e[1]), m["double"])
        else:
            value = re.sub(r"\s+#.*$", "", m["plain"]).strip()
        out[m["key"]] = value
    return out


def source_rows(cfg: str, prefix: str, env_file: str | Path | None = None, environment: Mapping[str, str] | None = None, **overrides) -> list[tuple]:
    """Rows (cfg, source, key, value) of one configuration, with credentials masked."""
    names = record.aliases(prefix)
    sources = {
        "override": {k: None if v is None else str(v) for k, v in overrides.items()},
        "environment": dict(os.environ if environment is None else environment),
        "env_file": read_env_file(env_file) if env_file is not None else {},
    }
    rows = []
    for source, values in sources.items():
        for key, value in values.items():
            if key in names:
                secret = names[key][0] in record.CREDENTIALS
                rows.append((cfg, source, key, "set" if secret and value else value))
    return rows


def probe_rows(cfg: str, paths: Mapping[str, str | None]) -> list[tuple]:
    """Rows (cfg, field, exists, is_dir, accessible) of this machine's paths; each is tested for the one access it needs."""
    rows = []
    for field, (_, access) in record.PATHS.items():
        if (p := paths.get(field)) is not None:
            path = Path(p)
            rows.append((cfg, field, path.exists(), path.is_dir(), os.access(path, os.W_OK if access == "w" else os.R_OK)))
    return rows
