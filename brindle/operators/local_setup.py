"""Preparing this machine: preconditions, output folders, the env file. Driver-side effects only."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path

from brindle.functions import record
from brindle.sources.env_file import ConfigurationError


def check_preconditions(values: Mapping[str, str | None]) -> None:
    """The three required values are there, and the source folder can be read."""
    if any(values.get(f) is None for f in record.REQUIRED):
        raise ConfigurationError(record.SETUP_NEEDS)
    source = Path(values["pdf_source_dir"])
    if not (source.is_dir() and os.access(source, os.R_OK)):
        raise ConfigurationError(record.SETUP_NO_SOURCE)


def make_folders(values: Mapping[str, str | None]) -> None:
    """The data root and the four output folders; what is there stays as it is."""
    root = Path(values["data_root"])
    root.mkdir(parents=True, exist_ok=True)
    if not os.access(root, os.W_OK):
        raise ConfigurationError(record.SETUP_NO_ROOT)
    for field in record.DERIVED:
        Path(values[field]).mkdir(parents=True, exist_ok=True)


def create_env_file(target: str | Path, values: Mapping[str, str | None], prefix: str) -> bool:
    """Write a private env file with the required values and blanks for all others. False, and nothing is done, if
    there is one."""
    target = Path(target)
    if target.exists():
        return False
    target.parent.mkdir(parents=True, exist_ok=True)
    upper = [k for k, (_, rank) in record.aliases(prefix).items() if rank == 0]
    lines = ["# Local configuration. Never commit this file."]
    for key, field in zip(upper, record.FIELDS):
        if field == record.CREDENTIALS[0]:
            lines.append("")
        lines.append(f"{key}={(values.get(field) or '') if field in record.REQUIRED else ''}")
    with os.fdopen(os.open(target, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o600), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return True
