"""Names of the JSON-lines files of one instrument: ``<family>_records.<serial>.jsonl``."""

from __future__ import annotations

SUFFIX = ".jsonl"


def validated_serial(serial: str) -> str:
    """The serial without blanks around it; ValueError if it can't be part of a file's name."""
    value = serial.strip()
    if not value or "/" in value or "\\" in value:
        raise ValueError(f"not fit for a file name: {serial!r}")
    return value


def record_filename(family: str, serial: str) -> str:
    """``log_gps``, ``452.020-P-06`` -> ``log_gps_records.452.020-P-06.jsonl``."""
    return f"{family}_records.{validated_serial(serial)}{SUFFIX}"


def parsed_filename(name: str, families: tuple[str, ...]) -> tuple[str, str] | None:
    """(family, serial) of a canonical name; null for any other, also one without a serial."""
    base, _, serial = name.removesuffix(SUFFIX).partition("_records.")
    return (base, serial) if name.endswith(SUFFIX) and base in families and serial else None
