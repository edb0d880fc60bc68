"""A plain Python statement of what the parse paths should do, for comparison in tests."""

import json
from datetime import datetime, timezone

from tollgate.model import STANDARD_DEFAULTS

INT64 = range(-(2**63), 2**63)


def _reject(name):
    raise ValueError(f"not JSON: {name}")


def strict_json(data: bytes):
    """The document, or an error class. NaN and Infinity are not JSON."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None, "INVALID_UTF8"
    try:
        return json.loads(text, parse_constant=_reject), None
    except ValueError:
        return None, "INVALID_JSON"


def iso(text: str):
    try:
        moment = datetime.fromisoformat(text)
    except ValueError:
        return None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    # Exact microseconds since the epoch; the result may lie outside the years of datetime.
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def _fits(value, default) -> bool:
    if isinstance(default, str):
        return isinstance(value, str)
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return False
    if isinstance(default, float):
        return True
    return isinstance(value, int) and value in INT64


def standard(data: bytes):
    """(row, None) or (None, error)."""
    document, error = strict_json(data)
    if error:
        return None, error
    if not isinstance(document, dict):
        return None, "NOT_AN_OBJECT"
    moment = document.get("timestamp", "")
    if moment and not isinstance(moment, str):
        return None, "BAD_TIMESTAMP:timestamp"
    row = {"timestamp": iso(moment) if moment else None}
    for name, default in STANDARD_DEFAULTS.items():
        value = document.get(name, default)
        if value is not None and not _fits(value, default):
            return None, f"TYPE_MISMATCH:{name}"
        row[name] = float(value) if isinstance(default, float) and value is not None else value
    return row, None
