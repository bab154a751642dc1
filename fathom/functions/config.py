"""Configurations as plain nested dicts."""

from __future__ import annotations

from typing import Any

# Levels of acoustic quality as (snr at least, dbv from, dbv to, correlation at least); difficult is like ok.
ACOUSTIC_LEVELS = {"good": (20.0, -26.0, -3.0, 60.0), "ok": (12.0, -36.0, -3.0, 45.0), "difficult": (12.0, -36.0, -3.0, 45.0)}

DEFAULT_FILTERS: dict[str, Any] = {
    "acoustic": {"enabled": True, "level": "ok"},
    "ping_replies": {"enabled": True, "min_replies": 3},
    "max_distance": {"enabled": True, "metres": 150.0},
    "wrms": {"enabled": True, "max_wrms": 15.0, "radius_seconds": 1.0},
}


def overlay(base: dict[str, Any], changes: dict[str, Any] | None) -> dict[str, Any]:
    """A copy of base with the values of changes laid over it, dict by dict; nulls and keys that base lacks are ignored."""
    out = {k: overlay(v, None) if isinstance(v, dict) else v for k, v in base.items()}
    for k, v in (changes or {}).items():
        if v is None or k not in out:
            continue
        out[k] = overlay(out[k], v) if isinstance(out[k], dict) and isinstance(v, dict) else v
    return out
