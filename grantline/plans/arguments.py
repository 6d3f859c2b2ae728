"""Checks of pipeline arguments."""

import re

_VOLUME = re.compile("/Volumes/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+")


def volume_path(path: str) -> str:
    """Check ``/Volumes/catalog/schema/volume``; a trailing ``/`` is dropped."""
    path = path.strip().rstrip("/")
    if not _VOLUME.fullmatch(path):
        raise ValueError(f"not a /Volumes/catalog/schema/volume path: {path!r}")
    return path
