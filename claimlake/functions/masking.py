"""Identifier masking. NULL stays NULL; hashes are lower-case hex."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mask_sha256(c: Column, salt: str = "") -> Column:
    """SHA-256 of the value; with a secret ``salt`` before it, the hashes of a small range
    of ids cannot be listed."""
    text = c.cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


def mask_md5(c: Column) -> Column:
    return F.md5(c.cast("string"))


MASKERS = {"sha256": mask_sha256, "md5": mask_md5}
