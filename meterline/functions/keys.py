"""Purpose-bound pseudonyms."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline.fixed_values import KEY_PREFIXES

_BLOCK = 64
SHORTEST_SECRET = 32


def hmac_sha256_hex(message: Column, secret: str) -> Column:
    """HMAC-SHA256 of a string column as lower-case hex, from two nested digests."""
    key = secret.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner = F.lit(bytes(byte ^ 0x36 for byte in key))
    outer = F.lit(bytes(byte ^ 0x5C for byte in key))
    first = F.sha2(F.concat(inner, F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(outer, F.unhex(first)), 256)


def analysis_key(domain: str, raw_id: Column, secret: str) -> Column:
    """Stable key of one domain; a missing or empty id stays missing."""
    if len(secret) < SHORTEST_SECRET:
        raise ValueError(f"a pseudonymisation secret of {SHORTEST_SECRET} characters or more is required")
    digest = hmac_sha256_hex(F.concat(F.lit(domain + ":"), raw_id), secret)
    key = F.concat(F.lit(KEY_PREFIXES[domain]), F.upper(F.substring(digest, 1, 24)))
    return F.when(raw_id != "", key)


def key_pattern(domain: str) -> str:
    return f"^{KEY_PREFIXES[domain]}[0-9A-F]{{24}}$"
