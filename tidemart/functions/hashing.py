"""Hash bucketing (S29-S30): used to salt hot keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions._col import as_col

__all__ = ["hash_mod", "hash_mod_128", "hash_mod_with_overrides", "HOT_KEY_BUCKETS"]

# ---- fixed values (must equal the source system's) -------------------------
# Hot addresses pinned to their own buckets (lower-case key -> bucket text):
HOT_KEY_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}
# -----------------------------------------------------------------------------


def hash_mod(x, n: int) -> Column:
    """Last 3 hex digits of md5(text) as an int, mod n, zero-padded to 4 digits."""
    tail = F.conv(F.substring(F.md5(as_col(x).cast("string")), 30, 3), 16, 10).cast("int")
    return F.lpad((tail % F.lit(n)).cast("string"), 4, "0")


def hash_mod_128(x) -> Column:
    """S29 ``btcHashMod``."""
    return hash_mod(x, 128)


def hash_mod_with_overrides(x, overrides: dict | None = None, n: int = 128) -> Column:
    """S30 ``ethHashMod``: pinned bucket for known hot keys, else :func:`hash_mod`."""
    table = HOT_KEY_BUCKETS if overrides is None else overrides
    pinned = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    return F.coalesce(F.element_at(pinned, F.lower(as_col(x).cast("string"))), hash_mod(x, n))
