"""Whether an owner's 32-byte key is a point of the ed25519 curve: keys that are none belong to programs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The field's prime and the curve's constant; the alphabet of base 58.
PRIME = 2**255 - 19
D = -121665 * pow(121666, -1, PRIME) % PRIME
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def key_bytes(text: str | None) -> bytes | None:
    """Bytes of a base-58 text; null if a character is foreign to it."""
    if not text or any(c not in ALPHABET for c in text):
        return None
    number = 0
    for c in text:
        number = number * 58 + ALPHABET.index(c)
    return b"\0" * (len(text) - len(text.lstrip("1"))) + number.to_bytes(-(-number.bit_length() // 8), "big")


def is_point(key: bytes | None) -> bool | None:
    """x^2 = (y^2 - 1) / (d y^2 + 1) has a root; null for anything but 32 bytes."""
    if key is None or len(key) != 32:
        return None
    y = int.from_bytes(key, "little") & (2**255 - 1)
    if y >= PRIME:
        return False
    u, v = (y * y - 1) % PRIME, (D * y * y + 1) % PRIME
    square = u * pow(v, -1, PRIME) % PRIME
    sign = key[31] >> 7
    return (not sign) if square == 0 else pow(square, (PRIME - 1) // 2, PRIME) == 1


def on_curve(address: Column) -> Column:
    """true, false, or null where the address is no 32-byte key."""

    @F.pandas_udf("boolean")
    def test(texts: pd.Series) -> pd.Series:
        return pd.Series([is_point(key_bytes(x)) for x in texts], dtype=object)

    return test(address)
