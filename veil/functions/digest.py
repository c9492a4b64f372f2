"""Salted digests. SHA-2 stays in the JVM; other algorithms go through one Arrow-batched UDF."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The algorithms and their digest sizes in bytes. SHAKE and BLAKE2 give any size up to theirs.
SHA2 = {"SHA224": 28, "SHA256": 32, "SHA384": 48, "SHA512": 64}
SHA3 = {"SHA3_224": 28, "SHA3_256": 32, "SHA3_384": 48, "SHA3_512": 64}
UP_TO = {"SHAKE128": 32, "SHAKE256": 64, "BLAKE2s": 32, "BLAKE2b": 64}
# The truncated forms of SHA-512.
SHA512_T = (28, 32)
ALGORITHMS = (*SHA2, *SHA3, *UP_TO)


def digest_size(algorithm: str, wanted: int | None) -> int:
    """The wanted size if the algorithm has it, else its largest."""
    if algorithm in UP_TO:
        return wanted if wanted and 0 < wanted <= UP_TO[algorithm] else UP_TO[algorithm]
    if algorithm == "SHA512" and wanted in SHA512_T:
        return wanted
    return (SHA2 | SHA3)[algorithm]


def salted_hash(
    col: Column,
    salt: str,
    salt_first: bool = False,
    algorithm: str = "SHA256",
    encode: str = "hex",
    size: int | None = None,
) -> Column:
    """Text digest of a value and a salt; null stays null.

    Values that are not strings are hashed in Spark's string form. A size the algorithm does not
    allow becomes its largest one.
    """
    raw = salted_digest(col, salt, salt_first, algorithm, size)
    if encode.lower() == "hex":
        return F.lower(F.hex(raw))
    # some session settings break base64 text into lines
    return F.translate(F.base64(raw), "\r\n", "")


def salted_digest(
    col: Column,
    salt: str | None,
    salt_first: bool = True,
    algorithm: str = "SHA256",
    size: int | None = None,
) -> Column:
    """Binary digest of a value and a salt; null stays null."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown hash algorithm {algorithm!r}; known: {', '.join(ALGORITHMS)}")
    size = digest_size(algorithm, size)
    text = col.cast("string")
    if salt:
        text = F.concat(F.lit(salt), text) if salt_first else F.concat(text, F.lit(salt))
    if SHA2.get(algorithm) == size:
        return F.unhex(F.sha2(text, size * 8))
    return _arrow_digest(algorithm, size)(text)


def _arrow_digest(algorithm: str, size: int) -> Callable:
    make, read = _hashlib_calls(algorithm, size)

    @F.pandas_udf("binary")
    def digest(values: pd.Series) -> pd.Series:
        return values.map(lambda v: read(make(v.encode("utf-8"))), na_action="ignore")

    return digest


def _hashlib_calls(algorithm: str, size: int) -> tuple[Callable, Callable]:
    if algorithm.startswith("SHAKE"):
        name = f"shake_{algorithm[5:]}"
        return lambda b: hashlib.new(name, b), lambda h: h.digest(size)
    if algorithm.startswith("BLAKE2"):
        family = algorithm.lower()
        return lambda b: getattr(hashlib, family)(b, digest_size=size), lambda h: h.digest()
    name = f"sha512_{size * 8}" if algorithm == "SHA512" else algorithm.lower()
    return lambda b: hashlib.new(name, b), lambda h: h.digest()
