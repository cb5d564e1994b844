"""Pieces of DuckDB SQL that several oracle statements share."""

from __future__ import annotations

#: CTE ``crc``: the 256 remainders of the CRC-32 polynomial, as one list ``t``
CRC_TABLE = """crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a string expression's UTF-8 bytes; ``crc.t`` must be in scope."""
    digits = f"hex(encode({text}))"
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(range(1, length({digits}), 2), "
            f"lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)), "
            "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)")


#: the lower-casing of A-Z alone
AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_az(text: str) -> str:
    return f"translate({text}, '{AZ}', '{az}')"
