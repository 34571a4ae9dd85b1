"""Pieces of the SQL twins: CRC-32 and UTF-8 bytes, which DuckDB has no functions for."""

from __future__ import annotations


def crc_table() -> str:
    """A table expression `crc_table` with `crc`, the list of the 256 CRC-32 steps."""
    return """crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i)
)"""


def utf8(text: str) -> str:
    """The list of UTF-8 bytes of a text that is not null."""
    return f"""flatten(list_transform(string_split({text}, ''), lambda ch: CASE
      WHEN ch = '' THEN []::BIGINT[]
      WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
      WHEN unicode(ch) < 2048 THEN [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)]::BIGINT[]
      WHEN unicode(ch) < 65536 THEN
        [224 + (unicode(ch) >> 12), 128 + ((unicode(ch) >> 6) & 63), 128 + (unicode(ch) & 63)]::BIGINT[]
      ELSE [240 + (unicode(ch) >> 18), 128 + ((unicode(ch) >> 12) & 63), 128 + ((unicode(ch) >> 6) & 63),
            128 + (unicode(ch) & 63)]::BIGINT[] END))"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; `crc_table` must be among the tables."""
    return f"""xor(list_reduce([4294967295::BIGINT] || {utf8(text)},
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""
