"""crc32 in DuckDB's SQL, which has no function for it."""

from __future__ import annotations

#: crc32 for DuckDB: the table of a byte's effect, and a macro over a text of Latin-1 letters, digits and signs.
CRC32_SQL = """
WITH RECURSIVE crc_steps AS (
  SELECT i AS byte, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM crc_steps WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """An expression for the crc32 of a text's UTF-8 bytes; crc_table's t has to be in scope."""
    points = f"list_transform(string_split({text}, ''), lambda s: unicode(s))"
    octets = f"flatten(list_transform({points}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 | (u >> 6), 128 | (u & 63)] END))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(CAST(c AS BIGINT) >> 8, t[CAST(xor(CAST(c AS BIGINT), b) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
