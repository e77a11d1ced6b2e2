"""Pieces of DuckDB SQL that several oracle queries use."""

from __future__ import annotations

# CTE: the 256 remainders of the reflected polynomial of CRC-32.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([n::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
           CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)
         ORDER BY n) AS t
  FROM range(256) r(n)
)"""


def crc32_sql(text: str, table: str = "t") -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text; table holds CRC_TABLE's list."""
    digits = f"hex(encode({text}))"
    byte = (
        f"(16 * (instr('0123456789ABCDEF', {digits}[2 * i - 1]) - 1)"
        f" + instr('0123456789ABCDEF', {digits}[2 * i]) - 1)::UBIGINT"
    )
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})"
    step = f"xor(a >> 8, {table}[(xor(a, b) & 255)::INT + 1])"
    start = "[4294967295::UBIGINT]"
    folded = f"list_reduce(list_concat({start}, {octets}), lambda a, b: {step})"
    return f"xor({folded}, 4294967295::UBIGINT)::BIGINT"
