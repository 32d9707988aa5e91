"""CRC-32 in DuckDB SQL, for the checks of operators whose contract names it."""

#: Members of a WITH RECURSIVE: ``crc_table`` has one row, the list ``tab`` of the checksum's 256 steps, worked out bit by bit.
CRC_TABLE = """crc_bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_bits WHERE k = 8)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of the SQL expression ``text``, beside a column ``tab``."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({digits}) // 2), lambda i: CAST('0x' || substring({digits}, 2 * i + 1, 2) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), {step}), 4294967295)"
