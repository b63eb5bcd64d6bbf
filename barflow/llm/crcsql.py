"""CRC32 in DuckDB SQL, byte by byte, for the statements that check the text operators."""

_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
_ENTRIES = "range(256)"
for _ in range(8):
    _ENTRIES = f"list_transform({_ENTRIES}, lambda c: {_BIT})"
#: A common table expression of one row: the 256 entries, as ``t``.
CRC_TABLE = f"crc_table AS (SELECT {_ENTRIES} AS t)"


def crc32_sql(text: str) -> str:
    """CRC32 of the UTF-8 bytes of ``text``, unsigned, in a query that also reads ``crc_table``."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda s: ('0x' || s)::BIGINT)"
    taken = f"list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)"
    return f"xor({taken}, 4294967295::BIGINT)"
