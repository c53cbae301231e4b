"""DuckDB SQL for functions that DuckDB lacks, for the statements beside the queries."""

from __future__ import annotations


def crc32_sql(number: str) -> str:
    """crc32 of a decimal number: bytes are xor-ed in, 256 stands for one shift."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST({number} AS VARCHAR), ''),
        lambda c: [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
        lambda c, e: CASE WHEN e < 256 THEN xor(c, e) WHEN c & 1 = 1
            THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)"""
