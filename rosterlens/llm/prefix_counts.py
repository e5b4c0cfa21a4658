"""Token counts by prefix dynamic programming.

The count of every prefix of a text is stored once, so a truncation ("how many
tokens are the first n bytes?") or a budget ("how many bytes fit into n
tokens?") is a lookup, and the text is never encoded again.

Defined results: null text is empty (0 bytes, 0 tokens); special strings inside
a text count as the library takes them; ids may be null or repeat; further
columns are ignored; an empty table gives an empty result. A text is held by
one task at a time, whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.textnum import blocks, text_buffers
from rosterlens.llm.tokens import PrefixCounts
from rosterlens.llm.work import ship_code

BLOCK_BYTES = 6_000_000


def _count(path: str, limit: int, full: bool):
    names = ["doc", "n_bytes", "n_tokens", "over_limit", "bytes_within_limit"] + ["prefix_counts"] * full

    def run(batches):
        counter = PrefixCounts.of(path)
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            rows = []
            for i, j in blocks(bounds, BLOCK_BYTES):
                for table in counter.tables(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]):
                    n = table.n_tokens
                    row = [table.n_bytes, n, n > limit, table.bytes_within(limit) if n > limit else table.n_bytes]
                    rows.append([*row, table.counts().astype("<i4").tobytes()] if full else row)
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()][:4 + full]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds))], names)
    return run


def prefix_token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                        limit: int = 512, full: bool = False) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, bytes_within_limit) per row; with
    ``full``, also ``prefix_counts``: a little-endian 32-bit count for each byte,
    that of the text up to and with it (inside a character: up to it).
    ``bytes_within_limit`` ends where the count first passes ``limit``."""
    ship_code(docs.sparkSession)
    schema = "doc long, n_bytes long, n_tokens long, over_limit boolean, bytes_within_limit long"
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _count(vocabulary, limit, full), schema + ", prefix_counts binary" * full).withColumnRenamed("doc", id_col)


def stored_tokens(prefix_counts: bytes, prefix: int) -> int:
    """Tokens of the first ``prefix`` bytes, from a stored column."""
    counts = np.frombuffer(prefix_counts, "<i4")
    return int(counts[min(prefix, len(counts)) - 1]) if prefix > 0 and len(counts) else 0
