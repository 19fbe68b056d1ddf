"""ASCII-lower-cased words of UTF-8 text, as bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Word bytes are ASCII digits and letters (lower-cased) and all bytes of non-ASCII characters;
#: any other byte parts words.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words(data: bytes) -> list[bytes]:
    return data.translate(_WORD).split()


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a part's texts have about ``size`` bytes (one text at least), which
    bounds what a task holds of them in Python."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            limit = (ends[start - 1] if start else 0) + size
            end = max(start + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(start, end - start)
            start = end
