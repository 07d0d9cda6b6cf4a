"""Places of words in texts held as bytes, for the operators that read whole texts in Python.

All characters beyond ASCII count as letters here, so a UTF-8 text can be cut byte by byte.
"""

from contextlib import contextmanager

import numpy as np
from pyspark.sql import SparkSession


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for first, last in ranges:
        found[first : last + 1] = True
    return found


#: Bytes of words of digits and letters, of either case, and of words of letters alone.
WORD_BYTES = _table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LETTER_BYTES = _table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def word_starts(body: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Where the maximal runs of ``letters`` begin."""
    inside = letters[body]
    return np.flatnonzero(inside[1:] > inside[:-1]) + 1 if not (len(inside) and inside[0]) else np.concatenate(([0], np.flatnonzero(inside[1:] > inside[:-1]) + 1))


def pieces(body: bytes, letters: np.ndarray, size: int = 1 << 20):
    """The text in pieces of about ``size`` bytes, cut where no word is divided, so that no list of all words is held."""
    start = 0
    while len(body) - start > size:
        end = start + size
        while end < len(body) and letters[body[end]]:  # to the end of the word, wherever that is
            ahead = np.flatnonzero(~letters[np.frombuffer(body, np.uint8, min(size, len(body) - end), end)])
            end = end + int(ahead[0]) if len(ahead) else min(end + size, len(body))
        yield body[start:end]
        start = end
    yield body[start:]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000):
    """Writes inside send Python workers at most so many rows at a time, which bounds what they and the executor hold of the texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
