"""Arrow batches in and out of tasks, and word hashing on their raw bytes.

Everything here works on one slice of a batch at a time, so that the memory of a
Python worker is bounded by ``SLICE_BYTES`` (or by one text, where that is longer);
the batches themselves are bounded by ``BATCH_BYTES`` and one row.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 500_000
#: What Spark sends to a Python worker at once: 10,000 rows of long texts would be many times that, there and here.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so that it has an inverse mod 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once, over Spark's own file transfer.

    Workers need not have the repository on their path, or on their disk. The session's Arrow
    batches are bounded by ``BATCH_BYTES`` unless it names a bound of its own.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent.parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, and after it what it allocated goes back to the system.

    Spark keeps Python workers for later tasks; without this each keeps the most it ever needed.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return wrapped


def add_columns(
    df: DataFrame,
    fields: Sequence[StructField],
    text: str,
    start: Callable[[], Callable[[pa.Array], list]],
    size: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` and new columns computed from its text column, slice by slice.

    ``start()`` runs once per task and returns the function that turns a string
    array (NULL included) into one Arrow array per field. A column of ``df`` that has
    the name of a new one is replaced by it.
    """
    ship(df.sparkSession)
    new = {f.name for f in fields}
    kept = [c for c in df.columns if c not in new]
    width = len(kept)
    # A text that is kept anyway goes to the task once.
    place = kept.index(text) if text in kept else width
    more = [] if text in kept else [F.col(f"`{text}`").alias("__text")]
    source = df.select(*[F.col(f"`{c}`") for c in kept], *more)
    schema = StructType([*source.schema.fields[:width], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or start()
            for part in slices(batch, place, size):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], *work(part.column(place))], names=[f.name for f in schema.fields]
                )

    return source.mapInArrow(freeing(run), schema)


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have ``size`` bytes together, or one row."""
    offsets = text_offsets(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield batch.slice(row, end - row)
        row = end


def text_offsets(texts: pa.Array) -> np.ndarray:
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    return np.concatenate(([0], np.cumsum(lengths)))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row, and where each text begins (and the last one ends)."""
    filled = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(texts: pa.Array) -> list[str]:
    return pc.fill_null(texts, "").to_pylist()


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


# Words --------------------------------------------------------------------------------


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, set for the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes that part words: white space only, or everything in ASCII but letters and digits.
SPACES = byte_table((0x20, 0x20), (0x09, 0x0D))
NOT_WORD = byte_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run without parting bytes; a run stays in its text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~parts[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def run_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; runs are in order and do not overlap.

    Differences of prefix sums of byte * base^place, divided by base^begin, in blocks
    of runs, so that a very long text needs little more than its own size.
    """
    out = np.empty(len(begins), np.uint64)
    first = 0
    while first < len(begins):
        low = begins[first]
        last = max(int(np.searchsorted(ends, low + SLICE_BYTES, "right")), first + 1)
        high = ends[last - 1]
        places = np.full(high - low, _BASE, np.uint64)
        places[:1] = 1
        np.cumprod(places, out=places)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * places, out=sums[1:])
        b, e = begins[first:last] - low, ends[first:last] - low
        places[:] = _INVERSE
        places[:1] = 1
        np.cumprod(places, out=places)
        out[first:last] = (sums[e] - sums[b]) * places[b] + (e - b).astype(np.uint64)
        first = last
    return mix(out)


def words(texts: pa.Array, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased (A-Z) word, and where each text's words begin."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    begins, ends = runs(data, offsets, parts)
    return run_hashes(data, begins, ends), np.searchsorted(begins, offsets)
