"""A map of how many documents hold a value, of fixed size, estimated from a bounded sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled

#: Cells of the map, a byte each: the size of what is broadcast, whatever the input.
CELLS = 1 << 23
#: Documents of the sample, chosen by a hash of the id.
SAMPLE = 20_000


def frequent(docs: DataFrame, values: Callable[[pa.Array], Iterator[np.ndarray]], sample: int = SAMPLE) -> bytes:
    """The map's bytes: 0, or twice the binary logarithm of how many of the sample's texts hold a value, if three of a quarter do.

    values gives each text's distinct 64-bit values. What is and isn't in the map may sway how work is dealt out and in
    which order values are tried, so only speed, never a result.
    """
    part = sampled(docs, sample).select("text").repartition(4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = set(), []
        for batch in batches:
            for own in values(batch.column(0)):
                if len(own) and (k := own.tobytes()) not in seen:
                    seen.add(k)
                    held.append(own)
        found, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
        often = counts >= 3
        yield pa.RecordBatch.from_arrays([pa.array((found[often] % np.uint64(CELLS)).astype(np.int32)), pa.array(counts[often].astype(np.int64))], names=["cell", "n"])

    held = part.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(CELLS, dtype=np.uint8)
    cells[held["cell"].to_numpy()] = np.log2(held["n"].to_numpy()) * 2
    return cells.tobytes()


def levels(data: bytes, values: np.ndarray) -> np.ndarray:
    """The map's byte for each value; 0 if it is not known to be frequent."""
    return np.frombuffer(data, dtype=np.uint8)[(values % np.uint64(CELLS)).astype(np.int64)]
