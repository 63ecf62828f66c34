"""Train a small model on a bounded sample in one task, away from the driver."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from catalens.llm.tasks import map_batches


def weights_of(sample: DataFrame, fit: Callable[[pa.Table], dict[str, float]]) -> dict[str, float]:
    """The named weights ``fit`` gives for the sample's rows; an empty sample gives none.

    The caller bounds the sample; the driver receives the weights alone. A lost executor repeats the task.
    """
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            found = fit(pa.Table.from_batches(held))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.float64())], names=["name", "weight"]
            )

    found = map_batches(sample.repartition(1), run, "name string, weight double")
    return {r.name: r.weight for r in found.collect()}
