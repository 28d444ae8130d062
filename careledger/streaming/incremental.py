"""Loading only the responses that landed since the last run."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame

from careledger.plans.facts import load_values
from careledger.session import shared_dir
from careledger.sources.landing import stream_landing
from careledger.sources.warehouse import Warehouse

Load = Callable[[Warehouse, DataFrame, dt.datetime], None]


def load_new(
    wh: Warehouse, landing: str, as_of: dt.datetime, load: Load = load_values,
    checkpoint: str | None = None, files_per_batch: int | None = None,
) -> None:
    """Load every response file not loaded yet, then stop.

    The checkpoint remembers which files are done, so a stopped run goes on where it was.
    A batch that is run again after a failure merges the same rows to the same result.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    # One folder of progress for each warehouse, landing folder and kind of load.
    key = hashlib.sha256(f"{wh.root}\n{landing.rstrip('/')}\n{load.__name__}".encode()).hexdigest()[:32]
    folder = checkpoint or f"{shared_dir(wh.spark)}/incremental/{key}"
    (
        stream_landing(wh.spark, landing, **options)
        .writeStream.foreachBatch(lambda batch, _: load(wh, batch, as_of))
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
