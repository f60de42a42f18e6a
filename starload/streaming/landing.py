"""Staging load as a stream: landing files are appended once, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.plans.warehouse import Warehouse, load_staging
from starload.schemas import PROJECT_LANDING
from starload.sources.files import _json_reader, _refuse_corrupt


def append_landed(spark: SparkSession, warehouse: Warehouse, folder: str, checkpoint: str, files_per_batch: int = 1000):
    """Append the landing files not seen before to staging, then stop.

    ``folder`` is laid out as ``param=<value>/*.json``. The checkpoint remembers the files;
    a batch repeated after a failure adds no row that staging holds already. A record that cannot be parsed
    fails the stream, as it fails a batch load.
    """
    fields = T.StructType(PROJECT_LANDING.fields + [T.StructField("param", T.StringType())])

    def append(batch: DataFrame, batch_id: int) -> None:
        nested = _refuse_corrupt(batch).withColumnRenamed("param", "nomeArquivo")
        fresh = load_staging(nested, f"{warehouse.root}/stream")
        warehouse.append(fresh)
        warehouse.finish("stream", list(fresh))

    query = (
        _json_reader(spark, fields, multi_line=False, stream=True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(append)
        .start()
    )
    query.awaitTermination()
    return query
