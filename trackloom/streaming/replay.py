"""Tables replayed as streams: parts land one after the other, each streamed by a query that starts from the last one's checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from trackloom.session import ship
from trackloom.sources.files import folder
from trackloom.streaming.collector import STATE_STORE


def replay(spark: SparkSession, parts: Iterable[DataFrame], transform: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """What `transform` makes of the parts as a stream, with state in RocksDB, as a table under `path`.

    Each part is a stop and a restart: its query reads what has landed since the checkpoint, keeps its state there and ends. A
    replay that was broken off goes on where it stood, as landed parts and the checkpoint stay.
    """
    ship(spark)
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        for n, part in enumerate(parts):
            landed = f"{path}/landed/part={n}"
            files, done = folder(spark, f"{landed}/_SUCCESS")
            if not files.exists(done):
                part.write.mode("overwrite").parquet(landed)
            rows = spark.readStream.schema(part.schema).option("recursiveFileLookup", True).parquet(f"{path}/landed")
            query = transform(rows).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    return spark.read.parquet(f"{path}/out")
