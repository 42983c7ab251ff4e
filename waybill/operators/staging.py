"""Tables of one run in the folder that all machines share: spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_collected: list[list[Shelf]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines of the cluster see: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder (tests); a cluster is refused."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if known:
        return known.rstrip("/")
    if "path" not in _local:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        _local["path"] = "file://" + tempfile.mkdtemp(prefix="waybill-")
    return _local["path"]


class Shelf:
    """Tables of one run in the shared folder. Writing one cuts the lineage: a lost executor
    costs a re-read of the table, not of what led to it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/waybill-{label}-{uuid.uuid4().hex[:12]}"
        if _collected:
            _collected[-1].append(self)

    def put(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that no later plan reads."""
        for name in names:
            self._remove(f"{self.root}/{name}")

    def clear(self) -> None:
        """Remove all tables, once nothing reads them any more."""
        self._remove(self.root)

    def _remove(self, place: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def cleared_afterwards() -> Iterator[None]:
    """Shelves that come to be within the block are cleared at its end. What is to last must have been written
    elsewhere by then, as frames over these shelves cannot be read any more."""
    _collected.append([])
    try:
        yield
    finally:
        for shelf in _collected.pop():
            shelf.clear()
