"""Small JSON documents and trained models kept on the file system Spark writes to."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session")
    return spark


def write_json(document: Mapping, path: str) -> None:
    text = json.dumps(document, sort_keys=True)
    _session().createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(path: str) -> dict:
    return json.loads(_session().read.text(path, wholetext=True).first()["value"])


def exists(path: str) -> bool:
    jvm = _session()._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = _session()._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


# Fixed value: the settings that decide what a trained model looks like.
HASHED_SECTIONS = (
    "models", "cleaner", "outliers", "multicollinearity", "pca", "encoder", "feature_engineering",
)


def source_state(path: str) -> list[tuple[str, int, int]]:
    """Name, length and modification time of every file a source path holds."""
    jvm = _session()._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(_session()._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    walk, out = fs.listFiles(target, True), []
    while walk.hasNext():
        f = walk.next()
        out.append((f.getPath().getName(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def frame_state(df: DataFrame) -> list:
    """Row count and two sums of row hashes; they follow any change of a row, a column or its type."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    row = df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftrightunsigned(h, 33))).first()
    return [df.dtypes, *row]


def config_hash(config: Mapping, source: str | None = None, data: DataFrame | None = None) -> str:
    """12 hex digits over the settings and, if given, the state of the source files or of the rows themselves."""
    relevant = {k: config[k] for k in HASHED_SECTIONS if k in config}
    relevant["loader"] = {k: v for k, v in config.get("loader", {}).items() if not k.endswith("_path")}
    if source is not None:
        relevant["source"] = source_state(source)
    elif data is not None:
        relevant["source"] = frame_state(data)
    text = json.dumps(relevant, sort_keys=True, default=str)
    return hashlib.md5(text.encode()).hexdigest()[:12]


def load_or_train(folder: str, name: str, digest: str, build: Callable):
    """(model, came from the store). A model is reused only under the same digest."""
    from ..operators.models import TrainedModel

    path = f"{folder.rstrip('/')}/{name}_{digest}"
    if exists(f"{path}/about"):
        return TrainedModel.load(path), True
    model = build()
    model.save(path)
    return model, False
