"""Which loads of a table were folded together, as versioned files beside the data.

A fold is a folder of rows of many loads with the load id as a column.  A
version lists every fold with its loads; readers take the highest version,
so a change of versions shows all of a fold or nothing of it.  The lists hold
names only, about 50 bytes a load.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

#: Spark does not take folders with a leading underscore for data
FOLDER = "_folds"
#: column of a fold that names the load
LOAD = "_load"


@dataclass(frozen=True)
class Folds:
    """One version: the loads of each fold with the times they were written at."""

    version: int = 0
    folds: dict[str, dict[str, int]] = field(default_factory=dict)
    #: loads whose rows in a fold no longer count, as they were written again
    replaced: dict[str, list[str]] = field(default_factory=dict)

    @property
    def loads(self) -> dict[str, int]:
        return {load: at for loads in self.folds.values() for load, at in loads.items()}

    def without(self, load: str) -> "Folds":
        """The next version, in which a load is a folder of its own again."""
        folds, replaced = dict(self.folds), dict(self.replaced)
        for name, loads in self.folds.items():
            if load in loads:
                folds[name] = {k: v for k, v in loads.items() if k != load}
                replaced[name] = sorted({*replaced.get(name, []), load})
        return replace(self, version=self.version + 1, folds=folds, replaced=replaced)

    def merged(self, gone: list[str], name: str, loads: dict[str, int]) -> "Folds":
        """The next version, in which the fold ``name`` stands for ``loads`` and for the folds ``gone``."""
        folds = {k: v for k, v in self.folds.items() if k not in gone} | {name: loads}
        replaced = {k: v for k, v in self.replaced.items() if k not in gone}
        return replace(self, version=self.version + 1, folds=folds, replaced=replaced)


def _place(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def fold_path(table_path: str, name: str) -> str:
    return f"{table_path}/{FOLDER}/{name}"


def entries(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder and the times of their last change; none if there is no such folder."""
    folder, fs = _place(spark, path)
    if not fs.exists(folder):
        return {}
    return {e.getPath().getName(): e.getModificationTime() for e in fs.listStatus(folder)}


def size_of(spark: SparkSession, path: str) -> int:
    folder, fs = _place(spark, path)
    return fs.getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = _place(spark, path)
    fs.delete(folder, True)


def current(spark: SparkSession, table_path: str) -> Folds:
    versions = [n for n in entries(spark, f"{table_path}/{FOLDER}") if n.endswith(".json")]
    if not versions:
        return Folds()
    file, fs = _place(spark, fold_path(table_path, max(versions)))
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Folds(**json.loads(text))


def commit(spark: SparkSession, table_path: str, state: Folds) -> None:
    """Make a version the current one: written beside, then renamed.

    A version that somebody else made first is not replaced; the caller then
    has worked on an old state and must start again.
    """
    name = f"{state.version:012d}.json"
    file, fs = _place(spark, fold_path(table_path, name))
    part, _ = _place(spark, fold_path(table_path, name + ".part"))
    out = fs.create(part, True)
    try:
        out.write(json.dumps(state.__dict__).encode())
    finally:
        out.close()
    if fs.exists(file) or not fs.rename(part, file):
        raise RuntimeError(f"{table_path}: version {state.version} of its folds exists already")
