"""Tables made of parts whose common state is one manifest.

Every write puts new files into a new folder; nothing that a reader may be using is changed. A commit
then names, for all tables at once, the folder of every part: the parts that were written, and
for the others the folder they had before. Parts are prompt versions, ranges of keys, or both.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.merge import latest_per_key
from .manifest import Conflict, StateLog
from .tables import stage

_PART = "_part"


@dataclass(frozen=True)
class Snapshot:
    """One state of a store: the folder of every part of every table, and the tables' schemas."""

    number: int = 0
    parts: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)


class TableStore:
    """Tables under one folder: ``data`` holds the files, ``states`` the manifests."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._states = StateLog(spark, f"{self.folder}/states")
        self._data = StateLog(spark, f"{self.folder}/data")

    def snapshot(self, number: int | None = None) -> Snapshot:
        number, state = self._states.load(number)
        return Snapshot(number, state.get("parts", {}), state.get("schemas", {}))

    def read(self, table: str, parts: Sequence[str] | None = None, at: Snapshot | None = None) -> DataFrame:
        """A table, or some of its parts, as of ``at`` (default: now). Parts it does not have are empty."""
        at = at or self.snapshot()
        if table not in at.schemas:
            raise KeyError(f"no table {table} in {self.folder} at state {at.number}")
        schema = StructType.fromJson(json.loads(at.schemas[table]))
        held = at.parts.get(table, {})
        paths = [f"{self.folder}/data/{held[p]}" for p in (held if parts is None else parts) if p in held]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _written(self, table: str, df: DataFrame, part: Column) -> dict[str, str]:
        """Write rows by part into a new folder; ``part -> folder``.

        Rows are rebalanced by part, so a part has few files and a large one is spread over tasks.
        """
        folder = f"{table}-{uuid.uuid4().hex}"
        rows = df.withColumn(_PART, part.cast("string")).hint("rebalance", _PART)
        rows.write.option("compression", "zstd").partitionBy(_PART).parquet(f"{self.folder}/data/{folder}")
        names = [n for n in self._data.list(folder) if n.startswith(f"{_PART}=")]
        return {unquote(n.removeprefix(f"{_PART}=")): f"{folder}/{n}" for n in names}

    def _commit(self, base: Snapshot, parts: Mapping[str, Mapping[str, str]], tables: Mapping[str, DataFrame]) -> Snapshot:
        state = {
            "parts": {**base.parts, **parts},
            "schemas": {**base.schemas, **{name: df.schema.json() for name, df in tables.items()}},
        }
        number = self._states.store(base.number, state)
        return Snapshot(number, state["parts"], state["schemas"])

    def replace(
        self, tables: Mapping[str, DataFrame], part: str, keep: Sequence[str] | None = (), base: Snapshot | None = None
    ) -> Snapshot:
        """New contents for several tables in one step; a failure before its end changes none of them.

        Parts are the values of column ``part``. Of the old parts those in ``keep`` stay where they are unless
        they are written anew; ``None`` keeps all. Raises ``Conflict`` if another commit came between.
        """
        base = base or self.snapshot()
        parts = {}
        for name, df in tables.items():
            held = base.parts.get(name, {})
            kept = {p: path for p, path in held.items() if keep is None or p in keep}
            parts[name] = kept | self._written(name, df, F.col(part))
        return self._commit(base, parts, tables)

    def merge(
        self,
        table: str,
        updates: DataFrame,
        keys: Sequence[str],
        part: Column,
        newest_first: Sequence[Column],
        attempts: int = 3,
    ) -> Snapshot:
        """Put rows into a table by key, whole rows; of equal keys in ``updates`` the newest wins.

        ``part`` must follow from the keys. Only parts that get rows are read and written; the files of
        the others stay as they are. The first rows of a table meet nothing and are written at once.
        After a commit of somebody else the merge is made again on top of it.
        """
        names = [c for c in updates.columns if not c.startswith("_")]
        newest = latest_per_key(updates, keys, newest_first).select(*names)
        touched = None
        for left in reversed(range(attempts)):
            base = self.snapshot()
            rows = newest
            if table in base.schemas:
                if touched is None:
                    staged = stage(newest.withColumn(_PART, part.cast("string")), "updates")
                    touched = [r[0] for r in staged.select(_PART).distinct().collect()]
                    rows = newest = staged.drop(_PART)
                old = self.read(table, touched, base)
                rows = old.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)
            try:
                held = base.parts.get(table, {})
                return self._commit(base, {table: {**held, **self._written(table, rows, part)}}, {table: newest})
            except Conflict:
                if not left:
                    raise
        raise AssertionError("unreachable")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` states refers to; their names.

        To be called when no write is going on and no reader uses an older state.
        """
        numbers = sorted(self._states.numbers())[-keep:]
        used = {
            path.split("/")[0]
            for n in numbers for parts in self.snapshot(n).parts.values() for path in parts.values()
        }
        gone = [name for name in self._data.list() if name not in used]
        for name in gone:
            self._data.delete(name)
        return gone
