"""A store of immutable Parquet parts and one pointer file.

A part is a folder that one batch wrote for one table. `CURRENT.json` names the parts in use; publishing writes new
parts and then replaces that file, so that all tables change at once or not at all. Parts of a batch are read without
touching those of others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finlake.operators.evidence import attest, is_recorded
from finlake.sources.files import Files, LocalFiles, files_of


class StateIntegrityError(RuntimeError):
    """The recorded state can't be used without a decision."""


class ClaimsIntegrityError(RuntimeError):
    """Claims aren't what was recorded for them."""


class ArtifactIntegrityError(RuntimeError):
    """Published rows aren't what was recorded for them."""


ALL = "_all"
#: Parts written at a time.
AT_ONCE = 6
#: How errors about parts that are gone, or aren't whole Parquet files, begin.
UNREADABLE = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "CANNOT_READ", "UNABLE_TO_INFER", "_LEGACY_ERROR_TEMP_20")


def write_json(path: Path, value: dict) -> None:
    """Whole or not at all, on a local disk."""
    LocalFiles().replace(str(path), json.dumps(value, indent=2, sort_keys=True))


class Store:
    """`root` is a folder that all machines mount under one path, or a URI that Spark and Hadoop reach."""

    def __init__(self, spark: SparkSession, root: str | Path, files: Files | None = None):
        self.spark, self.root = spark, str(root).rstrip("/")
        self.files = files or files_of(spark, self.root)

    def at(self, *names: str) -> str:
        return "/".join([self.root, *names])

    def exists(self, *names: str) -> bool:
        return self.files.exists(self.at(*names))

    def json(self, *names: str) -> dict:
        """A JSON object that the store wrote; anything else is a state that can't be used."""
        try:
            found = json.loads(self.files.text(self.at(*names)))
        except (ValueError, OSError) as e:
            raise StateIntegrityError(f"STATE_INVALID: {names[-1]} can't be read") from e
        if not isinstance(found, dict):
            raise StateIntegrityError(f"STATE_INVALID: {names[-1]} holds no object")
        return found

    def write(self, value: dict, *names: str) -> None:
        self.files.replace(self.at(*names), json.dumps(value, indent=2, sort_keys=True))

    def remove(self, *names: str) -> None:
        self.files.remove(self.at(*names))

    def state(self) -> dict:
        if not self.exists("CURRENT.json"):
            return {"version": 0, "tables": {}, "batches": {}, "watermark": None}
        found = self.json("CURRENT.json")
        try:
            old = [b for b in found["batches"].values() if "arrival" not in b]
            if len(old) == len(found["batches"]) == 1:
                old[0]["arrival"] = 1  # written before arrivals were kept: the only batch came first
            elif old:
                raise StateIntegrityError("STATE_MIGRATION_REQUIRED: batches without an arrival have no order; replay all deliveries in theirs into an empty store")
            arrivals = [b["arrival"] for b in found["batches"].values()]
            _ = found["version"], found["tables"], found["watermark"]
        except (KeyError, TypeError, AttributeError) as e:
            raise StateIntegrityError("STATE_INVALID: CURRENT.json lacks something") from e
        if any(not isinstance(a, int) or isinstance(a, bool) or a < 1 for a in arrivals) or len(set(arrivals)) != len(arrivals):
            raise StateIntegrityError("STATE_ARRIVAL_SEQUENCE_INVALID: arrivals aren't unique positive integers")
        return found

    def stage(self, state: dict, table: str, part: str, frame: DataFrame, keys: list[str]) -> DataFrame:
        """Writes a new part and records it, with its attestation as read back, in `state` (not yet published)."""
        path = f"parts/{table}/{part}-{uuid.uuid4().hex}"
        frame.write.parquet(self.at(path))
        back = self.spark.read.schema(frame.schema).parquet(self.at(path))
        state["tables"].setdefault(table, {})[part] = {"path": path, "files": self.files.listing(self.at(path)), "schema": json.loads(back.schema.json()), "keys": keys, **attest(back, keys, lanes=True).first().asDict()}
        return back

    def stage_all(self, state: dict, parts: list[tuple[str, str, DataFrame, list[str]]]) -> list[DataFrame]:
        """`stage` for parts that don't depend on one another, some at a time: the cluster is busy with all of them."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(pool.map(lambda p: self.stage(state, *p), parts))

    def ordered(self, state: dict, table: str, keys: list[str]) -> DataFrame:
        """A table in the order that it is shown in: by `keys`, which tell its rows apart."""
        return self.read(state, table).orderBy(*[F.col(k).asc_nulls_first() for k in keys])

    def parts(self, state: dict, table: str, among: list[str] | None = None, without: list[str] | None = None) -> list[dict]:
        held = state["tables"].get(table, {})
        return [p for name, p in sorted(held.items()) if (among is None or name in among) and name not in (without or [])]

    def read(self, state: dict, table: str, among: list[str] | None = None, without: list[str] | None = None, like: DataFrame | None = None) -> DataFrame:
        """Rows of the table's parts; an empty frame like `like` where there are none."""
        found = self.parts(state, table, among, without)
        if not found:
            if like is None:
                raise KeyError(table)
            return self.spark.createDataFrame([], like.schema)
        schema = StructType.fromJson(found[0]["schema"])
        return self.spark.read.schema(schema).parquet(*[self.at(p["path"]) for p in found])

    def verify(self, state: dict, part: str, read: Callable[[str], bool] = lambda table: True) -> list[str]:
        """Tables whose part of that name isn't what was recorded: by its files' names and sizes, and for tables that `read`
        names (those that a run is going to read) by its rows."""
        return [table for table, parts in sorted(state["tables"].items()) if part in parts and self.verify_part(state, table, part, read(table))]

    def verify_part(self, state: dict, table: str, part: str, rows: bool) -> bool:
        """Whether a part isn't what was recorded, by its files and, if so wanted, by its rows."""
        held = state["tables"][table][part]
        return ("files" in held and self.files.listing(self.at(held["path"])) != held["files"]) or (rows and not self._as_recorded(held))

    def _as_recorded(self, held: dict) -> bool:
        frame = self.spark.read.schema(StructType.fromJson(held["schema"])).parquet(self.at(held["path"]))
        now = self.attempt(lambda: attest(frame, held["keys"], lanes="set_digest" in held).first().asDict())
        return now is not None and is_recorded(now, held)

    @staticmethod
    def attempt(read: Callable[[], dict]) -> dict | None:
        """What `read` gives; None where parts are gone or aren't whole Parquet files."""
        try:
            return read()
        except PySparkException as e:
            if not str(e.getCondition()).startswith(UNREADABLE):
                raise  # a machine's trouble says nothing about the part
            return None

    def drop(self, state: dict, part: str) -> None:
        for parts in state["tables"].values():
            parts.pop(part, None)

    def commit(self, state: dict) -> None:
        self.write(state | {"version": state["version"] + 1}, "CURRENT.json")

    def inflight(self) -> dict | None:
        if not self.exists("inflight.json"):
            return None
        found = self.json("inflight.json")
        if not {"batch_id", "fingerprint"} <= set(found):
            raise StateIntegrityError("STATE_INVALID: inflight.json lacks something")
        return found

    def mark(self, value: dict | None) -> None:
        self.remove("inflight.json") if value is None else self.write(value, "inflight.json")
