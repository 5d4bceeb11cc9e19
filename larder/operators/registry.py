"""A registry of models: versions, stages, and loading by name and stage.

A model's registry is a log in a shared folder, one small JSON file per event, numbered from 1::

    <root>/<name>/000004.json   {"event": "stage", "version": 2, "stage": "production", "archived": [1]}

An event's file is created exclusively, so of two writers that try for the same number one
fails, reads the log again and tries the next: no version is given twice, no promotion is
lost, and the state follows from the log alone. An event that a dead writer left unfinished
counts as void. ``versions`` gives the state of all models as a DataFrame.

Exclusive creation is what HDFS and local file systems give for a create without overwrite; an
object store needs a connector with conditional writes.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators.model import ModelBundle, load_bundle
from larder.sources.storage import create_exclusively, list_children, read_text

# The stages a version can have.
STAGES = ("none", "staging", "production", "archived")
_NAME = re.compile(r"[A-Za-z0-9_.-]+")
_EVENTS = ("event string, version int, bundle string, description string, stage string, archived array<int>")


@dataclass(frozen=True)
class Version:
    name: str
    version: int
    bundle: str
    stage: str
    description: str


class ConcurrentWriter(RuntimeError):
    """Other writers took every event number that was tried."""


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str) -> str:
        if not _NAME.fullmatch(name):
            raise ValueError(f"a model name has letters, digits and _ . - only, got {name!r}")
        return f"{self.root}/{name}"

    def events(self, name: str) -> tuple[int, list[dict]]:
        """(last event number, events) of a model."""
        numbered = sorted((int(m.group(1)), p) for p in list_children(self.spark, self._folder(name))
                          if (m := re.search(r"/(\d{6})\.json$", p)))
        found = []
        for _, path in numbered:
            try:
                found.append(json.loads(read_text(self.spark, path)))
            except json.JSONDecodeError:
                continue                                # left unfinished
        return (numbered[-1][0] if numbered else 0), found

    def state(self, name: str) -> list[Version]:
        """All versions of a model, oldest first."""
        versions: dict[int, dict] = {}
        for e in self.events(name)[1]:
            if e["event"] == "register":
                versions[e["version"]] = {"bundle": e["bundle"], "description": e["description"], "stage": "none"}
            else:
                for v in e["archived"]:
                    versions[v]["stage"] = "archived"
                versions[e["version"]]["stage"] = e["stage"]
        return [Version(name, v, x["bundle"], x["stage"], x["description"]) for v, x in sorted(versions.items())]

    def _append(self, name: str, make, tries: int) -> dict:
        """Write the event that ``make(state)`` gives under the next number; start over if another writer was faster."""
        for _ in range(tries):
            last, _ = self.events(name)
            event = make(self.state(name))
            if create_exclusively(self.spark, f"{self._folder(name)}/{last + 1:06d}.json", json.dumps(event)):
                return event
        raise ConcurrentWriter(f"no event number of model {name} was free in {tries} tries")

    def register(self, name: str, bundle: str, description: str = "", tries: int = 20) -> int:
        """Add a bundle (a path) as the next version; returns its number."""
        return self._append(name, lambda known: {
            "event": "register", "version": max((v.version for v in known), default=0) + 1, "bundle": bundle,
            "description": description}, tries)["version"]

    def set_stage(self, name: str, version: int, stage: str, archive_existing: bool = True, tries: int = 20) -> list[int]:
        """Move a version to a stage; with ``archive_existing`` the versions that had it are archived, and returned."""
        if stage not in STAGES:
            raise ValueError(f"stage must be one of {STAGES}, got {stage!r}")

        def event(known: list[Version]) -> dict:
            if all(v.version != version for v in known):
                raise ValueError(f"model {name} has no version {version}")
            old = [v.version for v in known if v.stage == stage and v.version != version]
            return {"event": "stage", "version": version, "stage": stage,
                    "archived": old if archive_existing and stage in ("staging", "production") else []}
        return self._append(name, event, tries)["archived"]

    def find(self, name: str, wanted: str | int) -> Version:
        """A version by number, or the newest one that has a stage."""
        known = self.state(name)
        hits = [v for v in known if (v.version == wanted if isinstance(wanted, int) else v.stage == wanted)]
        if not hits:
            raise ValueError(f"model {name} has no version {wanted!r}" if known else f"there is no model {name}")
        return hits[-1]

    def load(self, name: str, wanted: str | int = "production") -> ModelBundle:
        return load_bundle(self.spark, self.find(name, wanted).bundle)

    def versions(self) -> DataFrame:
        """name, version, bundle, stage, description of every version of every model, from the logs alone."""
        folders = [p for p in list_children(self.spark, self.root) if _NAME.fullmatch(p.rstrip("/").rsplit("/", 1)[-1])]
        if not folders:
            return self.spark.createDataFrame([], "name string, version int, bundle string, stage string, description string")
        # one log per model: read whole, whatever the number of models
        log = (self.spark.read.schema(_EVENTS).json([f"{p}/*.json" for p in folders])
               .withColumn("path", F.input_file_name()).where(F.col("event").isNotNull())
               .withColumn("name", F.regexp_extract("path", r"/([^/]+)/\d{6}\.json$", 1))
               .withColumn("number", F.regexp_extract("path", r"/(\d{6})\.json$", 1).cast("int")))
        entered = log.where("event = 'register'").select("name", "version", "bundle", "description")
        moved = log.where("event = 'stage'").select("name", "number", "version", "stage")
        archived = (log.where("event = 'stage'").select("name", "number", F.explode("archived").alias("version"))
                    .withColumn("stage", F.lit("archived")))
        newest = Window.partitionBy("name", "version").orderBy(F.desc("number"))
        stages = (moved.unionByName(archived).withColumn("k", F.row_number().over(newest)).where("k = 1")
                  .select("name", "version", "stage"))
        return entered.join(stages, ["name", "version"], "left").select(
            "name", "version", "bundle", F.coalesce("stage", F.lit("none")).alias("stage"), "description")
