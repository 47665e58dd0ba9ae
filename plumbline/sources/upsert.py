"""Keyed tables: late and corrected rows replace rows of the same key, reruns change nothing.

A table is a folder. Each batch rewrites only the partitions it touches: the rows of those
partitions and of the batch are merged by key into a new folder, and a new manifest, which
names for every partition the folder that holds it, is switched in by a rename. Readers keep
the folders of the manifest they began with. A batch that was killed before the switch has
changed nothing and is simply run again; one that was switched in before is skipped by its
name. Merging is one shuffle of the touched partitions, with partial aggregates.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.columns import col, orderable

SLOT = "slot"


class KeyedTable:
    """Rows with unique ``keys`` at ``path``, stored by the columns ``partition_by``.

    The partition columns are keys as well, so that a key never moves between partitions;
    NULL is a value like any other. One batch may be written at a time: a second writer that
    saw the same manifest is refused at the switch and can run its batch again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str]):
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be among the keys")
        self.spark, self.path, self.keys, self.partition_by = spark, path.rstrip("/"), list(keys), list(partition_by)

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place, files = self._place(folder)
        return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []

    def manifest(self) -> dict:
        """The latest manifest: version, schema, batches, and per slot its folder and partition values."""
        versions = [int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]
        if not versions:
            return {"version": 0, "schema": None, "batches": [], "slots": {}}
        place, _ = self._place(f"manifests/{max(versions):010d}.json")
        return json.loads(self.spark.read.text(place.toString(), wholetext=True).first()["value"])

    def _switch(self, manifest: dict) -> None:
        """Write a manifest aside and rename it into its place, which must be free."""
        name = f"{manifest['version']:010d}"
        aside, files = self._place(f"manifests/.{name}.writing")
        place, _ = self._place(f"manifests/{name}.json")
        out = files.create(aside, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if files.exists(place) or not files.rename(aside, place):
            raise RuntimeError(f"version {manifest['version']} of {self.path} was written by another batch; run again")

    def _slot(self) -> Column:
        values = F.to_json(F.struct(*[col(c) for c in self.partition_by]), {"ignoreNullFields": "false"})
        return F.substring(F.sha2(values, 256), 1, 16)

    def _rows(self, manifest: dict, slots: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        if not slots:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{manifest['slots'][s]['folder']}/{SLOT}={s}" for s in slots]
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)

    def read(self, **partition: object) -> DataFrame:
        """All rows, or those of the partitions with the given values; other folders are not listed."""
        manifest = self.manifest()
        if manifest["schema"] is None:
            raise ValueError(f"nothing was written to {self.path}")
        wanted = [s for s, known in manifest["slots"].items() if all(known["values"][c] == (None if v is None else str(v)) for c, v in partition.items())]
        return self._rows(manifest, wanted)

    def upsert(self, batch: DataFrame, name: str, newest: str | None = None) -> bool:
        """Merge ``batch`` by key; returns whether it was new, by its ``name``.

        A row of the batch replaces the stored row of its key, and the last one by ``newest``
        wins where that column is given: an older correction that comes late changes
        nothing. Of rows of one key that tie, the batch's comes first, then the largest by
        all columns. New columns are refused. An empty batch only leaves its name.
        """
        manifest = self.manifest()
        if name in manifest["batches"]:
            return False
        if manifest["schema"] is None:
            manifest["schema"] = batch.schema.jsonValue()
        names = T.StructType.fromJson(manifest["schema"]).names
        if sorted(names) != sorted(batch.columns):
            raise ValueError(f"columns {batch.columns} are not those of the table, {names}")
        incoming = batch.select(*[col(c) for c in names])
        shown = F.to_json(F.struct(*[col(c).cast("string").alias(c) for c in self.partition_by]), {"ignoreNullFields": "false"})
        # One row per touched partition, as many as the manifest gets entries.
        touched = {r[SLOT]: json.loads(r["shown"]) for r in incoming.select(self._slot().alias(SLOT), shown.alias("shown")).distinct().collect()}
        stored = self._rows(manifest, [s for s in touched if s in manifest["slots"]])
        both = stored.withColumn("__incoming", F.lit(0)).unionByName(incoming.withColumn("__incoming", F.lit(1)))
        ties = [col(f.name) for f in batch.schema if orderable(f.dataType)]
        rank = F.struct(*([col(newest)] if newest else []), "__incoming", *ties)
        merged = both.groupBy(*[col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)]).agg(
            F.max_by(F.struct(*[col(c) for c in names]), rank).alias("__row")
        )
        rows = merged.select("__row.*")
        folder = f"data/{manifest['version'] + 1:010d}-{folder_name(name)}"
        if touched:
            rows.withColumn(SLOT, self._slot()).write.mode("overwrite").partitionBy(SLOT).parquet(f"{self.path}/{folder}")
        manifest["slots"] |= {s: {"folder": folder, "values": values} for s, values in touched.items()}
        manifest["batches"].append(name)
        manifest["version"] += 1
        self._switch(manifest)
        return True

    def remove_unused(self) -> list[str]:
        """Delete folders and manifests that the latest manifest does not need; no reader may be at work on them."""
        manifest = self.manifest()
        used = {known["folder"] for known in manifest["slots"].values()} | {f"manifests/{manifest['version']:010d}.json"}
        found = [f"{top}/{name}" for top in ("data", "manifests") for name in self._names(top)]
        gone = [f for f in found if f not in used]
        for name in gone:
            place, files = self._place(name)
            files.delete(place, True)
        return gone


def folder_name(name: str) -> str:
    """A batch name with nothing that a path could mistake."""
    return "".join(c if c.isalnum() or c in "-_" else "-" for c in name)
