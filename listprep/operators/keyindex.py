"""A stored index of the keys of a list that grows, so that a batch costs its own size and not that of the list.

Keys lie in immutable segments. A segment is cut in buckets by the hash of the key, as many as keep a bucket at about
``bucket_keys`` keys, and each bucket has bitmaps (Bloom filters) beside its keys.
To look up a batch, only the bitmaps of the buckets that the batch's hashes fall into are read, and only where they
say "maybe" the keys themselves; those are compared whole, so the answer is exact. A batch's new keys become a small
segment; ``fan`` segments of one level are merged to one of the next, so there are few segments and a key is rewritten
a logarithmic number of times. One manifest says which segments count, so readers never see a half-written one.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listprep.functions.bitmaps import BLOCK_KEYS, bit_at, probes
from listprep.operators.joins import join_unique
from listprep.operators.membership import first_rows
from listprep.sinks import files


class KeyIndex:
    """Index of one string key below ``path``. One writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, path: str, bucket_keys: int = 1_000_000, fan: int = 4):
        self.spark, self.path, self.bucket_keys, self.fan = spark, path.rstrip("/"), bucket_keys, fan

    # --- manifest: {"version", "segments": [{"name", "level", "rows", "buckets", "blocks"}], "done": {run: batch}, "pending"}

    def manifest(self) -> dict:
        """The newest state; an empty one if there is none."""
        versions = sorted(n for n in files.names(self.spark, f"{self.path}/manifest") if n.endswith(".json"))
        if not versions:
            return {"version": 0, "segments": [], "done": {}, "pending": None}
        return json.loads(files.read_text(self.spark, f"{self.path}/manifest/{versions[-1]}"))

    def commit(self, state: dict) -> None:
        """Writes the next version whole, then removes all but this one and the one before, which readers may hold."""
        state["version"] += 1
        files.write_text(self.spark, f"{self.path}/manifest/{state['version']:012d}.json", json.dumps(state))
        for name in sorted(files.names(self.spark, f"{self.path}/manifest"))[:-2]:
            files.remove(self.spark, f"{self.path}/manifest/{name}")
        live = {s["name"] for s in state["segments"]} | set(state.get("old", []))
        for name in files.names(self.spark, f"{self.path}/segments"):
            if name not in live:
                files.remove(self.spark, f"{self.path}/segments/{name}")

    # --- segments

    def _folder(self, segment: dict, kind: str) -> str:
        return f"{self.path}/segments/{segment['name']}/{kind}"

    def write_segment(self, keys: DataFrame, level: int, rows: int) -> dict:
        """A segment of distinct keys (column ``key``), ``rows`` of them."""
        buckets = max(1, math.ceil(rows / self.bucket_keys))
        # as many bitmaps as hold the keys of a bucket
        blocks = max(1, math.ceil(min(rows, self.bucket_keys) / BLOCK_KEYS))
        segment = {"name": uuid.uuid4().hex, "level": level, "rows": rows, "buckets": buckets, "blocks": blocks}
        placed = placed_keys(keys, buckets, blocks)
        parts = max(1, min(buckets, self.spark.sparkContext.defaultParallelism * 4))
        placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "hash").select("bucket", "hash", "key").write.partitionBy(
            "bucket"
        ).parquet(self._folder(segment, "keys"))
        stored = self._read(segment, "keys", "hash long, key string, bucket int")
        bits = (
            placed_keys(stored.select("key"), buckets, blocks)
            .select("bucket", "block", F.explode(probes(F.col("hash"))).alias("bit"))
            .groupBy("bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        )
        bits.repartition(parts, "bucket").write.partitionBy("bucket").parquet(self._folder(segment, "bits"))
        return segment

    def _read(self, segment: dict, kind: str, schema: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """The files of some buckets, opened by their paths: nothing else is listed or read."""
        folder = self._folder(segment, kind)
        reader = self.spark.read.schema(schema).option("basePath", folder)
        if buckets is None:
            return reader.parquet(folder)
        return reader.parquet(*[f"{folder}/bucket={b}" for b in buckets])

    def _filled(self, segment: dict) -> set[int]:
        return {int(n.removeprefix("bucket=")) for n in files.names(self.spark, self._folder(segment, "bits")) if n.startswith("bucket=")}

    def known(self, keys: DataFrame) -> DataFrame:
        """The keys (column ``key``, distinct) that the index holds.

        ``keys`` is read once per segment and should be a stored table. What comes to the driver are bucket numbers,
        at most as many as a segment has buckets or the batch has keys."""
        state = self.manifest()
        found = [f for segment in state["segments"] if (f := self._known_in(segment, keys)) is not None]
        if not found:
            return keys.limit(0)
        return reduce(DataFrame.unionByName, found).distinct()

    def _known_in(self, segment: dict, keys: DataFrame) -> DataFrame | None:
        placed = placed_keys(keys, segment["buckets"], segment["blocks"])
        touched = {r[0] for r in placed.select("bucket").distinct().collect()} & self._filled(segment)
        if not touched:
            return None
        bits = self._read(segment, "bits", "block int, bits binary, bucket int", sorted(touched))
        met = placed.join(bits, ["bucket", "block"]).filter(F.forall(probes(F.col("hash")), lambda p: bit_at(F.col("bits"), p)))
        maybe = met.select("bucket", "hash", "key")
        hit = sorted(r[0] for r in maybe.select("bucket").distinct().collect())
        if not hit:
            return None
        stored = self._read(segment, "keys", "hash long, key string, bucket int", hit)
        return maybe.join(stored.select("hash", "key"), ["hash", "key"], "left_semi").select("key")

    # --- growth

    def add(self, state: dict, keys: DataFrame, rows: int) -> None:
        """Adds distinct keys that the index does not hold to a state that is about to be committed, and merges levels
        that are full. Segments of the state before stay until the next commit."""
        if not rows:
            return
        state["old"] = [s["name"] for s in state["segments"]]
        state["segments"].append(self.write_segment(keys, self._level(rows), rows))
        while True:
            levels: dict[int, list[dict]] = {}
            for segment in state["segments"]:
                levels.setdefault(segment["level"], []).append(segment)
            full = [(level, group) for level, group in sorted(levels.items()) if len(group) >= self.fan]
            if not full:
                return
            level, group = full[0]
            every = reduce(DataFrame.unionByName, [self._read(s, "keys", "key string, bucket int").select("key") for s in group])
            rows = sum(s["rows"] for s in group)
            merged = self.write_segment(every, max(level + 1, self._level(rows)), rows)
            state["segments"] = [s for s in state["segments"] if s not in group] + [merged]
            state["old"] = [*state["old"], *[s["name"] for s in group]]

    def _level(self, rows: int) -> int:
        """Segments of a level have about equal sizes: each level holds ``fan`` times the one below."""
        return int(math.log(max(rows, 1), self.fan))


def placed_keys(keys: DataFrame, buckets: int, blocks: int) -> DataFrame:
    """Adds the hash of the key, its bucket and its bitmap."""
    own = keys.select("key", F.xxhash64("key").alias("hash"))
    spot = lambda part, n: F.pmod(F.xxhash64(F.lit(part), F.col("hash")), F.lit(n)).cast("int")
    return own.select("key", "hash", spot("bucket", buckets).alias("bucket"), spot("block", blocks).alias("block"))


def unknown_rows(batch: DataFrame, index: KeyIndex, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of the batch to append: keys that the index does not hold, the first row of each. Rows without a key go,
    as they have none to be known by. ``batch`` is read several times and should be a stored table."""
    own = batch.filter(F.col(key).isNotNull())
    known = index.known(own.select(F.col(key).cast("string").alias("key")).distinct())
    fresh = first_rows(own, [key], order)
    back = F.col("key").cast(batch.schema[key].dataType).alias(key)
    return join_unique(fresh, known.select(back), [key], "left_anti")
