"""Parquet tables that change all at once: versioned folders, and one small file that names the current set.

A table is made of parts (the months of a fact, or one part for a table that is always written whole). Every write puts its rows
into a new folder ``data/_commit=<id>`` and then publishes a manifest, ``manifests/<number>.json``: which parts there are, in
which commit's folder each one lies, how many rows it has, and the least and largest value of some columns. The manifest
is written aside and renamed to the next number, as the last step. Before that rename every reader sees the table as it was, after it
every reader sees it as it is now, and no file that a reader may be using has been touched: folders are removed only when
the newest ``KEEP`` manifests name none of their parts any more. What a dead job left behind is named by no manifest, and the next write removes it.

One job writes a table at a time; should two do it all the same, the rename of the second one fails and its rows are never seen.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

COMMIT = "_commit"
PART = "_part"
KEEP = 3
#: Surrogate keys are hexadecimal text, which takes half the room in a code by letters that it takes otherwise.
CODEC = "zstd"

#: Types whose least and largest values a manifest can hold, and how to read them back.
_DECODE: dict[type, Callable] = {
    T.DateType: dt.date.fromisoformat, T.TimestampNTZType: dt.datetime.fromisoformat, T.StringType: str,
    T.ByteType: int, T.ShortType: int, T.IntegerType: int, T.LongType: int,
}


@dataclass(frozen=True)
class Part:
    """One part: the commit whose folder holds it, its rows if counted, and (least, largest) by column, both null if there is no value."""

    commit: str
    rows: int | None
    range: Mapping[str, tuple] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    number: int
    schema: T.StructType
    parts: Mapping[str, Part]
    notes: Mapping[str, int] = field(default_factory=dict)  # of a table derived from others: the manifests of these that it has taken in

    def largest(self, column: str):
        """Largest value of a ranged column in all parts, from the manifest alone."""
        return max((p.range[column][1] for p in self.parts.values() if p.range[column][1] is not None), default=None)

    def meeting(self, ranges: Mapping[str, tuple]) -> list[str]:
        """The parts that may hold a row whose columns all lie within the given ranges."""
        def apart(have: tuple, want: tuple) -> bool:
            return None in have or None in want or have[1] < want[0] or want[1] < have[0]

        return [n for n, p in self.parts.items() if not any(c in p.range and apart(p.range[c], r) for c, r in ranges.items())]

    def to_json(self) -> str:
        text = lambda v: v if v is None or isinstance(v, (str, int)) else v.isoformat()
        return json.dumps({"schema": self.schema.json(), "notes": dict(self.notes), "parts": {
            name: {"commit": p.commit, "rows": p.rows, "range": {c: [text(v) for v in r] for c, r in p.range.items()}} for name, p in self.parts.items()}})

    @staticmethod
    def from_json(number: int, text: str) -> Manifest:
        told = json.loads(text)
        schema = T.StructType.fromJson(json.loads(told["schema"]))
        read = {f.name: _DECODE.get(type(f.dataType)) for f in schema.fields}
        return Manifest(number, schema, {
            name: Part(p["commit"], p["rows"], {c: tuple(None if v is None else read[c](v) for v in r) for c, r in p["range"].items()})
            for name, p in told["parts"].items()}, told["notes"])


class Snapshots:
    """A table of parts under ``path``. ``ranged`` names the columns whose ranges the manifest holds for each part, with its rows
    (``counted``: the rows in any case)."""

    def __init__(self, spark: SparkSession, path: str, ranged: Sequence[str] = (), keep: int = KEEP, counted: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.ranged = list(ranged)
        self.keep = keep
        self.counted = counted or bool(ranged)
        self.data, self.manifests, self.work = (f"{self.path}/{x}" for x in ("data", "manifests", "work"))

    # -- files --------------------------------------------------------------------

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        fs, where = self._fs(), self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _drop(self, path: str) -> None:
        self._fs().delete(self._at(path), True)

    def step(self, name: str) -> None:
        """Called after every step of a write; a hook for tests that end a job there."""

    # -- reading ------------------------------------------------------------------

    def numbers(self) -> list[int]:
        """The numbers of the published manifests, ascending."""
        return sorted(int(n.removesuffix(".json")) for n in self._names(self.manifests) if n.endswith(".json") and n[0].isdigit())

    def manifest(self, number: int | None = None) -> Manifest | None:
        """The current manifest, or an older one that is still kept."""
        numbers = self.numbers()
        if number is None and not numbers:
            return None
        number = numbers[-1] if number is None else number
        stream = self._fs().open(self._at(f"{self.manifests}/{number:012d}.json"))
        try:
            return Manifest.from_json(number, self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self.numbers())

    def folder(self, name: str, part: Part) -> str:
        return f"{self.data}/{COMMIT}={part.commit}/{PART}={name}"

    def read(self, manifest: Manifest | None = None, names: Iterable[str] | None = None, named: bool = False) -> DataFrame:
        """The rows of a manifest (the current one unless given): of all its parts, or of some. ``named`` adds the column ``_part``.

        Only the folders of those parts are listed. The rows stay those of this manifest, whatever is written meanwhile.
        """
        manifest = manifest or self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no table at {self.path}")
        wanted = manifest.parts if names is None else {n: manifest.parts[n] for n in names if n in manifest.parts}
        schema = T.StructType([*manifest.schema.fields, T.StructField(PART, T.StringType())])
        if wanted:
            folders = [self.folder(n, p) for n, p in wanted.items()]
            rows = self.spark.read.schema(schema).option("basePath", self.data).parquet(*folders).select(*schema.names)
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows if named else rows.drop(PART)

    def differing(self, since: int) -> list[str] | None:
        """The parts that are not what they were in an older manifest; None if that is no longer kept."""
        if since not in self.numbers():
            return None
        old, new = self.manifest(since).parts, self.manifest().parts
        return [n for n in {**old, **new} if old.get(n) != new.get(n)]

    def changes(self, since: int, columns: Sequence[str]) -> DataFrame | None:
        """The values of ``columns`` that rows have now and had not in an older manifest, or the other way round, once each, with ``_part``.

        Only the parts that differ are read, of both. None if the older manifest is no longer kept.
        """
        names = self.differing(since)
        if names is None:
            return None
        now = self.manifest()
        old = replace(self.manifest(since), schema=now.schema)  # a column that is new since is null in older rows
        pick = lambda m, sign: self.read(m, names, named=True).select(*columns, PART, F.lit(sign).alias("_sign"))
        both = pick(old, -1).unionByName(pick(now, 1))
        return both.groupBy(*columns, PART).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0").drop("_sign")

    def changed_keys(self, since: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame | None:
        """The values of ``keys`` for which the rows of ``columns`` are not those of an older manifest, once each; None if that is no longer kept.

        As ``changes``, but what is moved is the keys and a hash of 64 bits, not the rows; hashes meet among rows of the same keys only.
        """
        names = self.differing(since)
        if names is None:
            return None
        now = self.manifest()
        old = replace(self.manifest(since), schema=now.schema)
        marks = [*(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns)]  # a hash skips nulls: they are told beside

        def row(m: Manifest, sign: int) -> DataFrame:
            rows = self.read(m, names, named=True)
            return rows.select(*keys, F.xxhash64(*marks).alias("_hash"), F.lit(sign).alias("_sign"))

        both = row(old, -1).unionByName(row(now, 1))
        left = both.groupBy(*keys, "_hash").agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")
        return left.select(*keys).distinct()

    def pattern(self, manifest: Manifest) -> str | None:
        """The folders of a manifest as one path pattern, for SQL that names files; None if it has no part."""
        folders = [self.folder(n, p).removeprefix(f"{self.data}/") for n, p in manifest.parts.items()]
        return f"{self.data}/{{{','.join(folders)}}}" if folders else None

    # -- writing ------------------------------------------------------------------

    def aside(self, rows: DataFrame, step: str | None = "aside") -> DataFrame:
        """Rows that a write reads more than once, computed once; removed when the write is done."""
        path = f"{self.work}/{uuid.uuid4().hex}"
        rows.write.option("compression", CODEC).parquet(path)
        if step:
            self.step(step)
        return self.spark.read.schema(rows.schema).parquet(path)

    def write_commit(self, rows: DataFrame) -> str:
        """Rows with a column ``_part`` into a folder of a new commit, seen by no reader yet."""
        commit = f"c{uuid.uuid4().hex}"
        rows.write.partitionBy(PART).option("compression", CODEC).parquet(f"{self.data}/{COMMIT}={commit}")
        self.step("rows")
        return commit

    def measure(self, commit: str, schema: T.StructType) -> dict[str, Part]:
        """The parts of a commit, counted from its files: only the ranged columns are read, and nothing if there are none."""
        if not self.counted:
            prefix = f"{PART}="
            names = [n.removeprefix(prefix) for n in self._names(f"{self.data}/{COMMIT}={commit}") if n.startswith(prefix)]
            return {n: Part(commit, None) for n in names}
        ranged = [c for c in self.ranged if type(schema[c].dataType) in _DECODE]
        whole = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
        rows = self.spark.read.schema(whole).parquet(f"{self.data}/{COMMIT}={commit}")
        found = rows.groupBy(PART).agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ranged for f in (F.min, F.max)])
        # One row for each part of this write.
        return {r[PART]: Part(commit, r["n"], {c: (r[f"min_{c}"], r[f"max_{c}"]) for c in ranged}) for r in found.collect()}

    def publish(self, before: Manifest | None, schema: T.StructType, parts: Mapping[str, Part], notes: Mapping[str, int] | None = None) -> Manifest:
        """Makes ``parts`` the table, if ``before`` is still current. Notes stay unless others are given."""
        if notes is None:
            notes = before.notes if before else {}
        made = Manifest(before.number + 1 if before else 1, schema, dict(parts), dict(notes))
        fs, aside, place = self._fs(), f"{self.manifests}/_{uuid.uuid4().hex}", f"{self.manifests}/{made.number:012d}.json"
        out = fs.create(self._at(aside), True)
        out.write(bytearray(made.to_json().encode()))
        out.close()
        self.step("manifest")
        if fs.exists(self._at(place)) or not fs.rename(self._at(aside), self._at(place)):
            self._drop(aside)
            raise RuntimeError(f"another job has changed {self.path}; this write is not part of it")
        self.step("published")
        self.clean()
        self.step("cleaned")
        return made

    def replace(self, rows: DataFrame) -> Manifest:
        """The whole table anew, as one part. ``rows`` may be read from the table itself."""
        return self.replace_parts(rows.withColumn(PART, F.lit("all")))

    def replace_parts(self, rows: DataFrame, notes: Mapping[str, int] | None = None) -> Manifest:
        """All parts anew, from rows with a column ``_part``."""
        before = self.manifest()
        schema = T.StructType([f for f in rows.schema.fields if f.name != PART])
        return self.publish(before, schema, self.measure(self.write_commit(rows), schema), notes)

    def change_parts(self, rows: DataFrame, touched: Iterable[str], before: Manifest, notes: Mapping[str, int] | None = None) -> Manifest:
        """Some parts anew: those ``touched``, which ``rows`` holds in full; one that it holds no row of is gone."""
        schema = T.StructType([f for f in rows.schema.fields if f.name != PART])
        touched = set(touched)
        fresh = self.measure(self.write_commit(rows), schema)
        if set(fresh) - touched:
            raise ValueError(f"rows of other parts than the touched ones: {sorted(set(fresh) - touched)}")
        return self.publish(before, schema, {n: p for n, p in before.parts.items() if n not in touched} | fresh, notes)

    def note(self, notes: Mapping[str, int]) -> None:
        """Other notes for the rows there are."""
        now = self.manifest()
        if dict(now.notes) != dict(notes):
            self.publish(now, now.schema, now.parts, notes)

    def clean(self) -> None:
        """Removes what none of the newest manifests names, and what dead jobs left."""
        self._drop(self.work)
        kept = self.numbers()[-self.keep:]
        named = {p.commit for k in kept for p in self.manifest(k).parts.values()}
        for name in self._names(self.data):
            if name.startswith(f"{COMMIT}=") and name.removeprefix(f"{COMMIT}=") not in named:
                self._drop(f"{self.data}/{name}")
        for name in self._names(self.manifests):
            if name.startswith("_") or (name.endswith(".json") and name[0].isdigit() and int(name.removesuffix(".json")) < kept[0]):
                self._drop(f"{self.manifests}/{name}")
