"""Tables kept as folders that one small pointer file lists: whole loads, appends, merges, archives."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..functions.expressions import any_of
from ..operators.changes import dedupe_latest
from ..operators.upsert import upsert

BUCKET, ROUTE, GONE = "_bucket", "_route", "_gone"
REASON, READER = "rejected_for", "rejected_by"
BUCKET_ROWS = 500_000   # of a bucket when a table is first written
MAX_BUCKETS = 4_096
KEEP = 2                # versions whose folders stay


def spread(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Even output files: AQE splits hot partition values and merges small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def _parts(rows: DataFrame | Sequence[DataFrame]) -> list[DataFrame]:
    return [rows] if isinstance(rows, DataFrame) else list(rows)


@dataclass(frozen=True)
class Part:
    """A folder of the table. `rows` are whole tables or appends, `base` and `delta` the two layers of a merged table,
    `reject` rows without a key, `archive` rows moved away. `buckets` names the buckets it still holds, with their rows;
    `by` the columns its files are partitioned by, and then `schema` its columns, which a folder without rows does not tell."""

    folder: str
    kind: str = "rows"
    buckets: dict[int, int] = field(default_factory=dict)
    by: tuple[str, ...] = ()
    schema: str = ""


@dataclass(frozen=True)
class Balance:
    """What became of the rows of one load: read = loaded + collapsed + rejected."""

    load: str
    read: int = 0
    loaded: int = 0
    collapsed: int = 0
    rejected: int = 0


@dataclass(frozen=True)
class Manifest:
    parts: tuple[Part, ...] = ()
    keys: tuple[str, ...] = ()
    newest: str | None = None
    n_buckets: int = 1
    batches: dict[str, tuple[str, str]] = field(default_factory=dict)  # writer: its last batch and the folder of that
    balances: tuple[Balance, ...] = ()

    def text(self) -> str:
        head = {"keys": self.keys, "newest": self.newest, "n_buckets": self.n_buckets, "batches": self.batches}
        return "\n".join(json.dumps(x) for x in [head, *[{"balance": vars(b)} for b in self.balances], *[vars(p) for p in self.parts]])

    @classmethod
    def parse(cls, text: str) -> "Manifest":
        head, *lines = [json.loads(x) for x in text.splitlines()]
        return cls(tuple(Part(x["folder"], x["kind"], {int(b): n for b, n in x["buckets"].items()}, tuple(x.get("by", ())), x.get("schema", "")) for x in lines if "folder" in x),
                   tuple(head["keys"]), head["newest"], head["n_buckets"], {w: tuple(b) for w, b in head["batches"].items()},
                   tuple(Balance(**x["balance"]) for x in lines if "balance" in x))

    def of(self, *kinds: str) -> list[Part]:
        return [p for p in self.parts if p.kind in kinds]

    def without_buckets(self, gone: set[int]) -> tuple[Part, ...]:
        """The parts less some buckets of both layers; a part with none left goes."""
        out = []
        for p in self.parts:
            if p.kind in ("base", "delta"):
                p = replace(p, buckets={b: n for b, n in p.buckets.items() if b not in gone})
                if not p.buckets:
                    continue
            out.append(p)
        return tuple(out)


class VersionedTable:
    """A Parquet table kept as folders below one root.

    A load writes a folder of its own and then publishes it by one small
    pointer file, named by the version and listing the folders that make it
    up. A reader never sees half a load, a load may read the version it
    replaces, a failed load changes nothing, and of two writers of the same
    version the second fails without touching what the first wrote. An append
    adds a folder and copies nothing.

    A merge writes the changed rows only: a table with keys has base folders,
    dealt into buckets by the hash of the key, and deltas, and a reader takes
    the newest row of each key. Rows without a key are kept apart, with their
    reason, by the same pointer, and so is the balance of every load. A bucket
    whose deltas hold `compact_at` of its rows is written afresh. Folders that
    none of the last versions lists are removed.
    """

    def __init__(self, spark: SparkSession, root: str, *, compact_at: float = 0.3, most_deltas: int = 16):
        self.spark, self.root = spark, root.rstrip("/")
        self.compact_at, self.most_deltas = compact_at, most_deltas

    # ---- files ---------------------------------------------------------------------------------------
    def _path(self, *parts):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _published(self) -> list[int]:
        fs, folder = self._fs(), self._path("_published")
        if not fs.exists(folder):
            return []
        return sorted(int(n) for n in (f.getPath().getName() for f in fs.listStatus(folder)) if n.isdigit())

    def version(self) -> int:
        return max(self._published(), default=0)

    def exists(self) -> bool:
        return self.version() > 0

    def manifest(self, version: int | None = None) -> Manifest:
        v = self.version() if version is None else version
        if not v:
            return Manifest()
        stream = self._fs().open(self._path("_published", str(v)))
        try:
            return Manifest.parse(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def folders(self, version: int | None = None) -> list[str]:
        return [p.folder for p in self.manifest(version).parts]

    def at(self, folder: str) -> str:
        """Where a listed folder is; an archive may be elsewhere and is listed by its whole path."""
        return folder if folder.startswith("/") or ":/" in folder else f"{self.root}/{folder}"

    def _publish(self, version: int, manifest: Manifest) -> int:
        """The pointer appears whole, under a name that must not exist."""
        fs, draft = self._fs(), self._path("_published", f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(manifest.text(), "utf-8"))
        out.close()
        target = self._path("_published", str(version))
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise FileExistsError(f"version {version} of {self.root} was published by another load")
        self._remove_superseded(version)
        return version

    def _remove_superseded(self, version: int) -> None:
        """Folders of versions up to this one that none of the last KEEP versions lists, and their pointers."""
        fs, published = self._fs(), self._published()
        kept = [v for v in published if v <= version][-KEEP:]
        listed = {f for v in kept for f in self.folders(v)}
        for status in fs.listStatus(self._path()):
            name = status.getPath().getName()
            if not (name.startswith("v") and name[1:].split("-")[0].isdigit()) or int(name[1:].split("-")[0]) > version:
                continue  # no folder of ours, or one that a load is writing
            inside = [f for f in listed if f == name or f.startswith(f"{name}/")]
            if not inside:
                fs.delete(status.getPath(), True)
            elif name not in inside:
                for side in fs.listStatus(status.getPath()):
                    if side.isDirectory() and f"{name}/{side.getPath().getName()}" not in inside:
                        fs.delete(side.getPath(), True)
        for v in published:
            if v < min(kept):
                fs.delete(self._path("_published", str(v)), False)

    def _folder(self, version: int) -> str:
        return f"v{version}-{uuid.uuid4().hex[:12]}"

    def _write(self, df: DataFrame | Sequence[DataFrame], version: int, partition_by: Sequence[str], sort_by: Sequence[str]) -> str:
        folder = self._folder(version)
        for part in _parts(df):
            out = spread(part, partition_by)
            if sort_by:
                out = out.sortWithinPartitions(*partition_by, *sort_by)
            out.write.mode("append").options(**session.STORED).partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
        return folder

    @staticmethod
    def _rows_part(folder: str, df: DataFrame, by: Sequence[str]) -> Part:
        if not by:
            return Part(folder)
        columns = [*[f for f in df.schema.fields if f.name not in by], *[df.schema[c] for c in by]]
        return Part(folder, by=tuple(by), schema=T.StructType(columns).json())

    def _load(self, parts: Sequence[Part]) -> DataFrame:
        """Rows of folders. A folder partitioned by columns is a root of its own to Spark, the others are read as one."""
        plain = [self.at(p.folder) for p in parts if not p.by]
        out = [self.spark.read.option("mergeSchema", len(plain) > 1).parquet(*plain)] if plain else []
        out += [self.spark.read.schema(T.StructType.fromJson(json.loads(p.schema))).parquet(self.at(p.folder)) for p in parts if p.by]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)

    # ---- reading -------------------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame | None:
        m = self.manifest(version)
        out = self._merged(m).drop(BUCKET) if m.of("base", "delta") else None
        if m.of("rows"):
            rows = self._load(m.of("rows"))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    def rejected(self, version: int | None = None) -> DataFrame | None:
        """Rows that merges could not take, with `rejected_for`, the reason, and `rejected_by`, the load that read them."""
        parts = self.manifest(version).of("reject")
        return self._load(parts).drop(BUCKET, GONE) if parts else None

    def archived(self, version: int | None = None) -> DataFrame | None:
        parts = self.manifest(version).of("archive")
        return self._load(parts) if parts else None

    def balances(self, version: int | None = None) -> list[Balance]:
        return list(self.manifest(version).balances)

    def _layer(self, parts: list[Part], buckets: set[int] | None) -> DataFrame | None:
        """Rows of parts in some buckets; files are in order of the bucket, so others' row groups are skipped."""
        out = None
        for p in parts:
            wanted = set(p.buckets) if buckets is None else set(p.buckets) & buckets
            if wanted:
                df = self._load([p])
                df = df.where(F.col(BUCKET).isin(sorted(wanted))) if BUCKET in df.columns else df.withColumn(BUCKET, F.lit(0))
                out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def _merged(self, m: Manifest, buckets: set[int] | None = None) -> DataFrame:
        """The newest row of each key. Buckets without a delta are read as they are; only the others are joined."""
        deltas, touched = None, set()
        for at, p in enumerate(m.of("delta")):
            df = self._layer([p], buckets)
            if df is not None:
                touched |= set(p.buckets) if buckets is None else set(p.buckets) & buckets
                df = df.drop(REASON, READER).withColumn("_at", F.lit(at))
                deltas = df if deltas is None else deltas.unionByName(df, allowMissingColumns=True)
        base = m.of("base")
        if deltas is None:
            return self._layer(base, buckets).drop(REASON, READER)
        latest = dedupe_latest(deltas, m.keys, [F.col("_at").desc()], newest=m.newest if m.newest in deltas.columns else "_at").drop("_at")
        held = {b for p in base for b in p.buckets} if buckets is None else buckets
        old, calm = self._layer(base, touched), self._layer(base, held - touched)
        out = latest if old is None else upsert(old.drop(REASON, READER), latest, m.keys, newest=m.newest, unique=True)
        if GONE in out.columns:
            out = out.where(F.col(GONE).isNull()).drop(GONE)
        return out if calm is None else out.unionByName(calm.drop(REASON, READER), allowMissingColumns=True)

    # ---- loads ---------------------------------------------------------------------------------------
    def publish(self, df: DataFrame | Sequence[DataFrame], partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), *,
                rejected: DataFrame | None = None, balance: Balance | None = None) -> int:
        """The whole table anew; rows its load rejected and its balance appear with it. Earlier rejects and archives stay.

        Rows given in parts are written one part after the other, and appear together.
        """
        v = self.version() + 1
        before = self.manifest(v - 1)
        parts = [self._rows_part(self._write(df, v, partition_by, sort_by), _parts(df)[0], partition_by), *before.of("reject", "archive")]
        if rejected is not None:
            parts.append(Part(self._write(rejected, v, (), ()), "reject"))
        balances = before.balances if balance is None else (*before.balances, balance)
        return self._publish(v, replace(before, parts=tuple(parts), keys=(), newest=None, n_buckets=1, balances=balances))

    def append(self, df: DataFrame, partition_by: Sequence[str] = (), batch: tuple[str, str] | None = None) -> int:
        """The next version: the folders of this one and the new rows; columns new to the table are kept.

        `batch` names the writer and its batch. A batch that was published already, by a writer that did not learn of
        it, replaces what it had added: the pointer itself says which batch came last, so none is taken twice.
        """
        v = self.version() + 1
        m = self.manifest(v - 1)
        folder, parts, batches = self._write(df, v, partition_by, ()), m.parts, m.batches
        if batch is not None:
            writer, number = batch
            last, added = batches.get(writer, (None, None))
            if last == number:
                parts = tuple(p for p in parts if p.folder != added)
            batches = {**batches, writer: (number, folder)}
        return self._publish(v, replace(m, parts=(*parts, self._rows_part(folder, df, partition_by)), batches=batches))

    def merge(self, source: DataFrame | Sequence[DataFrame], keys: Sequence[str], newest: str | None = None, *, load: str = "", gone: DataFrame | None = None,
              read: int | None = None, unique: bool = False, buckets: int | None = None) -> Balance:
        """Take rows by key: the newest of a key stays (by `newest`, else the last loaded), others are added.

        The source is read once to be written, and once before to be counted unless `read` says how many rows it has.
        `unique` says that it has one row for each key: then nothing collapses. The writing pass sends each row to the merged rows, one
        for each key, or, where a key column is null, to the rejected ones with the reason; both appear in one version
        with the balance of the load. Rows of a key collapse to the newest. A null in `newest` loses to any time. Columns
        the source lacks keep what the table has; columns only the source has are added. Keys in `gone` that the source
        lacks are removed (of tables without `newest`). A source given in parts, all rows of a key in one of them, is
        written part by part, so that shuffle files of one part are on disk at a time.
        """
        v = self.version() + 1
        keys = tuple(keys)
        m = self._keyed(self.manifest(v - 1), keys, newest)
        v = self.version() + 1
        first, sources = not m.of("base", "delta"), _parts(source)
        if read is None and (first or not unique):
            read = sum(part.count() for part in sources)
        n_buckets = buckets or min(MAX_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, read) / BUCKET_ROWS)))) if first else m.n_buckets
        lacking = F.concat_ws(", ", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
        keyless = any_of([F.col(k).isNull() for k in keys])
        lost = None
        if gone is not None and not first:
            if newest:
                raise ValueError("a removal has no time to be compared")
            lost = gone.select(*keys).dropna().distinct().join(
                reduce(DataFrame.unionByName, [part.select(*keys) for part in sources]), list(keys), "left_anti").withColumn(GONE, F.lit(True))
        folder = self._folder(v)
        for k, one in enumerate(sources):
            if not unique:
                one = dedupe_latest(one, keys, newest=newest) if newest else dedupe_latest(one.withColumn("_same", F.lit(0)), keys, newest="_same").drop("_same")
            one = self._completed(one, m, keys)
            if lost is not None:
                one = one.withColumn(GONE, F.lit(None).cast("boolean"))
                one = one.unionByName(lost, allowMissingColumns=True) if k == 0 else one
            dealt = one.withColumns({
                REASON: F.when(keyless, F.concat(F.lit("null key: "), lacking)), READER: F.when(keyless, F.lit(load)),
                ROUTE: F.when(keyless, "reject").otherwise("load"),
                BUCKET: F.pmod(F.when(keyless, F.monotonically_increasing_id()).otherwise(F.xxhash64(*keys)), F.lit(n_buckets)).cast("int")})
            spread(dealt, [BUCKET]).sortWithinPartitions(ROUTE, BUCKET, *keys).write.mode("append").options(**session.STORED).partitionBy(ROUTE).parquet(
                f"{self.root}/{folder}")
        counts = self.spark.read.schema(f"{BUCKET} int, {ROUTE} string").parquet(f"{self.root}/{folder}").groupBy(ROUTE, BUCKET).count().collect()
        held = {kind: {r[BUCKET]: r["count"] for r in counts if r[ROUTE] == kind} for kind in ("load", "reject")}
        loaded, rejected = (sum(held[k].values()) for k in ("load", "reject"))
        removed = self._load([Part(f"{folder}/{ROUTE}=load")]).where(GONE).count() if lost is not None and loaded else 0
        loaded_rows = loaded - removed
        taken = loaded_rows + rejected if unique else read
        balance = Balance(load, taken, loaded_rows, taken - loaded_rows - rejected, rejected)
        parts = list(m.parts)
        if loaded:
            parts.append(Part(f"{folder}/{ROUTE}=load", "base" if first else "delta", held["load"]))
        elif first:  # no row yet: the columns are known all the same
            empty = self._write(sources[0].limit(0).withColumn(BUCKET, F.lit(0)), v, (), ())
            parts.append(Part(empty, "base", {0: 0}))
        if rejected:
            parts.append(Part(f"{folder}/{ROUTE}=reject", "reject"))
        self._publish(v, replace(m, parts=tuple(parts), keys=keys, newest=newest, n_buckets=n_buckets, balances=(*m.balances, balance)))
        self._compact_full()
        return balance

    def _keyed(self, m: Manifest, keys: tuple[str, ...], newest: str | None) -> Manifest:
        """The manifest as that of a table merged by these keys; a table written whole becomes one base bucket."""
        if m.keys and (m.keys != keys or m.newest != newest):
            raise ValueError(f"{self.root} is merged by {list(m.keys)} and {m.newest}, not by {list(keys)} and {newest}")
        if m.keys and m.of("rows"):  # rows were appended past the key: the table is written as one and merged from there
            self.publish(self.read())
            m = self.manifest()
        if not m.of("rows"):
            return m
        whole = [replace(p, kind="base", buckets={0: self._load([p]).count()}) if p.kind == "rows" else p for p in m.parts]
        return replace(m, parts=tuple(whole), keys=keys, newest=newest, n_buckets=1)

    def _completed(self, rows: DataFrame, m: Manifest, keys: tuple[str, ...]) -> DataFrame:
        """Rows with the table's columns and types; columns they lack are taken from the table, for their keys only."""
        if not m.of("base", "delta"):
            return rows
        table = self._merged(m).drop(BUCKET)
        rows = rows.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) if c in table.columns else F.col(c) for c in rows.columns])
        lacking = [c for c in table.columns if c not in rows.columns]
        if not lacking:
            return rows
        known = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *lacking)
        on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
        return rows.join(known, on, "left").drop(*[f"_k_{k}" for k in keys])

    def _compact_full(self) -> None:
        """Write buckets afresh whose deltas have grown; all of them where there are many deltas."""
        m = self.manifest()
        base: dict[int, int] = {}
        grown: dict[int, int] = {}
        for p in m.of("base", "delta"):
            into = base if p.kind == "base" else grown
            for b, n in p.buckets.items():
                into[b] = into.get(b, 0) + n
        due = {b for b, n in grown.items() if n >= self.compact_at * base.get(b, 0)}
        if len(m.of("delta")) >= self.most_deltas:
            due = set(grown)
        if due:
            self.compact(due)

    def compact(self, buckets: set[int] | None = None) -> int:
        """Write the merged rows of buckets (all that have deltas) as their new base."""
        v = self.version() + 1
        m = self.manifest(v - 1)
        due = buckets if buckets is not None else {b for p in m.of("delta") for b in p.buckets}
        if not due:
            return v - 1
        folder = self._folder(v)
        present = sorted(due & {b for p in m.of("base", "delta") for b in p.buckets}) or sorted(due)
        n = session.slices_for(session.source_bytes(self._merged(m, due)))
        for group in filter(None, (set(present[k::n]) for k in range(n))):
            spread(self._merged(m, group), [BUCKET]).sortWithinPartitions(BUCKET, *m.keys).write.mode("append").options(**session.STORED).parquet(
                f"{self.root}/{folder}")
        counts = self.spark.read.schema(f"{BUCKET} int").parquet(f"{self.root}/{folder}").groupBy(BUCKET).count().collect()
        held = {b: 0 for b in due} | {r[BUCKET]: r["count"] for r in counts}
        return self._publish(v, replace(m, parts=(*m.without_buckets(due), Part(folder, "base", held))))

    def archive(self, old: Callable[[DataFrame], DataFrame], elsewhere: str | None = None) -> int:
        """Move rows to the archive, which the same pointer lists: a reader sees a row on one side, never on both or none.

        `old` adds the boolean column `_old` to rows of the table. Appended folders without an old row stay as they are,
        folders of old rows only change sides without being written, and the others are written as two. `elsewhere` is
        a folder for the archive's new files.
        """
        v = self.version() + 1
        m = self.manifest(v - 1)
        if m.of("delta"):
            self.compact()
            v, m = self.version() + 1, self.manifest()
        marked = {p.folder: old(self._layer([p], None) if p.kind == "base" else self._load([p])) for p in m.of("rows", "base")}
        totals = None
        for name, df in marked.items():
            one = df.agg(F.lit(name).alias("folder"), F.count_if("_old").alias("n_old"), F.count(F.lit(1)).alias("n"))
            totals = one if totals is None else totals.unionByName(one)
        counts = {r["folder"]: (r["n_old"], r["n"]) for r in totals.collect()} if totals is not None else {}
        parts, away = [], []
        for p in m.parts:
            n_old, n = counts.get(p.folder, (0, 0))
            if not n_old:
                parts.append(p)
            elif n_old == n and p.kind == "rows" and elsewhere is None:
                away.append(replace(p, kind="archive"))
            else:
                folder = self._folder(v)
                stays = marked[p.folder].where(~F.col("_old")).drop("_old")
                order = [BUCKET, *m.keys] if p.kind == "base" else []
                out = spread(stays, order[:1])
                (out.sortWithinPartitions(*order) if order else out).write.parquet(f"{self.root}/{folder}")
                held = {}
                if p.kind == "base":
                    counted = self.spark.read.schema(f"{BUCKET} int").parquet(f"{self.root}/{folder}").groupBy(BUCKET).count()
                    held = {r[BUCKET]: r["count"] for r in counted.collect()} or {0: 0}
                parts.append(replace(p, folder=folder, buckets=held, by=(), schema=""))
                goes = f"{elsewhere.rstrip('/')}/{uuid.uuid4().hex[:12]}" if elsewhere else self._folder(v)
                spread(marked[p.folder].where("_old").drop("_old", BUCKET, REASON, READER)).write.parquet(self.at(goes))
                away.append(Part(goes, "archive"))
        return self._publish(v, replace(m, parts=(*parts, *away))) if away else v - 1
