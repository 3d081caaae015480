"""Relational store as Parquet tables: load a run, embed it, roll it back, look rows up, count them.

The ledger is a row of numbered files, each put there only if its number is free: so one of two loads at once gets the
number, and the other goes on from its state. A file holds the whole state: for ``parts`` and ``models`` the version of each
bucket (by a hash of the key), for the tables by run the folder. A load rewrites the buckets that its keys are in and
nothing else; old versions stay for those who read them until ``vacuum``. What has no file in the ledger is never seen.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle.operators import resolve, search

SCHEMAS = {
    "parts": "part_no string, part_name string, description string, part_type string, bom_level int, source_file string, form_version string, run_id string, updated_at timestamp",
    "models": "model_code string, model_name string, grade_suffix string, region string, run_id string",
    "bom_edges": "model_code string, parent_part_no string, child_part_no string, qty double, run_id string",
    "change_events": "event_id long, base_part_no string, new_part_no string, model_code string, change_type string, bom_level int, change_point string, change_reason string, form_version string, source_file string, raw_data string, created_at timestamp, change_point_embedding array<float>, run_id string",
    "event_details": "event_id long, detail_type string, detail_json string, run_id string",
    "preprocessing_runs": "n long, run_id string, status string, at timestamp, row_counts map<string,long>, folders map<string,string>",
}
BY_RUN = ("bom_edges", "change_events", "event_details")
#: The catalogue: keys, and references to them, as ``init`` writes it. A null refers to nothing.
KEYS = {"parts": "part_no", "models": "model_code", "change_events": "event_id"}
REFERENCES = {"change_events": {"base_part_no": "parts", "new_part_no": "parts", "model_code": "models"}}
#: Buckets of an upserted table, and how often a load goes on from another's state.
BUCKETS, ATTEMPTS = 64, 20


class Refused(ValueError):
    """The run cannot be loaded, whatever is tried."""


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` with other keys. Keys are unique in each."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti").select(*new.columns))


def at_once(spark: SparkSession, *acts: Callable) -> list:
    """What acts give that need nothing of each other: each is a row of small jobs, which alone would leave cores idle."""
    with ThreadPoolExecutor(len(acts)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(act)) for act in acts]]


def bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Files

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> dict[str, float]:
        """What is in a folder, with its time in seconds."""
        fs, p = self._fs(f"{self.root}/{folder}")
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in fs.listStatus(p)} if fs.exists(p) else {}

    def _text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put_if_absent(self, path: str, text: str) -> bool:
        """Whether the file could be put there: whole, and by one of all who try."""
        jvm = self.spark._jvm
        fs, target = self._fs(path)
        fs.mkdirs(target.getParent())
        temp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getScheme() == "file":  # there a rename does not fail for sure, a link does
                place = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
                jvm.java.nio.file.Files.createLink(place(target), place(temp))
            else:
                rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                none = self.spark.sparkContext._gateway.new_array(rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(temp, target, none)
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(temp, False)

    # State

    def init(self) -> bool:
        """Writes the catalogue (schemas, keys, references); False where it is there already."""
        return self._put_if_absent(f"{self.root}/catalogue.json", json.dumps({"schemas": SCHEMAS, "keys": KEYS, "references": REFERENCES, "buckets": BUCKETS}, indent=1))

    def _state(self) -> dict:
        last = max((x for x in self._names("ledger") if x.endswith(".json")), default=None)
        return json.loads(self._text(f"{self.root}/ledger/{last}")) if last else {"n": 0, "tables": {}}

    def _commit(self, state: dict, run_id: str, status: str, counts: dict[str, int], folders: dict[str, str], tables: dict) -> bool:
        n = state["n"] + 1
        entry = {"n": n, "run_id": run_id, "status": status, "at": datetime.now(timezone.utc).isoformat(), "row_counts": counts, "folders": folders, "tables": tables}
        return self._put_if_absent(f"{self.root}/ledger/{n:012d}.json", json.dumps(entry))

    def _ledger(self) -> DataFrame:
        schema = SCHEMAS["preprocessing_runs"]
        return self.spark.read.schema(schema).json(f"{self.root}/ledger") if self._names("ledger") else self._empty("preprocessing_runs")

    def runs(self) -> DataFrame:
        """A row a run: its last status and what its last act counted."""
        last = self._ledger().groupBy("run_id").agg(F.max_by(F.struct("status", "row_counts", "folders"), "n").alias("v"))
        return last.select("run_id", "v.*")

    def not_loaded(self, df: DataFrame) -> DataFrame:
        """Rows of runs that the ledger does not have."""
        return df.join(F.broadcast(self.runs().select("run_id")), "run_id", "left_anti")  # a row a run

    # Tables

    def _read(self, name: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(*paths) if paths else self._empty(name)

    def _empty(self, name: str) -> DataFrame:
        """No rows, which the optimizer knows: counting or joining them takes no job, and no Python worker."""
        columns = (F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(SCHEMAS[name]))
        return self.spark.range(1).select(*columns).where(F.lit(False))

    def _buckets(self, name: str, pointers: dict[str, str]) -> DataFrame:
        return self._read(name, [f"{self.root}/{name}/{v}/bucket={b}" for b, v in sorted(pointers.items())])

    def table(self, name: str, run_id: str | None = None) -> DataFrame:
        """A table as it is now, or the rows that it has of one run; later loads do not change what has been given."""
        if name == "preprocessing_runs":
            return self._ledger()
        if name in ("parts", "models"):
            now = self._buckets(name, self._state()["tables"].get(name, {}))
            return now.where(F.col("run_id") == run_id) if run_id else now
        return self._read(name, self._folders(run_id)[name])

    def _folders(self, run_id: str | None = None) -> dict[str, list[str]]:
        """Where the tables by run have the rows of the runs that are loaded, or of one run."""
        loaded = self.runs().where("status = 'loaded'").where(F.col("run_id") == run_id if run_id else F.lit(True))
        found = [r["folders"] or {} for r in loaded.select("folders").collect()]  # a row a run
        return {name: sorted(f"{self.root}/{name}/{f[name]}" for f in found if f.get(name)) for name in BY_RUN}

    def _counts(self, run_id: str) -> dict[str, int]:
        """Rows that the tables by run have of one run; what has no folder has none."""
        return {name: self._read(name, paths).count() if paths else 0 for name, paths in self._folders(run_id).items()}

    def lookup(self, name: str, value, run_id: str | None = None) -> DataFrame:
        """Rows by the table's key. Of parts and models one bucket is read, a file; of events the runs' files (or one run's)
        as far as their Bloom filters let the key be there."""
        key = KEYS[name]
        if name == "change_events":
            return self.table(name, run_id).where(F.col(key) == value)
        b = str(self.spark.range(1).select(bucket(F.lit(value)).alias("b")).first()["b"])
        pointers = self._state()["tables"].get(name, {})
        return self._buckets(name, {b: pointers[b]} if b in pointers else {}).where(F.col(key) == value)

    def _written(self, df: DataFrame, path: str, key: str, by: str | None = None) -> None:
        """In order of the key, with a Bloom filter on it."""
        out = df.write.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.page.size", 1 << 16)
        (out.partitionBy(by) if by else out).parquet(path)

    def _merged(self, name: str, new: DataFrame, pointers: dict[str, str], some: list[str], version: str) -> dict[str, str]:
        """Buckets ``some`` of a table with the rows of ``new``, as a version of their own."""
        key = KEYS[name]
        done = new.where(F.col("bucket").isin([int(b) for b in some]))
        if old := {b: pointers[b] for b in some if b in pointers}:
            done = upserted(self._buckets(name, old).withColumn("bucket", bucket(key)), done, [key])
        done = done.repartition(len(some), "bucket").sortWithinPartitions("bucket", key)  # a file a bucket, however few rows
        self._written(done, f"{self.root}/{name}/{version}", key, "bucket")
        return dict.fromkeys(some, version)

    # Acts

    def load(self, rows: DataFrame, run_id: str, embedder=None) -> dict[str, int]:
        """Loads the rows without a reason; with an ``embedder`` (texts to vectors) also the events' vectors. A run that
        the ledger has, or one without rows, is refused. Events that break the catalogue's rules, new ones being checked
        only, go to ``rejected`` instead."""
        state = self._state()
        self._refuse_known(run_id)
        version = f"{run_id}-{uuid.uuid4().hex[:8]}"
        untyped = {f.name: F.lit(None).cast("string") for f in rows.schema if f.dataType.simpleString() == "void"}
        clean = self._new(rows.where("_quarantine_reason is null").withColumns(untyped), "rows", version)  # whatever needs them
        if clean.isEmpty():
            fs, p = self._fs(f"{self.root}/new/{version}")
            fs.delete(p, True)
            raise Refused(f"run {run_id} has no rows")
        new, some, counts = {}, {}, {}

        def keyed(name: str, rows: DataFrame) -> None:
            new[name] = self._new(rows.withColumn("bucket", bucket(KEYS[name])), name, version)  # however often the merge is tried
            found = new[name].groupBy("bucket").agg(F.count("*").alias("n")).collect()  # a row a bucket
            some[name], counts[name] = sorted(str(r["bucket"]) for r in found), sum(r["n"] for r in found)

        merged = lambda name: self._merged(name, new[name], state["tables"].get(name, {}), some[name], version)
        *_, events = at_once(self.spark, lambda: keyed("parts", parts(clean, run_id)), lambda: keyed("models", models(clean, run_id)), lambda: self._events(clean, run_id, version))
        made: dict[str, dict[str, str]] = {}
        made["parts"], made["models"], n = at_once(self.spark, lambda: merged("parts"), lambda: merged("models"), lambda: self._kept(events, run_id, version, new, embedder))
        counts |= n
        for attempt in range(1, ATTEMPTS + 1):
            tables = {name: state["tables"].get(name, {}) | made[name] for name in made}
            if self._commit(state, run_id, "loaded", counts, {"change_events": version}, tables):
                return counts
            # another act came first: what it left alone still holds, other buckets are merged again
            self._refuse_known(run_id)
            before, state = state, self._state()
            for name in made:
                pointer = lambda s, b: s["tables"].get(name, {}).get(b)  # noqa: E731, B023
                moved = [b for b in some[name] if pointer(before, b) != pointer(state, b)]
                if moved:
                    made[name] |= self._merged(name, new[name], state["tables"].get(name, {}), moved, f"{version}-{attempt}")
        raise OSError(f"run {run_id}: {ATTEMPTS} other acts came first")

    def _refuse_known(self, run_id: str) -> None:
        if not self._ledger().where(F.col("run_id") == run_id).isEmpty():
            raise Refused(f"run {run_id} is loaded already")

    def _new(self, df: DataFrame, name: str, version: str) -> DataFrame:
        """Rows of a load, computed once."""
        at = f"{self.root}/new/{version}/{name}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def _events(self, clean: DataFrame, run_id: str, version: str) -> DataFrame:
        """The rows' events; ``_n`` numbers those of one id."""
        place = Window.partitionBy("event_id").orderBy("raw_data")
        made = change_events(clean, run_id).withColumn("run_id", F.lit(run_id)).withColumn("_n", F.row_number().over(place))
        return self._new(made, "change_events", version)

    def _kept(self, made: DataFrame, run_id: str, version: str, new: dict[str, DataFrame], embedder) -> dict[str, int]:
        """Writes the events that keep the catalogue's rules, and apart those that break them; counts both."""
        bad = broken(made, new, self.table("change_events").select("event_id"))
        gone = f"{self.root}/rejected/{version}"
        bad.withColumn("run_id", F.lit(run_id)).write.parquet(gone)
        bad = self.spark.read.schema(bad.schema).parquet(gone)
        made = made.where("_n = 1").join(bad.where("constraint != 'unique'").select("event_id"), "event_id", "left_anti").drop("_n")
        if embedder:
            made = search.embed(made, "change_point", "change_point_embedding", embedder)
        done = f"{self.root}/change_events/{version}"
        self._written(made.sortWithinPartitions("event_id"), done, "event_id")
        refused = bad.count()
        return {"change_events": self._read("change_events", [done]).count()} | ({"rejected": refused} if refused else {})

    def rejected(self, run_id: str) -> DataFrame:
        """(event_id, constraint, value, raw_data, run_id): what a run's load refused."""
        folders = [f for f in self._names("rejected") if f.rpartition("-")[0] == run_id]
        return self.spark.read.schema("event_id long, constraint string, value string, raw_data string, run_id string").parquet(*(f"{self.root}/rejected/{f}" for f in folders))

    def _again(self, run_id: str, status: str, counts: dict[str, int], folders: dict[str, str]) -> None:
        """An act on one run alone: whatever others did meanwhile stays."""
        for _ in range(ATTEMPTS):
            state = self._state()
            if self._commit(state, run_id, status, counts, folders, state["tables"]):
                return
        raise OSError(f"run {run_id}: {ATTEMPTS} other acts came first")

    def update_embeddings(self, run_id: str, embedder=None) -> int:
        """The vectors of a run's events, all anew; a null text counts as empty. They are a version of their own, which holds
        from its ledger file on."""
        last = self.runs().where((F.col("run_id") == run_id) & (F.col("status") == "loaded")).first()
        if last is None:
            return 0
        version = f"{run_id}-{uuid.uuid4().hex[:8]}"
        done = f"{self.root}/change_events/{version}"
        self._written(search.embed(self.table("change_events", run_id), "change_point", "change_point_embedding", embedder or search.hashed_vectors), done, "event_id")
        self._again(run_id, "loaded", last["row_counts"], {"change_events": version})
        return self._read("change_events", [done]).count()

    def rollback(self, run_id: str) -> dict[str, int]:
        """The run's rows are no longer in the tables by run; parts and models stay."""
        counts = self._counts(run_id)
        self._again(run_id, "rolled_back", counts, {})
        return counts

    def vacuum(self, grace: float = 86_400.0) -> int:
        """Deletes versions that the last state does not have and that are older than ``grace`` seconds, in which loads end and
        readers let go of what they read. Returns how many."""
        state, n = self._state(), 0
        held = {name: set(pointers.values()) for name, pointers in state["tables"].items()}
        for r in self.runs().where("status = 'loaded'").collect():  # a row a run
            for name, folder in r["folders"].items():
                held.setdefault(name, set()).add(folder)
        for name in ("parts", "models", *BY_RUN, "new"):
            for folder, at in self._names(name).items():
                if folder not in held.get(name, ()) and time.time() - at > grace:
                    fs, p = self._fs(f"{self.root}/{name}/{folder}")
                    fs.delete(p, True)
                    n += 1
        return n

    def verify(self, run_id: str) -> dict[str, int]:
        return {name: self.table(name, run_id).count() for name in ("parts", "models")} | self._counts(run_id)


def broken(events: DataFrame, new: dict[str, DataFrame], known: DataFrame) -> DataFrame:
    """(event_id, constraint, value, raw_data): rows of an id behind its first (``_n`` counts them), ids that are known, and
    references to no row. Parts and models of the events' own run are in ``new``, so nothing older has to be looked at for
    references."""
    none = F.lit(None).cast("string").alias("value")
    out = events.where("_n > 1").select("event_id", F.lit("unique").alias("constraint"), none, "raw_data")
    first = events.where("_n = 1")
    out = out.unionAll(first.join(known, "event_id", "left_semi").select("event_id", F.lit("known").alias("constraint"), none, "raw_data"))
    for table in ("parts", "models"):
        columns = [c for c, t in REFERENCES["change_events"].items() if t == table]
        cells = first.select("event_id", "raw_data", F.explode(F.array(*(F.struct(F.lit(c).alias("constraint"), F.col(c).alias("value")) for c in columns))).alias("r")).select("event_id", "r.*", "raw_data")
        out = out.unionAll(cells.where("value is not null").join(new[table].select(F.col(KEYS[table]).alias("value")), "value", "left_anti").select("event_id", "constraint", "value", "raw_data"))
    return out


#: Fixed value: bits of a row's number in an appearance's, which also has the file's number above and the role below.
ROW_BITS = 41


def parts(df: DataFrame, run_id: str) -> DataFrame:
    """Distinct base and new parts; attributes from the first appearance by file and row, base before new.

    An appearance is one long, so that the least of a part is found by hashing; the winners' attributes are joined after.
    Of repeated rows of one file and number the first by value counts."""
    files = df.select(F.col("source_file").alias("_name")).distinct().withColumn("_file", F.row_number().over(Window.orderBy("_name")).cast("long"))  # a row a file
    row = F.coalesce(F.col("row_index").cast("long"), F.lit(-1)) + 1
    fits = (row >= 0) & (row < 1 << ROW_BITS) & (F.col("_file") < 1 << 62 - ROW_BITS)
    at = F.when(fits, F.shiftleft("_file", ROW_BITS).bitwiseOR(row)).otherwise(F.raise_error(F.lit("a row's or file's number is too large")))
    rows = df.join(files, df["source_file"].eqNullSafe(files["_name"])).withColumn("_at", at)
    both = F.explode(F.array(F.struct(F.lit(0).alias("role"), F.col("base_part_no").alias("part_no")), F.struct(F.lit(1).alias("role"), F.col("new_part_no").alias("part_no"))))
    seen = rows.select("_at", both.alias("p")).where(F.col("p.part_no").isNotNull() & (F.trim("p.part_no") != ""))
    first = seen.groupBy(F.col("p.part_no").alias("part_no")).agg(F.min(F.shiftleft("_at", 1).bitwiseOR(F.col("p.role").cast("long"))).alias("_least"))
    attributes = ["part_name", "part_type", "bom_level", "source_file", "form_version"]
    mine = rows.select(F.col("_at").alias("_mine"), *attributes).withColumn("_n", F.row_number().over(Window.partitionBy("_mine").orderBy(*attributes))).where("_n = 1")
    won = first.join(mine, F.shiftright("_least", 1) == F.col("_mine"))
    return won.select("part_no", "part_name", F.lit(None).cast("string").alias("description"), "part_type", "bom_level", "source_file", "form_version", F.lit(run_id).alias("run_id"), F.current_timestamp().alias("updated_at"))


def models(df: DataFrame, run_id: str) -> DataFrame:
    codes = df.where(F.col("model_code").isNotNull()).select("model_code").dropDuplicates()
    return codes.select("model_code", resolve.parse_model(F.col("model_code")).alias("m")).select("model_code", "m.*", F.lit(run_id).alias("run_id"))


def change_events(df: DataFrame, run_id: str) -> DataFrame:
    """Events with an id from the run, the file and the row, the same at each attempt; raw_data is the row as JSON."""
    raw = F.to_json(F.struct(*(c for c in df.columns if not c.startswith("_"))), {"ignoreNullFields": "false"})
    id_ = F.xxhash64(F.lit(run_id), "source_file", "row_index").bitwiseAND(F.lit((1 << 63) - 1))
    return df.select(id_.alias("event_id"), "base_part_no", "new_part_no", "model_code", "change_type", "bom_level", "change_point", "change_reason", "form_version", "source_file", raw.alias("raw_data"), F.current_timestamp().alias("created_at"), F.lit(None).cast("array<float>").alias("change_point_embedding"))
