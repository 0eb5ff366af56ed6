"""The table layers as Parquet folders below one root."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from .. import schemas
from ..operators.ingest import parse_lines, stage_logs
from ..operators.merge import changes, upsert
from ..operators.numbering import starts
from ..scratch import Scratch, hadoop_path, path_exists

# Bytes up to which the stored pieces of raw requests are broadcast: some millions of them.
PIECES_AT_ONCE = 16 << 20

# The folder of staged requests without a date.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


def _any_of(values: list) -> str:
    """A pattern for one of the values; it matches nothing if there are none."""
    return "{" + ",".join(str(value) for value in values) + "}" if values else "none"


def _loads(loads: list[int] | None) -> str:
    return "load_id=*" if loads is None else f"load_id={_any_of(loads)}"


@dataclass(frozen=True)
class Load:
    load_id: int
    accepted: int
    rejected: int


class LogTables:
    """Raw requests by load, staged requests by day and load, and the keyed aggregate tables.

    A folder that does not exist yet reads as an empty table of its schema. Of
    a table, only the folders asked for are listed, so that a day or a load
    costs the same however many there are.

    The parts of keyed tables, days or months, are never written in place: a
    write makes folders of a new version, and a list of the folders that count
    is published last. Readers see the table before or after, never between.
    """

    def __init__(self, spark: SparkSession, root: str, scratch: Scratch | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.scratch = scratch or Scratch(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType, parts: str | None = None) -> DataFrame:
        """A table, or those of its folders that a pattern matches: found in one call, however many."""
        folder = self.path(name)
        if parts is None:
            paths = [folder] if path_exists(self.spark, folder) else []
        else:
            paths = [path.toString() for path in self._listed(f"{name}/{parts}")]
        if paths:
            return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)
        return self.spark.createDataFrame([], schema)

    def raw(self, loads: list[int] | None = None) -> DataFrame:
        """All raw requests of finished loads, or those of some loads.

        Ids are 1, 2, 3, .. without gaps, in the order of loads, and within a
        load of files by path and of lines in a file. They aren't stored with
        the requests: a task writes those of a split of the log in the order of
        the lines, so an id is the row's number in its file plus what the
        pieces before it add up to. They stay the same whenever they are read.
        """
        stored = self._stored(loads)
        if stored is None:
            return self.spark.createDataFrame([], schemas.RAW)
        pieces = self._read("raw_pieces", schemas.PIECES, _loads(loads))
        if self._bytes(f"raw_pieces/{_loads(loads)}/*.parquet") <= PIECES_AT_ONCE:
            pieces = F.broadcast(pieces)
        # an unfinished load has no pieces, so its rows don't show
        rows = stored.join(pieces, ["load_id", "task", "place"])
        rows = rows.withColumn("id", F.col("first_id") + F.col("row") - F.col("first_row"))
        return rows.select(*schemas.RAW.names)

    def _stored(self, loads: list[int] | None) -> DataFrame | None:
        """The accepted requests as written, with `place`, the split of the log they come from, and `row`, their number in a file."""
        paths = [path.toString() for path in self._listed(f"raw_logs/{_loads(loads)}/accepted=true")]
        if not paths:
            return None
        rows = self.spark.read.schema(schemas.STORED).option("basePath", self.path("raw_logs")).parquet(*paths)
        place = F.xxhash64("log_file", "log_block")  # tells the few splits apart that one task read
        return rows.select("*", place.alias("place"), F.col("_metadata.row_index").alias("row"))

    def _bytes(self, pattern: str) -> int:
        fs, hpath = hadoop_path(self.spark, f"{self.root}/{pattern}")
        return sum(status.getLen() for status in fs.globStatus(hpath) or [])

    def rejects(self, loads: list[int] | None = None) -> DataFrame:
        """The lines that loads, also those of streams, left out: load_id, value."""
        return self._read("raw_logs", schemas.REJECTS, f"{_loads(loads)}/accepted=false").select(*schemas.REJECTS.names)

    def staged(self, days: list[dt.date] | None = None, loads: list[int] | None = None) -> DataFrame:
        """All staged requests, or those of some days, or of some loads on these days."""
        parts = None if days is None else f"request_date={_any_of(days)}"
        if parts is not None and loads is not None:
            parts = f"{parts}/load_id={_any_of(loads)}"
        rows = self._read("stg_logs", schemas.STAGED, parts).select(*schemas.STAGED.names)
        return rows if loads is None else rows.where(F.col("load_id").isin(loads))

    def table(self, name: str, parts: list[dt.date] | None = None) -> DataFrame:
        """A keyed table, or some of its parts: days, or first days of months where it is split by month."""
        return self._parts(name, parts).select(*schemas.TABLES[name].schema.names)

    # -- loading -----------------------------------------------------------

    def _listed(self, pattern: str) -> list:
        fs, hpath = hadoop_path(self.spark, f"{self.root}/{pattern}")
        return [status.getPath() for status in fs.globStatus(hpath) or []]

    @staticmethod
    def _marks(name: str) -> str:
        """Where `_SUCCESS` notes a finished load: raw requests count once they are numbered."""
        return "raw_pieces" if name == "raw_logs" else name

    def is_finished(self, name: str, load_id: int) -> bool:
        return path_exists(self.spark, f"{self.path(self._marks(name))}/load_id={load_id}/_SUCCESS")

    def _newest_first(self, name: str) -> Iterator[int]:
        marks = self._listed(f"{self._marks(name)}/load_id=*/_SUCCESS")
        return iter(sorted((int(mark.getParent().getName().split("=")[1]) for mark in marks), reverse=True))

    def loads(self, name: str) -> list[int]:
        """The finished loads of `raw_logs`, `staged` or `refreshed`, from the folder listing alone."""
        return sorted(self._newest_first(name))

    def mark(self, name: str, load_id: int) -> None:
        """Note that a load is `staged` or `refreshed`."""
        fs, hpath = hadoop_path(self.spark, f"{self.path(name)}/load_id={load_id}/_SUCCESS")
        fs.create(hpath, True).close()

    def next_load(self) -> int:
        """The number after all finished loads and all that batches of streams were given; an unfinished load is replaced."""
        given = [int(path.getName().split("=")[1]) for path in self._listed("stream_batches/*/load_id=*")]
        return max([next(self._newest_first("raw_logs"), 0), *given]) + 1

    def load_of_batch(self, stream: str, batch_id: int) -> int:
        """The load number of a batch of a stream; the same one whenever it is asked for again.

        Only the last batch of a stream can come again, so notes of earlier
        ones are dropped and their listing stays short.
        """
        given = self._listed(f"stream_batches/{stream}-{batch_id}/load_id=*")
        if given:
            return int(given[0].getName().split("=")[1])
        load_id = self.next_load()
        fs, hpath = hadoop_path(self.spark, f"{self.root}/stream_batches/{stream}-{batch_id}/load_id={load_id}")
        fs.mkdirs(hpath)
        for note in self._listed(f"stream_batches/{stream}-*"):
            if int(note.getName().rsplit("-", 1)[1]) < batch_id - 1:
                fs.delete(note, True)
        return load_id

    def _first_free_id(self) -> int:
        # Ids grow from load to load, and a load notes the first one after its own.
        for load_id in self._newest_first("raw_logs"):
            noted = self._listed(f"raw_pieces/load_id={load_id}/_next_id=*")
            if noted:
                return int(noted[0].getName().split("=")[1])
            pieces = self._read("raw_pieces", schemas.PIECES, f"load_id={load_id}")
            free = pieces.agg(F.max(F.col("first_id") + F.col("size"))).first()[0]
            if free is not None:
                return free
        return 1

    def _number(self, load_id: int, first_id: int, accepted: int) -> None:
        """Give a written load its ids, from `first_id` on: one short row a task and split, from three narrow columns."""
        stored = self._stored([load_id])
        if stored is None:
            pieces = self.spark.createDataFrame([], schemas.PIECES)
        else:
            sizes = stored.groupBy("task", "log_file", "log_block", "place").agg(F.min("row").alias("first_row"), F.count("*").alias("size"))
            pieces = starts(sizes, "log_file", "log_block", "task").withColumn("first_id", F.col("start") + first_id)
        folder = f"{self.path('raw_pieces')}/load_id={load_id}"
        stored_names = [name for name in schemas.PIECES.names if name != "load_id"]
        pieces.select(*stored_names).coalesce(1).write.mode("overwrite").parquet(folder)
        fs, hpath = hadoop_path(self.spark, f"{folder}/_next_id={first_id + accepted}")
        fs.create(hpath, True).close()

    def load(self, lines: DataFrame, load_id: int | None = None, rejects_path: str | None = None) -> Load:
        """Append the lines as one load, accepted and rejected ones side by side, in one pass, and count both.

        The accepted ones are numbered, see `raw`; lines that didn't come from
        `read_log` or `stream_log`, and so have no place, in the order of the
        tasks. Nothing stops the same file from being loaded twice. An
        unfinished load of the same number is replaced. With `rejects_path`, rejected lines are
        written there as text as well.
        """
        if load_id is None:
            load_id = self.next_load()
        elif self.is_finished("raw_logs", load_id):
            raise ValueError(f"load {load_id} is finished")
        first_id = self._first_free_id()
        counts = Observation()
        places = {"log_file": F.lit(None).cast("string"), "log_block": F.lit(0).cast("long")}
        lines = lines.select("value", *[F.col(c) if c in lines.columns else other.alias(c) for c, other in places.items()])
        parsed = parse_lines(lines, keep=tuple(places)).observe(
            counts, F.count("*").alias("lines"), F.count_if(~F.col("parse_ok")).alias("rejected")
        )
        accepted = F.col("parse_ok")
        unparsed = "id", "load_id", "ingested_at"
        stored = [F.when(accepted, F.col(n)).alias(n) for n in schemas.RAW.names if n not in unparsed]
        rows = parsed.select(
            *stored, *places, F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("slot"), F.when(accepted, F.current_timestamp()).alias("ingested_at"), F.when(~accepted, F.col("value")).alias("value"),
            accepted.alias("accepted"),
        )
        folder = f"{self.path('raw_logs')}/load_id={load_id}"
        # the writer sorts a task's rows by `accepted` anyway; with the slot each kind keeps the order of the lines
        rows = rows.sortWithinPartitions("accepted", "slot").drop("slot")
        rows.write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("accepted").parquet(folder)
        seen = counts.get
        self._number(load_id, first_id, seen["lines"] - seen["rejected"])
        if rejects_path and seen["rejected"]:
            self.rejects([load_id]).select("value").write.mode("append").text(rejects_path)
        return Load(load_id, seen["lines"] - seen["rejected"], seen["rejected"])

    # -- staging -----------------------------------------------------------

    def stage(self, loads: list[int], spread_days: bool = False) -> None:
        """Stage some loads in one job, by day. Done again, it replaces what it wrote.

        No shuffle: a log file covers few days, so every task writes few files.
        Set `spread_days` for a backfill whose files mix many days; rows are
        then gathered by day, big days over several tasks.
        """
        rows = stage_logs(self.raw(loads))
        if spread_days:
            rows = rows.hint("rebalance", "request_date")
        self._replace_parts("stg_logs", rows, "request_date", "load_id")
        for load_id in loads:
            self.mark("staged", load_id)

    def stage_new(self, spread_days: bool = False) -> list[int]:
        """Stage the loads not staged yet, and return them.

        Loads are staged whole, so the raw requests still to do are known
        without comparing ids.
        """
        fresh = sorted(set(self.loads("raw_logs")) - set(self.loads("staged")))
        if fresh:
            self.stage(fresh, spread_days)
        return fresh

    def days_of(self, loads: list[int]) -> list[dt.date]:
        """The days the staged requests of these loads fall on, from the folder listing alone."""
        folders = [p for load_id in loads for p in self._listed(f"stg_logs/request_date=*/load_id={load_id}")]
        days = {folder.getParent().getName().split("=")[1] for folder in folders}
        return sorted(dt.date.fromisoformat(day) for day in days - {UNDATED})

    # -- keyed tables ------------------------------------------------------

    def _part_column(self, name: str) -> str:
        table = schemas.TABLES[name]
        return "month" if table.by_month else table.date_column

    def _with_part(self, name: str, rows: DataFrame) -> DataFrame:
        table = schemas.TABLES[name]
        if not table.by_month:
            return rows
        return rows.withColumn("month", F.trunc(table.date_column, "month"))

    def _lists(self, name: str) -> list[int]:
        """The versions whose lists are published, the last one first."""
        return sorted((int(path.getName()) for path in self._listed(f"{name}/_parts/*")), reverse=True)

    def _folders(self, name: str, version: int) -> dict[str, str]:
        """Part and folder of all parts that count in a version: one line a part."""
        fs, hpath = hadoop_path(self.spark, f"{self.path(name)}/_parts/{version}")
        stream = fs.open(hpath)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return dict(line.split("\t") for line in text.splitlines())

    def _parts(self, name: str, parts: list[dt.date] | None = None) -> DataFrame:
        table = schemas.TABLES[name]
        schema = table.schema
        if table.by_month:
            schema = T.StructType([*schema.fields, T.StructField("month", T.DateType())])
        versions = self._lists(name)
        folders = self._folders(name, versions[0]) if versions else {}
        wanted = folders if parts is None else {str(part) for part in parts} & folders.keys()
        paths = [f"{self.path(name)}/{folders[part]}" for part in wanted]
        if paths:
            rows = self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths)
            return rows.select(*schema.names)  # without the version
        return self.spark.createDataFrame([], schema)

    def _publish(self, name: str, rows: DataFrame) -> None:
        """Write rows that hold all rows of the parts they fall in, then put these parts in place of the ones before."""
        part = self._part_column(name)
        versions = self._lists(name)
        version = versions[0] + 1 if versions else 1
        folder = f"v={version}"
        # what an attempt that was not published left in the folder is replaced
        rows.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(f"{self.path(name)}/{folder}")
        before = self._folders(name, versions[0]) if versions else {}
        written = [path.getName() for path in self._listed(f"{name}/{folder}/{part}=*")]
        after = before | {new.split("=")[1]: f"{folder}/{new}" for new in written}
        fs, draft = hadoop_path(self.spark, f"{self.path(name)}/_draft-{version}")
        out = fs.create(draft, True)
        out.write("".join(f"{k}\t{v}\n" for k, v in after.items()).encode())
        out.close()
        lists = hadoop_path(self.spark, f"{self.path(name)}/_parts")[1]
        fs.mkdirs(lists)
        fs.rename(draft, hadoop_path(self.spark, f"{self.path(name)}/_parts/{version}")[1])
        # readers of the version before keep their files; older lists and what only they name go
        for old in versions[1:]:
            for unused in set(self._folders(name, old).values()) - set(before.values()) - set(after.values()):
                fs.delete(hadoop_path(self.spark, f"{self.path(name)}/{unused}")[1], True)
            fs.delete(hadoop_path(self.spark, f"{self.path(name)}/_parts/{old}")[1], False)

    def _replace_parts(self, name: str, rows: DataFrame, *part_columns: str) -> None:
        """Write the rows in place of the parts they fall in."""
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*part_columns).parquet(self.path(name))

    def _typed(self, name: str, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.TABLES[name].schema.fields])

    def replace_days(self, name: str, rows: DataFrame) -> None:
        """Write rows that hold every key of the days they fall on, of a table split by day."""
        self._publish(name, self._typed(name, rows))

    def upsert(self, name: str, source: DataFrame) -> int:
        """Insert or update the source's rows by the table's key; returns how many differ from what is there.

        Only parts with such rows are written, once; if there are none,
        nothing is.
        """
        table = schemas.TABLES[name]
        part = self._part_column(name)
        source = self.scratch.keep(self._with_part(name, self._typed(name, source)), f"{name}-new")
        parts = [row[0] for row in source.select(part).distinct().collect()]  # days or months
        target = self._parts(name, parts)
        new = self.scratch.keep(changes(target, source, table.keys), f"{name}-changes")
        counts = {row[0]: row[1] for row in new.groupBy(part).count().collect()}
        if counts:
            self._publish(name, upsert(self._parts(name, list(counts)), new, table.keys))
        return sum(counts.values())

    # -- partial aggregates ------------------------------------------------

    def add_partials(self, name: str, rows: DataFrame) -> None:
        """Keep what loads add, by day and load. Done again for a load, it replaces what it wrote."""
        schema = schemas.PARTIALS[name]
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        self._replace_parts(name, typed.hint("rebalance", "request_date"), "request_date", "load_id")

    def partials(self, name: str, days: list[dt.date]) -> DataFrame:
        """What all loads added to some days."""
        return self._read(name, schemas.PARTIALS[name], f"request_date={_any_of(days)}")

    # -- limits ------------------------------------------------------------

    def limits(self) -> list[float] | None:
        """The limits of volume that the anomalies were made with."""
        path = f"{self.path('limits')}/last"
        if not path_exists(self.spark, path):
            return None
        return [row[0] for row in self.spark.read.schema("value double, place int").parquet(path).orderBy("place").collect()]

    def set_limits(self, limits: list[float]) -> None:
        rows = self.spark.createDataFrame(list(zip(limits, range(len(limits)))), "value double, place int")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path('limits')}/last")

    def register_views(self) -> None:
        """All layers as temporary views, for SQL."""
        self.raw().createOrReplaceTempView("raw_logs")
        self.staged().createOrReplaceTempView("stg_logs")
        for name in schemas.TABLES:
            self.table(name).createOrReplaceTempView(name)
