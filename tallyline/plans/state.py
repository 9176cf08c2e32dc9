"""Where the tables live: Parquet folders plus one commit record per change.

Every job writes new folders ``<table>/commit=<n>`` and then, as its last step,
one commit record saying which folders are current. A job that dies before that
leaves nothing visible, and its retry overwrites the leftovers. One writer per
root at a time; readers may run any time.

Raw events and dead letters are append-only catalog tables, partitioned by
topic, Kafka partition and offset band. Which offsets are stored in full is
kept as disjoint ranges in a journal: an append says which offsets it is about
to store, stores those that no range covers, and only then adds their ranges.
So it compares with ranges instead of rows; rows are read again only where an
earlier append began and did not end. Jobs read up to the highest stored offset
of each partition, so an append that is only partly visible is not seen at all.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.apply import newest_records, upsert_ledger
from tallyline.operators import intervals, page_index
from tallyline.operators.dedup import absent_rows
from tallyline.schemas import (
    CHECK_RESULTS,
    CHECKPOINTS,
    DEAD_LETTERS,
    EVIDENCE,
    LEDGER,
    LEDGER_KEY,
    PARTITION_KEY,
    POSITION,
    RAW_EVENTS,
    REJECTS,
    RESULTS,
    RUNS,
)
from tallyline.session import settings

# Offsets per partition folder of the append-only tables: pruning on ``band``
# keeps readers away from history they have already processed.
BAND = 10_000_000
# Appends after which the journal of stored offsets starts anew from merged ranges.
JOURNAL_APPENDS = 100

_COMMITS = T.StructType(
    [
        T.StructField("commit", T.LongType()),
        T.StructField("appended", T.ArrayType(T.StringType())),
        T.StructField("body", T.StringType()),
    ]
)
# Rows of the journal: an append that ``started`` on offsets low..high, one that is ``closed``,
# a range that is ``stored``, and the ``base`` mark of a generation that begins with merged ranges.
_JOURNAL = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)
# The order of pages of one pair's results; together the columns identify one.
RESULT_ORDER = [("transaction_id", False), ("currency", False), ("left_source_system", False), ("right_source_system", False)]
_POSITIONED = {"raw_cdc_events": RAW_EVENTS, "cdc_dead_letters": DEAD_LETTERS}
# How rows are written. Jobs read them whole, so variants stay in one piece; and columns in which hardly
# a value comes twice fill a dictionary first that is then given up.
_WHOLE = {"spark.sql.variant.writeShredding.enabled": "false"}
_DISTINCT = (
    "kafka_offset", "event_timestamp", "kafka_timestamp", "source_timestamp", "source_lsn", "source_tx_id",
    *[f"{c}.{part}" for c in ("record_key", "before_payload", "after_payload", "payload") for part in ("value", "metadata")],
    "source_record_id", "transaction_id", "amount", "last_kafka_offset", "last_source_lsn", "last_cdc_event_timestamp",
    "source_payload", "left_amount", "right_amount",
)
WRITTEN = {f"parquet.enable.dictionary#{column}": "false" for column in _DISTINCT}
CURRENCIES = T.StructType(
    [T.StructField("currency", T.StringType()), T.StructField("enabled", T.BooleanType())]
)
_APPENDED = {"runs": RUNS, "check_results": CHECK_RESULTS, "cdc_rejects": REJECTS}


@dataclass(frozen=True)
class Journal:
    """What the journal says: its valid generation, the last number in use, and
    the appends that began and did not end as (number, topic, partition, low, high)."""

    generation: int = 0
    number: int = 0
    open: tuple[tuple, ...] = ()


@dataclass(frozen=True)
class Commit:
    """Which folders are current after commit ``number``."""

    number: int = 0
    last_run_id: int = 0
    checkpoints: int | None = None
    ledger_base: int | None = None  # the commit that wrote the bucketed table
    ledger_layers: list[int] = field(default_factory=list)  # commits of changes since, oldest first
    # [left, right, commit, ledger base and number of layers that they are of]; without
    # a pair the folder holds results of any.
    results: list[list] = field(default_factory=list)
    currencies: int | None = None


@dataclass(frozen=True)
class LastRun:
    """The stored results of a pair, the ledger they were made of, and its changes since."""

    results: DataFrame
    evidence: DataFrame
    ledger: DataFrame
    changes: DataFrame


class LedgerState:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        # Fixed for the life of a root; size it so that a bucket holds some
        # hundred megabytes of current records, one task each.
        self.buckets = buckets
        self._last = 0  # a commit that is known to exist
        self._known: set[tuple] = set()  # partitions that this session's catalog has

    # -- commits ---------------------------------------------------------

    def _commits(self) -> DataFrame:
        return self._read("_commits", _COMMITS)

    def _commit_record(self, number: int) -> DataFrame | None:
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/_commits/n={number}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def head(self) -> Commit:
        """The newest commit. Numbers follow each other, so it is found by asking for
        a few of them, and one record is read."""
        known, step = self._last, 1
        while self._commit_record(known + step) is not None:
            known, step = known + step, step * 2
        while step > 1:
            step //= 2
            if self._commit_record(known + step) is not None:
                known += step
        for number in range(known, 0, -1):  # a record that is being written is still empty
            row = self._commit_record(number).first()
            if row is not None:
                self._last = number
                return Commit(**json.loads(row["body"]))
        return Commit()

    def publish(self, base: Commit, appended: list[str] | None = None, **changes) -> Commit:
        """Make the folders written for ``base.number + 1`` current; ``appended``
        names the history tables that gained a folder."""
        new = replace(base, number=base.number + 1, **changes)
        body = json.dumps(new.__dict__, ensure_ascii=False)
        record = self.spark.createDataFrame([(new.number, appended or [], body)], _COMMITS)
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_commits/n={new.number}")
        return new

    # -- folders ---------------------------------------------------------

    def _read(self, table: str, schema: T.StructType, folders: list[str] | None = None) -> DataFrame:
        base = f"{self.root}/{table}"
        if folders is not None and not folders:
            return _empty(self.spark, schema)
        paths = [base] if folders is None else [f"{base}/{f}" for f in folders]
        try:
            return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        except AnalysisException as error:
            if folders is None and error.getCondition() == "PATH_NOT_FOUND":
                return _empty(self.spark, schema)
            raise

    def folder(self, table: str, commit: int) -> str:
        return f"{self.root}/{table}/commit={commit}"

    def write(self, df: DataFrame, table: str, commit: int, by: list[str] | None = None) -> None:
        writer = df.write.mode("overwrite")
        if by:
            # Rebalancing sizes the files: small buckets share a task, large
            # ones are divided.
            writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
        writer.options(**WRITTEN).parquet(self.folder(table, commit))

    def staged(self, table: str, commit: int) -> DataFrame:
        """A folder of an unpublished commit, written by the running job."""
        return self.spark.read.parquet(self.folder(table, commit))

    # -- snapshot tables -------------------------------------------------

    def checkpoints(self, head: Commit) -> DataFrame:
        commits = [] if head.checkpoints is None else [f"commit={head.checkpoints}"]
        return self._read("cdc_checkpoints", CHECKPOINTS, commits).select(*CHECKPOINTS.names)

    def _base_table(self, commit: int) -> str:
        return f"ledger_base_{hashlib.md5(self.root.encode()).hexdigest()[:16]}_{commit}"

    def write_base(self, ledger: DataFrame, commit: int) -> None:
        """Write the ledger as a table bucketed and sorted by its key."""
        (
            ledger.select(*LEDGER.names)
            .write.mode("overwrite")
            .bucketBy(self.buckets, *LEDGER_KEY)
            .sortBy(*LEDGER_KEY)
            .options(**WRITTEN)
            .option("path", self.folder("ledger_base", commit))
            .saveAsTable(self._base_table(commit), format="parquet")
        )

    def ledger_base(self, head: Commit) -> DataFrame:
        """The bucketed table of the last merge; joins on the ledger key need no exchange of it."""
        if head.ledger_base is None:
            return self.spark.createDataFrame([], LEDGER)
        name = self._base_table(head.ledger_base)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LEDGER.fields)
            keys = ", ".join(LEDGER_KEY)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{_quoted(self.folder('ledger_base', head.ledger_base))}'"
            )
        return self.spark.table(name)

    def ledger(self, head: Commit) -> DataFrame:
        """Current records: the base, guardedly updated by the newest of the changes since."""
        if not head.ledger_layers:
            return self.ledger_base(head)
        changes = self.ledger_changes(head)
        return upsert_ledger(self.ledger_base(head), newest_records(changes) if len(head.ledger_layers) > 1 else changes)

    def ledger_changes(self, head: Commit) -> DataFrame:
        """The rows of all layers; a key has at most one in each."""
        folders = [f"commit={c}" for c in head.ledger_layers]
        return self._read("ledger_changes", LEDGER, folders).select(*LEDGER.names)

    def currencies(self, head: Commit) -> DataFrame | None:
        """The stored currency list, if one was put."""
        if head.currencies is None:
            return None
        return self._read("supported_currencies", CURRENCIES, [f"commit={head.currencies}"])

    def write_results(self, results: DataFrame, commit: int) -> None:
        """Publish results range-sorted with fences, so that a page reads a file or two."""
        page_index.publish(results, RESULT_ORDER, self.folder("results", commit))

    def staged_results(self, commit: int) -> DataFrame:
        return self.spark.read.schema(RESULTS).parquet(f"{self.folder('results', commit)}/rows").select(*RESULTS.names)

    def results(self, head: Commit) -> DataFrame:
        frames = [self.staged_results(entry[2]) for entry in head.results]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], RESULTS)

    def evidence(self, head: Commit) -> DataFrame:
        folders = [f"commit={entry[2]}" for entry in head.results if entry[0] is not None]
        return self._read("result_evidence", EVIDENCE, folders).select(*EVIDENCE.names)

    def last_results(self, head: Commit, left: str, right: str) -> LastRun | None:
        """The pair's results with the ledger they are of and what changed since, if that is still there."""
        entry = next((e for e in head.results if e[:2] == [left, right]), None)
        if entry is None or entry[3] is None or entry[3] != head.ledger_base:
            return None
        of = replace(head, ledger_layers=head.ledger_layers[: entry[4]])
        since = replace(head, ledger_layers=head.ledger_layers[entry[4] :])
        return LastRun(
            self.staged_results(entry[2]),
            self._read("result_evidence", EVIDENCE, [f"commit={entry[2]}"]).select(*EVIDENCE.names),
            self.ledger(of),
            self.ledger_changes(since),
        )

    def appended(self, table: str, head: Commit) -> DataFrame:
        """Runs, check results or rejects, of published commits only."""
        schema = _APPENDED[table]
        rows = self._read(table, T.StructType([*schema.fields, T.StructField("commit", T.LongType())]))
        published = self._commits().where(
            (F.col("commit") <= head.number) & F.array_contains("appended", table)
        )
        return rows.join(published.select("commit"), "commit", "left_semi").select(*schema.names)

    # -- append-only tables ----------------------------------------------

    def events_table(self, table: str) -> str:
        """The name of the catalog table of ``table``, which is made if this session lacks it."""
        name = f"{table}_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in _POSITIONED[table].fields]
            by = ", ".join((*PARTITION_KEY, "band"))
            options = ", ".join(f"'{k}' '{v}'" for k, v in WRITTEN.items())
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}, band bigint) "
                f"USING parquet OPTIONS ({options}) PARTITIONED BY ({by}) LOCATION '{_quoted(f"{self.root}/{table}")}'"
            )
        return name

    def _events(self, table: str, bands: list[tuple[str, int, int]]) -> DataFrame:
        """The table, of which the catalog knows at least the given (topic, partition, band).

        Sessions that share a metastore share its partitions; any other learns from
        the journal which ones there are. No folder is listed for that.
        """
        name = self.events_table(table)
        missing = [b for b in bands if (table, *b) not in self._known]
        for k in range(0, len(missing), 500):
            specs = " ".join(
                f"PARTITION (kafka_topic='{_quoted(t)}', kafka_partition={p}, band={b})" for t, p, b in missing[k : k + 500]
            )
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
        self._known.update((table, *b) for b in missing)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def raw_events(self) -> DataFrame:
        return self._every("raw_cdc_events")

    def dead_letters(self) -> DataFrame:
        return self._every("cdc_dead_letters")

    def _every(self, table: str) -> DataFrame:
        journal = self._journal()
        bands = self._bands(self._stored(journal))
        begun = {(t, p, b) for _, t, p, low, high in journal.open for b in range(low // BAND, high // BAND + 1)}
        known = {(t, p, b) for t, p, b, _ in bands}
        return self._events(table, sorted(known | begun)).select(*_POSITIONED[table].names)

    # -- the journal of stored offsets -------------------------------------

    def _journal_rows(self) -> DataFrame:
        return self._read("ingest_journal", T.StructType([*_JOURNAL.fields, T.StructField("generation", T.IntegerType())]))

    def _write_journal(self, rows: DataFrame, generation: int, mode: str = "append") -> None:
        rows.coalesce(1).write.mode(mode).parquet(f"{self.root}/ingest_journal/generation={generation}")

    def _journal(self) -> Journal:
        """One small read: at most a few appends' rows besides the ranges, which stay where they are."""
        rows = self._journal_rows().where("kind <> 'stored'").collect()
        # A generation counts once its base mark is there; the first one needs none.
        generation = max((r["generation"] for r in rows if r["kind"] == "base"), default=0)
        closed = {r["number"] for r in rows if r["kind"] == "closed"}
        begun = {
            (r["number"], *(r[c] for c in (*PARTITION_KEY, "low", "high")))
            for r in rows
            if r["kind"] == "started" and r["number"] not in closed
        }
        return Journal(generation, max((r["number"] for r in rows), default=0), tuple(sorted(begun)))

    def _stored(self, journal: Journal) -> DataFrame:
        rows = self._journal_rows().where((F.col("generation") == journal.generation) & (F.col("kind") == "stored"))
        return rows.select(*PARTITION_KEY, "low", "high")

    def _bands(self, ranges: DataFrame) -> list[tuple[str, int, int, int]]:
        """(topic, partition, band, highest offset): one row for each partition folder."""
        rows = ranges.groupBy(*PARTITION_KEY, F.floor(F.col("low") / BAND).cast("bigint").alias("band"))
        return [tuple(r) for r in rows.agg(F.max("high").alias("high")).collect()]

    def stored_ranges(self) -> DataFrame:
        """(topic, partition, low, high): all offsets that are stored in full, as disjoint ranges."""
        return intervals.merged(self._stored(self._journal()))

    def marks(self) -> DataFrame:
        """(topic, partition, high): the highest offset that is stored in full."""
        return self._stored(self._journal()).groupBy(*PARTITION_KEY).agg(F.max("high").alias("high"))

    def store(self, batch: dict[str, DataFrame], staged: bool = False) -> None:
        """Store the rows of each table that are not stored yet; repeating it changes nothing.

        The rows are read twice: for their offsets, then for their content. With ``staged`` they
        are first written aside, which pays where offsets alone cost as much as the content
        (unparsed messages), and not where they are cheap or the batch is persisted.
        """
        if staged:
            folders = {table: f"{self.root}/ingest_rows/{table}" for table in batch}
            for table, rows in batch.items():
                with settings(rows.sparkSession, _WHOLE):
                    rows.select(*_POSITIONED[table].names).write.mode("overwrite").options(**WRITTEN).parquet(folders[table])
            batch = {t: self.spark.read.schema(_POSITIONED[t]).parquet(folder) for t, folder in folders.items()}
        begun = self._begin(*batch.values())
        if begun is not None:
            for table, rows in batch.items():
                self._insert(rows, table, begun)
            self._end(begun, [o[1:] for o in begun.open if o[0] == begun.number], self._announced(begun.number))
        if staged:
            for table, folder in folders.items():
                _empty(self.spark, _POSITIONED[table]).write.mode("overwrite").parquet(folder)

    def append_absent(self, rows: DataFrame, table: str) -> None:
        """The first half of :meth:`store`: the rows are there, but no job reads them yet."""
        begun = self._begin(rows)
        if begun is not None:
            self._insert(rows, table, begun)

    def complete(self, *batches: DataFrame) -> None:
        """Make the offsets of rows that are stored in full visible to the jobs."""
        journal = self._journal()
        ranges = self._announce(journal.number + 1, *batches)
        self._end(journal, self._spans(ranges), ranges)

    def _announced(self, number: int) -> DataFrame:
        """The ranges of an append, which its rows gave once."""
        fields = [f for f in _JOURNAL.fields if f.name not in ("number", "kind")]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.root}/ingest_ranges/number={number}")

    def _announce(self, number: int, *batches: DataFrame) -> DataFrame:
        """Write the offsets of an append as ranges, so that its rows are read for them once."""
        rows = batches[0].select(*POSITION)
        for batch in batches[1:]:
            rows = rows.unionByName(batch.select(*POSITION))
        ranges = intervals.islands(rows, BAND).select(*PARTITION_KEY, "low", "high")
        ranges.write.mode("overwrite").parquet(f"{self.root}/ingest_ranges/number={number}")
        return self._announced(number)

    def _spans(self, ranges: DataFrame) -> list[tuple]:
        spans = ranges.groupBy(*PARTITION_KEY).agg(F.min("low").alias("low"), F.max("high").alias("high"))
        return [tuple(r) for r in spans.collect()]  # one row per Kafka partition

    def _begin(self, *batches: DataFrame) -> Journal | None:
        """Announce the offsets of an append. Of what was open before, the result keeps
        what overlaps them, besides the append itself."""
        journal = self._journal()
        number = journal.number + 1
        spans = self._spans(self._announce(number, *batches))
        if not spans:
            return None
        own = [(number, *span) for span in spans]
        started = [(n, "started", t, p, low, high) for n, t, p, low, high in own]
        self._write_journal(self.spark.createDataFrame(started, _JOURNAL), journal.generation)
        near = {(t, p): (low, high) for t, p, low, high in spans}
        reach = lambda t, p: near.get((t, p), (1, 0))
        older = [o for o in journal.open if o[3] <= reach(*o[1:3])[1] and o[4] >= reach(*o[1:3])[0]]
        return Journal(journal.generation, number, (*older, *own))

    def _insert(self, rows: DataFrame, table: str, begun: Journal) -> None:
        """Insert the rows whose offset no range covers, one per position."""
        own = [o[1:] for o in begun.open if o[0] == begun.number]
        span = self.spark.createDataFrame(own, "kafka_topic string, kafka_partition int, first_offset bigint, last_offset bigint")
        fresh = intervals.uncovered(rows, self._stored(begun), span, BAND)
        older = [o[1:] for o in begun.open if o[0] < begun.number]
        if older:
            # An append that did not end may have left rows that no range covers.
            bands = sorted({(t, p, b) for t, p, low, high in older for b in range(low // BAND, high // BAND + 1)})
            left = self._events(table, bands).where(_within([(t, p, low, high) for t, p, low, high in older]))
            fresh = absent_rows(fresh, left)
        placed = fresh.withColumn("band", F.floor(F.col("kafka_offset") / BAND).cast("bigint"))
        if older:
            # The comparison left the rows of a band in many tasks.
            placed = placed.hint("rebalance", *PARTITION_KEY, "band").sortWithinPartitions(*PARTITION_KEY, "kafka_offset")
        name = self.events_table(table)
        with settings(rows.sparkSession, _WHOLE):
            placed.select(*self.spark.table(name).columns).write.insertInto(name)

    def _end(self, begun: Journal, spans: list[tuple], ranges: DataFrame) -> None:
        """Add the ranges of rows that are stored in full, which span ``spans``, and close
        the open appends that spanned no more.

        There may be as many ranges as rows, so any number of tasks writes them. Each is true
        as soon as it is there; the marks follow, and until then the append counts as open.
        """
        number = begun.number + 1
        own = {s[:2]: s[2:] for s in spans}
        beyond = {n for n, t, p, low, high in begun.open if not ((t, p) in own and own[t, p][0] <= low and high <= own[t, p][1])}
        closed = sorted({o[0] for o in begun.open} - beyond) or [number]
        rows = ranges.select(
            F.lit(number).cast("bigint").alias("number"), F.lit("stored").alias("kind"), *PARTITION_KEY, "low", "high"
        )
        rows.write.mode("append").parquet(f"{self.root}/ingest_journal/generation={begun.generation}")
        marks = self.spark.createDataFrame([(n, "closed", None, None, None, None) for n in closed], _JOURNAL)
        self._write_journal(marks, begun.generation)
        if number % JOURNAL_APPENDS == 0:
            self.merge_journal()

    def merge_journal(self) -> None:
        """Begin a new generation of the journal with merged ranges, and empty the one before the last."""
        journal = self._journal()
        new = journal.generation + 1
        number = journal.number + 1
        whole = intervals.merged(self._stored(journal), BAND)
        base = whole.select(F.lit(number).cast("bigint").alias("number"), F.lit("stored").alias("kind"), *PARTITION_KEY, "low", "high")
        base.write.mode("overwrite").parquet(f"{self.root}/ingest_journal/generation={new}")
        rows = [(number, "base", None, None, None, None)]
        rows += [(n, "started", t, p, low, high) for n, t, p, low, high in journal.open]
        self._write_journal(self.spark.createDataFrame(rows, _JOURNAL), new)
        if journal.generation > 0:
            # Readers of the last generation go on; the one before it becomes a folder without rows.
            self._write_journal(self.spark.createDataFrame([], _JOURNAL), journal.generation - 1, "overwrite")

    # -- incremental reads -------------------------------------------------

    def _raw_from(self, head: Commit, first: int) -> DataFrame:
        """Raw events up to the marks, from ``first`` beyond each checkpoint's folder on."""
        bands = self._bands(self._stored(self._journal()))
        marks: dict[tuple, int] = {}
        for t, p, _, high in bands:
            marks[t, p] = max(high, marks.get((t, p), high))
        done = {(r[0], r[1]): r[2] for r in self.checkpoints(head).select(*CHECKPOINTS.names[:3]).collect()}
        lows = {key: done.get(key, -1) + first for key in marks}
        wanted = [(*key, max(lows[key], 0) // BAND * BAND, high) for key, high in marks.items() if lows[key] <= high]
        known = [(t, p, b) for t, p, b, high in bands if lows[t, p] <= marks[t, p] and b >= max(lows[t, p], 0) // BAND]
        return self._events("raw_cdc_events", known).where(_within(wanted)).select(*RAW_EVENTS.names)

    def unprocessed_raw(self, head: Commit) -> DataFrame:
        """Raw events without the folders that lie wholly below the checkpoints.

        A superset of the unseen events: :func:`unseen_events` decides.
        """
        return self._raw_from(head, 1)

    def newest_raw(self, head: Commit) -> DataFrame:
        """Raw events from each checkpoint's folder on. A checkpoint is an offset
        that was stored, so every partition's newest event is among them."""
        return self._raw_from(head, 0)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, without the Python workers that an empty list would start."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _within(spans: list[tuple[str, int, int, int]]) -> Column:
    """Offsets low..high of (topic, partition, low, high), said of the partition columns as well."""
    condition = F.lit(False)
    for topic, partition, low, high in spans:
        condition = condition | (
            (F.col("kafka_topic") == topic)
            & (F.col("kafka_partition") == partition)
            & F.col("band").between(low // BAND, high // BAND)
            & F.col("kafka_offset").between(low, high)
        )
    return condition
