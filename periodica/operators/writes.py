"""Writes with relational semantics over plain Parquet folders.

A table is a folder with one sub-folder per version, ``v=1``, ``v=2`` and so on, and
each version has one sub-folder per write, ``segment=1`` and so on. Insert-if-absent
appends a segment to the current version; what changes rows starts the next version,
which may name partition folders of earlier versions that it leaves as they are.

A write first stores its rows where nobody reads them. It then takes the turn after
the last one that it had seen when it read the table, by creating a file that must
not exist (``v=1/turn=4``), and only then marks its rows as committed. If the turn
is taken, somebody else was faster: an insert looks through what has been stored
since and leaves those keys out, any other change starts over from the new rows. So
overlapping writers store a key once and lose no update, and a job that dies leaves
the rows as they were. A writer that dies between its turn and its mark has decided;
the next writer sets the mark for it. All results are functions of their inputs, so
a repeated job gives the same table.

The ``*_rows`` functions are the plain DataFrame part of each write.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType, VariantType

from periodica.functions.money import is_currency
from periodica.operators.aggregates import observe_counts
from periodica.operators.joins import absent_keys, null_safe_key
from periodica.session import forget, releasing, scratch_dir


@dataclass(frozen=True)
class WriteStats:
    """Counters of one write; ``error`` is set when the batch was rolled back."""

    processed: int = 0
    inserted: int = 0
    updated: int = 0
    skipped: int = 0
    error: str | None = None

    def __add__(self, other: WriteStats) -> WriteStats:
        sums = {k: v + getattr(other, k) for k, v in asdict(self).items() if k != "error"}
        return WriteStats(**sums, error=self.error or other.error)


class Overlap(RuntimeError):
    """Another writer changed the table after it was read."""


@dataclass(frozen=True)
class State:
    """What a reader of a table saw: its version and the last turn taken in it."""

    version: int = 0
    turn: int = 0


#: How often a write starts over before it gives up.
ATTEMPTS = 20
_MARK, _KEPT, _ORIGIN, _NULL = "_SUCCESS", "kept", "origin", "__HIVE_DEFAULT_PARTITION__"
#: How rows are stored; identifiers are digits of hashes, which only a codec with entropy coding makes shorter.
CODEC = "zstd"
#: Rows that are shuffled at a time where a job can be done part by part, unless a single part has more.
ROUND_ROWS = 16_000_000
#: Parts of a partition, by the first column it is sorted by, that lie in files of their own.
BUCKETS = 1024


def rounds(sizes: Iterable[tuple]) -> list[list]:
    """Parts, each with its number of rows, put together in order as long as a round stays within ``ROUND_ROWS``."""
    out: list[list] = [[]]
    filled = 0
    for part, rows in sizes:
        if out[-1] and filled + rows > ROUND_ROWS:
            out.append([])
            filled = 0
        out[-1].append(part)
        filled += rows
    return out


class ParquetTable:
    """A versioned Parquet folder with a declared schema.

    Partitioned tables are written through a rebalancing shuffle on the partition
    columns, so that a partition gets few files of even size however many tasks
    produce it, each sorted by ``sort_by`` for row-group skipping. Rows of equal first
    sort column share a file, where they take little room.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partition_by, self.sort_by = list(partition_by), list(sort_by)

    def on(self, spark: SparkSession) -> ParquetTable:
        """The same table as seen by another session."""
        return ParquetTable(spark, self.path, self.schema, self.partition_by, self.sort_by)

    # --- files ---

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{text}" if text else self.path)

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, pattern: str, up: int = 0) -> list[int]:
        """Numbers in the names of what the pattern matches, or of folders above it."""
        out = []
        for status in self._files().globStatus(self._path(pattern)) or []:
            found = status.getPath()
            for _ in range(up):
                found = found.getParent()
            out.append(int(found.getName().split("=")[1].split(".")[0]))
        return sorted(set(out))

    def _exists(self, name: str) -> bool:
        return self._files().exists(self._path(name))

    def _create(self, name: str, content: str = "") -> bool:
        """Create a file unless it exists; whether it was created."""
        try:
            stream = self._files().create(self._path(name), False)
        except Py4JJavaError as error:
            if not self._exists(name):
                raise error
            return False
        stream.write(bytearray(content.encode()))
        stream.close()
        return True

    def _lines(self, name: str) -> list[str]:
        """Lines of a small file; one that is only just being written is waited for."""
        for _ in range(100):
            stream = self._files().open(self._path(name))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            if text.endswith("\n"):
                return text.split("\n")[:-1]
            time.sleep(0.1)
        raise RuntimeError(f"{self.path}/{name} was never finished; the write that began it is lost, remove the file")

    # --- reading ---

    def version(self) -> int:
        """Number of the newest version with a committed segment, 0 when there is none."""
        return max(self._numbers(f"v=*/segment=*/{_MARK}", 2), default=0)

    def state(self) -> State:
        """The current state, after marking what a writer decided and did not come to mark."""
        while True:
            version = self.version()
            turn = max(self._numbers(f"v={version}/turn=*"), default=0)
            if turn:
                self._publish(self._lines(f"v={version}/turn={turn}"))
            if self.version() == version:
                return State(version, turn)

    def segments(self, version: int | None = None) -> list[str]:
        """Folders of the committed writes of a version."""
        version = self.version() if version is None else version
        return [f"{self.path}/v={version}/segment={s}" for s in self._numbers(f"v={version}/segment=*/{_MARK}", 1)]

    def kept(self, version: int | None = None) -> list[str]:
        """Partition folders of earlier versions that a version goes on using."""
        version = self.version() if version is None else version
        name = f"v={version}/{_KEPT}"
        return [f"{self.path}/{line}" for line in self._lines(name)] if self._exists(name) else []

    def partitions(self, version: int | None = None) -> list[str]:
        """Partition folders of a version, those that it keeps included; its segments when it is not partitioned."""
        version = self.version() if version is None else version
        folders = list(self.kept(version))
        for segment in self.segments(version):
            if not self.partition_by:
                folders.append(segment)
                continue
            deep = "/".join(f"{c}=*" for c in self.partition_by)
            found = self._files().globStatus(self._path(f"{segment[len(self.path) + 1:]}/{deep}")) or []
            folders += [f"{segment}/" + "/".join(s.getPath().toString().split("/")[-len(self.partition_by) :]) for s in found]
        return folders

    def origin(self, version: int | None = None) -> list[str] | None:
        """What a version was made from, as its writer noted it; none if it did not."""
        name = f"v={self.version() if version is None else version}/{_ORIGIN}"
        return self._lines(name) if self._exists(name) else None

    def folders_exist(self, folders: Sequence[str]) -> bool:
        return all(self._exists(f[len(self.path) + 1 :]) for f in folders)

    def rows_of(self, folders: Sequence[str]) -> DataFrame:
        """The rows of segments or partition folders."""
        by_version: dict[str, list[str]] = {}
        for folder in folders:
            by_version.setdefault(folder[len(self.path) + 1 :].split("/")[0], []).append(folder)
        if not by_version:
            return self.spark.createDataFrame([], self.schema)
        # Below the version's folder the segment is a partition column like the declared ones.
        parts = [
            self.spark.read.schema(self.schema).option("basePath", f"{self.path}/{version}").parquet(*group)
            .select(*self.schema.names)
            for version, group in sorted(by_version.items())
        ]
        return reduce(DataFrame.unionByName, parts)

    def read(self, state: State | None = None) -> DataFrame:
        """The current version, or that of a state; an empty frame before the first write."""
        version = self.version() if state is None else state.version
        return self.rows_of([*self.segments(version), *self.kept(version)])

    # --- writing ---

    def _claim(self, folder: str) -> str:
        """Reserve a folder; fails if another writer has taken it."""
        if not self._create(f"{folder}.claim"):
            raise Overlap(f"{self.path}/{folder} exists")
        return folder

    def _store(
        self, df: DataFrame | Sequence[DataFrame], version: int | None, derived: Mapping[str, Column] | None = None
    ) -> tuple[str, int]:
        """Write rows as a further segment of a version, or as a new one, not yet committed; its folder and their number.

        Several frames are written one after the other, each with its own shuffles.
        ``derived`` columns follow from the others and are added last, so that no shuffle carries them.
        """
        while True:
            if version is None:
                folder = f"v={max(self._numbers('v=*'), default=0) + 1}/segment=1"
            else:
                folder = f"v={version}/segment={max(self._numbers(f'v={version}/segment=*'), default=0) + 1}"
            try:
                self._claim(folder)
                break
            except Overlap:
                continue  # taken between looking and claiming
        parts = [df] if isinstance(df, DataFrame) else df
        return folder, sum(self._write(part, folder, derived or {}) for part in parts)

    def _write(self, df: DataFrame, folder: str, derived: Mapping[str, Column]) -> int:
        aligned = df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema if f.name not in derived
            ]
        )
        if self.partition_by:
            near = {f"_near_{c}": F.pmod(F.hash(c), F.lit(BUCKETS)) for c in self.sort_by[:1]}
            aligned = aligned.withColumns(near).hint("rebalance", *[F.col(c) for c in (*self.partition_by, *near)])
            aligned = aligned.sortWithinPartitions(*self.partition_by, *self.sort_by)
        aligned = aligned.select(
            *[derived[f.name].cast(f.dataType).alias(f.name) if f.name in derived else F.col(f.name) for f in self.schema]
        )
        counted, seen = observe_counts(aligned, "written")
        with releasing(self.spark):
            # The folder is claimed, so whatever is in it was written just now.
            unmarked = counted.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            unmarked = unmarked.option("compression", CODEC)
            unmarked.partitionBy(*self.partition_by).parquet(f"{self.path}/{folder}")
        return seen.get["rows"]

    def _publish(self, entry: Sequence[str]) -> None:
        """Mark the segment of a turn as committed, and its batch as stored."""
        self._create(f"{entry[0]}/{_MARK}")
        for tag in entry[1:]:
            self._create(f"tags/{tag}")

    def _commit(self, folder: str, state: State, tag: str | None = None) -> bool:
        """Take the turn after the state's; false if another writer has it."""
        entry = [folder, *([tag] if tag else [])]
        if not self._create(f"v={state.version}/turn={state.turn + 1}", "".join(f"{line}\n" for line in entry)):
            return False
        self._publish(entry)
        return True

    def stored(self, tag: str) -> bool:
        """Whether a batch of this name was committed."""
        self.state()
        return self._exists(f"tags/{tag}")

    def replace(
        self, df: DataFrame | Sequence[DataFrame], read: State | None = None, tag: str | None = None, keep: Sequence[str] = (),
        origin: Sequence[str] = (), derived: Mapping[str, Column] | None = None,
    ) -> int:
        """Write the next version; the one being read from stays untouched.

        With ``read``, the state that ``df`` was computed from, the write is refused if
        the table has changed since. ``keep`` names partition folders that the version
        goes on using, ``origin`` notes what it was made from; both need ``read``.
        """
        if (keep or origin) and read is None:
            raise ValueError("keep and origin hold for the state that was read")
        state = read or self.state()
        folder, rows = self._store(df, None, derived)
        if keep:
            self._create(f"{folder.split('/')[0]}/{_KEPT}", "".join(f"{f[len(self.path) + 1:]}\n" for f in keep))
        if origin:
            self._create(f"{folder.split('/')[0]}/{_ORIGIN}", "".join(f"{line}\n" for line in origin))
        while not self._commit(folder, state, tag):
            if read is not None:
                raise Overlap(f"{self.path} was changed after it was read at {read}")
            state = self.state()
            if state.version > int(folder.split("/")[0].split("=")[1]):
                folder, rows = self._store(self.rows_of([f"{self.path}/{folder}"]), None)
        return rows

    def append(
        self, df: DataFrame | Sequence[DataFrame], read: State | None = None, keys: Sequence[str] = (), tag: str | None = None,
        derived: Mapping[str, Column] | None = None,
    ) -> int:
        """Add rows to the current version, as a segment of their own, and return their number.

        With ``keys``, rows whose key another writer has stored since ``read`` are left out.
        ``derived`` columns follow from the others and are added where the rows are written.
        """
        state = read or self.state()
        if not state.version:
            return self.replace(df, state, tag, derived=derived)
        folder, rows = self._store(df, state.version, derived)
        while not self._commit(folder, state, tag):
            now = self.state()
            if now.version != state.version:
                raise Overlap(f"{self.path} was replaced while rows were appended to version {state.version}")
            if keys:
                turns = range(state.turn + 1, now.turn + 1)
                since = [f"{self.path}/{self._lines(f'v={state.version}/turn={turn}')[0]}" for turn in turns]
                mine = self.rows_of([f"{self.path}/{folder}"])
                folder, rows = self._store(absent_keys(mine, self.rows_of(since), keys), state.version)
            state = now
        return rows

    def replace_partitions(
        self, df: DataFrame | Sequence[DataFrame], touched: Sequence[Sequence], read: State, origin: Sequence[str] = ()
    ) -> int:
        """Write the next version from ``df``, the rows of the touched partitions, and the folders of all others.

        ``touched`` lists values of the partition columns. Refused if the table has
        changed since ``read``.
        """
        gone = {tuple(_NULL if v is None else str(v) for v in values) for values in touched}
        values = lambda f: tuple(unquote(part.split("=", 1)[1]) for part in f.split("/")[-len(self.partition_by) :])
        return self.replace(df, read, keep=[f for f in self.partitions(read.version) if values(f) not in gone], origin=origin)


def change(table: ParquetTable, build: Callable[[DataFrame], DataFrame]) -> int:
    """Replace a table by a function of its rows, starting over when another writer was faster."""
    for attempt in range(ATTEMPTS):
        state = table.state()
        try:
            return table.replace(build(table.read(state)), state)
        except Overlap:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def partitions_of(rows: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """The partitions that rows fall into, at most as many as the table has or will have."""
    with releasing(rows.sparkSession):
        return [tuple(r) for r in rows.select(*columns).distinct().collect()]


def rows_by_partition(rows: DataFrame, columns: Sequence[str]) -> list[tuple[tuple, int]]:
    """The partitions that rows fall into, in order, each with its number of rows."""
    with releasing(rows.sparkSession):
        found = rows.groupBy(*columns).agg(F.count("*")).collect()
    return sorted(((tuple(r)[:-1], r[-1]) for r in found), key=lambda x: [(v is not None, v) for v in x[0]])


def within_partitions(columns: Sequence[str], found: Sequence[tuple]) -> Column:
    """A filter on partition columns, NULL included, by which Spark skips all other folders."""
    if len(columns) == 1:
        values = [v for (v,) in found]
        plain = F.col(columns[0]).isin([v for v in values if v is not None])
        return plain | F.col(columns[0]).isNull() if None in values else plain
    each = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, values, strict=True)]) for values in found]
    return reduce(or_, each, F.lit(False))


def change_partitions(
    table: ParquetTable, touched: Callable[[DataFrame], DataFrame], build: Callable[[DataFrame], DataFrame],
    apart: Column | None = None,
) -> int:
    """As ``change`` for those partitions only that ``touched`` finds in the table; the files of others stay in use.

    ``touched`` returns rows whose partition columns name them; there are as many
    distinct ones as the table has partitions at most. ``build`` gets their rows and
    must leave the partition columns as they are. Where ``apart`` holds for all rows,
    no result depends on rows of two partitions; they are then built in rounds.
    Returns the rows written.
    """
    if not table.partition_by:
        return change(table, build)
    for attempt in range(ATTEMPTS):
        state = table.state()
        rows = table.read(state)
        found = partitions_of(touched(rows), table.partition_by)
        if not found:
            return 0
        groups = [found]
        if apart is not None:
            chosen = rows.where(within_partitions(table.partition_by, found))
            if chosen.where(~F.coalesce(apart, F.lit(False))).isEmpty():
                groups = rounds(rows_by_partition(chosen, table.partition_by))
        try:
            parts = [build(rows.where(within_partitions(table.partition_by, group))) for group in groups]
            return table.replace_partitions(parts, found, state)
        except Overlap:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def _orderable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema if f.name not in skip and not isinstance(f.dataType, (MapType, VariantType))]


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, with the key as ``_key`` and its number of batch rows as ``_copies``.

    The earliest row in ``order`` stays (NULLs last), settled by the remaining
    columns so that retries agree. Copies are folded before the shuffle.
    """
    rest = [c for c in batch.columns if c not in keys]
    first = [x for c in order for x in (F.col(c).isNull(), F.col(c))]
    plain = _orderable(batch, keys)
    row = F.struct(F.lit(0).alias("_"), *rest)
    if len(plain) == len(rest):
        # The row itself settles ties, so it is part of what is compared.
        best = F.min(F.struct(*[f.alias(f"_o{i}") for i, f in enumerate(first)], row.alias("row")))["row"]
    else:
        best = F.min_by(row, F.struct(F.lit(0), *first, *plain))
    # Of the type that a stored key has, so that it is not cast, and shuffled again, to be compared with those.
    stored = StructType([StructField(c, batch.schema[c].dataType) for c in keys])
    key = null_safe_key(keys).cast(stored)
    folded = batch.groupBy(key.alias("_key")).agg(best.alias("_row"), F.count("*").alias("_copies"))
    return folded.select(
        "_key", *[F.col(f"_row.{c}" if c in rest else f"_key.{c}").alias(c) for c in batch.columns], "_copies"
    )


def insert_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Batch rows whose natural key is new, one per key; NULL key parts are equal."""
    known = target.select(null_safe_key(keys).alias("_key"))
    return first_per_key(batch, keys, order).join(known, "_key", "left_anti").select(*batch.columns)


def flag_existing(folded: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``first_per_key`` with ``_exists``: whether the target holds their key.

    EXISTS in a projection is planned as an existence join, which never
    multiplies rows, whatever the target holds.
    """
    return folded.sparkSession.sql(
        "SELECT f.*, EXISTS (SELECT 1 FROM {known} t WHERE t._key = f._key) AS _exists FROM {folded} f",
        known=target.select(null_safe_key(keys).alias("_key")), folded=folded,
    )


def insert_new(
    table: ParquetTable,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    prune: Sequence[str] = (),
    tag: str | None = None,
    derived: Mapping[str, Column] | None = None,
    at_rest: bool = False,
) -> WriteStats:
    """Append rows whose natural key is absent and count what happened.

    Running the same batch again inserts nothing, and of overlapping inserts of a key
    one stores it. ``prune`` names partition columns that follow from the key: only the
    batch's partitions of the target are then read. ``tag`` names the batch: if one of
    that name was stored, nothing is read or written. The counters are taken in the
    writing stage, where lost and repeated tasks count once. ``derived`` columns follow
    from the key and are added where the rows are written. ``at_rest`` says that the batch
    is a scan of stored rows, which is cheaper to count by a scan of its own than to keep again.
    """
    if not set(prune) <= set(table.partition_by):
        raise ValueError(f"{list(prune)} are not all partition columns of {table.path}")
    if tag and table.stored(tag):
        return WriteStats()
    for attempt in range(ATTEMPTS):
        try:
            return _insert_once(table, batch, keys, order, prune, tag, derived, at_rest)
        except Overlap:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def _insert_once(table, batch, keys, order, prune, tag, derived, at_rest) -> WriteStats:
    state = table.state()
    target = table.read(state)
    if not table.partition_by:
        flagged = flag_existing(first_per_key(batch, keys, order), target, keys)
        counted, seen = observe_counts(flagged, "insert_new", processed=F.sum("_copies"))
        inserted = table.append(counted.where(~F.col("_exists")), state, keys, tag, derived)
        processed = seen.get["processed"] or 0
        return WriteStats(processed=processed, inserted=inserted, skipped=processed - inserted)
    staging = None
    try:
        if at_rest:
            folded, sizes = None, rows_by_partition(batch, prune)
            processed = sum(rows for _, rows in sizes)
        else:
            # Writing rearranges the rows, so the batch is kept, by column: it is counted
            # while it is written, and read again for its partitions and for its rows.
            staging = f"{scratch_dir(table.spark)}/insert-{uuid4().hex}"
            kept, seen = observe_counts(first_per_key(batch, keys, order), "insert_new", processed=F.sum("_copies"))
            with releasing(table.spark):
                kept.write.option("compression", CODEC).parquet(staging)
            folded = table.spark.read.schema(kept.schema).parquet(staging)
            processed = seen.get["processed"] or 0
            sizes = rows_by_partition(folded, prune) if prune else []

        def fresh(found: Sequence[tuple]) -> DataFrame:
            # All copies of a key are in its partition, so a round holds all rows of its keys.
            here = within_partitions(prune, found) if prune else F.lit(True)
            rows = folded.where(here) if folded is not None else first_per_key(batch.where(here), keys, order)
            return flag_existing(rows, target.where(here), keys).where(~F.col("_exists"))

        inserted = table.append([fresh(found) for found in rounds(sizes)], state, keys, tag, derived)
    finally:
        if staging:
            forget(table.spark, staging)
    return WriteStats(processed=processed, inserted=inserted, skipped=processed - inserted)


def insert_guarded(table: ParquetTable, batch: DataFrame, keys: Sequence[str], **options) -> WriteStats:
    """As ``insert_new``, but a failed batch is reported instead of raised.

    A batch is one write job, so on failure none of its rows count as inserted.
    """
    try:
        return insert_new(table, batch, keys, **options)
    except Exception as error:  # noqa: BLE001 - one bad batch must not stop the others
        try:
            lost = batch.count()
        except Exception:  # noqa: BLE001 - the input itself cannot be read
            lost = 0
        return WriteStats(processed=lost, skipped=lost, error=f"{type(error).__name__}: {error}"[:500])


def upsert_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Target with the batch written over it; within the batch the last writer wins."""
    from periodica.operators.windows import latest_by

    ties = [c for c in _orderable(batch, [*keys, order_col])]
    last = latest_by(batch, keys, [order_col, *ties]).select(*target.columns)
    return absent_keys(target, last, keys).unionByName(last)


def upsert(table: ParquetTable, batch: DataFrame, keys: Sequence[str], order_col: str) -> None:
    """Write a batch over a table; an update that overlaps another starts over and loses nothing."""
    change(table, lambda rows: upsert_rows(rows, batch, keys, order_col))


def replace_rows(target: DataFrame, predicate: Column, batch: DataFrame) -> DataFrame:
    """Target without the rows that match, plus the batch."""
    kept = target.where(~F.coalesce(predicate, F.lit(False)))
    return kept.unionByName(batch, allowMissingColumns=True)


def replace_where(table: ParquetTable, predicate: Column, batch: DataFrame) -> None:
    change(table, lambda rows: replace_rows(rows, predicate, batch))


def patch_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Target with the batch's non-NULL values; NULL never clears a known value."""
    news = batch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    patched = target.join(news, list(keys), "left")
    return patched.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns]
    )


def patch(table: ParquetTable, batch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> None:
    change(table, lambda rows: patch_rows(rows, batch, keys, columns))


def overwrite(table: ParquetTable, df: DataFrame) -> None:
    """Truncate and reload."""
    table.replace(df)


def refresh_snapshot(table: ParquetTable, df: DataFrame) -> int:
    """Store a derived table as a new version and return its number.

    Readers of the previous version go on undisturbed; a failed refresh leaves it
    current.
    """
    table.replace(df)
    return table.version()


def _fillable() -> Column:
    return F.col("currency").isNull() & (F.col("unit") != "USD") & is_currency(F.col("unit"))


def backfill_currency(facts: DataFrame) -> DataFrame:
    """Facts whose missing currency is taken from a plain money unit.

    Per-share units and the dollar stay as they are, and so does every value.
    """
    return facts.withColumn("currency", F.when(_fillable(), F.col("unit")).otherwise(F.col("currency")))


def backfill_table(facts: ParquetTable) -> int:
    """Fill missing currencies of stored facts; partitions without any keep their files. Returns the rows rewritten."""
    return change_partitions(facts, lambda rows: rows.where(_fillable()), backfill_currency)


def mark(df: DataFrame, keys_df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with a flag switched on where their key is listed."""
    listed = keys_df.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(listed, key, "left").select(
        *[(F.coalesce("_hit", column) if c == column else F.col(c)).alias(c) for c in df.columns]
    )
