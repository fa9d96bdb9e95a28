"""The stored tables: Parquet folders and a manifest that says which of them are current.

Every attempt writes folders of its own. A version becomes visible by one manifest file that is created without
overwriting, so of two writers on one version the second is refused and has changed nothing; it may send its batch
again. Nothing runs after a commit: compaction is a call of its own.

A batch is folded and appended as a delta. The base lies in buckets of the duplicate key; a delta knows the buckets
it touches, so matching, reading and compaction meet only these, and all other buckets pass through as they are.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from newsfold import schemas
from newsfold.operators import keyword_index, merge
from newsfold.operators.keyword_index import KeywordIndex
from newsfold.operators.normalize import NOT_AN_OBJECT, is_object, normalize_records, warning_rows
from newsfold.session import configured
from newsfold.sources import folders
from newsfold.sources.feed import NOT_AN_ARRAY, Feed, part_starts, with_arrival_numbers

#: Rows of a bucket when the base is laid out anew, and how many buckets there are at most.
BUCKET_ROWS = 1_000_000
MOST_BUCKETS = 4096
#: The base is laid out anew when its buckets have grown by so much.
GROWTH = 8
#: Rows of one file of a bucket.
FILE_ROWS = 2_000_000
#: Bytes of files, as stored, whose rows one task of a compaction takes.
TASK_BYTES = 32 << 20
#: Batches whose reports are kept in folders of their own; more are put together.
SEPARATE_REPORTS = 64


class CommitRefused(RuntimeError):
    """Another writer committed first. Nothing of this attempt is visible; send the batch again."""


@dataclass(frozen=True)
class Delta:
    name: str
    rows: int
    #: Buckets of the base that hold its keys, by the base's layout.
    buckets: list[int]


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    batch_no: int = 0
    #: How many buckets the base has, and the attempt that wrote each of those with rows.
    n_buckets: int = 0
    base: dict[str, str] = field(default_factory=dict)
    base_rows: int = 0
    deltas: list[Delta] = field(default_factory=list)
    next_seq: int = 0
    sources: str | None = None
    #: Attempts that wrote reports, errors and warnings.
    reports: list[str] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)
    #: Attempts of the base with a keyword index, and the layout of each.
    index: dict[str, list[int]] = field(default_factory=dict)

    @property
    def delta_rows(self) -> int:
        return sum(delta.rows for delta in self.deltas)

    def names(self) -> set[str]:
        """Folders this version needs."""
        found = {f"base/{attempt}/bucket={bucket}" for bucket, attempt in self.base.items()}
        found |= {f"delta/{delta.name}" for delta in self.deltas}
        found |= {f"{table}/{name}" for name in self.reports for table in ("report", "errors", "warnings")}
        found |= {f"index/{attempt}" for attempt in self.index}
        return found | ({f"sources/{self.sources}"} if self.sources else set())


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("dedupe_key"), F.lit(buckets)).cast("int")


class Snapshot:
    """Readers' view of one committed version; all tables agree with each other."""

    def __init__(self, store: MentionStore, manifest: Manifest):
        self._store, self.manifest = store, manifest

    def _read(self, schema, paths: list[str]) -> DataFrame:
        spark = self._store.spark
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*map(self._store.path, paths))

    def base(self, buckets: set[int] | None = None) -> DataFrame:
        """The base, or its given buckets."""
        wanted = [b for b in self.manifest.base if buckets is None or int(b) in buckets]
        return self._read(schemas.STORED_MENTIONS, [f"base/{self.manifest.base[b]}/bucket={b}" for b in wanted])

    def base_with_buckets(self) -> DataFrame:
        """The base of one attempt with ``base_bucket``."""
        (attempt,) = set(self.manifest.base.values())
        schema = StructType([*schemas.STORED_MENTIONS, StructField("bucket", IntegerType())])
        return self._read(schema, [f"base/{attempt}"]).withColumnRenamed("bucket", "base_bucket")

    def deltas(self, names: list[str] | None = None) -> DataFrame | None:
        """Folded rows of the batches that are not in the base yet; a key may occur once per delta."""
        names = [delta.name for delta in self.manifest.deltas] if names is None else names
        frames = [self._read(schemas.MENTIONS, [f"delta/{name}"]) for name in names]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def touched(self) -> set[int]:
        return {bucket for delta in self.manifest.deltas for bucket in delta.buckets}

    def mentions(self) -> DataFrame:
        """One row per duplicate key, with ``search_text``."""
        newer, touched = self.deltas(), self.touched()
        if newer is None:
            return self.base()
        if not touched & set(map(int, self.manifest.base)):
            return self.base().unionByName(merge.with_search_text(merge.fold_rows(newer)))
        untouched = self.base({int(b) for b in self.manifest.base} - touched)
        return untouched.unionByName(merge.overlay(self.base(touched), newer))

    def index(self) -> KeywordIndex | None:
        """The keyword index of :meth:`mentions`; none if a part of the base was written without one.

        Stored postings count for buckets that are still as they were indexed. Those of rows that a delta changes give way to
        postings of the rows as they are now, which are as many as the deltas' rows.
        """
        if not set(self.manifest.base.values()) <= set(self.manifest.index):
            return None
        newer, touched, segments = self.deltas(), self.touched(), []
        for attempt, layout in self.manifest.index.items():
            rows = keyword_index.read_postings(self._store.spark, self._store.path(f"index/{attempt}"), "base_bucket")
            live = [int(bucket) for bucket, name in self.manifest.base.items() if name == attempt]
            if len(live) < layout[2]:
                rows = rows.where(F.col("base_bucket").isin(live))
            if newer is not None:
                changed = merge.touched_rows(self.base(touched), newer).select("id")
                rows = rows.join(changed, "id", "left_anti")
            segments.append(keyword_index.Segment(rows, keyword_index.Layout(*layout[:2])))
        if newer is not None:
            now = merge.overlaid(self.base(touched), newer)
            segments.append(keyword_index.Segment(keyword_index.gathered(keyword_index.occurrences(now))))
        if not segments:
            empty = self._store.spark.createDataFrame([], schemas.STORED_MENTIONS)
            segments.append(keyword_index.Segment(keyword_index.gathered(keyword_index.occurrences(empty))))
        return keyword_index.KeywordIndex(segments, self.mentions())

    def keys(self, buckets: set[int]) -> DataFrame:
        """``dedupe_key`` of stored mentions in ``buckets`` and in all deltas, possibly repeated; no other column is read."""
        base, newer = self.base(buckets).select("dedupe_key"), self.deltas()
        return base if newer is None else base.unionByName(newer.select("dedupe_key"))

    def sources(self) -> DataFrame:
        return self._read(schemas.SOURCES, [f"sources/{self.manifest.sources}"] if self.manifest.sources else [])

    def report(self) -> DataFrame:
        return self._read(schemas.REPORT, [f"report/{name}" for name in self.manifest.reports])

    def errors(self) -> DataFrame:
        return self._read(schemas.ERRORS, [f"errors/{name}" for name in self.manifest.reports])

    def warnings(self) -> DataFrame:
        return self._read(schemas.WARNINGS, [f"warnings/{name}" for name in self.manifest.reports])


class MentionStore:
    """Tables under ``root``, on any file system Spark reads whose rename is atomic (HDFS, or a local disk)."""

    def __init__(
        self, spark: SparkSession, root: str, max_deltas: int = 8, max_delta_share: float = 0.25, indexed: bool = True
    ):
        """With ``indexed`` every compaction writes the keyword index of the buckets that it writes."""
        self.spark, self.root, self.indexed = configured(spark), root.rstrip("/"), indexed
        self.max_deltas, self.max_delta_share = max_deltas, max_delta_share

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def versions(self) -> list[int]:
        names = folders.children(self.spark, self.path("manifest"))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or an older one that has not been vacuumed."""
        if version is None:
            committed = self.versions()
            if not committed:
                return Snapshot(self, Manifest())
            version = committed[-1]
        held = json.loads(folders.read_text(self.spark, self.path(f"manifest/{version:012d}.json")))
        return Snapshot(self, Manifest(**held | {"deltas": [Delta(**delta) for delta in held["deltas"]]}))

    def _commit(self, manifest: Manifest) -> Snapshot:
        name = self.path(f"manifest/{manifest.version:012d}.json")
        try:
            folders.create_text(self.spark, name, json.dumps(asdict(manifest)), self.path(f"manifest/{uuid.uuid4().hex}.tmp"))
        except FileExistsError:
            raise CommitRefused(f"version {manifest.version} of {self.root} exists already") from None
        return Snapshot(self, manifest)

    def ingest(
        self, feed: Feed, batch_time: dt.datetime | None = None, stream: str | None = None, batch_id: int | None = None
    ) -> Snapshot:
        """Apply one batch: records, sources, report, errors and warnings, all or nothing.

        A batch of a named stream is applied once; delivering its ``batch_id`` again changes nothing.
        """
        before = self.snapshot()
        old, attempt = before.manifest, uuid.uuid4().hex
        if stream is not None and old.streams.get(stream, -1) >= batch_id:
            return before
        batch_no = old.batch_no + 1
        moment = batch_time or dt.datetime.now(dt.UTC)
        now = F.timestamp_millis(F.lit(round(moment.timestamp() * 1000)))

        staged = self._stage(feed, attempt)
        self._write(part_starts(staged, old.next_seq), f"parts/{attempt}")
        staged, following = with_arrival_numbers(staged, self.spark.read.parquet(self.path(f"parts/{attempt}")), old.next_seq)
        valid = staged.where("status = 'valid'")
        self._write(merge.fold_rows(merge.as_rows(valid, now)), f"delta/{attempt}")
        delta = self.spark.read.schema(schemas.MENTIONS).parquet(self.path(f"delta/{attempt}"))
        buckets = self._buckets(delta, old.n_buckets)

        self._write(merge.merge_sources(before.sources(), merge.batch_sources(valid, now)), f"sources/{attempt}")
        self._write_problems(staged, batch_no, attempt, feed.indexed)
        self._write(self._report(staged, before.keys(set(buckets)), delta).select(F.lit(batch_no).cast("bigint").alias("batch_no"), "*"), f"report/{attempt}")
        return self._commit(
            replace(
                old,
                version=old.version + 1,
                batch_no=batch_no,
                deltas=[*old.deltas, Delta(attempt, delta.count(), buckets)],
                next_seq=following,
                sources=attempt,
                reports=[*old.reports, attempt],
                streams=old.streams | ({stream: batch_id} if stream is not None else {}),
            )
        )

    def _buckets(self, rows: DataFrame, buckets: int) -> list[int]:
        """The buckets that hold the keys of ``rows``, at most ``buckets`` numbers."""
        return sorted(row[0] for row in rows.select(bucket_of(buckets)).distinct().collect()) if buckets else []

    def _stage(self, feed: Feed, attempt: str) -> DataFrame:
        """Normalise once into a table that the fold and the reports read by column.

        A written table, not a cache: it survives lost executors, its row numbers are fixed, and the reports
        read only the narrow columns they need.
        """
        status = (
            F.when(F.col("refused"), "refused").when(~is_object(F.col("record")), "malformed").otherwise("valid")
        )
        rows = feed.placed().withColumn("status", status).drop("refused")
        self._write(normalize_records(rows), f"staged/{attempt}")
        return self.spark.read.parquet(self.path(f"staged/{attempt}"))

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.option("compression", "zstd").parquet(self.path(name))

    def _write_problems(self, staged: DataFrame, batch_no: int, attempt: str, indexed: bool) -> None:
        """Errors and warnings with the record's index in its file."""
        first = staged.groupBy("file").agg(F.min("arrival_seq").alias("first"))

        def placed(rows: DataFrame) -> DataFrame:
            if indexed:
                return rows.withColumn("pos", F.col("line"))
            return rows.join(first, "file").withColumn("pos", F.col("arrival_seq") - F.col("first")).drop("first")

        number = F.lit(batch_no).cast("bigint").alias("batch_no")
        message = F.when(F.col("status") == "refused", F.lit(NOT_AN_ARRAY)).otherwise(F.lit(NOT_AN_OBJECT))
        place = F.when(F.col("status") == "malformed", F.col("pos")).alias("pos")
        errors = placed(staged.where("status <> 'valid'")).select(number, "file", place, message.alias("message"))
        self._write(errors, f"errors/{attempt}")
        warned = placed(staged.where("status = 'valid' AND size(warnings) > 0"))
        self._write(warning_rows(warned).select(number, "*"), f"warnings/{attempt}")

    def _report(self, staged: DataFrame, stored_keys: DataFrame, delta: DataFrame) -> DataFrame:
        def records(status: str) -> Column:
            return F.count_if(F.col("status") == status)

        counted = staged.agg(
            F.count_if(F.col("status") != "refused").alias("received"),
            records("malformed").alias("invalid"),
            records("refused").alias("refused_files"),
        ).first()
        return merge.inserted_and_merged(stored_keys, delta).select(
            F.lit(counted["received"]).cast("bigint").alias("received"),
            "inserted",
            "merged",
            F.lit(counted["invalid"]).cast("bigint").alias("invalid"),
            F.lit(counted["refused_files"]).cast("bigint").alias("refused_files"),
        )

    def maintain(self) -> Snapshot:
        """Compact what is due: deltas with a share of the base into it, many small deltas among themselves."""
        current = self.snapshot()
        if current.manifest.delta_rows > self.max_delta_share * max(1, current.manifest.base_rows):
            return self.compact()
        return self.merge_deltas() if len(current.manifest.deltas) > self.max_deltas else current

    def merge_deltas(self) -> Snapshot:
        """Make one delta of the newest ones, without the base and without an older one more than twice their size."""
        current, attempt = self.snapshot(), uuid.uuid4().hex
        deltas = current.manifest.deltas
        first, rows = len(deltas), 0
        while first and (rows == 0 or deltas[first - 1].rows <= 2 * rows):
            first -= 1
            rows += deltas[first].rows
        if len(deltas) - first < 2:
            return current
        self._write(merge.fold_rows(current.deltas([delta.name for delta in deltas[first:]])), f"delta/{attempt}")
        merged = self.spark.read.parquet(self.path(f"delta/{attempt}")).count()
        buckets = sorted({bucket for delta in deltas[first:] for bucket in delta.buckets})
        return self._commit(
            replace(
                current.manifest,
                version=current.manifest.version + 1,
                deltas=[*deltas[:first], Delta(attempt, merged, buckets)],
                reports=self._joined_reports(current, attempt),
            )
        )

    def compact(self) -> Snapshot:
        """Merge the deltas into the buckets they touch; other buckets stay where they are.

        The base is laid out anew only when it has outgrown its buckets by ``GROWTH``, so each row is moved a
        bounded number of times. Within a bucket rows are ordered by outlet and date, for filters to skip row groups.
        """
        current, attempt = self.snapshot(), uuid.uuid4().hex
        manifest, newer = current.manifest, current.deltas()
        if newer is None:
            return current
        rows = manifest.base_rows + manifest.delta_rows
        anew = rows > GROWTH * BUCKET_ROWS * manifest.n_buckets and manifest.n_buckets < MOST_BUCKETS
        buckets = min(MOST_BUCKETS, max(1, -(-rows // BUCKET_ROWS))) if anew else manifest.n_buckets
        touched = {int(bucket) for bucket in manifest.base} if anew else current.touched()
        before = current.base(touched)
        merged = merge.merge_into(before, merge.fold_rows(newer)).withColumn("bucket", bucket_of(buckets))
        # A bucket may be too much for one task, so it is dealt over as many as the bytes of its files take.
        stored = [f"base/{manifest.base[str(b)]}/bucket={b}" for b in touched if str(b) in manifest.base] + [f"delta/{delta.name}" for delta in manifest.deltas]
        size = sum(folders.size(self.spark, self.path(name)) for name in stored)
        met = buckets if anew else max(1, len(touched))
        shares = max(1, -(-size // (met * TASK_BYTES)))
        spread = F.pmod(F.xxhash64("id"), F.lit(shares))
        laid_out = merged.repartition(met * shares, "bucket", spread).sortWithinPartitions("bucket", "source_slug", "published_at")
        kept = merge.with_search_text(laid_out, "bucket")
        kept.write.options(maxRecordsPerFile=FILE_ROWS, compression="zstd").partitionBy("bucket").parquet(self.path(f"base/{attempt}"))
        written = {name.removeprefix("bucket=") for name in folders.children(self.spark, self.path(f"base/{attempt}")) if "=" in name}
        base = {b: name for b, name in manifest.base.items() if int(b) not in touched} | dict.fromkeys(written, attempt)
        new_rows = self.spark.read.parquet(self.path(f"base/{attempt}")).count()
        index = {name: layout for name, layout in manifest.index.items() if name in base.values()}
        if self.indexed and written:
            indexed = Snapshot(self, replace(manifest, base=dict.fromkeys(written, attempt))).base_with_buckets()
            layout = keyword_index.write_postings(indexed, self.path(f"index/{attempt}"), "base_bucket")
            index[attempt] = [layout.buckets, layout.parts, len(written)]
        return self._commit(
            replace(
                manifest,
                version=manifest.version + 1,
                n_buckets=buckets,
                base=base,
                base_rows=manifest.base_rows - before.count() + new_rows,
                deltas=[],
                index=index,
                reports=self._joined_reports(current, attempt),
            )
        )

    def _joined_reports(self, current: Snapshot, attempt: str) -> list[str]:
        """The folders of reports, errors and warnings; one folder of each if they are many."""
        if len(current.manifest.reports) <= SEPARATE_REPORTS:
            return current.manifest.reports
        for table, rows in (("report", current.report()), ("errors", current.errors()), ("warnings", current.warnings())):
            self._write(rows, f"{table}/{attempt}")
        return [attempt]

    def vacuum(self, keep: int = 2) -> None:
        """Drop what only versions older than the newest ``keep`` need. Folders of attempts under way are left alone."""
        committed = self.versions()
        manifests = {version: self.snapshot(version).manifest for version in committed}
        needed = set().union(*(manifests[version].names() for version in committed[-keep:]))
        for version in committed[:-keep]:
            for name in manifests[version].names() - needed:
                folders.remove(self.spark, self.path(name))
        # Nothing reads the normalised copy of a batch after its commit.
        for name in set().union(*(manifest.reports for manifest in manifests.values())):
            folders.remove(self.spark, self.path(f"staged/{name}"))
            folders.remove(self.spark, self.path(f"parts/{name}"))
        for version in committed[:-keep]:
            folders.remove(self.spark, self.path(f"manifest/{version:012d}.json"))
