"""Tickets with their custom values and comments as one stored table, changed bucket by bucket.

A row is a ticket, a custom value or a comment; rows are dealt into folders by a hash of the
ticket, so a ticket and all that belongs to it lie in one folder. A change set reads only the
folders that its tickets fall into and replaces only those that it changes. The new folders are
written beside the table, some at a time, so that what is shuffled at once is a part of them; when
all are there each takes the place of the old one. A folder has the rows of all three kinds and is
exchanged as a whole, so a ticket's new status and the comment that came with it appear together.
What fails before the exchange leaves everything as it was. Comments alone are only added.

Writers take turns; a reader that began before a change may have to read again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veildesk.operators.changes import (
    _apply,
    _checked,
    add_comments,
    macro_patches,
)
from veildesk.schemas import MACRO_COLUMNS
from veildesk.staging import delete_folder, shuffles_freed, staged

#: Folders are rewritten in at most so many rounds, each of so many folders at least. A round
#: looks through all patches, so the rounds do not grow with the table.
ROUNDS, FOLDERS = 8, 4
_PARTS = {"ticket": "id", "custom_value": "ticket_id", "comment": "ticket_id"}


@dataclass(frozen=True)
class Applied:
    """What a change set did: rejected patches, touched ticket ids and rewritten folders."""

    rejected: DataFrame
    touched: DataFrame
    buckets: list[int]
    applied: DataFrame | None = None


def _bucket(ticket: Column, other: Column, buckets: int) -> Column:
    """The folder of a ticket; what has no ticket is spread by its own id."""
    return F.pmod(F.xxhash64(F.coalesce(ticket, other)), F.lit(buckets)).cast("int")


class TicketTables:
    """The stored table under ``path``; ``create`` makes one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        rows = spark.read.parquet(path)
        self.schema = rows.schema
        # Every folder tells the number of folders, so that it is never given twice.
        first = rows.select("buckets").first()
        self.buckets = first["buckets"] if first else 1

    @classmethod
    def create(
        cls,
        path: str,
        tickets: DataFrame,
        custom_values: DataFrame,
        comments: DataFrame,
        buckets: int,
    ) -> TicketTables:
        """Write the tables once; a folder should hold what one task can rewrite.

        The kinds are written one after the other, so that only one is shuffled at a time."""
        spark = tickets.sparkSession
        values = custom_values.select("ticket_id", "field_id", "pos", "value")
        rows = _rows(tickets, values, comments, buckets)
        for part in _PARTS:
            mode = "error" if part == "ticket" else "append"
            with shuffles_freed(spark):
                _laid_out(rows.where(F.col("part") == part)).write.mode(mode).partitionBy(
                    "bucket"
                ).parquet(path)
        return cls(spark, path)

    @property
    def tickets(self) -> DataFrame:
        return self._part("ticket")

    @property
    def custom_values(self) -> DataFrame:
        return self._part("custom_value")

    @property
    def comments(self) -> DataFrame:
        return self._part("comment")

    def _part(self, part: str, buckets: list[int] | None = None) -> DataFrame:
        """Rows of one kind; only of some folders, which Spark then reads alone."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        return rows.where(F.col("part") == part).select(f"{part}.*")

    def _hit(self, rows: DataFrame) -> list[int]:
        """Folders that rows with a ``ticket_id`` fall into: at most as many as there are."""
        own = _bucket(F.col("ticket_id"), F.col("ticket_id"), self.buckets)
        found = rows.where(F.col("ticket_id").isNotNull()).select(own.alias("bucket")).distinct()
        return sorted(r["bucket"] for r in found.collect())

    def update(self, patches: DataFrame) -> Applied:
        """``update_tickets`` on the stored table."""
        return self._apply(_checked(self._part("ticket", self._hit(patches)), patches))

    def apply_macros(self, actions: DataFrame, applications: DataFrame) -> Applied:
        """``apply_macros`` on the stored table; ``applied`` tells what each application set."""
        patches = macro_patches(actions, applications)
        checked = _checked(self._part("ticket", self._hit(applications)), patches)
        done = self._apply(checked)
        applied = checked.where(F.col("problem").isNull()).select(
            "ticket_id", "macro_id", "seq", F.to_json(F.struct(*MACRO_COLUMNS)).alias("applied")
        )
        return Applied(done.rejected, done.touched, done.buckets, applied)

    def _apply(self, checked: DataFrame) -> Applied:
        hit = self._hit(checked.where(F.col("problem").isNull()))
        if hit:
            own = _bucket(F.col("ticket_id"), F.col("ticket_id"), self.buckets)
            # Names with a dot in front are no part of the table.
            new = f"{self.path}/.new-{uuid.uuid4().hex}"
            step = max(FOLDERS, -(-len(hit) // ROUNDS))
            try:
                for at in range(0, len(hit), step):
                    some = hit[at : at + step]
                    tickets, values, comments = (self._part(part, some) for part in _PARTS)
                    done = _apply(tickets, values, checked.where(own.isin(some)), comments)
                    self._write(_rows(done.tickets, done.custom_values, done.thread, self.buckets), new)
            except BaseException:
                delete_folder(self.spark, new)
                raise
            self._exchange(new)
            delete_folder(self.spark, new)
        rejected = checked.where(F.col("problem").isNotNull()).select("ticket_id", "seq", "problem")
        touched = checked.where(F.col("problem").isNull()).select(F.col("ticket_id").alias("id"))
        return Applied(rejected, touched.distinct(), hit)

    def _write(self, rows: DataFrame, path: str) -> None:
        """Add the rows to the folders under ``path``."""
        names = [f.name for f in self.schema if f.name != "bucket"]
        kinds = {f.name: f.dataType for f in self.schema}
        rows = rows.select(*[F.col(n).cast(kinds[n]) for n in names], "bucket")
        with shuffles_freed(self.spark):
            _laid_out(rows).write.mode("append").partitionBy("bucket").parquet(path)

    def _exchange(self, new: str) -> None:
        """The folders under ``new`` take the place of those of the same name."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(new).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for folder in files.listStatus(path(new)):
            name = folder.getPath().getName()
            if name.startswith("bucket="):
                files.delete(path(self.path, name), True)
                if not files.rename(folder.getPath(), path(self.path, name)):
                    raise OSError(f"{name} could not be exchanged, its rows are in {new}")
        self.spark.catalog.refreshByPath(self.path)

    def add_comments(self, new: DataFrame) -> list[int]:
        """``add_comments`` on the stored table: the new rows are added, nothing is rewritten.

        Returns the folders that got rows. The places of the new comments are settled first, as
        a task that ran again after the commit of another would count that one's rows."""
        hit = self._hit(new)
        known = self._part("comment", hit)
        kind = known.schema
        fresh = add_comments(known.where("false"), new, last_in=known)
        rows = staged(fresh.select(*[F.col(f.name).cast(f.dataType) for f in kind]), "comments")
        tickets, values = self._part("ticket").where("false"), self._part("custom_value").where("false")
        self._write(_rows(tickets, values, rows, self.buckets), self.path)
        return hit


def _rows(tickets: DataFrame, values: DataFrame, comments: DataFrame, buckets: int) -> DataFrame:
    """The three tables as rows of one, each in the struct of its kind."""
    frames = dict(zip(_PARTS, (tickets, values, comments), strict=True))
    kinds = {part: T.StructType(list(frame.schema)) for part, frame in frames.items()}
    own = {"ticket": "id", "custom_value": "field_id", "comment": "id"}
    out = []
    for part, frame in frames.items():
        cells = [
            (F.struct(*frame.columns) if part == p else F.lit(None).cast(kinds[p])).alias(p)
            for p in _PARTS
        ]
        bucket = _bucket(F.col(_PARTS[part]), F.col(own[part]), buckets).alias("bucket")
        out.append(
            frame.select(
                F.lit(part).alias("part"),
                F.col(_PARTS[part]).alias("key"),
                *cells,
                F.lit(buckets).alias("buckets"),
                bucket,
            )
        )
    return out[0].unionByName(out[1]).unionByName(out[2])


def _laid_out(rows: DataFrame) -> DataFrame:
    """A folder's rows together, a large folder over several tasks, kinds one after the other."""
    return rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "part", "key")
