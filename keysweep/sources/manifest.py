"""S3: the manifest table, kept as versions made of parquet folders.

Layout under a manifest root::

    <root>/data/<write>/day=17367/part-*.parquet          rows of one ETL day, from one write
    <root>/data/<write>/day=17368.3-of-8/part-*.parquet   one of eight key buckets of a large day
    <root>/_commits/00000002                              version 2: which write holds each part

A *part* is a day (the day number of the ETL time, days since 1970, UTC; ``none``
for rows without an ETL time) or, where a day is large, a bucket of its keys. A
commit names every part's write and row count, so a version that replaced one part
shares all other folders with the version before it. It also says which run it was
made for, and what that run deleted and skipped.

A part has a folder of its own unless its buckets are small: the buckets of a day whose
rows wouldn't fill a folder share one, so that folders and files grow with the rows
and not with the number of buckets::

    <root>/data/<write>-by512/day=17368/part-*.parquet         all of at most 512 buckets of the day
    <root>/data/<write>-by512/day=17368.1-of-4/part-*.parquet  512 of the day's 2048 buckets

The write's name says how many buckets share a folder; each row there holds the name of
its part, and readers take the rows of those parts that their version has in that write.

A version is visible only once its commit exists, and a commit gets its name only
when it is written whole (:func:`keysweep.sources.fs.create_marker`). A commit that
is torn all the same (its text ends early, or doesn't have the checksum at its end) is no
version: readers take the one before it, and the next publish takes the next free
number. Readers resolve the version once and pin it. Old versions stay for rollback
until they are expired.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.schemas import DAY_SECONDS, ETL_TIME, EVENT_ID, FINGERPRINT, MANIFEST
from keysweep.sources import fs

COMMITS = "_commits"
DATA = "data"
DAY = "day"
PART = "part"
_BY = "-by"
NO_DAY = "none"
_OF = "-of-"


def etl_day(etl_time: Column) -> Column:
    """Partition value of an ETL time: the day number as text, ``none`` for null."""
    return F.coalesce(F.floor(etl_time / DAY_SECONDS).cast("string"), F.lit(NO_DAY))


def split_part(part: str) -> tuple[str, int]:
    """(day, number of the day's buckets) of a part's name."""
    day, _, bucket = part.partition(".")
    return day, int(bucket.partition(_OF)[2]) if bucket else 1


def buckets_per_folder(write: str) -> int:
    """How many buckets of a day share a folder of a write."""
    return int(write.rpartition(_BY)[2]) if _BY in write else 1


def folder_counts(buckets: dict[str, int], per_folder: int) -> dict[str, int]:
    """Number of folders of every day that has more than one, from its number of buckets."""
    return {day: n // per_folder for day, n in buckets.items() if n > per_folder}


def part_folder(write: str, part: str) -> str:
    """The folder of a part within a write, by the rule of :func:`with_part` for fewer buckets."""
    day, of = split_part(part)
    per_folder = buckets_per_folder(write)
    if of == 1 or per_folder == 1:
        return part
    folders = folder_counts({day: of}, per_folder).get(day)
    bucket = int(part.partition(".")[2].partition(_OF)[0])
    return f"{day}.{bucket % folders}{_OF}{folders}" if folders else day


def with_part(rows: DataFrame, buckets: dict[str, int], etl: str = ETL_TIME, out: str = DAY) -> DataFrame:
    """``rows`` with the name of the part that each key and ETL time belong to.

    ``buckets`` holds the number of buckets (a power of two) of every day that has more
    than one; it is as long as the list of large days in a commit, and broadcast.
    """
    day = etl_day(F.col(etl))
    if not buckets:
        return rows.withColumn(out, day)
    sizes = rows.sparkSession.createDataFrame(sorted(buckets.items()), "_day string, _of int")
    key = F.xxhash64(F.col(EVENT_ID), F.col(FINGERPRINT))
    bucket = F.concat(F.col("_day"), F.lit("."), F.pmod(key, F.col("_of").cast("long")).cast("string"), F.lit(_OF),
                      F.col("_of").cast("string"))
    met = rows.join(F.broadcast(sizes), day == F.col("_day"), "left")
    return met.withColumn(out, F.coalesce(bucket, day)).drop("_day", "_of")


class TornCommit(ValueError):
    """The text of a commit isn't whole."""


@dataclass(frozen=True)
class Commit:
    """Content of a commit: part -> (write folder, rows), and what the run that made it did."""

    days: dict[str, tuple[str, int]]
    run: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.days.values())

    @property
    def buckets(self) -> dict[str, int]:
        """Number of buckets of every day that has more than one."""
        return {day: n for day, n in map(split_part, self.days) if n > 1}

    def only(self, days: Iterable[str]) -> Commit:
        wanted = set(days)
        return Commit({d: v for d, v in self.days.items() if d in wanted})

    def to_text(self) -> str:
        body = {"rows": self.rows, "days": {d: list(v) for d, v in sorted(self.days.items())}, "run": self.run}
        return json.dumps({**body, "end": zlib.crc32(json.dumps(body).encode())})

    @staticmethod
    def from_text(text: str) -> Commit:
        try:
            body = json.loads(text)
            end = body.pop("end", None)   # commits of earlier releases have none
            if end is not None and end != zlib.crc32(json.dumps(body).encode()):
                raise TornCommit("its checksum doesn't hold")
            return Commit({d: (w, int(n)) for d, (w, n) in body["days"].items()}, body.get("run", {}))
        except (json.JSONDecodeError, AttributeError, KeyError, TypeError) as err:
            raise TornCommit(str(err)) from err


def write_path(root: str, write: str) -> str:
    return f"{root.rstrip('/')}/{DATA}/{write}"


def day_path(root: str, write: str, day: str) -> str:
    """The folder that holds a part's rows, maybe among those of other buckets of its day."""
    return f"{write_path(root, write)}/{DAY}={part_folder(write, day)}"


def commit_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{version:08d}"


def written_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of all writes, committed or not."""
    return sorted(fs.list_names(spark, f"{root.rstrip('/')}/{DATA}"))


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all commit files, whole or torn."""
    return sorted(int(n) for n in fs.list_names(spark, f"{root.rstrip('/')}/{COMMITS}") if n.isdigit())


def read_commit(spark: SparkSession, root: str, version: int) -> Commit:
    return Commit.from_text(fs.read_small(spark, commit_path(root, version)))


def is_torn(spark: SparkSession, root: str, version: int) -> bool:
    try:
        read_commit(spark, root, version)
    except TornCommit:
        return True
    return False


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that have a whole commit."""
    return [n for n in commit_numbers(spark, root) if not is_torn(spark, root, n)]


def newest_whole(spark: SparkSession, root: str, numbers: list[int]) -> int | None:
    """The newest of some commits that isn't torn."""
    return next((n for n in reversed(numbers) if not is_torn(spark, root, n)), None)


def current_version(spark: SparkSession, root: str) -> int | None:
    return newest_whole(spark, root, commit_numbers(spark, root))


def read_days(spark: SparkSession, root: str, commit: Commit) -> DataFrame:
    """Rows of the days of a commit: DataFrame[eventid, fingerprint, etltime].

    Where buckets share folders, the rows of the commit's parts are taken by a join with
    their names, as long as the commit's list and broadcast. It is one scan all the same:
    a union would have the joins above done for each of its sides.
    """
    paths = sorted({day_path(root, write, part) for part, (write, _) in commit.days.items()})
    if not paths:
        return spark.createDataFrame([], MANIFEST)
    if all(buckets_per_folder(write) == 1 for write, _ in commit.days.values()):
        return spark.read.schema(MANIFEST).parquet(*paths)
    # Rows of writes whose parts have folders of their own hold no name.
    wanted = {(write, part if buckets_per_folder(write) > 1 else "") for part, (write, _) in commit.days.items()}
    rows = spark.read.schema(T.StructType([*MANIFEST.fields, T.StructField(PART, T.StringType())])).parquet(*paths)
    write = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -3), "/", 1)
    named = rows.select(*MANIFEST.names, write.alias("_write"), F.coalesce(F.col(PART), F.lit("")).alias(PART))
    wanted = spark.createDataFrame(sorted(wanted), f"_write string, {PART} string")
    return named.join(F.broadcast(wanted), ["_write", PART], "left_semi").select(*MANIFEST.names)


def read_snapshot(spark: SparkSession, root: str, version: int) -> DataFrame:
    return read_days(spark, root, read_commit(spark, root, version))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The published manifest: DataFrame[eventid, fingerprint, etltime]."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published manifest under {root}")
    return read_snapshot(spark, root, version)


def row_count(spark: SparkSession, root: str, version: int) -> int:
    """Row count of a version, from its commit."""
    return read_commit(spark, root, version).rows


