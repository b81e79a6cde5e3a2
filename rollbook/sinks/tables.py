"""Catalog objects: the namespace and the keyed table of current users.

The table is a view of eleven columns over two parts: a base, bucketed by id, with
one row per id as of the last merge, and the batches of the ingest log that are not
merged yet. Only those are shuffled when the table is read or merged; the base is
neither shuffled nor sorted, however large it is, and a lookup by id reads one
bucket of it. Each bucket is a partition of the base too, so that a merge writes
the buckets that the log touches and leaves the files of the others alone.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rollbook.fixed import DATABASE, TABLE, USER_COLUMNS
from rollbook.schema import LOG_SCHEMA, POSITION
from rollbook.sinks.user_log import LOOKUP_OPTIONS, ensure_log, read_log

_VERSION_COLUMNS = (*USER_COLUMNS, *POSITION)


@dataclass(frozen=True)
class UserTable:
    """Names and places of one keyed table.

    `buckets` counts when the base is first made; about a gigabyte per bucket is a
    good size, and a merge can change it. The base outlives the session only in a
    persistent catalog.
    """

    folder: str
    log_path: str
    database: str = DATABASE
    table: str = TABLE
    buckets: int = 64

    @property
    def name(self) -> str:
        return f"{_name(self.database)}.{_name(self.table)}"

    def part(self, suffix: str) -> str:
        return f"{_name(self.database)}.{_name(f'{self.table}_{suffix}')}"


def ensure_table(spark: SparkSession, table: UserTable) -> str:
    """Create the namespace and the table unless they exist, and return the table's name.

    Parquet tables take no primary key; the view shows one row per id. It is pointed
    at the given log, so a job can go on with a new log after a merge of the old one.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(table.database)}")
    # The catalog takes any location; a folder that cannot be written to shall fail here, not at the first merge.
    spark.range(0).coalesce(1).write.mode("ignore").parquet(f"{table.folder}/made")
    _create_base(spark, table, table.part("base"), f"{table.folder}/empty", table.buckets)
    ensure_log(spark, table.log_path)
    _show(spark, table, _marks(spark, table))
    return table.name


def drop_table(spark: SparkSession, table: UserTable) -> None:
    """Forget the table's names. Its files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {table.name}")
    spark.sql(f"DROP TABLE IF EXISTS {table.part('base')}")


def merge_log(spark: SparkSession, table: UserTable, buckets: int | None = None) -> None:
    """Fold the batches that the log holds now into the base, and leave them out from then on.

    Buckets that the batches touch are read once and written beside the old ones, to which the
    catalog then points, bucket by bucket. (Overwriting them in place would lose a bucket if the
    job died between removing and renaming its files.) Readers see the old rows or the new ones,
    and as the newest position of an id counts, a merge that failed half way is just done again.
    Another number of `buckets` rewrites all of the base and replaces its entry in the catalog;
    readers between the two statements find none.
    """
    ensure_table(spark, table)
    base, label = table.part("base"), uuid.uuid4().hex
    place, written = f"{table.folder}/{label}", table.part(f"base_{label}")
    count, before = _bucket_count(spark, base), _marks(spark, table)
    # The batches of a stream follow one another, so its highest is enough to name them all.
    found = read_log(spark, table.log_path).groupBy("run").agg({"batch_id": "max"}).collect()
    marks = before | {row[0]: row[1] for row in found}
    again = buckets not in (None, count)
    touched = "true"
    if not again:
        ids = _log(table, "id", count, before, marks)
        slices = [str(row[0]) for row in spark.sql(f"SELECT DISTINCT {_slice(count)} FROM ({ids})").collect()]
        touched = f"slice IN ({', '.join(slices)})" if slices else "false"
    if touched != "false":
        partitions = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            # The log's one shuffle then brings it into the base's buckets.
            spark.conf.set("spark.sql.shuffle.partitions", count)
            (
                spark.sql(_merged(table, touched, count, before, marks))
                .withColumn("slice", F.expr(_slice(buckets or count)))
                .write.partitionBy("slice")
                .bucketBy(buckets or count, "id")
                .sortBy("id")
                .option("path", place)
                .saveAsTable(written)
            )
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
        # A table with a location of its own: this forgets the name and keeps the files.
        spark.sql(f"DROP TABLE {written}")
        if again:
            spark.sql(f"DROP TABLE {base}")
            _create_base(spark, table, base, place, buckets)
            spark.sql(f"ALTER TABLE {base} RECOVER PARTITIONS")
        else:
            there = {row[0] for row in spark.sql(f"SHOW PARTITIONS {base}").collect()}
            for number in slices:
                here = f"PARTITION (slice = {number})", f"LOCATION {_text(f'{place}/slice={number}')}"
                change = "{} SET {}" if f"slice={number}" in there else "ADD {} {}"
                spark.sql(f"ALTER TABLE {base} {change.format(*here)}")
    spark.sql(f"ALTER TABLE {base} SET TBLPROPERTIES ('merged' = {_text(json.dumps(marks))})")
    spark.sql(f"REFRESH TABLE {base}")
    _show(spark, table, marks)


def _create_base(spark: SparkSession, table: UserTable, name: str, place: str, buckets: int) -> None:
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}"
        for field in LOG_SCHEMA.fields
        if field.name in _VERSION_COLUMNS
    )
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {name} ({columns}, slice int) USING parquet
        OPTIONS ({', '.join(f"'{key}' '{value}'" for key, value in LOOKUP_OPTIONS.items())})
        PARTITIONED BY (slice) CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS
        LOCATION {_text(place)}
        """
    )


def _slice(buckets: int) -> str:
    """The bucket that Spark puts a row into, which is its partition."""
    return f"pmod(hash(id), {buckets})"


def _show(spark: SparkSession, table: UserTable, marks: dict[str, int]) -> None:
    shown = ", ".join(USER_COLUMNS)
    versions = _versions(spark, table, marks)
    spark.sql(f"CREATE OR REPLACE VIEW {table.name} AS SELECT {shown} FROM ({versions})")


def _marks(spark: SparkSession, table: UserTable) -> dict[str, int]:
    """The highest merged batch of each run."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table.part('base')}").filter("key = 'merged'").collect()
    return json.loads(rows[0]["value"]) if rows else {}


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bucket_count(spark: SparkSession, name: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return int(described.filter("col_name = 'Num Buckets'").first()["data_type"])


def _log(table: UserTable, columns: str, buckets: int, after: dict[str, int], upto: dict[str, int] | None = None) -> str:
    """The newest row of every id in the log's batches, brought into the base's buckets.

    Batches up to those in `after` are merged and not read; `upto` bounds the others.
    The rows are reduced to one per id first, so an id that holds much of the log does not
    fill a bucket.
    """
    newest_first = ", ".join(f"`{name}` DESC" for name in POSITION)
    bounds = [f"NOT (run = {_text(run)} AND batch_id <= {batch})" for run, batch in after.items()]
    if upto is not None:
        named = [f"(run = {_text(run)} AND batch_id <= {batch})" for run, batch in upto.items()]
        bounds.append(f"({' OR '.join(named) or 'false'})")
    return f"""
        SELECT /*+ REPARTITION({buckets}, id) */ {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY {newest_first}) AS _rank
            FROM parquet.{_name(table.log_path)} WHERE {' AND '.join(['reason IS NULL', *bounds])}
        ) WHERE _rank = 1
    """


def _position(side: str) -> str:
    return f"struct({', '.join(f'{side}.`{name}`' for name in POSITION)})"


def _merged(table: UserTable, touched: str, buckets: int, after: dict[str, int], upto: dict[str, int]) -> str:
    """The newest row of every id in the touched buckets, which stream once past a hash table of the log's rows."""
    columns = ", ".join(f"`{name}`" for name in _VERSION_COLUMNS)
    newer = f"base.id IS NULL OR {_position('log')} > {_position('base')}"
    chosen = ", ".join(f"if(log.id IS NOT NULL AND ({newer}), log.`{c}`, base.`{c}`) AS `{c}`" for c in _VERSION_COLUMNS)
    return f"""
        SELECT /*+ SHUFFLE_HASH(log) */ {chosen} FROM (SELECT * FROM {table.part('base')} WHERE {touched}) AS base
        FULL OUTER JOIN ({_log(table, columns, buckets, after, upto)}) AS log ON base.id = log.id
    """


def _versions(spark: SparkSession, table: UserTable, after: dict[str, int]) -> str:
    """The newest row of every id, with its position, from the base and the log's unmerged batches.

    The base's rows stream past a hash table of the log's, once whole and once as ids and positions.
    (A full join reads the base once, as a merge does, but no lookup by id would get past it.)
    """
    columns = ", ".join(f"`{name}`" for name in _VERSION_COLUMNS)
    base = table.part("base")
    count = _bucket_count(spark, base)
    ids = ", ".join(f"`{name}`" for name in ("id", *POSITION))
    mine = ", ".join(f"log.`{name}`" for name in _VERSION_COLUMNS)
    return f"""
        SELECT /*+ SHUFFLE_HASH(log) */ {columns} FROM {base} AS base
        LEFT ANTI JOIN ({_log(table, ids, count, after)}) AS log
        ON base.id = log.id AND {_position('log')} > {_position('base')}
        UNION ALL
        SELECT /*+ SHUFFLE_HASH(log) */ {mine} FROM ({_log(table, columns, count, after)}) AS log
        LEFT JOIN (SELECT {ids} FROM {base}) AS base ON base.id = log.id
        WHERE base.id IS NULL OR {_position('log')} > {_position('base')}
    """
