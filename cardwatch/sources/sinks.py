"""Idempotent table sinks and the keyed publish projection.

``insert_if_absent`` is the Spark form of ``UNIQUE(key) ... ON CONFLICT DO
NOTHING``: keep one row per key inside the batch, anti-join the keys already
in the target, append the rest.  A micro-batch replayed after a failure
therefore adds nothing twice.  What it reads of the target is the key column, of
the files that may hold a key of the batch (``key_index``), of the batch's own
partitions (``prune_by``), or of all.

``jdbc_merge`` is the same for database tables, inside the database: rows go to
staging tables in parallel, and one transaction inserts what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardwatch.sources import codec, commits, keyindex, storage


def new_rows(batch: DataFrame, target: DataFrame | None, key: str = "transaction_id",
             also_on: list[str] | None = None, order_by: list[str] | None = None, distinct_keys: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is neither repeated earlier in the batch nor in ``target``.

    Of several batch rows with one key the first by ``order_by`` stays, ties by
    the hash of the whole row, so a replay keeps the same one.  NULL keys are
    not equal to each other, as in SQL; the pipeline quarantines such records
    before they get here.  ``also_on`` adds columns that are a function of the
    key (e.g. the event date a table is partitioned by) to the anti-join,
    which is then a join on (partition, key).  ``distinct_keys`` tells that no
    key is repeated in the batch, which then isn't grouped by it once more.
    """
    on = list(also_on or []) + [key]
    fresh = batch if distinct_keys else _first_rows(batch, key, order_by)
    if target is None:
        return fresh
    # never broadcast: compressed keys look far smaller than the driver would have to hold them
    return fresh.join(target.select(*on).hint("merge"), on, "left_anti")


def _first_rows(batch: DataFrame, key: str, order_by: list[str] | None) -> DataFrame:
    """One row per key of the batch, and all rows without a key."""
    cols = [F.col(c) for c in batch.columns]
    rank = F.struct(*[F.col(c) for c in order_by or []], F.xxhash64(*cols).alias("_row_hash"))
    keyed = batch.where(F.col(key).isNotNull())
    first = keyed.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*cols), rank).alias("_r")).select("_r.*")
    return first.unionByName(batch.where(F.col(key).isNull()))


def _stored(spark: SparkSession, path: str, fmt: str, schema, partition: str | None, values: list | None) -> DataFrame | None:
    """The table at ``path`` with a known schema (so an empty table reads as no rows), or None before the first write.

    With ``partition`` only the folders of ``values`` are listed.
    """
    if not storage.exists(spark, path):
        return None
    reader = spark.read.schema(schema).format(fmt)
    if partition is None:
        return reader.load(path)
    folders = [p for p in (f"{path}/{partition}={v}" for v in values or []) if storage.exists(spark, p)]
    return reader.option("basePath", path).load(folders) if folders else None


def stored_table(rows: DataFrame, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path`` read with the columns of ``rows``, None before the first write."""
    return _stored(rows.sparkSession, path, fmt, rows.schema, None, None)


def _counted(rows: DataFrame, path: str, fmt: str, partition_by: list[str] | None) -> int:
    """Append ``rows`` to the table and count them on the way."""
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(seen.get["n"] or 0)


def insert_if_absent(batch: DataFrame, path: str, key: str = "transaction_id",
                     partition_by: list[str] | None = None, fmt: str = "parquet",
                     prune_by: str | None = None, order_by: list[str] | None = None, key_index: bool = False,
                     distinct_keys: bool = False) -> int:
    """Append the new rows of ``batch`` to the table at ``path`` (shared storage on a cluster); returns how many.

    The key is unique in the whole table: the anti-join reads the key column,
    restricted to the batch's key range (two scalars).  With ``key_index`` it
    reads only files that may hold a key of the batch
    (:mod:`cardwatch.sources.keyindex`), so new keys read about nothing of the
    table's history whatever their order.  Where the key fixes a
    partition column (a date written into the id, or a source that re-sends
    unchanged), ``prune_by`` names it: then only the partitions that the batch
    touches are listed and read, at the price that a key sent again with
    another date is a new row.  ``distinct_keys``: see :func:`new_rows`.
    """
    spark = batch.sparkSession
    if prune_by:
        dates = sorted(r[0] for r in batch.select(prune_by).distinct().collect() if r[0] is not None)  # days of one batch
        target = _stored(spark, path, fmt, batch.schema, prune_by, dates)
    elif key_index:
        return _insert_indexed(batch, path, key, partition_by, fmt, order_by, distinct_keys)
    else:
        target = _stored(spark, path, fmt, batch.schema, None, None)
        lo, hi = batch.agg(F.min(key), F.max(key)).first() if target is not None else (None, None)
        target = target.where(F.col(key).between(F.lit(lo), F.lit(hi))) if lo is not None else None
    rows = new_rows(batch, target, key, also_on=[prune_by] if prune_by else None, order_by=order_by, distinct_keys=distinct_keys)
    return _counted(rows, path, fmt, partition_by)


def _insert_indexed(batch: DataFrame, path: str, key: str, partition_by: list[str] | None, fmt: str, order_by: list[str] | None,
                    distinct_keys: bool) -> int:
    spark = batch.sparkSession
    keyindex.repair(spark, path, key, partition_by, fmt)
    files = keyindex.candidates(spark, path, batch, key)
    target = spark.read.schema(batch.schema).option("basePath", path).format(fmt).load(sorted(files)) if files else None
    rows = new_rows(batch, target, key, order_by=order_by, distinct_keys=distinct_keys)
    # new files appear in the batch's own partitions only
    folders = None
    if partition_by:
        days = batch.select(*partition_by).distinct().collect()
        folders = ["/".join([path, *[f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None else r[c]}" for c in partition_by]]) for r in days]
    before = keyindex.listed(spark, path, partition_by, folders)
    note = keyindex.begin(spark, path)
    n = _counted(rows, path, fmt, partition_by)
    keyindex.add(spark, path, keyindex.listed(spark, path, partition_by, folders) - before, key, fmt)
    storage.delete(spark, note)
    return n


def insert_into_table(batch: DataFrame, table: str, key: str = "transaction_id") -> None:
    """Same as :func:`insert_if_absent` for a catalog table."""
    spark = batch.sparkSession
    target = spark.table(table) if spark.catalog.tableExists(table) else None
    rows = new_rows(batch, target, key)
    if target is None:
        rows.write.saveAsTable(table)
    else:
        rows.select(*target.columns).write.insertInto(table)


def _connect(spark: SparkSession, url: str, properties: dict):
    info = spark.sparkContext._jvm.java.util.Properties()
    for k, v in properties.items():
        info.setProperty(k, str(v))
    return spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, info)


def _names(table: str) -> tuple[str | None, str]:
    """Schema (None: the connection's own) and name of a table, without quotes."""
    parts = [p.strip('"') for p in table.split(".")]
    return (parts[-2] if len(parts) > 1 else None), parts[-1]


def _has_table(connection, table: str) -> bool:
    """True if the database has the table, in the named schema or else in the connection's."""
    schema, name = _names(table)
    schema = schema or connection.getSchema()
    for s in {schema, schema and schema.upper(), schema and schema.lower()}:
        for n in {name, name.upper(), name.lower()}:
            found = connection.getMetaData().getTables(None, s, n, None)
            try:
                if found.next():
                    return True
            finally:
                found.close()
    return False


def _execute(connection, sql: str) -> int:
    statement = connection.createStatement()
    try:
        return int(statement.executeUpdate(sql))
    finally:
        statement.close()


def staging_name(table: str) -> str:
    """The staging table of a target, in its schema."""
    return f"{table}_staging" if not table.endswith('"') else f'{table[:-1]}_staging"'


def jdbc_merge(batches: list[tuple[DataFrame, str]], url: str, properties: dict | None = None, key: str = "transaction_id",
               order_by: list[list[str]] | None = None, key_type: str = "VARCHAR(64)", before_merge=None) -> list[int]:
    """Insert the new rows of each batch into its database table, all tables in one transaction; returns the numbers of rows.

    Spark writes each batch, one row per key, to a staging table with as many
    connections as it has tasks; a failed task or job leaves the targets as they
    were, and the next try overwrites the staging table.  Then one connection
    runs an ``INSERT ... SELECT ... WHERE NOT EXISTS`` per table and commits
    once: readers see all tables' rows or none, and existing keys are looked up
    by the database in its own index, not read by Spark.  Missing targets are
    created with a unique key of ``key_type`` (a type that the database can
    compare).  A NULL key is an error before anything is merged, as the column
    is NOT NULL in the table's definition.

    ``before_merge`` is called after staging (tests put failures there).
    """
    options = dict(properties or {})
    spark = batches[0][0].sparkSession
    connection = _connect(spark, url, options)
    try:
        for k, (batch, table) in enumerate(batches):
            rows = new_rows(batch, None, key, order_by=order_by[k] if order_by else None)
            rows = rows.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"{key} is NULL"))))
            (rows.write.format("jdbc").option("url", url).option("dbtable", staging_name(table)).options(**options)
             .option("createTableColumnTypes", f"{key} {key_type}").mode("overwrite").save())
        if before_merge:
            before_merge()
        connection.setAutoCommit(False)
        counts = []
        for batch, table in batches:
            columns = ", ".join(f'"{c}"' for c in batch.columns)
            if not _has_table(connection, table):
                _execute(connection, f"CREATE TABLE {table} AS SELECT * FROM {staging_name(table)} WITH NO DATA")
                _execute(connection, f'CREATE UNIQUE INDEX {_names(table)[1]}_key ON {table} ("{key}")')
            counts.append(_execute(connection, f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging_name(table)} s "
                                               f'WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t."{key}" = s."{key}")'))
        for _, table in batches:
            _execute(connection, f"DROP TABLE {staging_name(table)}")
        connection.commit()
        return counts
    except BaseException:
        if not connection.getAutoCommit():
            connection.rollback()
        raise
    finally:
        connection.close()


def jdbc_append(batch: DataFrame, url: str, table: str, properties: dict | None = None,
                key: str | None = "transaction_id", order_by: list[str] | None = None) -> int | None:
    """JDBC append; with ``key`` only rows whose key is new (:func:`jdbc_merge`), so a replay adds nothing."""
    if key:
        return jdbc_merge([(batch, table)], url, properties, key, [order_by] if order_by else None)[0]
    batch.write.format("jdbc").option("url", url).option("dbtable", table).options(**dict(properties or {})).mode("append").save()
    return None


def write_batch(rows: DataFrame, path: str, query: str, batch_id: int, kept: bool = False) -> int:
    """Rows of one batch of one stream in a folder of their own, which a replay overwrites; returns how many, writes none for none.

    ``kept`` tells that the rows come from a cache without much work, so that they aren't kept once more to be counted.
    """
    if kept:
        if rows.isEmpty():
            return 0
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/{commits.QUERY}={query}/{commits.BATCH}={batch_id}")
        return int(seen.get["n"])
    rows = rows.persist()
    try:
        n = rows.count()
        if n:
            rows.write.mode("overwrite").parquet(f"{path}/{commits.QUERY}={query}/{commits.BATCH}={batch_id}")
        return n
    finally:
        rows.unpersist()


def foreach_batch_writer(write_fn, skip_empty: bool = True, persist: bool = True):
    """foreachBatch callback: persist once, skip empty batches, write, unpersist.

    ``persist=False`` for a ``write_fn`` that persists what it makes of the batch.
    """

    def _run(df: DataFrame, batch_id: int) -> None:
        if not persist:
            write_fn(df, batch_id)
            return
        df = df.persist()
        try:
            if skip_empty and df.isEmpty():
                return
            write_fn(df, batch_id)
        finally:
            df.unpersist()

    return _run


def publish(df: DataFrame, fmt: str = "kafka", path: str | None = None, topic: str | None = None,
            options: dict | None = None) -> None:
    """Write (key = user_id, value = JSON) records: to a Kafka topic, or to shared storage in any file format."""
    kv = codec.encode(df)
    w = kv.write.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "kafka":
        if not topic:
            raise ValueError("publish to kafka needs a topic")
        w.option("topic", topic).save()
    else:
        if not path:
            raise ValueError("publish to files needs a path on shared storage")
        w.mode("append").save(path)
