"""JSON lines, keyed tables, contract files, snapshots and golden sets (S-12..S-26, S-28..S-31, T6, T7, T10, T11)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Lines that are whole JSON objects; blank, broken and other lines are left out, a missing path is an empty table (S-17, S-19)."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value").startswith("{"))
    bad = StructType([*schema.fields]).add("_corrupt", "string")
    got = lines.select(F.from_json("value", bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return got.where("r is not null and r._corrupt is null").select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields])


def read_strict(spark: SparkSession, path: str, schema: StructType | str, drafts: bool = False) -> DataFrame:
    """Whole JSON files of golden items: names that start with _ or TEMPLATE are skipped, drafts too unless asked for, one bad file aborts (S-12)."""
    got = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path).withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    got = got.where(~F.col("_file").startswith("_") & ~F.col("_file").startswith("TEMPLATE"))
    return (got if drafts else got.where("status <> 'draft'")).drop("_file")


def last_of_key(df: DataFrame, key: str | list[str], order: Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(order.desc()))).where("_r = 1").drop("_r")


class KeyedTable:
    """A Parquet table with one row a key. Every write makes a new version; readers take the newest complete one.

    A version counts once Spark's committer has marked it complete, so a reader never sees half a write, and a lost
    driver leaves the version before in place.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, keep: int = 3) -> None:
        self.spark, self.path, self.key, self.schema, self.keep = spark, path, key, StructType.fromDDL(schema), keep

    def versions(self) -> list[int]:
        p, fs = _fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        jvm = self.spark.sparkContext._jvm
        found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")]
        return sorted(int(x.getName()[2:]) for x in found if fs.exists(jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS")))

    def read(self) -> DataFrame:
        got = self.versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={got[-1]}") if got else self.spark.createDataFrame([], self.schema)

    def overwrite(self, df: DataFrame) -> None:
        got = self.versions()
        df.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/v={(got[-1] if got else 0) + 1}")
        for old in self.versions()[: -self.keep]:
            p, fs = _fs(self.spark, f"{self.path}/v={old}")
            fs.delete(p, True)

    def upsert(self, rows: DataFrame, order: str | None = None) -> None:
        """New rows replace those of their key; of several new rows on a key the last by order stays."""
        new = rows if order is None else last_of_key(rows, self.key, F.col(order))
        new = new.select(*self.schema.names).dropDuplicates([self.key])
        old = self.read().join(new.select(self.key), self.key, "left_anti")
        self.overwrite(old.unionByName(new))

    def put_new(self, rows: DataFrame) -> None:
        """Only keys that are not there yet: a second run writes nothing new (T-10)."""
        new = rows.select(*self.schema.names).dropDuplicates([self.key]).join(self.read().select(self.key), self.key, "left_anti")
        self.overwrite(self.read().unionByName(new))


class BucketedTable(KeyedTable):
    """A KeyedTable for large tables: rows lie in buckets by a hash of the key, and a write replaces the buckets that it touches, not the table.

    A version is a manifest, a small file that names the folder of each bucket, written once those are complete. What a day's
    rows cost grows with the buckets that they fall into; folders that none of the last keep manifests names are deleted. Null keys share a bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, keep: int = 3, buckets: int = 256) -> None:
        super().__init__(spark, path, key, schema, keep)
        self.buckets = buckets

    def _children(self, prefix: str) -> list:
        p, fs = _fs(self.spark, self.path)
        return [x.getPath() for x in fs.listStatus(p) if x.getPath().getName().startswith(prefix)] if fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(x.getName()[2:]) for x in self._children("m="))

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """Folder of each bucket that has rows, in the newest version."""
        found = self.versions()
        if not found:
            return {}
        text = self.spark.read.text(f"{self.path}/m={found[-1] if version is None else version}", wholetext=True).first()[0]
        return {int(k): v for k, v in json.loads(text).items()}

    def _folders(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])

    def read(self) -> DataFrame:
        return self._folders(sorted(self.manifest().values()))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _commit(self, rows: DataFrame, touched: set[int], kept: dict[int, str]) -> None:
        found = self.versions()
        n = (found[-1] if found else 0) + 1
        rows.select(*self.schema.names, self._bucket().alias("_b")).repartition("_b").write.mode("overwrite").partitionBy("_b").parquet(f"{self.path}/w={n}")
        p, fs = _fs(self.spark, f"{self.path}/w={n}")
        written = {int(x.getPath().getName()[3:]) for x in fs.listStatus(p) if x.getPath().getName().startswith("_b=")}
        now = {b: f for b, f in kept.items() if b not in touched} | {b: f"w={n}/_b={b}" for b in written}
        jvm = self.spark.sparkContext._jvm
        half = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_m={n}")
        out = fs.create(half, True)
        out.write(bytearray(json.dumps(now), "utf-8"))
        out.close()
        fs.rename(half, jvm.org.apache.hadoop.fs.Path(f"{self.path}/m={n}"))
        self._forget()

    def _forget(self) -> None:
        _, fs = _fs(self.spark, self.path)
        versions = self.versions()
        used = {f.split("/")[0] for v in versions[-self.keep :] for f in self.manifest(v).values()}
        for x in self._children("m="):
            if int(x.getName()[2:]) not in versions[-self.keep :]:
                fs.delete(x, True)
        for x in self._children("w="):
            if x.getName() not in used and int(x.getName()[2:]) < versions[-1]:
                fs.delete(x, True)

    def overwrite(self, df: DataFrame) -> None:
        self._commit(df, set(range(self.buckets)), {})

    def _touched(self, rows: DataFrame) -> tuple[set[int], dict[int, str], DataFrame]:
        """Buckets of the rows' keys (at most as many numbers as there are buckets), the manifest, and what those buckets hold."""
        touched = {r.b for r in rows.select(self._bucket().alias("b")).distinct().collect()}
        kept = self.manifest()
        return touched, kept, self._folders([kept[b] for b in sorted(touched & set(kept))])

    def upsert(self, rows: DataFrame, order: str | None = None) -> None:
        new = (rows if order is None else last_of_key(rows, self.key, F.col(order))).select(*self.schema.names).dropDuplicates([self.key])
        touched, kept, old = self._touched(new)
        if touched:
            self._commit(old.join(new.select(self.key), self.key, "left_anti").unionByName(new), touched, kept)

    def put_new(self, rows: DataFrame) -> None:
        wanted = rows.select(*self.schema.names).dropDuplicates([self.key])
        _, kept, old = self._touched(wanted)
        new = wanted.join(old.select(self.key), self.key, "left_anti")
        touched = {r.b for r in new.select(self._bucket().alias("b")).distinct().collect()}
        if touched:
            same = self._folders([kept[b] for b in sorted(touched & set(kept))])
            self._commit(same.unionByName(new), touched, kept)


def write_export(records: DataFrame, counts: DataFrame, path: str, export_id: str, version: str, order: str = "doc_id") -> None:
    """JSON lines in a folder a source (none for a source without records) and a one-row manifest (S-21). Sorted, so that two exports of one store hold the same lines."""
    records.repartitionByRange("source", order).sortWithinPartitions("source", order).write.mode("overwrite").partitionBy("source").json(f"{path}/records")
    blocks = counts.groupBy().agg(F.array_sort(F.collect_list(F.struct("block", "value", "n"))).alias("counts"))  # as many rows as vocabulary values and sources
    blocks.select(F.lit(version).alias("contract_version"), F.lit(export_id).alias("export_id"), "counts").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/records")


SNAPSHOT = "documents array<struct<doc_id:string,title:string,text:string,locator:string,url:string,published:string>>"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Documents of all snapshot files; of several on an id that of the last file stays (S-23)."""
    raw = spark.read.schema(SNAPSHOT).option("multiLine", "true").json(path).withColumn("_file", F.input_file_name())
    docs = raw.select("_file", F.posexplode("documents").alias("_pos", "d")).select("_file", "_pos", "d.*")
    return docs.withColumn("_o", F.struct("_file", "_pos")).transform(lambda d: last_of_key(d, "doc_id", F.col("_o"))).drop("_file", "_pos", "_o")


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, doc_id) pairs of golden cases; null lists give none (S-24)."""
    raw = spark.read.schema("cases array<struct<id:string,expect:struct<expected_doc_ids:array<string>>>>").option("multiLine", "true").json(path)
    return raw.select(F.explode("cases").alias("c")).select(F.col("c.id").alias("case_id"), F.explode("c.expect.expected_doc_ids").alias("doc_id"))


def pick(snapshot: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(ord, doc_id) as items in that order; a missing id is an error (S-25)."""
    got = wanted.join(snapshot.withColumn("_hit", F.lit(True)), "doc_id", "left")
    key = F.when(F.col("_hit").isNull(), F.raise_error(F.concat(F.lit("not in the snapshot: "), "doc_id")).cast("string")).otherwise(F.col("doc_id"))
    return got.select("ord", key.alias("doc_id"), "url", "title", F.left(F.coalesce("text", F.lit("")), F.lit(4000)).alias("body"), F.to_date(F.left("published", F.lit(10))).alias("published_at")).orderBy("ord")


def with_summary(scores: DataFrame, summary: DataFrame) -> DataFrame:
    """Score lines and a last line for the summary, as JSON text; a file without it stems from a run that was cut off (S-28)."""
    lines = scores.select(F.lit(0).alias("o"), F.to_json(F.struct("*")).alias("value"))
    last = summary.select(F.lit(1).alias("o"), F.to_json(F.struct(F.lit("summary").alias("kind"), F.struct("*").alias("summary"))).alias("value"))
    return lines.unionByName(last).orderBy("o").select("value")


def front_matter_url(notes: DataFrame) -> DataFrame:
    """notes(path, value) with source_url read from the head of the file (S-26)."""
    head = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---", 1)
    return notes.select("path", F.nullif(F.trim(F.regexp_replace(F.regexp_extract(head, r"(?m)^source_url:\s*(.*)$", 1), "^['\"]|['\"]$", "")), F.lit("")).alias("source_url"))
