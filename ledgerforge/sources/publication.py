"""Tables that change together: written beside the published versions, then switched by one commit.

Each table is written to a folder of its own under its namespace, as a table nobody asks for by name. The commit
is one small file that lists all of them, put in place by a rename; from then on readers that go through
`published` get every new table, and before it none. The catalog's tables follow one by one, by a change
of location where the layout is the same. A run that stops in between is finished by `recover`, which
the next run calls first; one that stops before its commit leaves the published tables as they were.
The version before stays readable until the next commit, for queries that began on it. One run at a time
may publish under a namespace.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.sources.schemas import LINEAGE

#: Columns that readers look single values up by; files tell by a Bloom filter which of their row groups lack one.
LOOKUPS = ("tx_hash",)
VERSIONS = "versions"
JOURNAL = "publication.json"
PREVIOUS = "previous_version"
#: Values of a ledger hardly repeat, so a dictionary costs time and is dropped when it is full; zstd packs what does
#: repeat. Only where a row comes from does all through a file.
PACKED_FILES = {
    "compression": "zstd",
    "parquet.enable.dictionary": "false",
    **{f"parquet.enable.dictionary#{column}": "true" for column in LINEAGE},
}
#: Row groups are what a scan can be split by.
ROW_GROUPS = {**PACKED_FILES, "parquet.block.size": str(8 << 20)}


def bloom_filters(*columns: str) -> dict[str, str]:
    """Parquet write options: a filter per row group for these columns, sized by the distinct values met."""
    enabled = {f"parquet.bloom.filter.enabled#{column}": "true" for column in columns}
    return {**enabled, "parquet.bloom.filter.adaptive.enabled": "true"} if enabled else {}


def namespace_location(spark: SparkSession, namespace: str) -> str:
    rows = spark.sql(f"DESCRIBE NAMESPACE EXTENDED {namespace}").filter("info_name = 'Location'")
    return rows.first()["info_value"].rstrip("/")


def _path(spark: SparkSession, path: str):
    """Hadoop's path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    at, files = _path(spark, path)
    files.delete(at, True)


def _details(spark: SparkSession, name: str) -> dict[str, object]:
    """Columns, partition columns, buckets and location of a table, from one question to the catalog."""
    rows = [(row.col_name, row.data_type) for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    names = [key for key, _ in rows]
    headings = [i for i, key in enumerate(names) if key == "" or key.startswith("#")]
    partitions = []
    if "# Partition Information" in names:
        start = names.index("# Partition Information") + 2
        partitions = rows[start : next(i for i in headings if i >= start)]
    details = dict(rows[headings[0] :])
    found = {key: details.get(key) or "" for key in ("Location", "Num Buckets", "Bucket Columns", "Sort Columns")}
    return {**found, "columns": rows[: headings[0]], "partitions": partitions}


def _same_layout(one: dict, other: dict) -> bool:
    """Whether a change of location is enough to replace one version by the other."""
    return all(one[key] == other[key] for key in one if key != "Location") and not one["partitions"]


class Publication:
    """Pending tables of one run over the namespaces of `home`, the namespace that keeps the commit file."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home
        self.pending: dict[str, str] = {}  # name -> the table that holds its new version
        self._locations: dict[str, str] = {}

    def _location(self, namespace: str) -> str:
        if namespace not in self._locations:
            self._locations[namespace] = namespace_location(self.spark, namespace)
        return self._locations[namespace]

    def write(
        self, name: str, df: DataFrame, partition_by=(), bucket: tuple[int, *tuple[str, ...]] | None = None
    ) -> None:
        """Write the next version of `name`; `bucket` is a number of buckets, the column that decides and more to sort by."""
        namespace, _, table = name.rpartition(".")
        mark = uuid4().hex
        path = f"{self._location(namespace)}/{VERSIONS}/{table}-{mark}"
        beside = f"{namespace}._{table}_{mark}"
        filters = bloom_filters(*(column for column in LOOKUPS if column in df.columns))
        writer = df.write.format("parquet").option("path", path).options(**filters, **ROW_GROUPS)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket:
            writer = writer.bucketBy(*bucket[:2]).sortBy(*bucket[1:])
        try:
            writer.saveAsTable(beside)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
            delete_folder(self.spark, path)
            raise
        self.pending[name] = beside

    def read(self, name: str) -> DataFrame:
        """The version this run wrote, or else the published one."""
        if name in self.pending:
            return self.spark.table(self.pending[name])
        return _last_version(self.spark, self._location(self.home), name)

    def commit(self) -> None:
        """Publish all pending tables at once."""
        if not self.pending:
            return
        _write_journal(self.spark, self.home, self.pending)
        self.pending = {}
        recover(self.spark, self.home)

    def abandon(self) -> None:
        """Forget what was not committed and delete its files."""
        for beside in self.pending.values():
            location = _details(self.spark, beside)["Location"]
            self.spark.sql(f"DROP TABLE {beside}")
            delete_folder(self.spark, location)
        self.pending = {}

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_exc) -> None:
        self.commit() if kind is None else self.abandon()


def _write_journal(spark: SparkSession, home: str, pending: dict[str, str]) -> None:
    path = f"{namespace_location(spark, home)}/{JOURNAL}"
    draft, files = _path(spark, f"{path}-{uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(pending).encode()))
    out.close()
    if files.exists(_path(spark, path)[0]) or not files.rename(draft, _path(spark, path)[0]):
        files.delete(draft, False)
        raise RuntimeError(f"Another run is publishing under {home}; recover it first.")


def _read_journal(spark: SparkSession, folder: str) -> dict[str, str]:
    at, files = _path(spark, f"{folder}/{JOURNAL}")
    if not files.exists(at):
        return {}
    return json.loads(spark.read.text(f"{folder}/{JOURNAL}", wholetext=True).first()[0])


def _last_version(spark: SparkSession, folder: str, name: str) -> DataFrame:
    beside = _read_journal(spark, folder).get(name)
    return spark.table(beside if beside and spark.catalog.tableExists(beside) else name)


def published(spark: SparkSession, home: str, name: str) -> DataFrame:
    """The last committed version of a table, also while the catalog has not followed yet."""
    return _last_version(spark, namespace_location(spark, home), name)


def recover(spark: SparkSession, home: str) -> list[str]:
    """Let the catalog follow the last commit; returns the tables that had not been switched."""
    folder = namespace_location(spark, home)
    left = _read_journal(spark, folder)
    switched = [name for name, beside in left.items() if _switch(spark, name, beside)]
    if left:
        delete_folder(spark, f"{folder}/{JOURNAL}")
    return switched


def _switch(spark: SparkSession, name: str, beside: str) -> bool:
    """Give `name` the files of `beside`. Can be repeated after it stopped anywhere."""
    if not spark.catalog.tableExists(beside):
        return False
    new, old, before = _details(spark, beside), {"Location": ""}, ""
    if spark.catalog.tableExists(name):
        old = _details(spark, name)
        found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == PREVIOUS).first()
        before = found["value"] if found else ""
        if _same_layout(old, new):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{new['Location']}'")
            spark.sql(f"DROP TABLE {beside}")
        else:
            spark.sql(f"DROP TABLE {name}")
    if spark.catalog.tableExists(beside):
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    if old["Location"] not in ("", new["Location"]):
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{old['Location']}')")
    if before and before not in (old["Location"], new["Location"]):
        delete_folder(spark, before)
    spark.catalog.refreshTable(name)
    return True
