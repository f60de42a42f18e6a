"""Tables whose reloads appear at once: catalog-managed partitions behind a view.

A version is a catalog table whose partitions each have a folder of their own. A reload writes the folders of its slices, where no reader
looks; the next version names these and, for all other partitions, the folders of the version before, which costs catalog entries and no data. Then
one statement points the view at it. A reader sees the table before or after the reload, never between, and a reload that
dies leaves nothing but folders that no version names.

The catalog has to outlive the session for other sessions to see the tables; the session's own is enough for one application.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.sources.folders import NULL_FOLDER, matching, remove


class Published:
    """A partitioned table read through the view ``name``; its files lie below ``root``. One writer at a time."""

    def __init__(self, spark: SparkSession, name: str, root: str, partition: str):
        self.spark, self.name, self.root, self.partition = spark, name, root.rstrip("/"), partition

    def _tables(self) -> list[int]:
        found = self.spark.sql(f"SHOW TABLES LIKE '{self.name}_p*'").select("tableName").collect()
        numbers = (row.tableName.removeprefix(f"{self.name}_p") for row in found)
        return sorted(int(number) for number in numbers if number.isdigit())

    def _version(self) -> int | None:
        """The version the view shows."""
        if self.spark.sql(f"SHOW VIEWS LIKE '{self.name}'").isEmpty():
            return None
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").filter("col_name = 'Comment'").collect()
        return int(rows[0].data_type)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _places(self, version: int | None) -> dict[str, str]:
        """Folder of every partition of a version, by its value in SQL."""
        if version is None:
            return {}
        table = f"{self.name}_p{version}"
        kind = self.spark.table(table).schema[self.partition].dataType
        out = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {table}").collect():
            value = self._literal(self._unescaped(row.partition), kind)
            found = self.spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({self.partition} = {value})")
            out[value] = found.filter("col_name = 'Location'").first().data_type
        return out

    def _unescaped(self, folder: str) -> str:
        """The value in a folder's name, ``column=value``."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])

    @staticmethod
    def _literal(text: str, kind: T.DataType) -> str:
        return text if isinstance(kind, T.IntegralType) else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def _written(self, df: DataFrame) -> dict[str, str]:
        """Write rows into folders of their own, one for each partition value; the folders are what was filled."""
        folder = f"{self.root}/slices-{uuid.uuid4().hex}"
        df.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(folder)
        kind, found = df.schema[self.partition].dataType, {}
        for path in matching(self.spark, f"{folder}/{self.partition}=*"):
            value = self._unescaped(path.getName())
            if value == NULL_FOLDER:
                raise ValueError(f"a row of {self.name} has no {self.partition}")
            found[self._literal(value, kind)] = path.toString()
        return found

    def _publish(self, schema: T.StructType, places: dict[str, str]) -> int:
        """Create the next version over the given folders and point the view at it."""
        number = max(self._tables(), default=0) + 1
        table = f"{self.name}_p{number}"
        fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        self.spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY (`{self.partition}`) LOCATION '{self.root}/{table}'")
        if places:
            parts = " ".join(f"PARTITION ({self.partition} = {value}) LOCATION '{folder}'" for value, folder in sorted(places.items()))
            self.spark.sql(f"ALTER TABLE {table} ADD {parts}")
        self._switch(table, number)
        return number

    def _switch(self, table: str, number: int) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} COMMENT '{number}' AS SELECT * FROM {table}")

    def replace_all(self, df: DataFrame) -> DataFrame:
        """A version of these rows alone."""
        self._publish(df.schema, self._written(df))
        return self.read()

    def replace_slices(self, df: DataFrame, values: list | None = None) -> DataFrame:
        """Replace the partitions present in ``df``, and empty those of ``values`` that it has no row for; all others stay.

        ``df`` is evaluated once, and may read the table itself.
        """
        before = self._version()
        if before is None:
            return self.replace_all(df)
        kind = df.schema[self.partition].dataType
        places = {**self._places(before)}
        for value in values or []:
            places.pop(self._literal(str(value), kind), None)
        places.update(self._written(df))
        schema = self.spark.table(f"{self.name}_p{before}").schema
        self._publish(T.StructType([*schema.fields, *[f for f in df.schema if f.name not in schema.names]]), places)
        return self.read()

    def replace_where(self, fresh: DataFrame, condition) -> DataFrame:
        """Replace the rows that meet a condition by fresh ones; only partitions that lose or get a row are written.

        Rows for which the condition is unknown stay.
        """
        now, doomed = self.read(), F.coalesce(condition, F.lit(False))
        touched = now.filter(doomed).select(self.partition).union(fresh.select(self.partition)).distinct()
        # one value per partition concerned reaches the driver
        values = [row[0] for row in touched.collect()]
        kept = now.filter(F.col(self.partition).isin(values) & ~doomed)
        return self.replace_slices(kept.unionByName(fresh, allowMissingColumns=True), values)

    def forget(self, keep: int = 2) -> None:
        """Drop all but the newest versions, and the folders that those left name none of."""
        shown = self._version()
        old = [number for number in self._tables() if number != shown][: -max(keep - 1, 0) or None]
        for number in old:
            self.spark.sql(f"DROP TABLE {self.name}_p{number}")
        used = {folder for number in self._tables() for folder in self._places(number).values()}
        for slices in matching(self.spark, f"{self.root}/slices-*"):
            folders = [path.toString() for path in matching(self.spark, f"{slices.toString()}/{self.partition}=*")]
            for folder in folders:
                if folder not in used:
                    remove(self.spark, folder)
            if not used.intersection(folders):
                remove(self.spark, slices.toString())
