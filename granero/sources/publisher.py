"""A Spark data source that publishes request payloads: ``df.write.format("payloads").option("path", ...)``.

Rows have ``key``, ``chunk``, ``items`` and ``payload`` (``scans.payload_chunks`` makes them). Each task writes its payloads, one
file each, into a folder of its own attempt and reports them in its commit message. Only when all tasks have succeeded
and the failure budget holds are the files of the successful attempts moved to the outbox, and the list that names
them is written last; a failed or repeated task leaves nothing that the list names. Payloads that can't be sent (no JSON
array, or more records than ``size``) count their records as failed. The write as a whole fails, and publishes nothing,
when failed records exceed ``budget_rows`` or the share ``budget_share`` of all records.

The classes are made by a function so that workers get them with the job and need no installation.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Records of a request, and how many may fail before a publication is given up.
CHUNK, BUDGET_SHARE, BUDGET_ROWS = 500, 0.2, 500
PAYLOADS = "key string, chunk long, items long, payload string"


def payload_source() -> type:
    """The data source class, for ``spark.dataSource.register``."""
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    @dataclass
    class Written(WriterCommitMessage):
        folder: str
        files: list
        items: int
        failed: int

    def place(path: str):
        import re

        from pyarrow import fs

        if re.match(r"^(file:)?/+", path):
            return fs.LocalFileSystem(), re.sub(r"^(file:)?/+", "/", path)
        return fs.FileSystem.from_uri(path)

    class Writer(DataSourceWriter):
        def __init__(self, options: dict, run: str):
            self.path, self.run = options["path"], run
            self.size = int(options.get("size", 500))
            self.share, self.rows = float(options.get("budget_share", 0.2)), int(options.get("budget_rows", 500))

        def write(self, iterator):
            from pyspark import TaskContext

            task = TaskContext.get()
            system, root = place(self.path)
            folder = f"{root}/_sending/{self.run}/{task.partitionId()}-{task.taskAttemptId()}"
            system.create_dir(folder, recursive=True)
            files, items, failed = [], 0, 0
            for number, row in enumerate(iterator):
                items += row["items"]
                try:
                    records = json.loads(row["payload"])
                    if not isinstance(records, list) or len(records) > self.size:
                        raise ValueError("no array of bounded length")
                except (TypeError, ValueError):
                    failed += row["items"]
                    continue
                name = f"{self.run}-{task.partitionId():05d}-{number:05d}.json"
                with system.open_output_stream(f"{folder}/{name}") as out:
                    out.write(json.dumps({"key": row["key"], "chunk": row["chunk"], "payload": row["payload"]}).encode())
                files.append(name)
            return Written(folder, files, items, failed)

        def commit(self, messages):
            system, root = place(self.path)
            done = [one for one in messages if one is not None]
            items, failed = sum(one.items for one in done), sum(one.failed for one in done)
            if failed > self.rows or failed > self.share * items:
                self.abort(messages)
                raise RuntimeError(f"publication given up: {failed} of {items} records failed")
            system.create_dir(f"{root}/outbox", recursive=True)
            system.create_dir(f"{root}/published", recursive=True)
            names = []
            for one in done:
                for name in one.files:
                    system.move(f"{one.folder}/{name}", f"{root}/outbox/{name}")
                    names.append(name)
            listed = {"files": names, "items": items, "failed": failed}
            with system.open_output_stream(f"{root}/published/.{self.run}") as out:
                out.write(json.dumps(listed).encode())
            system.move(f"{root}/published/.{self.run}", f"{root}/published/{self.run}.json")
            system.delete_dir(f"{root}/_sending/{self.run}")

        def abort(self, messages):
            from pyarrow import fs

            system, root = place(self.path)
            if system.get_file_info(f"{root}/_sending/{self.run}").type != fs.FileType.NotFound:
                system.delete_dir(f"{root}/_sending/{self.run}")

    class PayloadSource(DataSource):
        @classmethod
        def name(cls):
            return "payloads"

        def schema(self):
            return "key string, chunk long, items long, payload string"

        def writer(self, schema, overwrite):
            import uuid

            return Writer(dict(self.options), uuid.uuid4().hex)

    return PayloadSource


def publish(payloads: DataFrame, path: str, size: int = CHUNK, budget_share: float = BUDGET_SHARE, budget_rows: int = BUDGET_ROWS) -> None:
    """Send all payloads, or none where more records fail than the budget allows."""
    spark = payloads.sparkSession
    spark.dataSource.register(payload_source())
    rows = payloads.select(F.col("key").cast("string").alias("key"), F.col("chunk").cast("long").alias("chunk"), F.col("items").cast("long").alias("items"), "payload")
    writer = rows.write.format("payloads").mode("append").option("path", path).option("size", size)
    writer.option("budget_share", budget_share).option("budget_rows", budget_rows).save()


def published(spark: SparkSession, path: str) -> DataFrame:
    """(key, chunk, payload) of everything published: the files that some list names, whatever else lies beside them."""
    lists = spark.read.schema("files array<string>").json(f"{path}/published")
    names = lists.select(F.explode("files").alias("_name")).distinct()
    rows = spark.read.schema("key string, chunk long, payload string").json(f"{path}/outbox")
    return rows.withColumn("_name", F.element_at(F.split(F.input_file_name(), "/"), -1)).join(names, "_name", "left_semi").drop("_name")
