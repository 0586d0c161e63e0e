"""Streaming sources: TCP lines, files of a directory, demo traffic, UDP datagrams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


def _shaped(df: DataFrame, source: str) -> DataFrame:
    return df.select(F.lit(source).alias("source_file"), F.col("line"), F.col("arrived")).where(F.trim("line") != "")


def tcp_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Newline-framed lines from a TCP server. Spark's socket source keeps nothing
    for a restart; put a log collector with a durable queue before it in production."""
    df = spark.readStream.format("socket").option("host", host).option("port", port).option("includeTimestamp", True).load()
    return _shaped(df.select(F.col("value").alias("line"), F.col("timestamp").alias("arrived")), f"tcp:{host}:{port}")


def tailed(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Lines of files as they appear in a folder (rotated logs, landed requests)."""
    df = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    return df.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"), F.current_timestamp().alias("arrived")).where(F.trim("line") != "")


def demo_traffic(spark: SparkSession, per_second: int = 10) -> DataFrame:
    """Templated CEF lines at a steady rate."""
    df = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    k = F.col("value")
    line = F.format_string("CEF:0|Demo|Sensor|1.0|%d|Demo event|%d|src=10.0.0.%d dst=203.0.113.%d spt=%d dpt=%d proto=TCP outcome=%s", k, (k % 5 * 2).cast("int"), (k % 250).cast("int"), (k % 40).cast("int"), (40000 + k % 1000).cast("int"), (20 + k % 100).cast("int"), F.when(k % 3 == 0, "deny").otherwise("allow"))
    return _shaped(df.select(line.alias("line"), F.col("timestamp").alias("arrived")), "demo")


class DatagramSource(DataSource):
    """``spark.readStream.format("datagrams").option("port", …)``: one row per
    datagram. The driver holds the socket; a batch's datagrams are kept until it
    commits, so a failed batch is read again, but not over a driver's restart."""

    @classmethod
    def name(cls):
        return "datagrams"

    def schema(self):
        return "line string, sender string"

    def simpleStreamReader(self, schema):
        return DatagramReader(self.options)


class DatagramReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        # Spark makes readers that never read, too: only the first read binds
        self.address = options.get("host", "127.0.0.1"), int(options.get("port", 5514))
        self.socket = None
        self.most = int(options.get("maxPerBatch", 10_000))
        self.held: dict[int, tuple[str, str]] = {}
        self.next = 0

    def bound(self):
        import socket

        if self.socket is None:
            self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
            self.socket.bind(self.address)
            self.socket.setblocking(False)
        return self.socket

    def initialOffset(self):
        return {"n": 0}

    def read(self, start):
        for _ in range(self.most):
            try:
                data, sender = self.bound().recvfrom(65_535)
            except BlockingIOError:
                break
            self.held[self.next] = (data.decode("utf-8", "replace").rstrip("\r\n"), sender[0])
            self.next += 1
        return iter([self.held[k] for k in range(start["n"], self.next) if k in self.held]), {"n": self.next}

    def readBetweenOffsets(self, start, end):
        return iter([self.held[k] for k in range(start["n"], end["n"]) if k in self.held])

    def commit(self, end):
        self.held = {k: v for k, v in self.held.items() if k >= end["n"]}


def udp_lines(spark: SparkSession, port: int, host: str = "127.0.0.1") -> DataFrame:
    spark.dataSource.register(DatagramSource)
    df = spark.readStream.format("datagrams").option("host", host).option("port", port).load()
    return _shaped(df.select("line", F.current_timestamp().alias("arrived")), f"udp:{host}:{port}")
