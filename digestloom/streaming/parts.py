"""Incremental parts: each micro-batch is unique in itself and becomes one part; a batch job merges the parts.

The part's number is the batch's, so a batch that runs again after a failure overwrites its own part. How much a batch
takes (the source's ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``) bounds the part's size.
"""

from __future__ import annotations

import glob
import os
import shlex
import subprocess
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from digestloom.operators.unique import exact_unique
from digestloom.sources.packs import write_packs

#: File name of a part's pack, by number; the algorithm's name goes into the braces.
PART_PACK = "part_{:05d}_{{}}.bin"


class Uploader:
    """Sends part packs away by a command with ``{path}`` in it. A part is deleted only after its command has
    succeeded; one that fails stays and is tried again at the next call."""

    def __init__(self, folder: str, command: str, timeout: float = 300, retries: int = 3, wait: Callable[[float], None] = time.sleep) -> None:
        self.folder, self.command, self.timeout, self.retries, self.wait = folder, shlex.split(command), timeout, retries, wait
        self.sent, self.failed = 0, 0

    def send(self, path: str) -> bool:
        try:
            return not subprocess.run([x.replace("{path}", path) for x in self.command], capture_output=True, timeout=self.timeout).returncode
        except (OSError, subprocess.SubprocessError):
            return False

    def drain(self) -> list[str]:
        """Sends all parts there are; returns those that could not be sent."""
        left = []
        for path in sorted(glob.glob(f"{self.folder}/part_*.bin")):
            if self.send(path):
                os.remove(path)
                self.sent += 1
            else:
                self.failed += 1
                left.append(path)
        return left

    def finish(self) -> list[str]:
        """drain() until nothing is left or ``retries`` rounds have failed."""
        for k in range(self.retries + 1):
            if not (left := self.drain()) or k == self.retries:
                return left
            self.wait(2.0**k)
        return []


def write_parts(stream: DataFrame, folder: str, checkpoint: str, uploaded: Callable[[int, str], None] | None = None):
    """Starts the query; ``stream`` has (algo, digest); parts are Parquet, by number and algorithm. ``uploaded`` is
    called with each part once it is whole, at least once; it should be safe to repeat."""

    def one(batch: DataFrame, number: int) -> None:
        path = f"{folder}/part={number}"
        exact_unique(batch).write.mode("overwrite").partitionBy("algo").parquet(path)
        if uploaded:
            uploaded(number, path)

    return started(stream, checkpoint, one)


def write_part_packs(stream: DataFrame, folder: str, checkpoint: str, uploader: Uploader | None = None, updated_unix: int | None = None):
    """Starts the query; ``stream`` has (algo, digest). Each batch becomes a triple part_00000_md5.bin, ..._sha1.bin,
    ..._sha256.bin of sorted packs, each renamed into place when it is whole."""

    def one(batch: DataFrame, number: int) -> None:
        os.makedirs(folder, exist_ok=True)
        write_packs(exact_unique(batch), folder, updated_unix, PART_PACK.format(number))
        if uploader:
            uploader.drain()

    return started(stream, checkpoint, one)


def started(stream: DataFrame, checkpoint: str, one: Callable[[DataFrame, int], None]):
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact union of all Parquet parts in the folder."""
    return exact_unique(spark.read.schema("digest binary, part long, algo int").parquet(folder))
