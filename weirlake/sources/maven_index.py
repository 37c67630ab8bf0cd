"""Reader of repository index chunks: gzip, a version byte and time, then records of counted fields."""

from __future__ import annotations

import gzip
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def _modified_utf8(raw: bytes) -> str:
    """Java's modified UTF-8: a two-byte null, and surrogates encoded one by one."""
    return raw.replace(b"\xc0\x80", b"\x00").decode("utf-8", "surrogatepass").encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def index_events(content: bytes) -> Iterator[tuple[int, str, str, int | None]]:
    """(ordinal, ADD or REMOVE, uinfo, modified) of a chunk; other records count but are left out."""
    f = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))

    def exactly(n: int) -> bytes:
        got = f.read(n)
        if len(got) != n:
            raise EOFError("the chunk ends inside a record")
        return got

    if exactly(1) != b"\x01":
        raise ValueError("unknown index version")
    exactly(8)
    ordinal = 0
    while head := f.read(4):
        if len(head) < 4:
            raise EOFError("the chunk ends inside a record")
        fields = {}
        for _ in range(struct.unpack(">i", head)[0]):
            exactly(1)
            key = _modified_utf8(exactly(struct.unpack(">H", exactly(2))[0]))
            raw = exactly(struct.unpack(">i", exactly(4))[0])
            if key in ("u", "del", "m"):
                fields[key] = _modified_utf8(raw)
        modified = int(fields["m"]) if fields.get("m", "").isdigit() else None
        if "u" in fields:
            yield ordinal, "ADD", fields["u"], modified
        elif "del" in fields:
            yield ordinal, "REMOVE", fields["del"], modified
        ordinal += 1


def read_maven_index(spark: SparkSession, path: str) -> DataFrame:
    """(path, ordinal, kind, uinfo, modified) of index chunks, a chunk a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, content in zip(b["path"].to_pylist(), b["content"], strict=True):
                got = list(index_events(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([where] * len(got), pa.string()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string()), pa.array([g[3] for g in got], pa.int64())],
                    ["path", "ordinal", "kind", "uinfo", "modified"],
                )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, ordinal long, kind string, uinfo string, modified long")
