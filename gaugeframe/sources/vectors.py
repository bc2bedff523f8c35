"""Vectors stored as ``.npy`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 32 << 20
WHOLE_BYTES = 32 << 20


def read_npy(spark: SparkSession, path: str, glob: str = "*.npy", chunk_bytes: int = CHUNK_BYTES,
             partitions: int | None = None, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``path, idx, value`` (float32) of every ``.npy`` file under ``path``.

    Files of up to ``whole_bytes`` come through Spark's own file layer, so any store that Spark
    reads, with its credentials, will do. Larger files are read in byte ranges, each its own
    task-sized row, through ``pyarrow.fs``: neither such a file nor its content is ever held by one
    task. n-dimensional arrays are flattened in C order.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    small = files.filter(F.col("length") <= whole_bytes).select("path", "content")
    large = files.filter(F.col("length") > whole_bytes).select("path", "length")
    return _whole_files(small).unionByName(_by_ranges(spark, large, chunk_bytes, partitions))


def _whole_files(files: DataFrame) -> DataFrame:
    def read_whole(batches):
        import io

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for uri, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                values = np.load(io.BytesIO(content.as_buffer()), allow_pickle=False).reshape(-1)
                step = max(1, (4 << 20) // max(1, values.itemsize))
                for lo in range(0, len(values), step):
                    some = values[lo:lo + step].astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(uri, len(some)), pa.array(np.arange(lo, lo + len(some), dtype=np.int64)), pa.array(some)],
                        names=["path", "idx", "value"])

    return files.mapInArrow(read_whole, "path string, idx bigint, value float")


def _by_ranges(spark: SparkSession, files: DataFrame, chunk_bytes: int, partitions: int | None) -> DataFrame:
    if partitions is None:
        # An explicit number: the ranges are tiny rows, which AQE would pack into one task.
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                         4 * spark.sparkContext.defaultParallelism)
    ranges = (files.select("path", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)),
                  F.lit(chunk_bytes).cast("long"))).alias("start"))
              .repartition(partitions, "path", "start"))

    def read_ranges(batches):
        import ast
        import struct

        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        opened = {}

        def open_npy(uri):
            if uri not in opened:
                opened.clear()
                filesystem, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
                handle = filesystem.open_input_file(name)
                magic = handle.read_at(12, 0)
                if magic[:6] != b"\x93NUMPY":
                    raise ValueError(f"not an npy file: {uri}")
                wide = magic[6] > 1
                size = struct.unpack("<I", magic[8:12])[0] if wide else struct.unpack("<H", magic[8:10])[0]
                begin = 12 if wide else 10
                header = ast.literal_eval(handle.read_at(size, begin).decode("latin1"))
                opened[uri] = (handle, np.dtype(header["descr"]), header["shape"],
                               header["fortran_order"], begin + size)
            return opened[uri]

        for batch in batches:
            for uri, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                handle, dtype, shape, fortran, data_at = open_npy(uri)
                total = int(np.prod(shape, dtype=np.int64))
                # items whose first byte falls into [start, start + chunk_bytes)
                first = max(0, -(-(start - data_at) // dtype.itemsize))
                last = min(total, max(0, -(-(start + chunk_bytes - data_at) // dtype.itemsize)))
                step = max(1, (4 << 20) // dtype.itemsize)
                for lo in range(first, last, step):
                    hi = min(last, lo + step)
                    raw = handle.read_at((hi - lo) * dtype.itemsize, data_at + lo * dtype.itemsize)
                    idx = np.arange(lo, hi, dtype=np.int64)
                    if fortran and len(shape) > 1:
                        idx = np.ravel_multi_index(np.unravel_index(idx, shape, order="F"), shape)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(uri, hi - lo), pa.array(idx.astype(np.int64)),
                         pa.array(np.frombuffer(raw, dtype).astype(np.float32))],
                        names=["path", "idx", "value"])

    return ranges.mapInArrow(read_ranges, "path string, idx bigint, value float")
