"""Token-id files: one zstandard frame a document, a seek table, checksums.

A file holds, in this order:

- for each document a zstandard frame (with content checksum) of its ids as
  little-endian unsigned 32-bit integers;
- a skippable frame (magic 0x184D2A50) with the documents' ids as little-endian
  signed 64-bit integers and a bitmap byte each for null ids;
- the seek table of the public seekable format: a skippable frame (magic
  0x184D2A5E) of compressed size, content size and the low 32 bits of the
  content's XXH64 for each frame, then the frame count, the flags and the
  closing magic 0x8F92EAB1.

Any zstandard tool can decompress a file whole; a reader that wants a few
documents reads the two tables at the end and then those frames alone.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.common import new_path, table

SKIP_IDS, SKIP_SEEK, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: A writer starts another file once one has this many bytes.
FILE_BYTES = 32 << 20


def _xxh32_of_64(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Builds one file in memory, up to about FILE_BYTES and a document."""

    def __init__(self) -> None:
        import zstandard

        self._pack = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True).compress
        self.body, self.entries, self.ids = bytearray(), [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self._pack(ids)
        self.body += frame
        self.entries.append((len(frame), len(ids), _xxh32_of_64(ids)))
        self.ids.append(doc_id)

    def finish(self) -> bytes:
        n = len(self.entries)
        ids = struct.pack(f"<{n}q", *[i or 0 for i in self.ids]) + bytes(i is None for i in self.ids)
        table = b"".join(struct.pack("<3I", *e) for e in self.entries) + struct.pack("<IBI", n, 0x80, SEEK_END)
        return bytes(self.body) + struct.pack("<2I", SKIP_IDS, len(ids)) + ids + struct.pack("<2I", SKIP_SEEK, len(table)) + table


class Reader:
    """Reads documents of one file; ``read(at, size)`` gives bytes of it, so only wanted parts are fetched."""

    def __init__(self, read, size: int):
        import zstandard

        self._read, self._open = read, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", read(size - 9, 9))
        if magic != SEEK_END or flags != 0x80:
            raise ValueError("no seek table at the file's end")
        at = size - 9 - 12 * n
        raw = np.frombuffer(read(at, 12 * n), dtype="<u4").reshape(n, 3)
        if struct.unpack("<2I", read(at - 8, 8)) != (SKIP_SEEK, 12 * n + 9):
            raise ValueError("damaged seek table")
        self.packed, self.sizes, self.checks = raw[:, 0].astype(np.int64), raw[:, 1].astype(np.int64), raw[:, 2]
        self.starts = np.cumsum(self.packed) - self.packed
        ids = read(at - 8 - 9 * n, 9 * n)
        self.doc_ids = [None if null else i for i, null in zip(struct.unpack(f"<{n}q", ids[: 8 * n]), ids[8 * n :])]

    def ids(self, k: int) -> bytes:
        """The packed ids of the file's k-th document; raises if its checksum fails."""
        data = self._open.decompress(self._read(int(self.starts[k]), int(self.packed[k])), max_output_size=int(self.sizes[k]))
        if _xxh32_of_64(data) != int(self.checks[k]):
            raise ValueError(f"checksum of frame {k} differs")
        return data


def _filesystem(path: str):
    """The store of a path and the path within it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode all documents and write them to files of ``path`` in ascending doc_id order (nulls first).

    ``path`` is in a store that all executors reach. File names sort in document
    order. A task writes under a name of its own and renames at the end, so a
    task that is run again leaves the same files; what dead tasks left under
    their own names is removed when all is written. Rows of equal doc_id stand
    side by side, in an order that their texts decide; a null text counts as empty; no documents give no files.
    """
    store, root = _filesystem(path)
    store.create_dir(root)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from readloom.llm.tokens import encoder

        model, tail = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        store, root = _filesystem(path)
        part, names = TaskContext.get().partitionId(), []

        def close(w: Writer) -> None:
            name = f"{root}/part-{part:06d}-{len(names):06d}.zst"
            own = f"{root}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own, compression=None) as f:
                f.write(w.finish())
            if store.get_file_info(name).type.name == "NotFound":
                store.move(own, name)
            else:  # an earlier run of this task has written the same file
                store.delete_file(own)
            names.append(name)

        w = Writer()
        for pdf in batches:
            for doc, ids in zip(pdf["doc_id"].array, model.ids(pdf["text"].tolist())):
                w.add(None if pd.isna(doc) else int(doc), ids + tail)
                if len(w.body) >= FILE_BYTES:
                    close(w)
                    w = Writer()
        if w.entries:
            close(w)
        yield pd.DataFrame({"n": [len(names)]})

    # The text takes part in the order, so that rows of one doc_id are spread and come alike in every attempt of a task.
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    ordered = hashed.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").drop("hash")
    ordered.mapInPandas(write, "n long").agg(F.sum("n")).collect()
    from pyarrow.fs import FileSelector

    for left in store.get_file_info(FileSelector(root)):
        if left.base_name.startswith(".") and left.base_name.count(".") == 1:
            store.delete_file(left.path)


def _ranges(file, ahead: int):
    """A function that reads (at, size) of an open file, ``ahead`` bytes more at once if next ones are wanted too."""
    have = [0, b""]

    def read(at: int, size: int) -> bytes:
        if at < have[0] or at + size > have[0] + len(have[1]):
            have[:] = at, file.read_at(max(size, ahead), at)
        return have[1][at - have[0] : at - have[0] + size]

    return read


def read_token_files(spark: SparkSession, path: str, only: Iterable[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents of token files: file, at (place in the file), doc_id, n_tokens, ids_crc32 and the packed ids.

    With ``only``, a set of doc_ids, the tables at a file's end are read and the
    frames of those documents alone; otherwise files are read in runs of 4 MB.
    """
    wanted = None if only is None else frozenset(only)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, size in zip(pdf["path"], pdf["length"]):
                store, path = _filesystem(name)
                file = store.open_input_file(path)
                r = Reader(_ranges(file, 4 << 20 if wanted is None else 0), int(size))
                at = [k for k, i in enumerate(r.doc_ids) if wanted is None or i in wanted]
                for j in range(0, len(at), 1000):
                    rows = [(name, k, r.doc_ids[k], ids) for k in at[j : j + 1000] for ids in [r.ids(k)]]
                    out = pd.DataFrame(rows, columns=["file", "at", "doc_id", "ids"])
                    out["doc_id"] = pd.array([x[2] for x in rows], dtype="Int64")
                    out.insert(3, "n_tokens", [len(x[3]) // 4 for x in rows])
                    out.insert(4, "ids_crc32", [zlib.crc32(x[3]) for x in rows])
                    yield out if with_ids else out.drop(columns="ids")
                file.close()

    schema = "file string, at long, doc_id long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(path).select("path", "length")
    return files.mapInPandas(read, schema)


def with_starts(read: DataFrame) -> DataFrame:
    """Add start, the ids of all documents before: within the file, after those of the files before."""
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("_t"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    totals = totals.select(F.col("file").alias("_f"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    out = read.withColumn("_own", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
    return out.join(totals, F.col("file") == F.col("_f")).withColumn("start", (F.col("_own") + F.col("_base")).cast("long")).drop("_own", "_f", "_base")


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    """Write all documents' ids of the word vocabulary, read the files back, and tell what they hold."""
    import public_tokenizers

    path = new_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    from readloom.llm.common import staged

    read = staged(read_token_files(spark, path, with_ids=False), "token_rows")
    return with_starts(read).select("doc_id", "start", "n_tokens", "ids_crc32")
