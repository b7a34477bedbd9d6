"""Token ids in Arrow files of equal-length sequences.

Each file holds record batches of two fixed-size-list columns: ``ids``
(sequences of SEQUENCE token ids) and ``mask`` (true for ids, false for the
padding that ends a file). Lists of fixed size have no offsets, so a sequence is
found by arithmetic and read as a view of the mapped file. A second Arrow file
beside it, the index, has the documents' ids and places.

Documents are dealt by range of their id; each task encodes its range in order
and streams it into files of its own name. The manifest lists the files of the
tasks that succeeded; what a lost or repeated attempt leaves behind is in no
manifest and is never read.

Defined results: a null text counts as empty (only the end id is written); null
document ids come first; repeated ids are written one after another in order of
their text's hash; very long texts are written whole, over as many sequences as
they need; an empty table gives no file and an empty manifest; other columns are
not read, so their names can't clash; ``read`` needs the type of ids that are not
long.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, width
from presslens.llm.tokens import encoder
from presslens.session import scratch_path

#: ids in a sequence, and sequences in a record batch
SEQUENCE = 2048
BATCH = 128


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with its file system: one without a scheme lies on the cluster's default one, as for Spark itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class TokenFileWriter:
    """Streams ids into one Arrow file; memory holds one batch."""

    def __init__(self, uri: str, dtype: np.dtype, sequence: int = SEQUENCE, batch: int = BATCH):
        self.fs, path = _open(uri)
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.dtype, self.sequence, self.size = dtype, sequence, sequence * batch
        self.schema = pa.schema(
            {"ids": pa.list_(pa.from_numpy_dtype(dtype), sequence), "mask": pa.list_(pa.bool_(), sequence)},
            metadata={"sequences_per_batch": str(batch)},
        )
        self.out = self.fs.open_output_stream(path)
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.pending: list[np.ndarray] = []
        self.held = self.written = 0

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.size:
            flat = np.concatenate(self.pending)
            full = len(flat) - len(flat) % self.size
            for at in range(0, full, self.size):
                self._write(flat[at : at + self.size])
            self.pending, self.held = [flat[full:]], len(flat) - full

    def _write(self, flat: np.ndarray) -> None:
        padded = np.zeros(-(-len(flat) // self.sequence) * self.sequence, dtype=self.dtype)
        padded[: len(flat)] = flat
        mask = np.arange(len(padded)) < len(flat)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (padded, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.written += len(flat)

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.pending))
        self.file.close()
        self.out.close()


class TokenFile:
    """Random access to a token file; local files are mapped and read without a copy."""

    def __init__(self, uri: str):
        self.reader = pa.ipc.open_file(_input(uri))
        self.sequence = self.reader.schema.field("ids").type.list_size
        self.per_batch = int(self.reader.schema.metadata[b"sequences_per_batch"])
        self._at, self._batch = -1, None

    def _load(self, at: int) -> pa.RecordBatch:
        if at != self._at:
            self._at, self._batch = at, self.reader.get_batch(at)
        return self._batch

    def _flat(self, at: int) -> np.ndarray:
        return self._load(at).column(0).values.to_numpy(zero_copy_only=True)

    def __len__(self) -> int:
        last = self.reader.num_record_batches - 1
        return 0 if last < 0 else last * self.per_batch + len(self._load(last))

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``i``: its ids (a view) and its mask."""
        batch, nth = self._load(i // self.per_batch), i % self.per_batch
        n = self.sequence
        return self._flat(i // self.per_batch)[nth * n : (nth + 1) * n], batch.column(1)[nth].values.to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; a view unless they lie in several batches."""
        size, found = self.sequence * self.per_batch, []
        while n > 0:
            at, skip = divmod(start, size)
            found.append(self._flat(at)[skip : skip + n])
            start, n = start + len(found[-1]), n - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found)


def _input(uri: str):
    fs, path = _open(uri)
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)


def write(
    df: DataFrame,
    vocabulary: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    sequence: int = SEQUENCE,
    batch: int = BATCH,
) -> DataFrame:
    """Write the token files and return their manifest: range, tokens, documents (paths), n_docs, n_ids."""
    spark = df.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "tokens"))
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.col("hash")]
    dealt = docs.withColumn("hash", F.xxhash64("text")).repartitionByRange(width(spark), *order).sortWithinPartitions(*order)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, n_docs, start = encoder(vocabulary), None, 0, 0
        at = TaskContext.get().partitionId()
        stem = f"{folder}/part-{at:06d}-{uuid.uuid4().hex}"
        end = enc.pack([end_id])
        for rows in batches:
            if not len(rows):
                continue
            if out is None:
                out = TokenFileWriter(f"{stem}.arrow", enc.dtype, sequence, batch)
                fs, path = _open(f"{stem}.index.arrow")
                index_out = fs.open_output_stream(path)
                schema = pa.schema({"doc_id": rows.column(0).type, "start": pa.int64(), "n_tokens": pa.int64()})
                index = pa.ipc.new_file(index_out, schema)
            sizes = np.empty(len(rows), dtype=np.int64)
            for i, text in enumerate(rows.column(1)):
                ids = np.frombuffer(enc.encode(text.as_py()) + end, dtype=enc.dtype)
                sizes[i] = len(ids)
                out.add(ids)
            starts = start + np.cumsum(sizes) - sizes
            index.write_batch(pa.RecordBatch.from_arrays([rows.column(0), pa.array(starts), pa.array(sizes)], schema=schema))
            start, n_docs = start + int(sizes.sum()), n_docs + len(rows)
        if out is not None:
            out.close()
            index.close()
            index_out.close()
            row = {"range": [at], "tokens": [f"{stem}.arrow"], "documents": [f"{stem}.index.arrow"], "n_docs": [n_docs], "n_ids": [start]}
            yield pa.RecordBatch.from_pydict(row)

    kinds = "range bigint, tokens string, documents string, n_docs bigint, n_ids bigint"
    return materialise(dealt.select("doc_id", "text").mapInArrow(save, kinds), "manifest")


def read(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Documents read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The manifest has one row per file; the sums over it are over files, not documents.
    """
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    files = files.repartition(width(manifest.sparkSession), "tokens").select("tokens", "documents", "before")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for file in rows.to_pylist():
                tokens, index = TokenFile(file["tokens"]), pa.ipc.open_file(_input(file["documents"]))
                for i in range(index.num_record_batches):
                    docs = index.get_batch(i)
                    starts, sizes = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    crcs = [zlib.crc32(tokens.span(s, n).astype("<u4")) for s, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), pa.array(starts + file["before"]), docs.column(2), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return files.mapInArrow(load, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
