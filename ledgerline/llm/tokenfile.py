"""Token ids in files of independent zstandard frames with a seek table at the end.

A file holds the documents of one range of ids in ascending order, one frame per document
(its ids as little-endian unsigned 32-bit integers, with a content checksum), then a skippable
frame with the document ids, then the seek table as a skippable frame: per frame its
compressed size, its size and the low 32 bits of the XXH64 of its content; then the number of
frames, a descriptor and a magic number. Any zstandard reader can decompress the file; a
reader that knows the table decompresses only the frames it wants.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, in_slices, scratch, table, utf8, written
from ledgerline.llm.wordids import encoder

# Fixed values of the public seekable format; 0x184D2A50 to 0x184D2A5F mark skippable frames.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

TOKENIZER = "word_bpe_49k.json"
END = 1
LEVEL = 3
# Document id written for a row without one.
NO_ID = -(1 << 63)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class FrameWriter:
    """Appends documents to an open binary file."""

    def __init__(self, out) -> None:
        self.out, self.entries, self.keys = out, [], []
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)

    def add(self, key: int, content: bytes) -> None:
        frame = self.zip.compress(content)
        self.out.write(frame)
        self.entries.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.keys.append(key)

    def close(self) -> None:
        keys = np.array(self.keys, "<i8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(keys)) + keys)
        self.entries.append((len(keys) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        body = b"".join(struct.pack("<III", *e) for e in self.entries)
        body += struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(body)) + body)


class FrameReader:
    """Documents of a file by position, each read and decompressed alone."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        frames, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table_ = np.frombuffer(source.read_at(12 * frames, size - 9 - 12 * frames), "<u4").reshape(-1, 3)
        self.sizes, self.lengths, self.sums = (table_[:, i].astype(np.int64) for i in range(3))
        self.places = np.cumsum(self.sizes) - self.sizes
        self.keys = np.frombuffer(source.read_at(int(self.sizes[-1]) - 8, int(self.places[-1]) + 8), "<i8")
        self.unzip = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.keys)

    def content(self, position: int) -> bytes:
        frame = self.source.read_at(int(self.sizes[position]), int(self.places[position]))
        content = self.unzip.decompress(frame)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[position]:
            raise ValueError(f"frame {position} is damaged")
        return content

    def ids(self, position: int) -> np.ndarray:
        return np.frombuffer(self.content(position), "<u4")


def _uri(path: str) -> str:
    return path if ":/" in path else f"file://{path}"


def open_file(path: str) -> FrameReader:
    filesystem, place = pafs.FileSystem.from_uri(_uri(path))
    return FrameReader(filesystem.open_input_file(place))


def write_files(documents: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Write all documents below ``folder``; one row per file: part, file, docs, tokens.

    Rows are ranged by doc_id (rows without one first, equal ids by a hash of the text), so
    file by file and inside a file they ascend. A file's name is new for every attempt of a
    task, and the returned table names those of the attempts that counted: a task may fail or
    run twice. NULL text is empty text; repeated rows are documents each; texts of any length are
    written whole; extra columns are not read. No documents give no files.
    """
    schema = "part int, file string, docs long, tokens long"
    order = ["doc_id", "_order"]
    rows = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("_order", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    )
    base = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = out = None
        tokens = 0
        part = TaskContext.get().partitionId()
        name = f"{base}/part-{part:05d}-{uuid.uuid4().hex}.ids.zst"
        codes = encoder(tokenizer, end)
        for batch in in_slices(batches):
            if writer is None:
                filesystem, place = pafs.FileSystem.from_uri(name)
                filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
                out = filesystem.open_output_stream(place, compression=None)  # the name would choose one
                writer = FrameWriter(out)
            ids, sizes = codes.encode(utf8(batch))
            ends = np.cumsum(sizes)
            for key, a, b in zip(batch.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                writer.add(NO_ID if key is None else key, ids[a:b].astype("<u4").tobytes())
                tokens += b - a
        if writer is not None:
            writer.close()
            out.close()
            yield arrow(schema, {"part": [part], "file": [name], "docs": [len(writer.keys)], "tokens": [tokens]})

    return written(rows.mapInArrow(run, schema), "token-files")


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start (ids before it in all files), n_tokens, ids_crc32 of every stored document.

    Each file is read by one task, frame by frame; frames are checked against their sums.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                reader = open_file(file)
                for low in range(0, len(reader), 20_000):
                    contents = (reader.content(i) for i in range(low, min(low + 20_000, len(reader))))
                    sizes, sums = zip(*((len(c) // 4, zlib.crc32(c)) for c in contents))
                    ends = start + np.cumsum(sizes)
                    keys = [None if k == NO_ID else k for k in reader.keys[low:low + 20_000].tolist()]
                    yield arrow(schema, {"doc_id": keys, "start": ends - np.array(sizes), "n_tokens": sizes, "ids_crc32": sums})
                    start = int(ends[-1])

    tasks = max(1, files.count())
    return placed.select("file", "start").repartition(tasks, "file").mapInArrow(run, schema)


def documents_of(path: str, wanted: Sequence[int]) -> dict[int, np.ndarray]:
    """Ids of the wanted documents of one file; no other frame is decompressed."""
    reader = open_file(path)
    position = {int(k): i for i, k in enumerate(reader.keys)}
    return {k: reader.ids(position[k]) for k in wanted if k in position}


def op8_tokenfile(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, written to files in order of ids, and read back from them."""
    files = write_files(table(spark, folder, "documents"), scratch(spark, "ids"), tokenizer_path(TOKENIZER))
    return read_files(files)
