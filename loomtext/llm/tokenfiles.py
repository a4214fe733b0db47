"""Token-id files: every document its own zstandard frame, with one dictionary that all of them share.

The dictionary is trained on the serialised ids of a bounded sample of documents. A file holds documents in key order:
magic, a JSON header (dictionary hash, tokenizer, id width, end id), the keys, token counts and frame offsets as plain
arrays, then the frames; one document is read by its offset alone. Files are written in the shared folder under a name
given by range and number, through a rename, so that an attempt repeated after a lost executor leaves the same files.

Defined cases: a null text is empty and has the end id alone; null keys come first; repeated keys keep all their rows
(ordered by a hash of the text); an empty table writes no file.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, shared_dir
from .encoding import encoder

MAGIC = b"LOOMTOK1"
#: Bounds of the dictionary: documents and bytes a document that it is trained on, and its size.
SAMPLE_DOCS, SAMPLE_BYTES, DICT_BYTES = 400, 64_000, 65_536
#: Bytes of frames after which a worker ends a file and begins the next.
FILE_BYTES = 32 << 20
LEVEL = 3


def open_store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def put(uri: str, data: bytes) -> None:
    """Write under another name and rename, so that readers never see a part of a file."""
    store, path = open_store(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, path)


def get(uri: str) -> bytes:
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        return f.read()


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; where the samples are too few to train on, their own bytes are the dictionary."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def join_file(dictionary: bytes, width: int, header: dict, keys, counts, frames) -> bytes:
    head = json.dumps(header | {"dictionary": hashlib.sha256(dictionary).hexdigest(), "width": width, "documents": len(keys)}, sort_keys=True).encode()
    offsets = np.zeros(len(frames) + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    index = [
        np.array([k is None for k in keys], "u1").tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(), np.array(counts, "<u4").tobytes(), offsets.tobytes(),
    ]
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *index, *frames])


class TokenFile:
    """A file's index, and its documents by position. ``read`` gives so many bytes from a place of the file."""

    def __init__(self, read, dictionary: bytes):
        import zstandard

        at = len(MAGIC) + 4
        start = read(0, at)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        (n,) = struct.unpack("<I", start[len(MAGIC) :])
        self.header = json.loads(bytes(read(at, n)))
        if self.header["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError("the file was written with another dictionary")
        at, docs = at + n, self.header["documents"]
        index, self.body = read(at, 21 * docs + 8), at + 21 * docs + 8
        null, keys = np.frombuffer(index, "u1", docs), np.frombuffer(index, "<i8", docs, docs)
        self.counts, self.offsets = np.frombuffer(index, "<u4", docs, 9 * docs), np.frombuffer(index, "<u8", docs + 1, 13 * docs)
        self.keys = [None if z else int(k) for z, k in zip(null, keys, strict=True)]
        self.read, self.width = read, self.header["width"]
        self.expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    @classmethod
    def of_bytes(cls, data: bytes, dictionary: bytes) -> TokenFile:
        view = memoryview(data)
        return cls(lambda at, n: view[at : at + n], dictionary)

    @classmethod
    def stored(cls, uri: str, dictionary: bytes) -> TokenFile:
        """A file in storage, of which the index is read now and a document's frame when it is asked for."""
        store, path = open_store(uri)
        file = store.open_input_file(path)
        return cls(lambda at, n: file.read_at(n, at), dictionary)

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, i: int) -> np.ndarray:
        begin, end = int(self.offsets[i]), int(self.offsets[i + 1])
        return np.frombuffer(self.expand.decompress(self.read(self.body + begin, end - begin), max_output_size=int(self.counts[i]) * self.width), f"<u{self.width}")


MANIFEST = "part int, number int, file string, documents long, tokens long"


def write_tokens(df: DataFrame, tokenizer: str, end_id: int, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``df``'s texts in key order under ``folder``; the manifest has a row for each file."""
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The sample is chosen by hash alone, as every partition sends its own candidates to the driver.
    order = F.xxhash64("key", "text")
    # As many ranges as the input has splits, so that a task stays of one size however large the input is.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    chosen = docs.filter(F.octet_length("text") <= SAMPLE_BYTES).select(order.alias("chosen")).orderBy("chosen").limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(chosen.distinct()), order == F.col("chosen")).select("text", order.alias("chosen")).orderBy("chosen", "text").limit(SAMPLE_DOCS)
    enc = encoder(tokenizer)
    width = 2 if enc.tokenizer.get_vocab_size() <= 65_536 else 4
    ids = enc.encode([r[0] for r in sample.collect()])
    dictionary = train_dictionary([np.frombuffer(i, "<u4").astype(f"<u{width}").tobytes() for i in ids if i])
    put_dictionary(folder, dictionary)
    name = tokenizer.rsplit("/", 1)[-1]

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        part, number, size = TaskContext.get().partitionId(), 0, 0
        enc = encoder(tokenizer)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        keys, counts, frames = [], [], []
        end = np.array([end_id], "<u4").tobytes()

        def flush():
            uri = f"{folder}/tokens-{part:06d}-{number:04d}.ltok"
            put(uri, join_file(dictionary, width, {"tokenizer": name, "end_id": end_id}, keys, counts, frames))
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": uri, "documents": len(keys), "tokens": sum(counts)}], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                for k, raw in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                    a = np.frombuffer(raw + end, "<u4")
                    frame = press.compress(a.astype(f"<u{width}").tobytes())
                    keys.append(k)
                    counts.append(len(a))
                    frames.append(frame)
                    size += len(frame) + 24
                if size > FILE_BYTES:
                    yield flush()
                    keys, counts, frames, size, number = [], [], [], 0, number + 1
        if keys:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])
    # Ranges in key order: files sorted by (part, number) hold the keys in ascending order.
    ordered = docs.repartitionByRange(ranges, F.col("key").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"), "text")
    return materialize(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def put_dictionary(folder: str, dictionary: bytes) -> None:
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    put(f"{folder}/dictionary-{hashlib.sha256(dictionary).hexdigest()[:16]}.zdict", dictionary)


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(key, start, n_tokens, ids): all documents of the files, with the ids of all files before counted in."""
    store, path = open_store(folder)
    from pyarrow import fs

    names = [f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".zdict")]
    with store.open_input_file(names[0]) as f:
        dictionary = f.read()
    # One row for each file, so this running sum is over a small table.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("file", "before")
    files = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("file"))

    def run(batches):
        for batch in batches:
            for uri, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                f = TokenFile.of_bytes(get(uri), dictionary)
                starts = start + np.concatenate([[0], np.cumsum(f.counts.astype(np.int64))])
                for at in range(0, len(f), 512):
                    some = range(at, min(len(f), at + 512))
                    ids = [f.ids(i).astype("<u4").tobytes() for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f.keys[i] for i in some], pa.int64()), pa.array(starts[at : at + len(ids)], pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                        ["key", "start", "n_tokens", "ids"],
                    )

    return files.mapInArrow(run, "key long, start long, n_tokens long, ids binary")


def op3_token_files(spark, sf_dir):
    import public_tokenizers

    folder = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    manifest = write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 1, folder)
    out = read_tokens(spark, manifest, folder)
    return out.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
