"""Training-order materialisation: token sequences in fixed-stride shards, at permuted slots.

Documents are tokenised into one stream of ids, in order of doc_id, and cut into sequences
of SEQUENCE ids. A keyed Feistel network with cycle-walking permutes
the sequence numbers; what it gives is the sequence's slot in training order, known without
a shuffle, a table or a look at other sequences, and invertible. Each range of SHARD_RECORDS
slots is one partition, sorted by slot and written as one file of records of equal length.
Slots are written in PASSES, so that only a part of the ids is in a shuffle at a time. A reader that stopped before slot s goes on at file s // SHARD_RECORDS, byte
s % SHARD_RECORDS * stride.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import delete, scratch, shuffles_dropped
from .packing import public_byte_bpe
from .shared import partitions, sliced, table

SEQUENCE = 2048
#: The vocabulary's own end of text, after every document and in the last sequence's padding.
END_ID = 50256
#: Bytes of an id; one that needs more is an error.
ID_BYTES = 2
#: Records of a file, but for the last.
SHARD_RECORDS = 4096
#: Ranges of slots that are shuffled and written one after the other.
PASSES = 2
#: Production key of the permutation.
KEY = 20_240_229
ROUNDS = 6

#: slot, sequence, ids that aren't padding, CRC-32 of those
HEADER = "<QQII"
HEADER_BYTES = struct.calcsize(HEADER)
#: Ends every record, as the writer is Spark's line writer; lengths tell records apart.
RECORD_END = b"\n"


@dataclass(frozen=True)
class Layout:
    sequence: int = SEQUENCE
    id_bytes: int = ID_BYTES
    shard_records: int = SHARD_RECORDS

    @property
    def stride(self) -> int:
        return HEADER_BYTES + self.sequence * self.id_bytes + len(RECORD_END)

    @property
    def dtype(self) -> str:
        return f"<u{self.id_bytes}"


class Permutation:
    """A keyed bijection of 0 to n - 1: Feistel rounds, walked until the value is below n.

    The network permutes the smallest even number of bits that holds n, under 4 n values,
    so a walk takes under four steps on average.
    """

    def __init__(self, n: int, key: int, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        digest = [zlib.crc32(struct.pack("<QI", key, i)) for i in range(2 * rounds)]
        self.keys = [np.uint64(a << 32 | b) for a, b in zip(digest[::2], digest[1::2])]

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ x >> np.uint64(32)) & self.mask

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._mix(right, key)
        return left << self.half | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in reversed(self.keys):
            left, right = right ^ self._mix(left, key), left
        return left << self.half | right

    def _walk(self, x, step) -> np.ndarray:
        x = step(np.asarray(x, np.uint64))
        while len(outside := np.flatnonzero(x >= np.uint64(self.n))):
            x[outside] = step(x[outside])
        return x.astype(np.int64)

    def slot(self, sequence) -> np.ndarray:
        return self._walk(sequence, self._forward)

    def sequence(self, slot) -> np.ndarray:
        return self._walk(slot, self._backward)


def _ordered(docs: DataFrame) -> DataFrame:
    """doc_id and text by doc_id, then text; partitions are ranges, and one doc_id may fill several."""
    order = ["doc_id", F.crc32("text")]
    return docs.select("doc_id", "text").repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order, "text")


def _stream(ordered: DataFrame, encoding, layout: Layout) -> DataFrame:
    """doc_id, n_ids, ids, and where they start in the stream of the task that reads them."""
    kind = ordered.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        enc, part, at = encoding(), TaskContext.get().partitionId(), 0
        for batch in sliced(batches):
            starts, counts, blobs = [], [], []
            for text in batch.column("text").to_pylist():
                ids = np.append(enc.ids(text or ""), np.uint32(END_ID))
                if int(ids.max()) >> 8 * layout.id_bytes:
                    raise OverflowError(f"id {ids.max()} needs over {layout.id_bytes} bytes")
                starts.append(at)
                counts.append(len(ids))
                blobs.append(ids.astype(layout.dtype).tobytes())
                at += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * len(starts), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
                ["doc_id", "part", "start", "n_ids", "ids"],
            )

    return ordered.mapInArrow(encode, f"doc_id {kind}, part int, start long, n_ids long, ids binary")


def _pieces(stream: DataFrame, before: dict[int, int], order: Permutation, layout: Layout, slots: tuple[int, int] | None = None) -> DataFrame:
    """One row per document and sequence that it has ids in: slot, sequence, offset there.

    With `slots`, those from the first to before the second, and their ids.
    """
    kind = stream.schema["doc_id"].dataType.simpleString()
    size = layout.sequence

    def cut(batches):
        for batch in sliced(batches):
            part, start, count = (batch.column(c).to_numpy() for c in ("part", "start", "n_ids"))
            start = start + np.array([before[p] for p in part.tolist()], np.int64)
            first = start // size
            times = (start + count - 1) // size - first + 1
            doc = np.repeat(np.arange(len(count)), times)
            sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(times) - times, times)
            slot = order.slot(sequence)
            if slots:
                here = np.flatnonzero((slot >= slots[0]) & (slot < slots[1]))
                doc, sequence, slot = doc[here], sequence[here], slot[here]
            begin = np.maximum(start[doc], sequence * size)
            length = np.minimum(start[doc] + count[doc], (sequence + 1) * size) - begin
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(doc)),
                "slot": pa.array(slot),
                "sequence_id": pa.array(sequence),
                "offset": pa.array(begin - sequence * size),
            }
            if slots:
                ids, wide = batch.column("ids").to_pylist(), layout.id_bytes
                within = (begin - start[doc]) * wide
                columns["ids"] = pa.array(
                    [ids[d][a : a + n] for d, a, n in zip(doc.tolist(), within.tolist(), (length * wide).tolist())], pa.binary()
                )
            yield pa.RecordBatch.from_pydict(columns)

    return stream.select("doc_id", "part", "start", "n_ids", *["ids"] * bool(slots)).mapInArrow(
        cut, f"doc_id {kind}, slot long, sequence_id long, offset long" + ", ids binary" * bool(slots)
    )


def _records(pieces: DataFrame, layout: Layout, first_shard: int, n_shards: int) -> DataFrame:
    """A record for each slot; partition k holds shard first_shard + k, in order of slots."""
    wide = layout.id_bytes
    padding = np.array([END_ID], layout.dtype).tobytes() if END_ID >> 8 * wide == 0 else bytes(wide)

    def record(slot, sequence, parts):
        ids = b"".join(parts)
        head = struct.pack(HEADER, slot, sequence, len(ids) // wide, zlib.crc32(ids))
        return head + ids + padding * (layout.sequence - len(ids) // wide)

    def join(batches):
        at, parts = None, []
        for batch in sliced(batches):
            out = []
            for slot, sequence, ids in zip(*(batch.column(c).to_pylist() for c in ("slot", "sequence_id", "ids"))):
                if at is not None and at[0] != slot:
                    out.append(record(*at, parts))
                    parts = []
                at = (slot, sequence)
                parts.append(ids)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([record(*at, parts)], pa.binary())], ["record"])

    shard = (F.floor(F.col("slot") / layout.shard_records) - first_shard).cast("int")
    return (
        pieces.drop("doc_id")
        .repartitionById(n_shards, shard)
        .sortWithinPartitions("slot", "offset")
        .mapInArrow(join, "record binary")
    )


def write_training_order(docs: DataFrame, path: str, key: int = KEY, encoding=public_byte_bpe, layout: Layout = Layout(), passes: int = PASSES) -> int:
    """Write `path`/shards (records) and `path`/index (documents of each slot); returns the number of sequences.

    `docs` needs doc_id and text; null text is empty. Every row, repeated or without a
    doc_id, adds its ids and END_ID; an empty table writes no sequence. Sequences follow
    doc_id (null first) and text, slots the key; neither follows how docs is partitioned.
    Files are written by Spark's own writer, so a lost task leaves none behind and the
    target may be any store Spark knows.
    """
    spark = docs.sparkSession
    tokens = scratch(spark, "stream")
    with shuffles_dropped(spark):
        _stream(_ordered(docs), encoding, layout).write.option("compression", "zstd").parquet(tokens)
        try:
            stream = spark.read.parquet(tokens)
            before, total = {}, 0
            for r in stream.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():  # one row per partition
                before[r["part"]] = total
                total += r["n"]
            n = -(-total // layout.sequence)
            if not n:
                return 0
            order = Permutation(n, key)
            n_shards = -(-n // layout.shard_records)
            cuts = sorted({n_shards * i // passes for i in range(passes + 1)})
            for first, end in zip(cuts, cuts[1:]):
                pieces = _pieces(stream, before, order, layout, (first * layout.shard_records, end * layout.shard_records))
                records = _records(pieces, layout, first, end - first).select(F.col("record").cast("string"))
                # a file a partition, whatever the session says, as names carry the shard
                records.write.option("lineSep", RECORD_END.decode()).option("maxRecordsPerFile", 0).text(f"{path}/shards/first={first}")
            index = _pieces(stream, before, order, layout).repartition(partitions(docs), "slot")
            (
                index.groupBy("slot", "sequence_id")
                .agg(F.transform(F.array_sort(F.collect_list(F.struct("offset", "doc_id"))), lambda x: x["doc_id"]).alias("doc_ids"))
                .write.parquet(f"{path}/index")
            )
        finally:
            delete(spark, tokens)
    return n


def read_shards(spark: SparkSession, path: str, layout: Layout = Layout(), first_slot: int = 0, with_ids: bool = True) -> DataFrame:
    """slot, shard, record (its place in the shard), sequence_id, n_tokens, ids_crc32 and ids (binary) from first_slot on.

    Files before first_slot's aren't opened, records before it are skipped by their stride.
    A record whose place, slot, length or checksum don't agree is an error.
    """
    shard = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int") + F.col("first").cast("int")
    files = (
        spark.read.format("binaryFile").load(f"{path}/shards")
        .filter((shard >= first_slot // layout.shard_records) & (F.col("length") > 0))
        .select(shard.alias("shard"), "content")
    )

    def split(batches):
        for batch in batches:
            for number, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = memoryview(content.as_buffer())
                if len(data) % layout.stride:
                    raise ValueError(f"shard {number} has a part of a record")
                base, rows = number * layout.shard_records, []
                for record in range(max(0, first_slot - base), len(data) // layout.stride):
                    at = record * layout.stride
                    slot, sequence, n, crc = struct.unpack_from(HEADER, data, at)
                    at += HEADER_BYTES
                    ids = data[at : at + n * layout.id_bytes]
                    if slot != base + record or zlib.crc32(ids) != crc:
                        raise ValueError(f"shard {number} is damaged at record {record}")
                    rows.append((slot, number, record, sequence, n, crc) + (bytes(ids),) * with_ids)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["slot", "shard", "record", "sequence_id", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    return files.mapInArrow(
        split,
        "slot long, shard int, record long, sequence_id long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids,
    )


def read_record(spark: SparkSession, path: str, slot: int, layout: Layout = Layout()) -> tuple[int, np.ndarray]:
    """sequence_id and ids (without padding) of one slot; opens its file and reads one stride."""
    shard, record = divmod(slot, layout.shard_records)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.globStatus(hadoop.Path(f"{path}/shards/first=*"))]  # one for each pass
    first = max((n for n in (int(x.partition("=")[2]) for x in names) if n <= shard), default=0)
    files = fs.globStatus(hadoop.Path(f"{path}/shards/first={first}/part-{shard - first:05d}-*"))
    if not files:
        raise IndexError(f"no slot {slot}")
    stream = fs.open(files[0].getPath())
    try:
        stream.seek(record * layout.stride)
        data = bytes(stream.readNBytes(layout.stride))
    finally:
        stream.close()
    if len(data) != layout.stride:
        raise IndexError(f"no slot {slot}")
    found, sequence, n, crc = struct.unpack_from(HEADER, data)
    ids = data[HEADER_BYTES : HEADER_BYTES + n * layout.id_bytes]
    if found != slot or zlib.crc32(ids) != crc:
        raise ValueError(f"slot {slot} is damaged")
    return sequence, np.frombuffer(ids, layout.dtype)


def op3_feistel_order(spark, sf_dir):
    """All documents written in training order, and every record as read back, with the ids of its documents."""
    docs = table(spark, sf_dir, "documents")
    path = scratch(spark, "order")
    n = write_training_order(docs, path)
    if not n:
        return spark.createDataFrame([], "slot long, sequence_id long, shard int, record long, n_tokens long, ids_crc32 long, doc_ids array<long>")
    found = read_shards(spark, path, with_ids=False)
    return found.join(spark.read.parquet(f"{path}/index"), ["slot", "sequence_id"])
