"""Lexical retrieval packing: BM25 neighbours fill each seed document's window.

Documents are tokenised once and written, with their ids, to the shared folder; how many
documents have each id, and how long they are, is counted over all of them. They are then
range-partitioned by a lexical sort key (min-hashes of their ids, so that documents
with common vocabulary lie together, and doc_id, so that copies can be cut anywhere).
A partition is packed shard by shard, SHARD_TOKENS at a time: the shard's BM25 inverted
index returns, for each seed, its unused neighbours by score, which fill the rest of the
seed's window. Neighbours that fit go in whole; then the best one left is cut, and what
remains of it is the next seed. Windows are full but for the last one of a partition.
"""

from __future__ import annotations

import base64
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import materialized, partitions, sliced, table

WINDOW = 2048
END_ID = 1
#: Tokens of a shard, the unit of an index in memory.
SHARD_TOKENS = 1 << 21
#: Windows that a partition fills at least.
PARTITION_WINDOWS = 64
#: An index holds terms that over one in so many documents have as rows, all others as postings.
COMMON_SHARE = 8
K1, B = 1.2, 0.75

_ODD = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint64)


class ByteBPE:
    """Ids of texts under a byte-level BPE that comes as ranks and as a tokenizers file.

    The ranks give the same ids several times faster. Where their pattern matcher gives
    up (very long runs of white space), the tokenizers file takes the text.
    """

    def __init__(self, ranks_path: str, pattern: str, tokenizer_path: str):
        self._slow = Tokenizer.from_file(tokenizer_path)
        special = {t.content: i for i, t in self._slow.get_added_tokens_decoder().items()}
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self._special = set(special)

    def ids(self, text: str) -> np.ndarray:
        try:
            return self._fast.encode_to_numpy(text, allowed_special=self._special)
        except ValueError:
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


def public_byte_bpe() -> ByteBPE:
    import public_tokenizers as public

    return ByteBPE(str(public.path("byte_bpe_50k.tiktoken")), public.PATTERN, str(public.path("byte_bpe_50k.json")))


def lexical_key(ids: np.ndarray, times: np.ndarray) -> int:
    """Four 16-bit ids, each drawn with a chance that follows its frequency in the text.

    The draws are weighted min-hashes, alike for texts alike. They don't depend on length,
    so long texts lie among short ones and partitions get about as many tokens.
    """
    key = 0
    for odd in _ODD:
        u = ((ids.astype(np.uint64) + np.uint64(1)) * odd % np.uint64(1 << 32) + 0.5) / (1 << 32)
        key = key << 16 | int(ids[np.argmin(-np.log(u) / times)]) & 0xFFFF
    return key - (1 << 64) if key >> 63 else key


def tokenised(docs: DataFrame, encoding=public_byte_bpe) -> DataFrame:
    """doc_id, key, n_ids, ids (little-endian, 16 bits if they suffice, else 32), wide; terms, df.

    Null text is empty; every document ends with END_ID. Each task's last row is of no
    document (n_ids is null): its terms are the ids that documents of the task have, df
    the number of those documents.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "key", "n_ids", "ids", "wide", "terms", "df"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def encode(batches):
        enc, counts = encoding(), np.zeros(1 << 16, np.int64)
        for batch in sliced(batches):
            doc_type, out = batch.schema.field("doc_id").type, []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(enc.ids(text or ""), np.uint32(END_ID))
                terms, times = np.unique(ids, return_counts=True)
                wide = bool(terms[-1] > 0xFFFF)
                if terms[-1] >= len(counts):
                    counts = np.append(counts, np.zeros(int(terms[-1]), np.int64))
                counts[terms] += 1
                out.append((doc, lexical_key(terms, times), len(ids), ids.astype("<u4" if wide else "<u2").tobytes(), wide, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [doc_type, *types])], names)
        terms = np.flatnonzero(counts)
        if len(terms):
            last = (None, None, None, None, None, terms, counts[terms])
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, [doc_type, *types])], names)

    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, key long, n_ids long, ids binary, wide boolean, terms array<long>, df array<long>"
    )


class Statistics(NamedTuple):
    """Of all documents: their number, their mean length, and how many have each id."""

    n: int
    mean: float
    df: np.ndarray


def statistics(written: DataFrame) -> Statistics:
    """What tasks counted, summed by Spark; as many rows as the vocabulary has ids go to the driver."""
    n, tokens = written.agg(F.count("n_ids"), F.sum("n_ids")).first()
    pairs = written.filter("terms is not null").select(F.explode(F.arrays_zip("terms", "df")).alias("e"))
    summed = pairs.groupBy(F.col("e.terms").alias("term")).agg(F.sum("e.df").alias("df")).toPandas()
    df = np.zeros(int(summed["term"].max()) + 1 if n else 0, np.int64)
    df[summed["term"].to_numpy(np.int64)] = summed["df"].to_numpy(np.int64)
    return Statistics(n, (tokens or 0) / max(1, n), df)


class Index:
    """A BM25 inverted index of a shard's documents, with ids as terms and statistics of all documents."""

    def __init__(self, docs: list[np.ndarray], corpus: Statistics):
        n = len(docs)
        length = np.array([len(d) for d in docs], np.int64)
        flat = np.concatenate(docs).astype(np.int64)
        pair, tf = np.unique(np.repeat(np.arange(n, dtype=np.int64), length) << 32 | flat, return_counts=True)
        doc, term = pair >> 32, pair & 0xFFFFFFFF
        vocabulary, term, df = np.unique(term, return_inverse=True, return_counts=True)
        idf = np.log1p((corpus.n - corpus.df[vocabulary] + 0.5) / (corpus.df[vocabulary] + 0.5))
        weight = (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / corpus.mean))).astype(np.float32)
        self.of_doc = np.searchsorted(doc, np.arange(n + 1))
        self.term, self.df, self.n = term, df, n
        by_term = np.argsort(term, kind="stable")
        self.posting_doc, self.posting_weight = doc[by_term], weight[by_term]
        self.of_term = np.concatenate([[0], np.cumsum(df)])
        # terms that over 1 of COMMON_SHARE documents have, as rows of weights: COMMON_SHARE times the postings at most
        self.common = np.cumsum(df * COMMON_SHARE > n) - 1
        self.common[df * COMMON_SHARE <= n] = -1
        row = self.common[term]
        self.dense = np.zeros((row.max(initial=-1) + 1, n), np.float32)
        self.dense[row[row >= 0], doc[row >= 0]] = weight[row >= 0]

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first (ties: in order)."""
        own = slice(self.of_doc[seed], self.of_doc[seed + 1])
        terms = self.term[own]
        terms = terms[self.df[terms] > 1]
        if not len(terms):
            return terms
        common = self.common[terms]
        score = np.zeros(self.n, np.float32)
        if (common >= 0).any():
            asked = np.zeros(len(self.dense), np.float32)
            asked[common[common >= 0]] = 1
            score += asked @ self.dense
        spans = [slice(a, z) for a, z in zip(self.of_term[terms[common < 0]].tolist(), self.of_term[terms[common < 0] + 1].tolist())]
        if spans:
            doc = np.concatenate([self.posting_doc[s] for s in spans])
            score += np.bincount(doc, weights=np.concatenate([self.posting_weight[s] for s in spans]), minlength=self.n)
        score[~unused] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


class Packer:
    """Fills windows shard after shard; the window that is open is carried over."""

    def __init__(self, first_sequence: int, corpus: Statistics, window: int = WINDOW):
        self.corpus, self.window, self.sequence, self.used = corpus, window, first_sequence, 0

    def _put(self, out, doc, ids, start):
        """Put ids from start on into the open window; returns where it stopped."""
        length = min(len(ids) - start, self.window - self.used)
        out.append((doc, start, ids[start : start + length], len(ids), self.sequence, self.used))
        self.used += length
        if self.used == self.window:
            self.sequence, self.used = self.sequence + 1, 0
        return start + length

    def pack(self, docs: list[tuple[object, np.ndarray]]) -> list[tuple]:
        out: list[tuple] = []
        ids = [i for _, i in docs]
        index = Index(ids, self.corpus)
        unused = np.ones(len(docs), bool)
        length = np.array([len(i) for i in ids])
        following, seed, start = 0, None, 0
        while True:
            if seed is None:
                while following < len(docs) and not unused[following]:
                    following += 1
                if following == len(docs):
                    return out
                seed, start = following, 0
                unused[seed] = False
            while start < len(ids[seed]):
                start = self._put(out, docs[seed][0], ids[seed], start)
            rest, seed = (seed, None)
            if not self.used:
                continue
            found = index.neighbours(rest, unused)
            for d in found[length[found] <= self.window - self.used].tolist():
                if length[d] <= self.window - self.used:
                    self._put(out, docs[d][0], ids[d], 0)
                    unused[d] = False
                    if not self.used:
                        break
            if self.used:
                left = found[unused[found]]
                if len(left):  # the best neighbour left is cut, and goes on as the next seed
                    seed, start = int(left[0]), 0
                    unused[seed] = False


def packed(docs: DataFrame, encoding=public_byte_bpe, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    with_ids adds the piece's ids (little-endian unsigned 32-bit). Every id of every row
    is in one piece; repeated rows and null doc_ids are documents of their own. sequence_id
    is the partition's number times 2^33 plus a count. An empty table gives no pieces.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    written = materialized(tokenised(docs, encoding))
    corpus = statistics(written)
    total = round(corpus.n * corpus.mean)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)  # a number for each id of the vocabulary
    # the last window of a partition is padded, so small tables get few partitions
    parts = max(1, min(partitions(docs), total // (PARTITION_WINDOWS * window)))
    order = ["key", "doc_id", F.crc32("ids")]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(batches):
        packer = Packer(TaskContext.get().partitionId() << 33, shared.value, window)
        held, tokens = [], 0

        def rows():
            found = packer.pack(held)
            columns = [
                pa.array([p[0] for p in found], doc_type),
                pa.array([p[1] for p in found], pa.int64()),
                pa.array([len(p[2]) for p in found], pa.int64()),
            ]
            blobs = [p[2].astype("<u4").tobytes() for p in found]
            columns.append(pa.array([zlib.crc32(b) for b in blobs], pa.int64()))
            columns += [pa.array([p[i] for p in found], pa.int64()) for i in (3, 4, 5)]
            if with_ids:
                columns.append(pa.array(blobs, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

        for batch in sliced(batches):
            doc_type = batch.schema.field("doc_id").type
            for doc, blob, wide in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "wide"))):
                held.append((doc, np.frombuffer(blob, "<u4" if wide else "<u2")))
                tokens += len(held[-1][1])
                if tokens >= SHARD_TOKENS:
                    yield rows()
                    held, tokens = [], 0
        if held:
            yield rows()

    return (
        written.filter("n_ids is not null").select("doc_id", "key", "ids", "wide").repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            pack,
            f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids,
        )
    )


def op4_bm25_packing(spark, sf_dir):
    """Pieces of all documents in windows of 2048 ids; null text is empty."""
    return packed(table(spark, sf_dir, "documents"), with_ids=False)
