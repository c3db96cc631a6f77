"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus's most frequent words, counted by Spark over all texts, are compiled with
their token ids into an automaton that shares suffixes. It is written to flat arrays,
shipped once (LEXICON_WORDS bounds its size), memory-mapped by every Python worker and
walked for a whole batch of words at a time. Words that it does not hold are merged
exactly by the tokenizer's own BPE model.
"""

from __future__ import annotations

import hashlib
import mmap
import re
import struct
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import materialized, sliced, table

#: Bound of the lexicon: a few MB.
LEXICON_WORDS = 1 << 16
#: Words a task counts, or remembers, before it hands them on or forgets them.
FLUSH_WORDS = 300_000
#: Code points of text a task counts, and of words it remembers, at most; so long words don't fill its memory.
FLUSH_CHARS = 1 << 24
#: Code points whose new words are looked up together.
CHUNK_CHARS = 1 << 20

_LATIN = [chr(c) for c in range(0x250)]
#: Of those: white space and what is printed, if lower case leaves it in the table.
_COMMON = "".join(c for c in _LATIN if (c in "\t\n\r" or c.isprintable() or c == "\xa0") and c.lower() in _LATIN)
#: Texts with none of these split as the patterns below say; others go through the tokenizer's own normaliser.
_RARE = re.compile(f"[^{re.escape(_COMMON)}]")
_LETTERS = "".join(c for c in _LATIN if c.isalpha())
_NUMBERS = "".join(c for c in _LATIN if c.isnumeric())
#: The tokenizer's pattern, with its letters and numbers as far as such texts have them.
_WORD = re.compile(rf"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


class WordSplitter:
    """The words of a text, as the tokenizer's normaliser and pre-tokenizer give them."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = added
        self._specials = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self._char = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._byte = {c: b for b, c in self._char.items()}

    def words(self, text: str) -> list[str]:
        if self._specials is not None and "<|" in text:
            found = []
            for i, part in enumerate(self._specials.split(text)):
                found += [part] if i % 2 else self._plain(part)
            return found
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not _RARE.search(text):
            return _WORD.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self._byte[c] for c in piece).decode() for piece, _ in pieces]

    def merge(self, word: str) -> list[int]:
        """Exact merges of one word."""
        if word in self.special:
            return [self.special[word]]
        mapped = word if word.isascii() and word.isprintable() else "".join(self._char[b] for b in word.encode())
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """A minimal acyclic automaton of the words, as flat arrays.

    Words go in sorted; a state that can no longer change is replaced by an equal one if
    there is one. Each arc carries how many words come before those behind it, so the sum
    along a path is the word's number, and the number finds its ids.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def freeze(node):
        key = (node[0], tuple((c, t) for c, t in node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path, last = [[False, []]], ""

    def close(depth):
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1][-1] = (path[-1][1][-1][0], freeze(node))

    words = sorted(entries)
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        for c in word[common:]:
            path[-1][1].append((ord(c), None))
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    root = freeze(path[0])

    below = np.zeros(len(states), np.int64)  # states are numbered after those they lead to
    keys, targets, skips = [], [], []
    for s, (final, arcs) in enumerate(states):
        n = int(final)
        for c, t in arcs:
            keys.append(s << 21 | c)
            targets.append(t)
            skips.append(n)
            n += int(below[t])
        below[s] = n
    order = np.argsort(np.array(keys, np.int64)) if keys else np.zeros(0, np.int64)
    lengths = [len(entries[w]) for w in words]
    arrays = [
        np.array([root], np.int64),
        np.array(keys, np.int64)[order],
        np.array(targets, np.int64)[order],
        np.array(skips, np.int64)[order],
        np.array([f for f, _ in states], np.int64),
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        np.array([i for w in words for i in entries[w]], np.int64),
    ]
    head = np.array([len(a) for a in arrays], np.int64)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, memory-mapped from a file of this machine."""

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as f:  # it has no name, so nothing is left behind
            f.write(compiled)
            f.flush()
            data = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
        ends = np.cumsum(np.concatenate([[7], data[:7]]))
        root, self.key, self.target, self.skip, self.final, self.start, self.ids = (data[a:b] for a, b in zip(ends, ends[1:]))
        self.root = int(root[0])

    def find(self, words: list[str]) -> np.ndarray:
        """Number of each word in the lexicon, -1 if it is not there."""
        length = np.array([len(w) for w in words], np.int64)
        found = np.zeros(len(words), np.int64)
        if not len(self.key):
            return found - 1
        begin = np.cumsum(length) - length
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        state = np.full(len(words), self.root, np.int64)
        live = np.arange(len(words))
        depth = 0
        while len(live):
            live = live[length[live] > depth]
            key = state[live] << 21 | code[begin[live] + depth]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            good = self.key[arc] == key
            found[live[~good]] = -1
            live, arc = live[good], arc[good]
            found[live] += self.skip[arc]
            state[live] = self.target[arc]
            depth += 1
        return np.where((found >= 0) & (self.final[state] == 1), found, -1)


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word, n over all whole texts; tasks hand on sums of up to FLUSH_WORDS words."""

    def count(batches):
        split, held, chars = WordSplitter(path), Counter(), 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in sliced(batches):
            for text in batch.column("text").to_pylist():
                held.update(split.words(text or ""))
                chars += len(text or "")
                if len(held) >= FLUSH_WORDS or chars >= FLUSH_CHARS:
                    yield flush()
                    held.clear()
                    chars = 0
        yield flush()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """The words of `counts` (word, n) above a count that at most `size` words reach.

    Counts are put into classes, 64 for each doubling, and only as many classes of the
    largest counts are fetched as have `size` words or fewer in all.
    """
    classed = materialized(counts.filter("n > 1").select("word", F.floor(F.log2("n") * 64).cast("int").alias("class")))
    left, least = size, None
    for row in classed.groupBy("class").count().orderBy(F.desc("class")).toLocalIterator():  # 64 * 63 rows at most
        left -= row["count"]
        if left < 0:
            break
        least = row["class"]
    if least is None:
        return []
    return sorted(r["word"] for r in classed.filter(F.col("class") >= least).select("word").toLocalIterator())


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON_WORDS) -> bytes:
    """Compile the most frequent words of all texts, `size` at most."""
    split = WordSplitter(path)
    return compile_lexicon({w: split.merge(w) for w in frequent_words(word_counts(docs, path), size)})


class Codec:
    """Encodes texts as the tokenizer does, and decodes ids."""

    def __init__(self, path: str, compiled: bytes):
        self.split = WordSplitter(path)
        self.lexicon = Lexicon(compiled)
        size = self.split.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token = [self.split.tokenizer.id_to_token(i) for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.known_chars = 0

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > FLUSH_WORDS or self.known_chars > FLUSH_CHARS:
            self.known.clear()
            self.known_chars = 0
            new = list(words)
        self.known_chars += sum(map(len, new))
        start, ids = self.lexicon.start.tolist(), self.lexicon.ids.astype("<u4").tobytes()
        for word, n in zip(new, self.lexicon.find(new).tolist()):
            if n >= 0:
                self.known[word] = ids[4 * start[n] : 4 * start[n + 1]]
            else:
                found = self.split.merge(word)
                self.known[word] = struct.pack(f"<{len(found)}I", *found)

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers.

        Words that are new in CHUNK_CHARS of text or a little more are learnt together.
        """
        held, chars = [], 0
        for text in texts:
            held.append(self.split.words(text))
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self._flush(held)
                held, chars = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[list[str]]) -> Iterator[bytes]:
        self.learn(set().union(*held))
        known = self.known
        for words in held:
            yield b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> str:
        return " ".join([self.token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoded(docs: DataFrame, path: str, compiled: bytes) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded, for every row.

    Null text counts as empty and gives no ids. Repeated rows are encoded each.
    """
    return _coded(docs, path, compiled, digests=False)


def _coded(docs: DataFrame, path: str, compiled: bytes, digests: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(compiled)
    kind = docs.schema["doc_id"].dataType.simpleString()
    if digests:
        names, kinds = ["ids_sha256", "decoded_sha256"], [pa.string(), pa.string()]
    else:
        names, kinds = ["ids", "decoded"], [pa.binary(), pa.large_string()]

    def code(batches):
        codec = Codec(path, shared.value)
        for batch in sliced(batches):
            n, first, second = [], [], []
            for ids in codec.encode_all(text or "" for text in batch.column("text").to_pylist()):
                decoded = codec.decode(ids)
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest() if digests else ids)
                second.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])],
                names=["doc_id", "n_tokens", *names],
            )

    first_kind = "string" if digests else "binary"
    return docs.select("doc_id", "text").mapInArrow(code, f"doc_id {kind}, n_tokens long, {names[0]} {first_kind}, {names[1]} string")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op10_lexicon_bpe(spark, sf_dir):
    """Digests of the ids and the decoded text of every whole text; null text is empty."""
    docs = table(spark, sf_dir, "documents")
    path = vocabulary("word_bpe_49k.json")
    return _coded(docs, path, build_lexicon(docs, path), digests=True)
