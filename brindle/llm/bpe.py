"""BPE encoding with a minimal acyclic transducer as lexicon, and decoding.

The corpus's most frequent words (pre-tokens), counted over all texts, are compiled with their ids
into a minimal acyclic automaton: sorted words are added one by one and every finished suffix is
shared with an equal one made before. Each edge carries the number of words that sort before it,
so a walk that sums them ends at the word's own number, which leads to its ids. The automaton is a
file in the shared folder that Spark hands to each executor, whose workers map it into memory; a
new executor fetches it again. A word that the lexicon lacks is merged exactly, by rank. A worker
keeps the ids of words it has met, CACHE rare ones at most.

Only the most frequent WORDS words are compiled (a bound on the lexicon, not on what is encoded).

Defined results: a null text is an empty one, with no ids; a null id stays null; repeated rows
give repeated rows; an empty table gives an empty table; other columns are not read; a text of any
length is encoded whole. Special strings in a text become their id, as the tokenizers library does.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import struct
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

TOKENIZER = "byte_bpe_50k.json"
WORDS = 200_000
CACHE = 600_000
#: A task's distinct words are counted in parts of so many.
COUNTED = 300_000


# The pattern for texts below U+0250, with its classes of letters, numbers and white space spelt out.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_LATIN = re.compile("[\x00-\u024f]*\\Z").match
_LATIN_WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
_ANY_WORDS = regex.compile(public_tokenizers.PATTERN).findall


def words_in(text: str) -> list[str]:
    """The pre-tokens of a text; the standard library's engine takes half the time where it may."""
    return _LATIN_WORDS(text) if _LATIN(text) else _ANY_WORDS(text)


class Model:
    """A byte-level BPE vocabulary: exact merging of one word, and bytes of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        byte_of = _byte_alphabet()
        vocab = said["model"]["vocab"]
        pieces = {i: bytes(byte_of[c] for c in p) for p, i in vocab.items() if all(c in byte_of for c in p)}
        self.single = [0] * 256
        for i, p in pieces.items():
            if len(p) == 1:
                self.single[p[0]] = i
        # Ids are paired into one number; merges are known by rank.
        self.pairs: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(said["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.bytes_of = pieces | {i: t.encode() for t, i in self.special.items()}
        self.words = words_in
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the pair of lowest rank is merged, leftmost first, until none is left."""
        ids = [self.single[b] for b in word]
        if len(ids) > 64:
            return self._merge_long(ids)
        get, none = self.pairs.get, len(self.made)
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at] = new = self.made[best]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get(new << 32 | ids[at + 1], none)
            if at:
                ranks[at - 1] = get(ids[at - 1] << 32 | new, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long words, by a heap over a linked list."""
        n, pairs = len(ids), self.pairs
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[rank], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := pairs.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# --- the lexicon -----------------------------------------------------------------------------


def compiled(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """The automaton of the words with their ids, as one block of bytes."""
    entries = sorted(entries)
    nodes: dict[tuple, int] = {}  # finished states by what they accept: final, edges
    made: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, []]]  # states of the last word: final, finished edges

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in nodes:
            nodes[key] = len(made)
            made.append(key)
        return nodes[key]

    def close(depth: int, word: bytes) -> None:
        while len(path) - 1 > depth:
            path[-2][1].append((word[len(path) - 2], finish(path.pop())))

    last = b""
    for word, _ in entries:
        common_len = len(os.path.commonprefix([last, word]))
        close(common_len, last)
        path.extend([False, []] for _ in word[common_len:])
        path[-1][0] = True
        last = word
    close(0, last)
    root = finish(path[0])
    below = []  # words from each state on; states are finished after all that they lead to
    for final, edges in made:
        below.append(final + sum(below[t] for _, t in edges))
    first, labels, targets, skips = [0], bytearray(), [], []
    for final, edges in made:
        n = int(final)
        for label, t in edges:
            labels.append(label)
            targets.append(t)
            skips.append(n)
            n += below[t]
        first.append(len(labels))
    finals = bytes(f for f, _ in made)
    offsets = np.cumsum([0, *(len(ids) for _, ids in entries)])
    parts = [np.array(first, "<u4").tobytes(), np.array(targets, "<u4").tobytes(), np.array(skips, "<u4").tobytes(), offsets.astype("<u4").tobytes(), np.array([i for _, ids in entries for i in ids], "<u4").tobytes(), bytes(labels), finals]
    return struct.pack("<8Q", root, *map(len, parts)) + b"".join(parts)


class Lexicon:
    """A compiled automaton, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *sizes = struct.unpack_from("<8Q", self.map)
        at, arrays = 64, []
        for n in sizes[:5]:
            arrays.append(np.frombuffer(self.map, "<u4", n // 4, at))
            at += n
        self.first, self.target, self.skip, self.offset, _ = (memoryview(a) for a in arrays)
        self.ids_at = 64 + sum(sizes[:4])
        self.labels_at, self.finals_at = at, at + sizes[5]

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian uint32, or None if it isn't in the lexicon."""
        state, number, first, find, at = self.root, 0, self.first, self.map.find, self.labels_at
        for i in range(len(word)):
            edge = find(word[i : i + 1], at + first[state], at + first[state + 1]) - at
            if edge < 0:
                return None
            number += self.skip[edge]
            state = self.target[edge]
        if not self.map[self.finals_at + state]:
            return None
        return self.map[self.ids_at + 4 * self.offset[number] : self.ids_at + 4 * self.offset[number + 1]]


class Codec:
    """Encodes and decodes whole texts in a worker."""

    def __init__(self, model: Model, lexicon: Lexicon | None):
        self.model, self.lexicon = model, lexicon
        self.frequent: dict[str, bytes] = {}
        self.rare: dict[str, bytes] = {}

    def _ids(self, word: str) -> bytes:
        """For a word in neither dictionary."""
        data = word.encode()
        if self.lexicon and (ids := self.lexicon.get(data)) is not None:
            self.frequent[word] = ids  # as many as the lexicon has, at most
            return ids
        if len(self.rare) >= CACHE:
            self.rare.clear()
        ids = struct.pack(f"<{len(m)}I", *m) if (m := self.model.merge(data)) else b""
        if len(word) < 64:
            self.rare[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian uint32."""
        special, out = self.model.special, []
        frequent, rare, ids = self.frequent.get, self.rare.get, self._ids
        for part in self.model.cut(text) if self.model.cut and any(s in text for s in special) else (text,):
            if part in special:
                out.append(struct.pack("<I", special[part]))
            else:
                out += [frequent(w) or rare(w) or ids(w) for w in self.model.words(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.model.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", "replace")


# --- on Spark --------------------------------------------------------------------------------

_codecs: dict[tuple[str, str], Codec] = {}
_models: dict[str, Model] = {}


def model_at(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def codec_at(path: str, lexicon: str) -> Codec:
    if (path, lexicon) not in _codecs:
        _codecs.clear()
        _codecs[path, lexicon] = Codec(model_at(path), Lexicon(SparkFiles.get(lexicon)))
    return _codecs[path, lexicon]


def word_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """How often each word stands in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = model_at(path).words, Counter()
        out = lambda: pa.RecordBatch.from_pydict({"word": [*counts], "n": [*counts.values()]}, pa.schema([("word", pa.string()), ("n", pa.int64())]))
        for batch in batches:
            for x in batch.column(0):
                if x.is_valid:
                    counts.update(words(x.as_py()))
                    if len(counts) >= COUNTED:
                        yield out()
                        counts.clear()
        yield out()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, path: str, text_col: str, words: int) -> list[str]:
    """The most frequent words, ``words`` at most: those of a count above which there are no more.

    The cut is found from a histogram of counts by sixteenths of a power of two, so that only the
    words themselves reach the driver.
    """
    counts = common.written(word_counts(docs, path, text_col).withColumn("size", F.floor(16 * F.log2("n")).cast("int")), "counts")
    total, cut = 0, None
    for size, n in sorted(((r["size"], r["n"]) for r in counts.groupBy("size").agg(F.count("*").alias("n")).select("size", "n").collect()), reverse=True):
        total += n
        if total > words:
            break
        cut = size
    out = [] if cut is None else [r.word for r in counts.where(F.col("size") >= cut).select("word").collect()]
    common.removed(docs.sparkSession, counts)
    return out


def lexicon_for(docs: DataFrame, path: str, text_col: str = "text", words: int = WORDS) -> str:
    """Compile the most frequent words into a file of the shared folder; its name for SparkFiles."""
    spark, model = docs.sparkSession, model_at(path)
    data = compiled([(w, model.merge(w)) for w in map(str.encode, frequent_words(docs, path, text_col, words))])
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    where = f"{common.shared_path(spark, 'lexicon')}/{name}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(where)
    stream = file.getFileSystem(conf).create(file)
    stream.write(data)
    stream.close()
    spark.sparkContext.addFile(file.getFileSystem(conf).makeQualified(file).toString())
    return name


def recode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, words: int = WORDS) -> DataFrame:
    """A row for each document: its id, ``ids`` (little-endian uint32) and the ``decoded`` text."""
    path = path or public_tokenizers.path(TOKENIZER)
    lexicon = lexicon_for(docs, path, text_col, words)
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batch: pa.RecordBatch):
        codec = codec_at(path, lexicon)
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            ids = [codec.encode(x.as_py() or "") for x in part.column(1)]
            yield {id_col: part.column(0), "ids": ids, "decoded": [codec.decode(i) for i in ids]}

    return common.by_batch(docs.select(id_col, text_col), f"`{id_col}` {kind}, ids binary, decoded string", rows)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = recode(common.table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
