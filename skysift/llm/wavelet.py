"""Token-ID output: one wavelet matrix a shard.

A file holds the ids of a run of documents, in ascending id order, as bit
planes from the highest bit of its largest id to the lowest; after each plane
the ids are stably parted by that bit. A plane is cut into chunks of 65,536
bits, each compressed by itself, with the count of ones before it, so access,
counting and occurrence lookup take one or two ranks a plane and inflate only
the chunks that they touch; the whole sequence is restored by undoing the
partings.

Layout (little-endian):
    magic 'WM2\\0', u32 levels, u64 n, u64 documents, u64 size of the next part,
    documents x (i64 id, u64 start within the file), compressed;
    for each plane: u64 zeros, then for each chunk u64 ones before it and u64
    its compressed size, then the chunks.

Documents are dealt to ranges of ids by their texts' bytes, and each task
encodes its range and writes its files, so texts are moved once and ids never.
The files are rows of a table, written by Spark to the shared folder.
`read_files`, `count_tokens`, `locate_tokens` and `tokens_at` answer from these
files alone.

Edge cases: null texts are empty and give the end id alone. Rows that repeat an
id each keep their ids; their order among themselves follows their content. A
null id sorts first and is written as the smallest 64-bit integer. A very long
text makes a long file. An empty table gives no files. Only the id and the text
column are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.llm.common import slices, written

_MAGIC, _CHUNK = b"WM2\0", 1 << 16
_NO_ID = -(2**63)


class Plane:
    """The bits of one level: compressed chunks, and the ones before each."""

    def __init__(self, zeros: int, ones: np.ndarray, frames: list[bytes | memoryview], n: int):
        self.zeros, self.ones, self.frames, self.n = zeros, ones, frames, n
        self._chunk = functools.lru_cache(4)(self._inflate)

    @classmethod
    def of(cls, bit: np.ndarray, squeeze: zstandard.ZstdCompressor) -> Plane:
        packed = np.packbits(bit, bitorder="little")
        at = range(0, len(packed), _CHUNK // 8)
        counts = np.bitwise_count(packed)
        ones = np.add.reduceat(counts, list(at), dtype=np.int64) if len(packed) else np.zeros(0, np.int64)
        total = int(ones.sum())
        return cls(len(bit) - total, np.cumsum(ones) - ones, [squeeze.compress(packed[a : a + _CHUNK // 8].tobytes()) for a in at], len(bit))

    def _inflate(self, c: int) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self.frames[c]), np.uint8)

    def rank(self, i: int) -> int:
        """Ones before position i."""
        if i >= self.n:
            return self.n - self.zeros
        c, rest = divmod(i, _CHUNK)
        chunk = self._chunk(c) if rest else None
        ones = int(self.ones[c])
        if rest >= 8:
            ones += int(np.bitwise_count(chunk[: rest >> 3]).sum(dtype=np.int64))
        if rest & 7:
            ones += (int(chunk[rest >> 3]) & ((1 << (rest & 7)) - 1)).bit_count()
        return ones

    def bit(self, i: int) -> int:
        c, rest = divmod(i, _CHUNK)
        return int(self._chunk(c)[rest >> 3]) >> (rest & 7) & 1

    def select(self, k: int, one: bool) -> int:
        """Position of the k-th one, or zero (from 0)."""
        before = self.ones if one else np.arange(len(self.ones)) * _CHUNK - self.ones
        c = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self._chunk(c), bitorder="little") == one
        return c * _CHUNK + int(np.nonzero(bits)[0][k - int(before[c])])

    def bits(self) -> np.ndarray:
        inflate = zstandard.ZstdDecompressor()
        packed = np.frombuffer(b"".join(inflate.decompress(f) for f in self.frames), np.uint8)
        return np.unpackbits(packed, count=self.n, bitorder="little").view(bool)


def _parted(values: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The values without the bit, then those with it; by places, since a mask costs a mispredicted branch for every other value."""
    out, zero = np.empty_like(values), np.flatnonzero(~bit)
    values.take(zero, out=out[: len(zero)], mode="clip")
    values.take(np.flatnonzero(bit), out=out[len(zero) :], mode="clip")
    return out


class WaveletMatrix:
    """A sequence of unsigned integers as succinct bit planes."""

    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @classmethod
    def of(cls, values: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        """With as many planes as the largest value needs, or `levels` of them."""
        levels = max(1, int(values.max(initial=0)).bit_length()) if levels is None else levels
        squeeze = zstandard.ZstdCompressor(level=1)
        planes, now = [], values
        for level in reversed(range(levels)):
            bit = (now & now.dtype.type(1 << level)).astype(bool)
            planes.append(Plane.of(bit, squeeze))
            now = _parted(now, bit)
        return cls(planes, len(values))

    def access(self, i: int) -> int:
        value = 0
        for plane in self.planes:
            bit, ones = plane.bit(i), plane.rank(i)
            i = plane.zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _walk(self, value: int, i: int, j: int) -> tuple[int, int]:
        for k, plane in enumerate(self.planes):
            a, b = plane.rank(i), plane.rank(j)
            i, j = (plane.zeros + a, plane.zeros + b) if value >> (len(self.planes) - 1 - k) & 1 else (i - a, j - b)
        return i, j

    def count(self, value: int, i: int = 0, j: int | None = None) -> int:
        """How often a value stands in positions i to j (exclusive)."""
        if value >> len(self.planes):
            return 0
        a, b = self._walk(value, i, self.n if j is None else j)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of a value; -1 if there are fewer."""
        if not 0 <= k < self.count(value):
            return -1
        at = self._walk(value, 0, 0)[0] + k
        for level in reversed(range(len(self.planes))):
            one = bool(value >> (len(self.planes) - 1 - level) & 1)
            at = self.planes[level].select(at - self.planes[level].zeros if one else at, one)
        return at

    def values(self) -> np.ndarray:
        """The whole sequence: the partings are undone from the last plane to the first."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in reversed(range(len(self.planes))):
            bit, zeros = self.planes[k].bits(), self.planes[k].zeros
            before = np.empty_like(now)
            before[np.flatnonzero(~bit)] = now[:zeros]
            before[np.flatnonzero(bit)] = now[zeros:] | now.dtype.type(1 << (len(self.planes) - 1 - k))
            now = before
        return now


def pack(doc_ids: np.ndarray, starts: np.ndarray, values: np.ndarray) -> bytes:
    m = WaveletMatrix.of(values)
    table = zstandard.ZstdCompressor(level=1).compress(np.stack([doc_ids.astype("<i8"), starts.astype("<i8")], axis=1).tobytes())
    parts = [_MAGIC, struct.pack("<IQQQ", len(m.planes), m.n, len(doc_ids), len(table)), table]
    for p in m.planes:
        sizes = np.array([len(f) for f in p.frames], np.int64)
        parts += [struct.pack("<Q", p.zeros), np.stack([p.ones, sizes], axis=1).astype("<i8").tobytes(), *p.frames]
    return b"".join(parts)


def unpack(content: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """(document ids, starts, matrix) of a file; no plane is inflated."""
    if content[:4] != _MAGIC:
        raise ValueError("not a wavelet matrix file")
    levels, n, docs, size = struct.unpack_from("<IQQQ", content, 4)
    at = 4 + struct.calcsize("<IQQQ")
    table = np.frombuffer(zstandard.ZstdDecompressor().decompress(content[at : at + size]), "<i8", docs * 2).reshape(-1, 2)
    at += size
    planes, chunks, view = [], -(-n // _CHUNK), memoryview(content)
    for _ in range(levels):
        zeros = struct.unpack_from("<Q", content, at)[0]
        index = np.frombuffer(content, "<i8", chunks * 2, at + 8).reshape(-1, 2)
        at += 8 + index.nbytes
        ends = at + np.cumsum(index[:, 1])
        planes.append(Plane(zeros, index[:, 0], [view[e - s : e] for e, s in zip(ends.tolist(), index[:, 1].tolist(), strict=True)], n))
        at = int(ends[-1]) if chunks else at
    return table[:, 0], table[:, 1], WaveletMatrix(planes, n)


#: Punctuation after a letter or digit: the tokenizers in question part there, whatever follows.
_POINT = re.compile(r"[!-/:-@\[-`{-~](?<=[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff].)")
#: White space other than the space and the line break, and our marks.
_OTHER = re.compile("[\0-\x02\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_FIRST, _GLUED, _END = "\0", "\x01", "\x02"


class WordEncoder:
    """Encodes texts by the tokenizers library, a word at a time where its model allows, and ends each with `end_id`.

    A byte-level BPE parts a text before every single space, around a single
    line break and between a letter or digit and punctuation, so the ids of a
    text are those of these parts joined. The ids of parts are kept, up to
    `most` of them; others are encoded again each time. New parts go to the
    library in long strings, set apart by a special token that no text has. A
    text with a white-space run, a special token or a mark goes to the library
    whole, and so do all texts with a tokenizer of another build.
    """

    def __init__(self, path: str, end_id: int, most: int = 900_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.apart = next(((i, t.content) for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word)), None)
        self.by_word = self.apart is not None and not spec.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 65536 and end_id < 65536 else np.dtype("<u4")
        self.most, self.kept = most, {_END: 0}
        self.ends, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, self.width)
        self.ends[1], self.ids[0] = 1, end_id

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, their counts)."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.array(list(itertools.chain.from_iterable(lists)), self.width), counts

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number, mark = self.apart
        ids, _ = self._library([mark.join(parts[a : a + 1000]) + mark for a in range(0, len(parts), 1000)])
        at = np.nonzero(ids == number)[0]
        return np.delete(ids, at), np.diff(at, prepend=-1) - 1

    def _whole(self, text: str) -> bool:
        # Other white space may stand next to a space or a line break and change how the run is parted.
        return "  " in text or " \n" in text or "\n\n" in text or any(s in text for s in self.special) or _OTHER.search(text) is not None

    def _add(self, ids: np.ndarray, counts: np.ndarray, n: int) -> None:
        """Puts entries after the first n."""
        at = int(self.ends[n])
        if n + len(counts) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(len(counts), len(self.ends) // 2), np.int64)])
        if at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(ids), len(self.ids) // 2), self.width)])
        self.ids[at : at + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(counts)] = at + np.cumsum(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, each with its end id; their counts)."""
        marked, whole = [], []
        for t in texts:
            if not self.by_word or self._whole(t):
                marked.append(f"{_GLUED}{_GLUED}{len(whole)}")
                whole.append(t)
            else:
                marked.append(_FIRST + _POINT.sub(rf" {_GLUED}\g<0>", t.replace("\n", " \n")))
        # A word after a line break begins with it, a text's first word and a glued part have marks; others came after a space.
        words = (f" {_END} ".join(marked) + f" {_END}").split(" ") if marked else []
        index = np.fromiter(map(self.kept.get, words, itertools.repeat(-1)), np.int64, len(words))
        miss = np.nonzero(index < 0)[0]
        new, once = {}, {}
        codes = [~once.setdefault(w, len(once)) if w[:1] == _FIRST or w[:2] == _GLUED * 2 else new.setdefault(w, len(new)) for w in map(words.__getitem__, miss.tolist())]
        codes = np.array(codes, np.int64)
        n = len(self.kept)
        index[miss] = np.where(codes < 0, len(new) + ~codes, codes) + n
        if len(miss):
            own = [w for w in once if w[:1] == _FIRST]
            ids, counts = self._parts([w[1:] if w[:1] == _GLUED else w if w[:1] == "\n" else " " + w for w in new] + [w[1:] for w in own]) if new or own else (np.zeros(0, self.width), np.zeros(0, np.int64))
            self._add(ids, counts, n)
            if whole:
                self._add(*self._library(whole), n + len(counts))
            # Whole texts come after all first words in the pool, in `once` they are mixed.
            place = {w: k for k, w in enumerate(own)}
            order = np.array([place[w] if w[:1] == _FIRST else len(own) + int(w[2:]) for w in once], np.int64)
            odd = miss[codes < 0]
            index[odd] = n + len(new) + order[~codes[codes < 0]]
        start = self.ends[index]
        count = self.ends[index + 1] - start
        total = np.cumsum(count)
        flat = self.ids[np.arange(total[-1] if len(total) else 0) - np.repeat(total - count - start, count)]
        keep = min(len(new), max(0, self.most - n))
        self.kept.update(zip(itertools.islice(new, keep), range(n, n + keep), strict=True))
        return flat, np.diff(total[index == 0], prepend=0)


_encoders: dict[tuple, WordEncoder] = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    """The encoder of this worker, kept for its next tasks (a closure would get a copy of the dictionary with each task)."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


_FILE = "first_doc long, shard long, n_tokens long, content binary"


class _Files:
    """Gathers documents until a file has `shard_tokens` ids."""

    def __init__(self, shard_tokens: int):
        self.most, self.shard = shard_tokens, -1
        self._next()

    def _next(self) -> None:
        self.docs, self.starts, self.chunks, self.n, self.shard = [], [], [], 0, self.shard + 1

    def add(self, docs: list, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(counts)
        a = 0
        while a < len(docs):
            before = int(ends[a - 1]) if a else 0
            z = min(len(docs), int(np.searchsorted(ends, before + self.most - self.n)) + 1)
            self.docs.extend(_NO_ID if d is None else d for d in docs[a:z])
            self.starts.append(self.n + ends[a:z] - counts[a:z] - before)
            self.chunks.append(ids[before : ends[z - 1]])
            self.n += int(ends[z - 1]) - before
            a = z
            if self.n >= self.most:
                yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.docs:
            content = pack(np.array(self.docs, np.int64), np.concatenate(self.starts), np.concatenate(self.chunks))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((self.docs[0], pa.int64()), (self.shard, pa.int64()), (self.n, pa.int64()), (content, pa.binary()))], names=["first_doc", "shard", "n_tokens", "content"])
            self._next()


def _in_order(docs: DataFrame, payload: str, size, partition_bytes: int) -> DataFrame:
    """Rows (doc_id, payload) dealt to ranges of about `partition_bytes`, sorted by id, then content."""
    total = docs.agg(F.sum(size)).first()[0] or 0
    order = ["doc_id", F.xxhash64(payload)]
    return docs.repartitionByRange(max(1, -(-total // partition_bytes)), *order).sortWithinPartitions(*order)


def _written(files: DataFrame) -> DataFrame:
    return written(files.withColumn("place", F.spark_partition_id()).select("place", "shard", "first_doc", "n_tokens", "content"), "token-files")


def write_files(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_tokens: int = 1_000_000, partition_bytes: int = 32 << 20) -> DataFrame:
    """The table of files of the documents' ids, each text's followed by `end_id`, in ascending doc_id order.

    Columns: place and shard (together the order of the files), first_doc,
    n_tokens, content. A file takes documents until it holds `shard_tokens` ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, files = _encoder(tokenizer_path, end_id), _Files(shard_tokens)
        for batch in batches:
            for part in slices(batch, 1):
                ids, counts = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                yield from files.add(part.column(0).to_pylist(), ids, counts)
        yield from files.close()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _written(_in_order(texts, "text", F.octet_length("text"), partition_bytes).mapInArrow(run, _FILE))


def write_id_files(encoded: DataFrame, *, shard_tokens: int = 1_000_000, partition_bytes: int = 32 << 20) -> DataFrame:
    """The same table from ids that stand already: `encoded` has doc_id, ids (packed, little-endian) and width (bytes of an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(shard_tokens)
        for batch in batches:
            for doc, ids, width in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                values = np.frombuffer(ids, f"<u{width}")
                yield from files.add([doc], values, np.array([len(values)]))
        yield from files.close()

    slim = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids", "width")
    return _written(_in_order(slim, "ids", F.length("ids"), partition_bytes).mapInArrow(run, _FILE))


def bases(files: DataFrame) -> DataFrame:
    """(place, shard, base): the ids in all files before, as sums within a place, within 1,024 places, and over these."""
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    sizes = files.select("place", "shard", "n_tokens", F.shiftright("place", 10).alias("thousand"))
    places = sizes.groupBy("thousand", "place").agg(F.sum("n_tokens").alias("n"))
    # One row for 1,024 places of 32 MB each.
    thousands = places.groupBy("thousand").agg(F.sum("n").alias("n")).select("thousand", summed("n", before(F.lit(0)).orderBy("thousand")).alias("far"))
    places = places.select("thousand", "place", summed("n", before("thousand").orderBy("place")).alias("near")).join(thousands, "thousand")
    inner = sizes.select("place", "shard", summed("n_tokens", before("place").orderBy("shard")).alias("own"))
    return inner.join(places, "place").select("place", "shard", (F.col("own") + F.col("near") + F.col("far")).cast("long").alias("base"))


def _each_file(files: DataFrame, of_file, schema: str, names: list[str]) -> DataFrame:
    """Rows (place, shard, *names) that of_file(doc ids, starts, matrix) yields as lists of arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, shard, content in zip(*(batch.column(i) for i in range(3)), strict=True):
                for arrays in of_file(*unpack(content.as_py())):
                    n = len(arrays[0])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, place.as_py(), np.int32)), pa.array(np.full(n, shard.as_py(), np.int64)), *arrays], names=["place", "shard", *names])

    return files.select("place", "shard", "content").mapInArrow(run, "place int, shard long, " + schema)


def _doc_array(docs: np.ndarray) -> pa.Array:
    return pa.array(docs, pa.int64(), mask=docs == _NO_ID)


def read_files(files: DataFrame) -> DataFrame:
    """One row a document from the files alone: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""

    def of_file(docs: np.ndarray, starts: np.ndarray, matrix: WaveletMatrix):
        values = matrix.values().astype("<u4", copy=False)
        ends = np.append(starts[1:], matrix.n)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        yield [_doc_array(docs), pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())]

    rows = _each_file(files, of_file, "doc_id long, own long, n_tokens long, ids_crc32 long", ["doc_id", "own", "n_tokens", "ids_crc32"])
    # Only these short rows meet the bases, never the files.
    return rows.join(bases(files), ["place", "shard"]).select("doc_id", (F.col("own") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def count_tokens(files: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """(token, n): how often each of `tokens` stands in all files."""

    def of_file(docs: np.ndarray, starts: np.ndarray, matrix: WaveletMatrix):
        yield [pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())]

    asked = files.sparkSession.createDataFrame([(t,) for t in tokens], "token long").distinct()
    found = _each_file(files, of_file, "token long, n long", ["token", "n"]).groupBy("token").agg(F.sum("n").alias("n"))
    return asked.join(found, "token", "left").select("token", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def locate_tokens(files: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """(token, doc_id, position): every place of `tokens`; position is within the document."""

    def of_file(docs: np.ndarray, starts: np.ndarray, matrix: WaveletMatrix):
        for token in dict.fromkeys(tokens):
            n = matrix.count(token)
            for a in range(0, n, 10_000):
                at = np.array([matrix.select(token, k) for k in range(a, min(n, a + 10_000))])
                doc = np.searchsorted(starts, at, side="right") - 1
                yield [pa.array(np.full(len(at), token)), _doc_array(docs[doc]), pa.array(at - starts[doc])]

    return _each_file(files, of_file, "token long, doc_id long, position long", ["token", "doc_id", "position"]).select("token", "doc_id", "position")


def tokens_at(files: DataFrame, positions: Sequence[int]) -> DataFrame:
    """(position, token) of the stated positions in the sequence of all files; positions beyond it give no row."""
    asked = files.sparkSession.createDataFrame([(p,) for p in dict.fromkeys(positions)], "position long")
    spans = files.select("place", "shard", "n_tokens").join(bases(files), ["place", "shard"])
    # The stated positions are few; each lies in one file.
    meet = spans.join(F.broadcast(asked), (F.col("position") >= F.col("base")) & (F.col("position") < F.col("base") + F.col("n_tokens")))
    wanted = meet.groupBy("place", "shard").agg(F.collect_list(F.struct("position", (F.col("position") - F.col("base")).alias("at"))).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, at in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                matrix = unpack(content.as_py())[2]
                yield pa.RecordBatch.from_arrays([pa.array([x["position"] for x in at], pa.int64()), pa.array([matrix.access(x["at"]) for x in at], pa.int64())], names=["position", "token"])

    return files.join(wanted, ["place", "shard"]).select("content", "at").mapInArrow(run, "position long, token long")
