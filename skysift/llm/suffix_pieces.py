"""SentencePiece encoding and decoding by suffix-array matching.

The text of a batch is cut where a space mark follows another character, which
no piece spans (checked when the model is read). Of a batch's text the different
words that this worker has not encoded before are concatenated and indexed by a
suffix array, sorted to the length of the longest piece; words encoded before,
`most` at the most, are looked up. Every piece is searched in it by bisection,
all pieces at once, which gives the ranges of its occurrences: the edges
(position, length, piece). Sorted by position, they are relaxed:

* in a BPE model, by the score of the merge: within each word, the best edge
  that spans two neighbouring symbols joins them, the leftmost of equals, until
  no edge spans two;
* in a unigram model, from left to right to the best path.

Characters that no piece has become byte pieces, or the unknown id in a model
without them. Words of up to `LONG` characters are relaxed together as one
matrix; a longer one of a BPE model by a heap.

Edge cases: null and empty texts have no ids. Runs of spaces, line breaks and
the space mark itself are kept as the model's normaliser gives them. Rows that
repeat an id, or have none, each give their own row. Texts go to Python in
parts of bounded bytes, a very long one by itself. Only the id, the text and the
columns asked for are read, so others cannot clash.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.llm.common import slices

MARK = "▁"
LONG = 64
_CUT = re.compile(f"{MARK}*[^{MARK}]*")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift += 7
        at += 1
        if data[at - 1] < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int, int, int | bytes]]:
    """(number, start, end, value) of the fields of a protobuf message."""
    at = 0
    while at < len(data):
        start = at
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, start, at, value


def model_type(data: bytes) -> str:
    """'unigram' or 'bpe', from the trainer's settings in a model file."""
    for number, _, _, value in fields(data):
        if number == 2:
            for inner, _, _, kind in fields(value):
                if inner == 3:
                    return {1: "unigram", 2: "bpe"}[kind]
    return "unigram"


class Pieces:
    """A SentencePiece vocabulary and the words encoded with it so far, `most` at the most."""

    def __init__(self, model: str | bytes, most: int = 400_000):
        import sentencepiece

        if isinstance(model, str):
            with open(model, "rb") as file:
                model = file.read()
        self.kind = model_type(model)
        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        names = [p.id_to_piece(i) for i in range(n)]
        self.names = names
        self.bytes = {}
        plain = []
        for i, name in enumerate(names):
            if p.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                plain.append(i)
        if any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain):
            raise ValueError("a piece spans words")
        self.unknown = p.unk_id()
        chars = sorted({c for i in plain for c in names[i]})
        self.code = np.zeros(0x110000, np.uint16)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.depth = max(len(names[i]) for i in plain)
        self.packs = -(-self.depth // 4)
        self.ids = np.array(plain, np.int32)
        self.lengths = np.array([len(names[i]) for i in plain])
        self.scores = np.full(n + 1, -np.inf, np.float32)
        self.scores[plain] = [p.get_score(i) for i in plain]
        self.unknown_score = np.float32(min(self.scores[plain]) - 10)
        padded = np.zeros((len(plain), self.packs * 4), np.uint16)
        for row, i in enumerate(plain):
            padded[row, : len(names[i])] = self.code[[ord(c) for c in names[i]]]
        self.low = self._pack(padded)
        past = np.arange(self.packs * 4)[None, :] >= self.lengths[:, None]
        self.high = self._pack(np.where(past, 0xFFFF, padded).astype(np.uint16))
        self.width = np.dtype("<u2") if n <= 65536 else np.dtype("<u4")
        self.most, self.kept = most, {}
        self.plain_spaces = p.normalize("a  b \n c ") == f"{MARK}a{MARK}{MARK}b{MARK}\n{MARK}c{MARK}"

    @staticmethod
    def _pack(windows: np.ndarray) -> list[np.ndarray]:
        """Windows of 16-bit codes as 64-bit numbers that sort alike."""
        w = windows.astype(np.uint64)
        return [w[:, k] << np.uint64(48) | w[:, k + 1] << np.uint64(32) | w[:, k + 2] << np.uint64(16) | w[:, k + 3] for k in range(0, w.shape[1], 4)]

    def _edges(self, codes: np.ndarray) -> np.ndarray:
        """table[position, length - 1]: the piece there, else -1."""
        n = len(codes)
        longer = np.concatenate([codes, np.zeros(self.packs * 4, np.uint16)])
        keys = self._pack(np.lib.stride_tricks.sliding_window_view(longer, self.packs * 4)[:n])
        suffixes = np.lexsort(keys[::-1])
        ordered = [k[suffixes] for k in keys]

        def bisect(wanted: list[np.ndarray], below) -> np.ndarray:
            low, high = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), n)
            while (low < high).any():
                mid = (low + high) >> 1
                at = np.minimum(mid, n - 1)
                less = np.zeros(len(low), bool)
                tied = np.ones(len(low), bool)
                for have, want in zip(ordered, wanted, strict=True):
                    x = have[at]
                    less |= tied & (x < want)
                    tied &= x == want
                go = (less | tied & below) & (low < high)
                low, high = np.where(go, mid + 1, low), np.where(go | (low >= high), high, mid)
            return low

        first, last = bisect(self.low, False), bisect(self.high, True)
        count = last - first
        which = np.repeat(np.arange(len(self.ids)), count)
        place = suffixes[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
        table = np.full((n + 1, self.depth), -1, np.int32)
        order = np.argsort(place, kind="stable")
        table[place[order], self.lengths[which][order] - 1] = self.ids[which][order]
        return table

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word (with its space marks), packed."""
        if not words:
            return []
        text = "\0".join(words) + "\0"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[points]
        codes[points == 0] = 0
        table = self._edges(codes)
        lengths = np.array([len(w) for w in words])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        out: list[bytes] = [b""] * len(words)
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            size = int(lengths[order[at]])
            if size > LONG:
                for w in order[at:]:
                    bounds = self._heap(table, int(starts[w]), int(lengths[w])) if self.kind == "bpe" else self._path(table, starts[w : w + 1], lengths[w : w + 1])[0]
                    out[w] = self._ids(table, points, np.asarray(bounds))
                break
            top = next(x for x in (4, 8, 12, 16, 24, 32, LONG) if size <= x)
            to = int(np.searchsorted(lengths[order], top, side="right"))
            part = order[at:to]
            for w, bounds in zip(part, (self._merge if self.kind == "bpe" else self._path)(table, starts[part], lengths[part]), strict=True):
                out[w] = bounds
            at = to
            flat = np.concatenate([out[w] for w in part])
            counts = np.array([len(out[w]) - 1 for w in part])
            inner = np.ones(len(flat), bool)
            inner[np.cumsum(counts + 1) - 1] = False
            begin, end = flat[inner], flat[np.nonzero(inner)[0] + 1]
            ids = table[begin, np.minimum(end - begin, self.depth) - 1]
            packed = ids.astype(self.width).tobytes()
            odd = np.add.reduceat(ids < 0, np.cumsum(counts) - counts) if len(ids) else np.zeros(len(part))
            edge = np.concatenate([[0], np.cumsum(counts)]) * self.width.itemsize
            for k, w in enumerate(part):
                out[w] = self._ids(table, points, out[w]) if odd[k] else packed[edge[k] : edge[k + 1]]
        return out

    def _ids(self, table: np.ndarray, points: np.ndarray, bounds: np.ndarray) -> bytes:
        ids = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            piece = int(table[a, b - a - 1]) if b - a <= self.depth else -1
            if piece >= 0:
                ids.append(piece)
            elif self.bytes:
                ids.extend(self.bytes[x] for x in chr(points[a]).encode("utf-8", "surrogatepass"))
            else:
                ids.append(self.unknown)
        return np.array(ids, dtype=self.width).tobytes()

    def _merge(self, table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Bounds of the symbols of each word after all merges."""
        top = int(lengths.max())
        bounds = np.minimum(np.arange(top + 3)[None, :], lengths[:, None]) + starts[:, None]
        live = np.arange(len(starts))
        while len(live):
            now = bounds[live]
            left, span = now[:, :-2], now[:, 2:] - now[:, :-2]
            real = (now[:, 2:] > now[:, 1:-1]) & (span <= self.depth)
            piece = np.where(real, table[left, np.clip(span, 1, self.depth) - 1], -1)
            score = self.scores[piece]  # the last row is for no piece
            best = score.argmax(1)
            some = score[np.arange(len(live)), best] > -np.inf
            live, best, now = live[some], best[some], now[some]
            column = np.arange(top + 2)[None, :]
            shifted = np.where(column > best[:, None], now[:, 1:], now[:, :-1])
            bounds[live, :-1] = shifted
        ends = starts + lengths
        count = (bounds < ends[:, None]).sum(1)
        return [np.append(b[:c], e) for b, c, e in zip(bounds, count, ends, strict=True)]

    def _heap(self, table: np.ndarray, start: int, length: int) -> list[int]:
        end = start + length
        after = {i: i + 1 for i in range(start, end)}
        before = {i + 1: i for i in range(start, end)}
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            mid = after.get(a)
            if mid is None or mid >= end:
                return
            b = after[mid]
            if b - a <= self.depth and table[a, b - a - 1] >= 0:
                heapq.heappush(heap, (-float(self.scores[table[a, b - a - 1]]), a, b))

        for i in range(start, end):
            offer(i)
        while heap:
            _, a, b = heapq.heappop(heap)
            mid = after.get(a)
            if mid is None or mid >= end or after.get(mid) != b:
                continue
            del after[mid]
            del before[mid]
            after[a], before[b] = b, a
            offer(a)
            if a in before:
                offer(before[a])
        return [*sorted(after), end]

    def _path(self, table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Bounds of the best path of each word."""
        n, top = len(starts), int(lengths.max())
        best = np.full((n, top + 1 + self.depth), -np.inf, np.float32)
        come = np.zeros((n, top + 1 + self.depth), np.int64)
        best[:, 0] = 0
        for at in range(top):
            live = np.nonzero(at < lengths)[0]
            row = table[starts[live] + at]
            for k in range(self.depth):
                piece = row[:, k]
                score = self.scores[piece]
                if k == 0:
                    score = np.where(piece < 0, self.unknown_score, score)
                total = (best[live, at] + score).astype(np.float32)
                better = total > best[live, at + k + 1]
                best[live[better], at + k + 1] = total[better]
                come[live[better], at + k + 1] = at
        out = []
        for w in range(n):
            bounds = [int(lengths[w])]
            while bounds[-1]:
                bounds.append(int(come[w, bounds[-1]]))
            out.append(np.array(bounds[::-1], np.int64) + starts[w])
        return out

    def _words(self, text: str) -> list[str]:
        """The words of a text, each without the space mark that begins it; after '\\0' a word stands as it is."""
        if self.plain_spaces and "  " not in text and MARK not in text and "\0" not in text:
            return text.split(" ") if text else []
        normal = self.processor.normalize(text)
        return [w[1:] if w[0] == MARK and w[1:2] != "\0" else "\0" + w for w in _CUT.findall(normal) if w]

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self._words(t) for t in texts]
        new = [w for w in set().union(*parts) if w not in self.kept]
        fresh = dict(zip(new, self._encode_words([w[1:] if w[:1] == "\0" else MARK + w for w in new]), strict=True))
        if len(self.kept) + len(fresh) > self.most:
            fresh.update({w: self.kept[w] for p in parts for w in p if w in self.kept})
            look = fresh
            for w in new[: max(0, self.most - len(self.kept))]:
                self.kept[w] = fresh[w]
        else:
            self.kept.update(fresh)
            look = self.kept
        return [b"".join(map(look.__getitem__, p)) for p in parts]

    def decode(self, ids: np.ndarray) -> str:
        names = self._surface()
        return b"".join([names[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")[1:]

    def _surface(self) -> list[bytes]:
        if not hasattr(self, "_surfaces"):
            self._surfaces = [name.encode() for name in self.names]
            for value, i in self.bytes.items():
                self._surfaces[i] = bytes([value])
        return self._surfaces


_models: dict[str, Pieces] = {}


def _pieces(path: str) -> Pieces:
    if path not in _models:  # kept for the next task of this worker
        _models[path] = Pieces(path)
    return _models[path]


def encode_pieces(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """(doc_id, ids array of int) and the columns named in `also`."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"), *also)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path)
        for part in (p for batch in batches for p in slices(batch, 1)):
            packed = model.encode([t or "" for t in part.column(1).to_pylist()])
            counts = np.array([len(x) // model.width.itemsize for x in packed], np.int32)
            flat = np.frombuffer(b"".join(packed), model.width).astype(np.int32)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, *part.columns[2:]], names=["doc_id", "ids", *also])

    schema = T.StructType([slim.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), *[slim.schema[c] for c in also]])
    return slim.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids array of int); null ids are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path)
        for batch in batches:
            ids = batch.column(1)
            texts = [model.decode(x.values.to_numpy()) if x.is_valid else "" for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit integers), same (the decoded ids are the text)."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path)
        for part in (p for batch in batches for p in slices(batch, 1)):
            texts = [t or "" for t in part.column(1).to_pylist()]
            ids = [np.frombuffer(x, model.width).astype("<u4") for x in model.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array([model.decode(x) == t for x, t in zip(ids, texts, strict=True)])],
                names=["doc_id", "n_pieces", "ids_crc32", "same"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, same boolean")
