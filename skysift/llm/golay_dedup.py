"""SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprints: 64 bits, each the majority of that bit over the XXH64 of all
four-word shingles. Two documents are linked where 4 bits or fewer differ.

Finding all links. A fingerprint is cut into segments of 22, 21 and 21 bits,
each read as a word of the binary Golay code (23, 12), which decodes every word
to the one codeword within 3 errors. The codewords that a word and its one-bit
neighbours decode to are its *nearby codewords*: 1 or 6, and two words that
differ in 2 bits or fewer share one, since they have a common neighbour. With
4 errors over three segments, either

* a segment has none, and one of the others has 2 or fewer: keys made of the
  exact segment and each nearby codeword of another; or
* two segments have one each and the third 2 or fewer, so that one of three
  blocks of the third has none: keys of that block, each nearby codeword of one
  segment, and the codeword that the other decodes to.

So every linked pair shares a key of 33 or 31 bits, whatever the data; a
fingerprint has 135 keys at most. Fingerprints that share a key are verified,
and a bucket gives the edges of a spanning forest of its links.

Hot buckets. Equal fingerprints are one row. Where a bucket holds more than
`bucket` different ones, its members are linked through midpoints instead: two
fingerprints that differ in 4 bits or fewer both lie within 2 bits of some word,
and all that lie within 2 bits of the same word are linked. A hot fingerprint
gives its 2,081 nearby words, and words are grouped with map-side reduction, so
the work stays in proportion to the rows where pairs would be their square.

Edge cases: null and empty texts, and texts without words, have fingerprint
zero and link like any other. Fewer than four words: one shingle of them all.
Rows that repeat an id each have the fingerprint of their own text. Rows
without id link like others, but name no component: theirs is the smallest id
reachable, null if there is none. Texts go to Python in parts of bounded bytes,
a very long one by itself. Only the id and the text are read, so other columns
cannot clash; `keep_first` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.llm.common import bytes_of, fresh, slices, written
from skysift.llm.components import components, with_least

SEED, WIDTH = 42, 4
_GENERATOR, _N, _PARITY = 0b101011100011, 23, 11
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_MOST_ERRORS = 4


def _syndrome(word: np.ndarray) -> np.ndarray:
    """The remainder of a 23-bit word by the generator polynomial."""
    word = word.copy()
    for bit in range(_N - 1, _PARITY - 1, -1):
        word = np.where(word >> bit & 1 == 1, word ^ (_GENERATOR << (bit - _PARITY)), word)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high 11 and the low 12 bits, and the error word of each syndrome."""
    one = 1 << np.arange(_N, dtype=np.int64)
    i, j, k = (x.ravel() for x in np.meshgrid(*[np.concatenate([one, [0]])] * 3))
    errors = np.unique(np.where((i != j) | (i == 0), i | j, i) | k)  # all words of weight 3 or less
    table = np.zeros(1 << _PARITY, np.int64)
    table[_syndrome(errors)] = errors
    return _syndrome(np.arange(1 << 11, dtype=np.int64) << 12), _syndrome(np.arange(1 << 12, dtype=np.int64)), table


_HIGH, _LOW, _ERROR = _tables()


def decoded(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the nearest codeword of each 23-bit word."""
    return (words ^ _ERROR[_HIGH[words >> 12] ^ _LOW[words & 4095]]) >> _PARITY


def nearby(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index): what each word and its neighbours within the low `bits` bits decode to, each once."""
    flips = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
    index = np.sort(decoded((words[:, None] ^ flips[None, :]).ravel()).reshape(len(words), -1), axis=1)
    new = np.ones(index.shape, bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    rows = np.nonzero(new)[0]
    return rows, index[new]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints (uint64)."""
    cut = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    own = [decoded(c) for c in cut]
    near = [nearby(c, n) for c, (_, n) in zip(cut, SEGMENTS, strict=True)]
    rows, keys = [], []

    def add(rule: int, row: np.ndarray, key: np.ndarray) -> None:
        rows.append(row)
        keys.append(rule << 36 | key)

    for exact in range(3):
        for other in range(3):
            if other != exact:
                row, code = near[other]
                add(exact * 3 + other, row, cut[exact][row] << 12 | code)
    for third in range(3):
        i, j = (s for s in range(3) if s != third)
        for block in range(3):
            part = cut[third] >> 7 * block & (127 if block < 2 else 255)
            for expand, fixed in ((i, j), (j, i)):
                row, code = near[expand]
                pair = code << 12 | own[fixed][row] if expand == i else own[fixed][row] << 12 | code
                add(9 + third * 3 + block, row, part[row] << 24 | pair)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The 64-bit fingerprints of texts given as UTF-8 bytes end to end and n + 1 offsets."""
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    if not len(data):
        return out
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first = first[:-1]
    begins = ~space & (first | np.concatenate([[True], space[:-1]]))
    last = np.zeros(len(data), bool)
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = ~space & (last | np.concatenate([space[1:], [True]]))
    # Words one space apart: of a run of white space only the first byte stays.
    keep = ~space | np.concatenate([[False], ~space[:-1]])
    place = np.cumsum(keep) - 1
    kept = data[keep]
    kept = np.where((kept >= 65) & (kept <= 90), kept + 32, kept).astype(np.uint8)
    kept[space[keep]] = 32
    at, to = np.nonzero(begins)[0], np.nonzero(ends)[0]
    doc = np.searchsorted(offsets, at, side="right") - 1
    words = np.bincount(doc, minlength=n)
    until = np.cumsum(words)
    number = np.arange(len(at))
    starts = (number + WIDTH <= until[doc]) | (number == until[doc] - words[doc])
    final = np.minimum(number + WIDTH, until[doc])[starts] - 1
    text = kept.tobytes()
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(text[a:b], SEED) for a, b in zip(place[at[starts]].tolist(), (place[to[final]] + 1).tolist(), strict=True)), np.uint64, int(starts.sum()))
    shingles = np.bincount(doc[starts], minlength=n)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    for a in range(0, n, 64):  # bits of few documents at once
        z = min(n, a + 64)
        base = bounds[a]
        bits = np.unpackbits(hashes[base : bounds[z]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for d in range(a, z):
            if shingles[d]:
                ones = bits[bounds[d] - base : bounds[d + 1] - base].sum(0, dtype=np.int64)
                out[d] = np.packbits(ones * 2 > shingles[d], bitorder="little").view(np.uint64)[0]
    return out


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def document_prints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, print): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                prints = fingerprints(*bytes_of(part.column(2)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "print"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id long, text_hash long, print long")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a signed number it counts the bits of its absolute value


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the end."""
    return np.concatenate([[0], np.nonzero(values[1:] != values[:-1])[0] + 1, [len(values)]])


_EDGE, _HOT = 0, 1


def _key_rows(bucket: int):
    """Distinct prints to (key, print, hot). A key that more than `bucket` prints of a batch share gives one row for them, marked; they follow as rows without key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy()
            for a in range(0, len(every), 4000):
                prints = every[a : a + 4000]
                row, key = keys_of(prints.view(np.uint64))
                order = np.lexsort((prints[row], key))
                row, key = row[order], key[order]
                bounds = _runs(key)
                size = np.repeat(np.diff(bounds), np.diff(bounds))
                many = size > bucket
                lead = np.zeros(len(key), bool)
                lead[bounds[:-1]] = True
                hot = np.unique(prints[row[many]])
                stay = ~many | lead
                keys = pa.concat_arrays([pa.array(key[stay]), pa.nulls(len(hot), pa.int64())])
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate([prints[row[stay]], hot])), pa.array(np.concatenate([many[stay], np.ones(len(hot), bool)]))], names=["key", "print", "hot"])

    return run


def _bucket_edges(bucket: int):
    """Rows sorted by key to (a, b, kind): forest edges of each bucket's links, or its members as hot."""

    def bucket_rows(prints: np.ndarray, hot: bool) -> tuple[np.ndarray, np.ndarray]:
        prints = np.unique(prints)
        if hot or len(prints) > bucket:
            return prints, prints
        near = _distance(prints[:, None], prints[None, :]) <= _MOST_ERRORS
        label = np.arange(len(prints))
        while True:
            new = np.where(near, label[None, :], len(prints)).min(1)
            if (new == label).all():
                break
            label = new
        joined = label != np.arange(len(prints))
        return prints[joined], prints[label[joined]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_before, held, hot_before = None, [], False
        for batch in batches:
            key, prints, hot = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(key):
                continue
            bounds = _runs(key)
            a, b, kind = [], [], []

            def close(rows: np.ndarray, is_hot: bool, a=a, b=b, kind=kind) -> None:
                if len(rows) > 1 or is_hot:
                    x, y = bucket_rows(rows, is_hot)
                    a.append(x)
                    b.append(y)
                    kind.append(np.full(len(x), _HOT if is_hot or len(x) and x[0] == y[0] else _EDGE))

            # Pairs at once: most buckets that are not single hold two.
            starts, sizes = bounds[:-1], np.diff(bounds)
            inner = np.ones(len(starts), bool)
            inner[0] = inner[-1] = False
            any_hot = np.logical_or.reduceat(hot, starts)
            two = inner & (sizes == 2) & ~any_hot
            x, y = prints[starts[two]], prints[starts[two] + 1]
            ok = (_distance(x, y) <= _MOST_ERRORS) & (x != y)
            a.append(np.maximum(x, y)[ok])
            b.append(np.minimum(x, y)[ok])
            kind.append(np.full(int(ok.sum()), _EDGE))
            for i in np.nonzero(~inner | (sizes > 2) & inner | any_hot & inner)[0]:
                rows, is_hot = prints[starts[i] : starts[i] + sizes[i]], bool(any_hot[i])
                if i == 0 and key_before is not None and key[0] == key_before:
                    held.append(rows)
                    hot_before |= is_hot
                    if sum(map(len, held)) > 4 * bucket:  # past doubt: hand on, keep one member
                        hot_before = True
                        rows = np.concatenate(held)
                        close(rows, True)
                        held = [rows[:1]]
                elif inner[i]:
                    close(rows, is_hot)
                else:
                    if held:
                        close(np.concatenate(held), hot_before)
                    key_before, held, hot_before = key[starts[i]], [rows], is_hot
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(np.concatenate(kind).astype(np.int32))], names=["a", "b", "kind"])
        if held:
            rows = np.concatenate(held)
            if len(rows) > 1 or hot_before:
                x, y = bucket_rows(rows, hot_before)
                hot_now = hot_before or bool(len(x) and x[0] == y[0])
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(np.full(len(x), _HOT if hot_now else _EDGE, np.int32))], names=["a", "b", "kind"])

    return run


def _ball() -> np.ndarray:
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    return np.concatenate([np.zeros(1, np.uint64), one, one[i] ^ one[j]])


def _midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hot prints to (word, print): each word within 2 bits of a print of the batch, once for each group linked within the batch; and (null, print, of) edges."""
    ball = _ball()
    for batch in batches:
        every = np.unique(batch.column(0).to_numpy())
        for a in range(0, len(every), 1000):
            prints = every[a : a + 1000]
            words = (prints.view(np.uint64)[:, None] ^ ball[None, :]).ravel().view(np.int64)
            member = np.repeat(np.arange(len(prints)), len(ball))
            order = np.argsort(words, kind="stable")
            words, member = words[order], member[order]
            bounds = _runs(words)
            sizes = np.diff(bounds)
            shared = np.repeat(sizes > 1, sizes)
            of_word = np.repeat(np.arange(len(sizes)), sizes)[shared]
            label = np.arange(len(prints))
            while len(of_word):
                first = np.full(len(sizes), len(prints))
                np.minimum.at(first, of_word, label[member[shared]])
                new = label.copy()
                np.minimum.at(new, member[shared], first[of_word])
                if (new == label).all():
                    break
                label = new
            one = prints[label[member[bounds[:-1]]]]
            joined = label != np.arange(len(prints))
            k = int(joined.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(words[bounds[:-1]]), pa.nulls(k, pa.int64())]), pa.array(np.concatenate([one, prints[joined]])), pa.array(np.concatenate([one, prints[label[joined]]]))],
                names=["word", "a", "b"],
            )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, a) sorted by word to edges between neighbours in a run."""
    word_before = print_before = None
    for batch in batches:
        word, prints = (batch.column(i).to_numpy() for i in range(2))
        if not len(word):
            continue
        if word_before is not None:
            word, prints = np.concatenate([[word_before], word]), np.concatenate([[print_before], prints])
        same = (word[1:] == word[:-1]) & (prints[1:] != prints[:-1])
        word_before, print_before = word[-1], prints[-1]
        pairs = np.unique(np.stack([prints[1:][same], prints[:-1][same]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def link_edges(prints: DataFrame, *, bucket: int = 48) -> DataFrame:
    """Edges (a, b) that connect the distinct `prints` (print long) exactly as all links of 4 bits or fewer do."""
    # Few prints a task: each becomes some hundred rows.
    rows = written(prints.mapInArrow(_key_rows(bucket), "key long, print long, hot boolean"), "golay-keys")
    keyed = rows.filter("key is not null").repartition("key").sortWithinPartitions("key", "print")
    found = written(keyed.mapInArrow(_bucket_edges(bucket), "a long, b long, kind int"), "golay-edges")
    hot = rows.filter("key is null").select("print").unionByName(found.filter(f"kind = {_HOT}").select(F.col("a").alias("print"))).distinct()
    hot = written(hot, "golay-hot")
    edges = found.filter(f"kind = {_EDGE}").select("a", "b")
    if not hot.head(1):
        return edges
    balls = written(hot.repartition(max(1, -(-hot.count() // 2000))).mapInArrow(_midpoints, "word long, a long, b long"), "golay-midpoints")
    chained = balls.filter("word is not null").select("word", "a").repartition("word").sortWithinPartitions("word", "a").mapInArrow(_chain, "a long, b long")
    return edges.unionByName(balls.filter("word is null").select("a", "b")).unionByName(chained.distinct())


def document_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row a document: doc_id, text_hash, print, component_id (least doc_id reachable by links)."""
    prints = written(document_prints(docs, id_col=id_col, text_col=text_col), "prints")
    distinct = written(prints.groupBy("print").agg(F.min("doc_id").alias("first_doc")), "distinct-prints")
    roots = written(components(link_edges(distinct.select("print"), **params)), "print-roots")
    linked = with_least(distinct, roots, "print", "first_doc")
    of_print = distinct.join(linked, F.col("print") == F.col("node"), "left").select("print", F.coalesce("component_id", "first_doc").alias("component_id"))
    # Written, so that a print of very many documents is a plain shuffled side, which Spark splits.
    return prints.join(written(of_print, "print-components"), "print", "left")


def near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable by links)."""
    return document_groups(docs, **params).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents without those linked, over any number of steps, to one of a smaller id.

    The few rows that go are taken out by an anti-join, so that texts are not
    dealt by their ids as long as those fit a broadcast. Of rows that repeat
    the id of a group's first document the one whose text has the least hash
    stays, once. Documents without an id cannot be told apart by it and all stay.
    """
    groups = written(document_groups(docs, id_col=id_col, text_col=text_col, **params).filter("doc_id is not null").select("doc_id", "text_hash", "component_id"), "groups")
    rows, ids = groups.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    gone = groups.filter("doc_id != component_id").select("doc_id", "text_hash")
    key, digest = fresh("__id", docs.columns), fresh("__text_hash", docs.columns)
    by_id = F.col(id_col).cast("long") == F.col(key)
    if rows == ids:
        return docs.join(written(gone.select(F.col("doc_id").alias(key)), "dropped-ids"), by_id, "left_anti")
    kept = groups.filter("doc_id = component_id")
    stays = written(kept.groupBy("doc_id").agg(F.min("text_hash").alias("stays")), "first-texts")
    gone = gone.unionByName(kept.join(stays, "doc_id").filter("text_hash != stays").select("doc_id", "text_hash")).distinct()
    gone = written(gone.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest)), "dropped-rows")
    left = docs.join(gone, by_id & (_text_hash(text_col) == F.col(digest)), "left_anti")
    named = left.filter(F.col(id_col).isNotNull())
    # What still repeats an id has the same text.
    return named.dropDuplicates([id_col]).unionByName(left.filter(F.col(id_col).isNull()))
