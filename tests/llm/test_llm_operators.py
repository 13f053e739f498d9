"""The ten operators against brute force, and their edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import same
from skysift.llm import cap_dedup, components, crf_quality, golay_dedup, license_join, mixing, pii_bootstrap, posting_ann, queries, suffix_pieces, url_cascade, wavelet
from skysift.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = ["", None, "a", "  a  b ", "x" * 5000, "a b c d", "a b c d", "é ü 日本 🎉\nline", "A\tb\nc", "word " * 3000]


def docs_of(spark, texts, extra=True):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, 0, "clash", 1.0) for i, t in enumerate(texts)]
    # Columns that operators use inside, to see that they are not read.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, score double")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    same(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


# 1


def test_classifier_on_held_out_documents(spark):
    r = queries.op1_crf_quality(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert r[0] >= 0.97 and r[1] > 50


def test_chain_by_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    sizes, good, move = np.array([3, 1, 4]), rng.normal(size=8), rng.normal(size=(2, 2))
    marginal, log_z, expected = crf_quality.Chain(sizes).run(good, move, pairs=True)
    at, total = 0, np.zeros((2, 2))
    for size in sizes:
        weights, ones, moves = 0.0, np.zeros(size), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=size):
            w = math.exp(sum(good[at + i] for i in range(size) if y[i]) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
            weights += w
            ones += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                moves[a, b] += w
        assert np.allclose(marginal[at : at + size], ones / weights)
        total += moves / weights
        at += size
    assert np.allclose(expected, total)


def test_classifier_edge_cases(spark):
    docs = docs_of(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = crf_quality.with_score(docs, crf_quality.train(docs, none)).collect()
    assert len(out) == len(ODD) and all(r["__score"] == 1.0 for r in out)
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(ODD))] + [(None, 1), (2, None), (3, 7)], "doc_id long, quality int")
    out = crf_quality.with_score(docs, crf_quality.train(docs, labels)).collect()
    assert all(0 <= r["__score"] <= 1 for r in out)
    assert crf_quality.with_score(docs.limit(0), crf_quality.train(docs, labels)).count() == 0


def test_training_sees_whole_texts(spark, monkeypatch):
    fit, seen = crf_quality.fit, []
    monkeypatch.setattr(crf_quality, "fit", lambda x, sizes, y, prior: seen.append((sizes, y)) or fit(x, sizes, y, prior))
    docs = docs_of(spark, ["\n".join(["a plain line"] * (450 if i % 2 else 820)) for i in range(40)])
    crf_quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))
    sizes, y = seen[0]
    assert set(sizes[y == 1]) == {450} and set(sizes[y == 0]) == {820}



def naive_features(line):
    letter = [sum(c in members.encode() for c in line.encode()) for members in crf_quality.CLASSES] + [sum(c > 127 for c in line.encode())]
    words, n = re.findall(rb"[^ \t]+", line.encode()), len(line.encode())
    letters = letter[0] + letter[1] + letter[-1]
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [x / max(n, 1) for x in letter] + [math.log1p(n) / 8, min(n / max(len(words), 1), 40) / 10, letter[1] / max(letters, 1), repeats / max(len(words), 1)]


def test_scores_by_brute_force():
    import itertools

    texts = ["A good line.\nand and and | 12!\n\nlast é", "", "one", "\n", "x\n" * 6]
    rng = np.random.default_rng(4)
    d = 1 + 3 * crf_quality.N_OWN
    model = crf_quality.Model(rng.normal(size=d) * 0.1, rng.uniform(0.5, 2, d), rng.normal(size=d), rng.normal(size=(2, 2)))
    data = [t.encode() for t in texts]
    got = model.scores(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for text, score in zip(texts, got, strict=True):
        lines = text.split("\n")
        own = [naive_features(line) for line in lines]
        none = [0.0] * crf_quality.N_OWN
        x = np.array([[1.0, *own[i], *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none)] for i in range(len(own))])
        good = ((x - model.mean) / model.scale) @ model.weights
        total, ones = 0.0, np.zeros(len(lines))
        for y in itertools.product((0, 1), repeat=len(lines)):
            w = math.exp(sum(g for g, v in zip(good, y, strict=True) if v) + sum(model.move[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            ones += w * np.array(y)
        weight = np.array([len(line.encode()) + 1 for line in lines])
        assert score == pytest.approx(float((ones / total * weight).sum() / weight.sum()))


def test_classifier_with_odd_rows(spark):
    rows = [(None, "a b", 1, "x"), (1, "good text", 2, "y"), (1, "bad|||", 3, None), (2, "z" * 300_000 + "\n" * 3000, 4, ""), (2, None, 5, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __score int, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(1, 1)], "doc_id long, quality int")
    model = crf_quality.train(docs, labels)
    assert len(crf_quality.with_score(docs, model).collect()) == 5 and crf_quality.with_score(docs, model).columns == ["doc_id", "text", "score", "__score"]
    kept = crf_quality.keep_good(docs, model, -1.0)
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)
    assert [r[0] for r in docs.select(crf_quality.held_out(F.col("doc_id"))).collect()][0] is False


# 2 and 3


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")


def test_nearest_by_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[300:340] = x[300]  # equal vectors: ties go to the smaller id
    x[:5] *= 3
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0])])
    got = {}
    for r in posting_ann.nearest(df, ratio=50.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 900, 20))
    d = x.astype(np.float64)
    for q, found in got.items():
        s = d @ d[q]
        order = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        assert [found[k + 1][0] for k in range(20)] == order
        assert all(abs(found[k + 1][1] - s[i]) < 1e-9 for k, i in enumerate(order))


def test_recall_on_the_table(spark):
    rows = queries.op2_posting_lists(spark, "/root/testdata/sf0.1").collect()
    e = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas()
    ids, x = e.vec_id.to_numpy(), np.array(e.embedding.tolist(), np.float64)
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.nonzero(ids % 20 == 0)[0]:
        s = x @ x[q]
        s[q] = -np.inf
        want = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, total = hits + len(want & got[ids[q]]), total + 20
    assert hits / total >= 0.9


def recall_of(rows, x, k=20):
    got, hits = {}, 0
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(len(x)), -s))[:k].tolist()) & got.get(q, set()))
    return hits / (k * len(range(0, len(x), 20)))


def test_answers_come_from_the_lists(spark):
    rng = np.random.default_rng(22)
    x = rng.normal(size=(6000, 32)).astype(np.float32)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    d = x.astype(np.float64)
    few = {"sample_rows": 512, "lists": 64}
    assert recall_of(posting_ann.nearest(df, **few).collect(), d) >= 0.9
    # Broken placing must show: one list a query and one copy a vector, and so no help from the sample.
    assert recall_of(posting_ann.nearest(df, copies=1, ratio=1.0, **few).collect(), d) <= 0.4


def test_rows_that_repeat_an_id(spark):
    rng = np.random.default_rng(23)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    ids = [i // 2 for i in range(300)]
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)] + [(0, x[0].tolist()), (None, x[3].tolist()), (20, [1.0, 2.0]), (21, [3.0, 1.0])]
    got = posting_ann.nearest(vectors(spark, rows), k=5, ratio=50.0).collect()
    d, want = x.astype(np.float64), []
    for q in range(300):
        if ids[q] % 20 == 0:
            s = d @ d[q]
            order = sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], ids[i]))[:5]
            want += [(ids[q], n + 1, ids[i], round(float(s[i]), 9)) for n, i in enumerate(order)]
    want.append((20, 1, 21, 5.0))
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(want)


def test_few_candidates(spark):
    assert posting_ann.nearest(vectors(spark, [])).count() == 0
    got = posting_ann.nearest(vectors(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 2), (0, 2, 1)]


def test_cap_filters_by_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 32))
    x = np.concatenate([b + rng.normal(size=(12, 32)) * rng.uniform(0.05, 0.45) for b in base] + [np.repeat(base[:1], 30, 0)]).astype(np.float32)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 32), (9002, [1.0])])
    got = {r.vec_id: r for r in cap_dedup.near_vectors(df, group_rows=16).collect()}
    d = x.astype(np.float64)
    n = d / np.linalg.norm(d, axis=1, keepdims=True)
    link = n @ n.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(x)).min(1))
        if (new == label).all():
            break
        label = new
    # Rounding at the threshold itself, and a filter's rare miss, may cost a link in a thousand.
    assert sum(got[i].n_links for i in range(len(x))) >= 0.999 * link.sum() and all(got[i].n_links <= link[i].sum() for i in range(len(x)))
    assert sum(got[i].component_id == label[i] for i in range(len(x))) >= 0.99 * len(x)
    for i in (9000, 9001, 9002):  # the last is alone of its length
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert cap_dedup.near_vectors(vectors(spark, [])).count() == 0


def test_cap_filters_at_the_threshold_in_a_large_table(spark):
    import pyarrow as pa

    rng = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(48_000, 64)))
    y = rng.normal(size=(3000, 64))
    y = unit(y - (x[:3000] * y).sum(1, keepdims=True) * x[:3000])
    c = rng.uniform(0.9001, 0.92, (3000, 1))
    both = np.concatenate([x, c * x[:3000] + np.sqrt(1 - c**2) * y]).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(both)), "embedding": pa.FixedSizeListArray.from_arrays(both.ravel(), 64).cast(pa.list_(pa.float32()))}))
    root = {r.vec_id: r.component_id for r in cap_dedup.near_vectors(df).filter("vec_id < 3000 or vec_id >= 48000").select("vec_id", "component_id").collect()}
    assert sum(root[i] != root[48_000 + i] for i in range(3000)) <= 3


@pytest.mark.parametrize("size", [4, 21, 154])
def test_codes_follow_the_size(size):
    rng = np.random.default_rng(13)
    x, y = rng.normal(size=(2, 5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
    code = cap_dedup.Filters(64, size, 2, 0.9, 0.001)
    (row, a), (other, b) = code.decode(x), code.decode(y)
    far = np.bitwise_count(code.sketch(x) ^ code.sketch(y)).sum(1) > code.far
    shared = set(np.intersect1d(row << 40 | a, other << 40 | b) >> 40)
    assert sum(i not in shared or far[i] for i in range(5000)) <= 5


def test_decoding_by_brute_force():
    rng = np.random.default_rng(14)
    x = rng.normal(size=(300, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = cap_dedup.ProductCode(10, 9, 3)
    row, found = code.decode(x)
    directions = np.array([np.concatenate([a, b]) for a in code.books[0] for b in code.books[1]])
    cosine = x @ directions.T
    for i in range(300):
        want = set(np.nonzero(cosine[i] >= code.threshold)[0].tolist())
        want = want if len(want) >= 3 else set(np.argsort(-cosine[i])[:3].tolist())
        assert set(found[row == i].tolist()) == want


def test_lengths_and_repeated_ids_of_near_vectors(spark):
    a, b = [1.0, 0.0], [1.0] + [0.0] * 7
    df = vectors(spark, [(0, b), (1, b), (2, a), (3, a), (3, [0.99, 0.01]), (None, b), (5, None), (None, None), (7, [0.0, 5.0])])
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cap_dedup.near_vectors(df).collect()), key=str)
    want = [(0, 2, 0, True), (1, 2, 0, False), (2, 2, 2, True), (3, 2, 2, False), (3, 2, 2, False), (None, 2, 0, True), (5, 0, 5, True), (None, 0, None, True), (7, 0, 7, True)]
    assert got == sorted(want, key=str)


# 4


def test_mix_meets_its_targets(spark):
    docs = table(spark, SF, "documents")
    out = mixing.mix_sources(docs, target_entropy=0.9, block_tokens=2000).collect()
    tokens, taken, weight = Counter(), Counter(), {}
    for r in out:
        tokens[r.source] += r["__tokens"]
        taken[r.source] += r["__tokens"] * r["__copies"]
        weight[r.source] = r["__weight"]
    total = sum(tokens.values())
    h = -sum(w * math.log(w) for w in weight.values()) / math.log(len(weight))
    natural = -sum(t / total * math.log(t / total) for t in tokens.values()) / math.log(len(tokens))
    assert abs(sum(weight.values()) - 1) < 1e-9 and h >= min(0.9, natural) - 1e-6
    longest = max(r["__tokens"] for r in out)
    for s, w in weight.items():
        assert w * total - longest - 1 <= taken[s] <= w * total + 1
    for s in tokens:  # whole epochs, and at most one copy more
        copies = {r["__copies"] for r in out if r.source == s}
        assert max(copies) - min(copies) <= 1


@pytest.mark.parametrize(("targets", "even"), [({"target_entropy": 0.95}, False), ({"max_repetition": 1.7}, False), ({"target_entropy": 0.9999, "max_repetition": 4.0}, True), ({"target_entropy": 0.97, "budget_tokens": 90_000}, False)])
def test_mix_by_brute_force(spark, targets, even):
    docs = table(spark, SF, "documents")
    if not even:  # one source holds most
        docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    block_tokens, seed = 700, 7
    got = {r.doc_id: r for r in mixing.mix_sources(docs, block_tokens=block_tokens, **targets).collect()}
    rows = docs.select("doc_id", F.concat(F.lit("="), "source").alias("source"), "text", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("hash")).collect()
    tokens = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    total, count = Counter(), Counter()
    for r in rows:
        total[r.source] += tokens[r.doc_id]
        count[r.source] += 1
    p = np.array([t for t in total.values() if t]) / sum(total.values())

    def bisect(good):
        low, high = 0.0, 1.0
        if good(1.0):
            return 1.0
        for _ in range(30):
            mid = (low + high) / 2
            low, high = (mid, high) if good(mid) else (low, mid)
        return low

    def entropy(a):
        w = p**a / (p**a).sum()
        return -(w * np.log(w)).sum() / math.log(len(w))

    exponents = [0.0]
    if "target_entropy" in targets:
        exponents = [bisect(lambda a: entropy(a) >= targets["target_entropy"])]
        assert 0 < exponents[0] < 1
    if "max_repetition" in targets:
        exponents.append(1 - bisect(lambda a: (p**-a).max() / (p**-a).min() <= targets["max_repetition"]))
    a = max(exponents)
    assert 0 < a < 1
    weight = {s: t**a if t else 0.0 for s, t in total.items()}
    z = sum(weight.values())
    budget = targets.get("budget_tokens", max(t / weight[s] for s, t in total.items() if t) * z if "max_repetition" in targets else sum(total.values()))
    plan = [(s, max(1, math.ceil(max(total[s], count[s]) / block_tokens)), int(weight[s] / z * budget + 1e-6 * total[s]) // total[s]) for s in total if total[s]]
    place = docs.select("doc_id", F.concat(F.lit("="), "source").alias("source"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("hash")).join(spark.createDataFrame(plan, "source string, blocks long, epochs long"), "source")
    place = place.withColumn("block", F.expr("pmod(xxhash64('block', hash), blocks)")).withColumn("perm", F.xxhash64(F.lit(seed), "source", "epochs", "block")).collect()
    for s, _, epochs in plan:
        assert got[next(r.doc_id for r in place if r.source == s)]["__weight"] == pytest.approx(weight[s] / z, rel=1e-6)
        room, stopped = int(weight[s] / z * budget + 1e-6 * total[s]) - epochs * total[s], False
        blocks = {}
        for r in place:
            if r.source == s:
                blocks.setdefault((r.perm % 2**64, r.block), []).append(r)
        for key in sorted(blocks):
            own = sorted(blocks[key], key=lambda r: r.hash)
            whole = sum(tokens[r.doc_id] for r in own) <= room and not stopped
            taken = 0
            for r in own:
                taken += tokens[r.doc_id]
                want = 1 if not tokens[r.doc_id] else epochs + (whole or not stopped and taken <= room)
                assert got[r.doc_id]["__copies"] == want, (s, key)
            if whole:
                room -= taken
            else:
                stopped = True


def test_query_mixes(spark):
    out = queries.op4_temperature_mixing(spark, SF)
    assert out.select("copies").distinct().count() > 1


def test_mix_with_odd_rows(spark):
    rows = [(1, "a b c", "x", 5, "w"), (1, "a b c", "x", 5, "w"), (None, None, None, None, None), (2, "word " * 200_000, "x", 3, "w"), (3, "", "y", 1, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, weight string").withColumnsRenamed({}).withColumn("__weight", F.lit(1)).withColumn("row", F.lit("r")).withColumn("hash", F.lit("h"))
    assert mixing.mix_sources(docs, target_entropy=0.9).count() == 5
    assert mixing.mixed_documents(docs, max_repetition=1.25).columns == docs.columns
    by_column = mixing.mix_sources(docs, tokens_col="copies", target_entropy=0.9).collect()
    assert sorted(r["__tokens"] for r in by_column) == [0, 1, 3, 5, 5]


def test_mix_by_repetition_keeps_every_document(spark):
    docs = table(spark, SF, "documents")
    out = mixing.mix_sources(docs, max_repetition=1.25, block_tokens=2000)
    low, high = out.agg(F.min("__copies"), F.max("__copies")).first()
    assert low >= 1 and high <= 2
    repeated = mixing.mixed_documents(docs, max_repetition=1.25, block_tokens=2000)
    assert repeated.columns == docs.columns and repeated.count() == out.agg(F.sum("__copies")).first()[0]
    t = out.groupBy("source").agg((F.sum(F.col("__tokens") * F.col("__copies")) / F.sum("__tokens")).alias("r")).agg(F.max("r")).first()[0]
    assert t <= 1.25 + 1e-6


def test_mix_edge_cases(spark):
    out = mixing.mix_sources(docs_of(spark, ODD), target_entropy=1.0).collect()
    assert len(out) == len(ODD) and {r.doc_id: r["__copies"] for r in out}[0] == 1
    assert mixing.mix_sources(docs_of(spark, ODD).limit(0), target_entropy=0.9).count() == 0


# 5


def test_wavelet_matrix_operations():
    rng = np.random.default_rng(5)
    v = rng.integers(0, 300, 3000).astype(np.uint16)
    m = wavelet.WaveletMatrix.of(v, 9)
    assert (m.values() == v).all() and all(m.access(i) == v[i] for i in range(0, 3000, 37))
    for value in (0, 7, 299, 400):
        at = np.nonzero(v == value)[0]
        assert m.count(value) == len(at) and m.count(value, 100, 2000) == ((at >= 100) & (at < 2000)).sum()
        assert [m.select(value, k) for k in range(len(at))] == at.tolist() and m.select(value, len(at)) == -1
    empty = wavelet.WaveletMatrix.of(np.zeros(0, np.uint16), 9)
    assert len(empty.values()) == 0 and empty.count(1) == 0
    ids, starts, back = wavelet.unpack(wavelet.pack(np.array([3, 5]), np.array([0, 10]), v))
    assert ids.tolist() == [3, 5] and starts.tolist() == [0, 10] and (back.values() == v).all()


def test_planes_are_parted_by_places_not_by_masks():
    """On random bits a mask takes several times as long; the least of five runs each, so that other load hardly counts."""
    import time

    rng = np.random.default_rng(3)
    values, bit = rng.integers(0, 50_000, 1_000_000).astype(np.uint16), rng.random(1_000_000) < 0.5

    def least(f):
        took = []
        for _ in range(5):
            start = time.thread_time()
            f()
            took.append(time.thread_time() - start)
        return min(took)

    masked = lambda: np.concatenate([values[~bit], values[bit]])
    assert wavelet._parted(values, bit).tolist() == masked().tolist()
    assert least(lambda: wavelet._parted(values, bit)) < least(masked)
    for part in (values, values[:0], values[:1], values.astype(np.uint32) * 3):
        assert wavelet.WaveletMatrix.of(part).values().tolist() == part.tolist()


def test_files_hold_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    texts = [*ODD, "a <|endoftext|> b", "it's  fine\n", "a\n b", "a \nb", "\n", "a\n", " a", "a ", "\0x y"]
    path = queries.tokenizer_path("byte_bpe_50k.json")
    texts += ["it's (a) 'test', isn't it? x!=y... e\u0301. caf\u00e9! 3.14, (b", "\x01.a \x02 b", "end. ", "<|endo ftext|>", "a,b;c 1,2 \u4f60. \u00d7. \u00aa."]
    files = wavelet.write_files(docs_of(spark, texts), path, shard_tokens=500, partition_bytes=10_000)
    assert files.count() > 1
    got = {r.doc_id: r for r in wavelet.read_files(files).collect()}
    library, start = Tokenizer.from_file(path), 0
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert wavelet.read_files(wavelet.write_files(docs_of(spark, texts).limit(0), path)).count() == 0


def test_files_hold_large_ids(spark):
    ids = np.array([3, 65_535, 65_536, 200_001, 4_000_000_000], "<u4")
    encoded = spark.createDataFrame([(0, bytearray(ids.tobytes()), 4)], "doc_id long, ids binary, width int")
    (row,) = wavelet.read_files(wavelet.write_id_files(encoded)).collect()
    assert (row.n_tokens, row.ids_crc32) == (5, zlib.crc32(ids.tobytes()))


def test_files_answer_without_the_ids(spark):
    rng = np.random.default_rng(15)
    ids = {i: rng.integers(0, 90_000, rng.integers(0, 900)) % rng.choice([5, 90_000]) for i in range(40)}
    encoded = spark.createDataFrame([(i, bytearray(v.astype("<u4").tobytes()), 4) for i, v in ids.items()], "doc_id long, ids binary, width int")
    files = wavelet.write_id_files(encoded, shard_tokens=1000, partition_bytes=20_000)
    assert files.select("place").distinct().count() > 2
    every = np.concatenate([ids[i] for i in range(40)])
    asked = [0, 3, int(every.max()), 89_999, 10**7]
    assert {r.token: r.n for r in wavelet.count_tokens(files, asked).collect()} == {t: int((every == t).sum()) for t in asked}
    found = sorted((r.token, r.doc_id, r.position) for r in wavelet.locate_tokens(files, asked).collect())
    assert found == sorted((t, i, p) for t in asked for i, v in ids.items() for p in np.nonzero(v == t)[0].tolist())
    at = [0, 1, len(every) // 2, len(every) - 1, len(every)]
    assert {r.position: r.token for r in wavelet.tokens_at(files, at).collect()} == {p: int(every[p]) for p in at[:-1]}


def test_large_matrix_by_chunks():
    v = np.random.default_rng(16).integers(0, 3, 200_000).astype(np.uint16)
    m = wavelet.WaveletMatrix.of(v)
    assert len(m.planes) == 2 and (m.values() == v).all()
    for value in range(3):
        at = np.nonzero(v == value)[0]
        assert [m.select(value, k) for k in (0, 30_000, len(at) - 1)] == [at[0], at[30_000], at[-1]]
        assert m.count(value, 65_536, 131_072) == (v[65_536:131_072] == value).sum()


def test_files_of_odd_rows(spark):
    rows = [(None, "b"), (None, "a"), (4, "x"), (4, "x"), (4, "y z"), (-9, None), (5, "long word. " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("i"), "place": F.lit(1), "content": F.lit("c")})
    files = wavelet.write_files(docs, queries.tokenizer_path("byte_bpe_50k.json"))
    got = wavelet.read_files(files).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -9, 4, 4, 4, 5] and [r.n_tokens for r in got[:3]] == [2, 2, 1]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist() and got[-1].n_tokens > 60_000


def test_settings_of_the_session_stay(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    queries.op5_wavelet_matrix(spark, SF).count()
    queries.op9_golay_simhash(spark, SF).count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


# 6


def test_pieces_of_odd_rows(spark):
    rows = [(None, "b c"), (7, "x"), (7, "x"), (7, None), (8, "long " * 100_000 + "y" * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "same": F.lit(2)})
    path = queries.tokenizer_path("piece_bpe_32k.model")
    got = suffix_pieces.round_trip(docs, path).collect()
    assert len(got) == 5 and all(r.same for r in got) and sorted(r.n_pieces for r in got)[0] == 0
    assert len(suffix_pieces.encode_pieces(docs, path, also=["same"]).collect()) == 5


def test_pieces_equal_the_library(spark):
    import sentencepiece

    texts = [*ODD, "a  b", "   lead", "trail  ", "\0a \0b", "ab" * 200 + " " + "x" * 300, "foo\n\nbar\t baz", *[r.text for r in table(spark, SF, "documents").select("text").limit(60).collect()]]
    path = queries.tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = suffix_pieces.encode_pieces(docs_of(spark, texts), path)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert [got[i] for i in range(len(texts))] == [library.encode(t or "") for t in texts]
    back = {r.doc_id: r.text for r in suffix_pieces.decode_pieces(encoded, path).collect()}
    assert [back[i] for i in range(len(texts))] == [t or "" for t in texts]
    assert suffix_pieces.round_trip(docs_of(spark, texts), path).filter("same").count() == len(texts)
    assert suffix_pieces.encode_pieces(docs_of(spark, texts).limit(0), path).count() == 0


def test_paths_are_the_best():
    import functools

    p = suffix_pieces.Pieces(queries.tokenizer_path("piece_bpe_32k.model"))
    p.kind = "unigram"
    pieces = {p.names[i]: float(p.scores[i]) for i in p.ids.tolist()}

    def best(word):
        @functools.cache
        def to(i):
            if i == 0:
                return 0.0
            return max(to(k) + (pieces[word[k:i]] if word[k:i] in pieces else float(p.unknown_score)) for k in range(max(0, i - p.depth), i) if word[k:i] in pieces or i - k == 1)

        return to(len(word))

    words = ["▁hest", "▁ariear", "▁thntion", "▁日本x", "▁" + "ab" * 50, "▁a"]
    for word, packed in zip(words, p._encode_words(words), strict=True):
        ids = np.frombuffer(packed, p.width).tolist()
        byte = {i for i in p.bytes.values()}
        score = sum(float(p.scores[i]) for i in ids if i not in byte)
        if not byte & set(ids):
            assert abs(score - best(word)) < 1e-3


# 7


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Com/en/7?x", "http://a.example.com/en/75", "http://example.com/en/8", "http://com/en/", "x://y://z.net/de/9", "http://notexample.com/en/7", "http://example.net/de/8#a", "http://a.org/es/?q", "http://a.org/es", "http://ü.com/en/é"]
    df = spark.createDataFrame([(i, u, "h", "allow") for i, u in enumerate(urls + urls)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in url_cascade.judge_urls(df, queries.URL_RULES).collect()}

    def judge(u):
        if u is None or "://" not in u:
            return "", "", None, "allow"
        rest = u.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        return host, path, best and best.text, best.action if best else "allow"

    for i, u in enumerate(urls + urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == judge(u)
    assert url_cascade.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_urls_of_odd_rows(spark):
    rows = [(None, "http://a.com/en/1"), (1, "http://a.com/en/1"), (1, "http://a.com/en/1"), (1, None), (2, "http://b.net/" + "x" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("c") for c in ("host", "path", "rule", "verdict", "__listed", "__pass_0", "key")})
    got = sorted((r.page_id or 0, r.verdict) for r in url_cascade.judge_urls(df, queries.URL_RULES).collect())
    assert got == [(0, "block"), (1, "allow"), (1, "block"), (1, "block"), (2, "allow")]


def test_url_verdicts_are_those_of_the_contract(spark, tmp_path):
    """The contract's list: block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/."""
    want = [("a.com/en/1", "com/en/", "block"), ("example.com/en/7", "example.com/en/7", "allow"), ("a.net/de/1", "net/de/", "allow"), ("example.net/de/7", "net/de/", "allow"), ("example.net/de/8", "example.net/de/8", "block"), ("a.org/es/1", "org/es/", "block"), ("a.org/de/1", None, "allow")]
    pages = spark.createDataFrame([(i, "http://" + key) for i, (key, _, _) in enumerate(want)], "page_id long, url string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op7_bloom_cascade(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r.host + r.path, r.rule, r.verdict) for r in got] == want


@pytest.mark.parametrize("shard_keys", [10**6, 100])
def test_cascade_is_exact_over_its_universe(spark, shard_keys):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_cascade.build_cascade(keys, bits_per_key=3, hashes=2, shard_keys=shard_keys)
    assert len(cascade.levels) > 2
    assert cascade.member(keys, F.col("key"), "found").filter("found != listed").count() == 0
    assert url_cascade.build_cascade(keys.withColumn("listed", F.lit(False))).levels == []


# 8


def test_licenses_edge_cases(spark):
    texts = [*ODD, "MIT License mit license", "cc---by", "gnu general public\nlicense", "Licensed under the Apache License,", "apache  license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit licensee", "cc by cc by"]
    got = {r.doc_id: r for r in license_join.scan_licenses(docs_of(spark, texts)).collect()}
    n = len(ODD)
    assert all(got[i].labels == "" and got[i].n_base == 0 and got[i].first_word is None and got[i].score == 0 for i in range(n))
    assert (got[n].n_base, got[n].first_word, got[n].last_word, got[n].base_labels) == (2, 0, 2, "mit")
    assert got[n + 1].base_labels == "cc-by" and got[n + 2].base_labels == "gpl"
    assert got[n + 5].base_labels == "" and got[n + 5].labels == "mit" and got[n + 5].score == 1.0
    assert got[n + 6].base_labels == "" and got[n + 7].n_base == 2 and got[n + 7].last_word == 2
    assert got[9].n_words == 3000 and got[7].n_words == 5
    assert license_join.scan_licenses(docs_of(spark, texts).limit(0)).count() == 0


def test_licenses_of_odd_rows(spark):
    rows = [(None, "MIT License"), (1, "Apache License"), (1, "cc by"), (1, "cc by"), (2, None), (3, "word " * 100_000 + "mit license")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("c") for c in ("labels", "score", "lowered", "text_hash", "id", "__words", "at", "found")})
    got = sorted((r.doc_id or 0, r.labels, r.n_words) for r in license_join.scan_licenses(df).collect())
    assert got == [(0, "mit", 2), (1, "apache", 2), (1, "cc-by", 2), (1, "cc-by", 2), (2, "", 0), (3, "mit", 100_002)]


def test_licenses_lower_only_ascii_letters(spark):
    texts = ["KIT BY", "\u212aIT BY", "K\u0130T BY", "kit\u00c9 by", " \u00c9T\u00c9 kit by"]
    got = {r.doc_id: (r.labels, r.n_words, r.first_word) for r in license_join.scan_licenses(docs_of(spark, texts), phrases={"kit by": "kit"}).collect()}
    assert got == {0: ("kit", 2, 0), 1: ("", 2, None), 2: ("", 2, None), 3: ("", 2, None), 4: ("kit", 3, 1)}
    assert {r.n_words for r in license_join.scan_licenses(docs_of(spark, texts), phrases={}, templates=()).collect()} == {2, 3}


def best_run(text, template, threshold=0.8):
    """The largest share of a template's words in a line or in a run of its length divided by the threshold."""
    words = lambda t: license_join._python_words(t)
    wanted, all_words, n = set(words(template)), words(text), math.ceil(len(words(template)) / threshold - 1e-9)
    blocks = [words(line) for line in text.split("\n")] + [all_words[i : i + n] for i in range(max(1, len(all_words)))]
    return max(len(wanted & set(b)) / len(wanted) for b in blocks)


def test_wrapped_notices_by_brute_force(spark):
    import textwrap

    rng = np.random.default_rng(8)
    vocabulary = sorted({w for _, t in license_join.TEMPLATES for w in license_join._python_words(t)})
    texts = []
    for _, t in license_join.TEMPLATES:
        for width in (12, 24, 40):
            texts.append("lead in words\n" + "\n".join(f" * {line}" for line in textwrap.wrap(t, width)) + "\nand what follows")
        spread = t.split()
        texts.append("\n".join(" filler of the text " * 4 + w for w in spread))  # too far apart
    texts += ["\n".join(" ".join(rng.choice(vocabulary, 9)) for _ in range(40)) for _ in range(30)]
    for _, t in license_join.TEMPLATES:  # a word lost, a word changed, words added
        for _ in range(6):
            w = t.split()
            w[rng.integers(len(w))] = "changed"
            w.insert(rng.integers(len(w)), "added added")
            if rng.random() < 0.5:
                w.pop(rng.integers(len(w)))
            texts.append("before\n" + "\n".join(textwrap.wrap(" ".join(w), 30)))
    got = {r.doc_id: r for r in license_join.scan_licenses(docs_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        shares = [(label, best_run(text, t)) for label, t in license_join.TEMPLATES]
        met = {label for label, share in shares if share >= 0.8 - 1e-9}
        base = {label for label in got[i].base_labels.split(",") if label}
        assert set(filter(None, got[i].labels.split(","))) == met | base, text
        assert got[i].score == pytest.approx(1.0 if base else max([share for _, share in shares if share >= 0.8 - 1e-9], default=0.0)), text
    for k, (label, _) in enumerate(license_join.TEMPLATES):
        assert all(label in got[4 * k + w].labels.split(",") for w in range(3))


# 9


def fingerprint(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    import xxhash

    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    texts = [*ODD, *[r.text for r in table(spark, SF, "documents").select("text").limit(30).collect()]]
    got = {r.doc_id: r for r in golay_dedup.near_duplicates(docs_of(spark, texts)).collect()}
    assert all(got[i].fingerprint == f"{fingerprint(t):016x}" for i, t in enumerate(texts))
    assert got[1].component_id == 0 and got[6].component_id == 5
    assert golay_dedup.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0


def test_groups_of_odd_rows(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    rows = [(None, a, 1), (5, a, 2), (5, b, 3), (3, a, 4), (7, b, 5), (7, b, 6), (9, None, 7), (None, "", 8), (11, "long text " * 100_000, 9), (3, a, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int").withColumns({"print": F.lit(1), "component_id": F.lit(2), "text_hash": F.lit(3)})
    got = sorted((r.doc_id or 0, r.component_id) for r in golay_dedup.near_duplicates(docs).collect())
    assert got == [(0, 3), (0, 9), (3, 3), (3, 3), (5, 3), (5, 5), (7, 5), (7, 5), (9, 9), (11, 11)]
    kept = golay_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(0, a), (0, ""), (3, a), (5, b), (9, ""), (11, "long text " * 100_000)])


def test_close_words_share_a_key():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = []
    for x in (a, b):
        row, key = golay_dedup.keys_of(x)
        sets = [set() for _ in x]
        for r, k in zip(row.tolist(), key.tolist(), strict=True):
            sets[r].add(k)
        keys.append(sets)
    assert all(p & q for p, q in zip(*keys, strict=True))


@pytest.mark.parametrize("bucket", [48, 3])
def test_links_by_brute_force(spark, bucket):
    rng = np.random.default_rng(10)
    seeds = rng.integers(0, 2**63, 30).astype(np.uint64)
    prints = [np.uint64(0), np.uint64(2**64 - 1)]
    for s in seeds:
        x = s
        for _ in range(40):  # chains, whose ends differ in more bits than a link may
            y = x
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= np.uint64(1) << np.uint64(bit)
            prints.append(y)
            x = y if rng.random() < 0.5 else x
    p = np.unique(np.array(prints, np.uint64))
    link = np.bitwise_count(p[:, None] ^ p[None, :]) <= 4
    label = np.arange(len(p))
    while True:
        new = np.where(link, label[None, :], len(p)).min(1)
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(int(v),) for v in p.view(np.int64)], "print long")
    roots = {r.node: r.root for r in components.components(golay_dedup.link_edges(df, bucket=bucket)).collect()}
    got = {}
    for v, k in zip(p.view(np.int64).tolist(), label.tolist(), strict=True):
        got.setdefault(roots.get(v, v), set()).add(k)
    assert all(len(s) == 1 for s in got.values()) and len(got) == len(set(label.tolist()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(50)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 10


def base_spans(t):
    def luhn(d):
        s = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            s += v - 9 if v > 9 else v
        return s % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [[(m.start(), m.end()) for m in re.finditer(p, t) if ok(m[0])] for p, ok in kinds]


def test_base_spans_by_brute_force(spark):
    texts = [
        *ODD, "a@b.c_d@e.f x@y.z-w@q.r", "a.b@c.d.e. f@g", "😀 me@x.yz 10.0.0.255 10.0.0.256 1.2.3.4.5.6.7.8 0001.2.3.004", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (201) 555-0123 +44 20 7946 0958 +12 345", "1" * 4000,
        "a" * 20000, "a." * 5000 + "@" + "b." * 4000, "+1 " + "2 " * 3000, "1 " * 3000, "+" * 50 + "1-2-3-4-5-6-7-8-9", *[r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").limit(300).collect()],
    ]
    got = {r.id: r for r in pii_bootstrap.find_pii(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = [(k, a, b) for k, spans in enumerate(base_spans(t or "")) for a, b in spans]
        assert [(s.kind, s.start, s.end) for s in got[i].base] == want, t
        assert {(s.kind, s.start, s.end) for s in got[i].spans} >= set(want)
    assert pii_bootstrap.find_pii(docs_of(spark, texts).limit(0)).count() == 0


def test_query_digests(spark):
    rows = queries.op10_pii_bootstrap(spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in rows:
        spans = base_spans(texts[r.doc_id] or "")
        text = ",".join(f"{k}:{a}:{b}" for k, s in zip(pii_bootstrap.KINDS, spans, strict=True) for a, b in s)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, spans)) and r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_context_finds_unseen_identifiers(spark):
    seeds = [f"please dial number +1 (201) 555-{1000 + i} now" for i in range(30)]
    docs = docs_of(spark, [*seeds, "please dial number 0800-123456 now", "the year 123456 was long"])
    got = {r.id: r for r in pii_bootstrap.find_pii(docs).collect()}
    assert [(s.kind, s.start, s.end) for s in got[30].spans] == [(3, 19, 30)] and got[30].base == [] and got[31].spans == []
    text = {r.doc_id: r.text for r in pii_bootstrap.redact(docs).collect()}
    assert text[30] == "please dial number <PHONE> now" and text[0] == "please dial number <PHONE> now" and text[31] == "the year 123456 was long"


def test_redaction_of_overlaps(spark):
    docs = docs_of(spark, ["card +4111 1111 1111 1111 x", None, "a 10.1.1.1 b"])
    out = {r.doc_id: r.text for r in pii_bootstrap.redact(docs).collect()}
    assert out[1] is None and out[2] == "a <IP> b" and "1111" not in out[0]


def found_texts(spark, texts):
    return {r.id: [texts[r.id][s.start : s.end] for s in r.spans] for r in pii_bootstrap.find_pii(docs_of(spark, texts)).collect()}


def test_discovered_identifiers_are_seeds(spark):
    texts = [f"write mail a{i}@b.org right away" for i in range(60)] + [f"write mail k{i}-77421 right away" for i in range(12)]
    texts += [f"under file k{i}-77421 it stands" for i in range(12)] + ["under file z9-88888 it stands", "the other z9-88888 of them"]
    got = found_texts(spark, texts)
    assert got[60] == ["k0-77421"] and got[72] == ["k0-77421"]
    assert got[84] == ["z9-88888"] and got[85] == []


def test_candidates_of_several_groups(spark):
    odd = ["201.555.0123", "0800 123 456", "DE89 3704 0044 0532 0130 00", "john (at) example.com", "(201) 555-0123"]
    texts = [f"please call +1 201 555 {1000 + i} before noon" for i in range(60)] + [f"please call {o} before noon" for o in odd]
    got = found_texts(spark, texts)
    assert [got[60 + i] for i in range(len(odd))] == [[o] for o in odd]


def test_secrets_by_their_context(spark):
    rng = np.random.default_rng(17)
    digest = lambda: rng.bytes(20).hex()
    texts = [f'some words token = "{digest()}" and more' for _ in range(30)] + ['other words token = "hunter2-99x41" as well', f"commit {digest()} of the tree", 'TOKEN = "77AB-1234-QRST"!!']
    got = found_texts(spark, texts)
    assert all(len(got[i]) == 1 and len(got[i][0]) == 40 for i in range(30))
    assert got[30] == ["hunter2-99x41"] and got[31] == [] and got[32] == ["77AB-1234-QRST"]
    text = {r.doc_id: r.text for r in pii_bootstrap.redact(docs_of(spark, texts)).collect()}
    assert text[30] == 'other words token = "<SECRET>" as well' and text[31] == texts[31]


def test_personal_data_in_the_tables(spark):
    """Context adds spans on the tables, the secrets that stand there, and nothing else."""
    sf = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    found = pii_bootstrap.find_pii(table(spark, sf, "documents")).collect()
    added = {(r.id, s.kind, s.start, s.end) for r in found for s in r.spans if s not in r.base}
    planted = {(i, 4, *m.span(1)) for i, t in texts.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    assert len(planted) > 100 and added == planted


def test_redaction_of_odd_rows(spark):
    rows = [(None, "a@b.cd x", 1, "s"), (1, "10.0.0.1", 2, "t"), (1, None, 3, None), (1, "no data", 4, "u"), (1, "10.0.0.1", 5, "v"), (2, "word " * 50_000 + "me@x.yz", 6, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int, added string").withColumns({c: F.lit(c) for c in ("id", "t", "row", "own_hash", "text_hash", "base", "new", "ordered")})
    out = pii_bootstrap.redact(docs)
    assert out.columns == docs.columns
    got = {r.spans: r.text for r in out.collect()}
    assert got == {1: "<EMAIL> x", 2: "<IP>", 3: None, 4: "no data", 5: "<IP>", 6: "word " * 50_000 + "<EMAIL>"}
