"""The pipeline stage by stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from skysift.llm import crf_quality, golay_dedup, pii_bootstrap  # noqa: E402
from skysift.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, now = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        now[name] = (docs, docs := spark.read.parquet(str(tmp_path / name)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())

    before, after = now["quality"]
    model = crf_quality.train(before, table(spark, SF, "labels"))
    assert ids(after) == ids(crf_quality.with_score(before, model).filter("__score >= 0.7"))
    bad = table(spark, SF, "labels").filter("quality = 0")
    assert after.join(bad, "doc_id").count() <= 0.1 * bad.count()

    before, after = now["deduplicate"]
    rows = golay_dedup.near_duplicates(before).collect()
    p = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    link = np.bitwise_count(p[:, None] ^ p[None, :]) <= 4
    label = np.array([r.doc_id for r in rows])
    while True:
        new = np.where(link, label[None, :], 10**9).min(1)
        if (new == label).all():
            break
        label = new
    assert ids(after) == sorted(set(label.tolist()))

    before, after = now["private"]
    assert ids(after) == ids(before)
    assert pii_bootstrap.find_pii(after).filter(F.size("base") > 0).count() == 0
    assert after.filter(F.length("text") != F.col("n_chars")).count() == 0

    before, after = now["mix"]
    assert set(ids(after)) == set(ids(before))

    before, after = now["pieces"]
    assert ids(after) == ids(before) and after.filter(F.size("ids") != F.col("n_pieces")).count() == 0


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_stages_with_odd_rows(spark):
    """Nulls, repeated rows, copies, names that operators use inside, and a very long text."""
    copy = "one two three four five six seven eight"
    rows = [(None, copy, None), (5, copy, "a"), (5, copy, "a"), (3, copy, None), (7, None, "b"), (8, "", "b"), (9, "call me@x.yz or 10.0.0.1", "hot"), (10, "long text " * 60_000, "hot")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(c) for c in ("__score", "__id", "__text_hash", "component_id", "spans", "added", "row", "copies", "weight", "hash", "tokens", "blocks")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        if name == "deduplicate":
            assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, copy), (3, copy), (7, ""), (9, rows[6][1]), (10, rows[7][1])]
        if name == "private":
            text = {r.doc_id: r for r in got}
            assert len(got) == len(rows) and text[9].text == "call <EMAIL> or <IP>" and text[9].n_chars == 20 and text[7].text is None
        if name == "mix":
            assert {(r.doc_id, r.text) for r in got} == {(i, t) for i, t, _ in rows}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(pieces) == len(rows) and {r.doc_id: r.n_pieces for r in pieces}[7] == 0
