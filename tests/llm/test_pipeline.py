"""The pipeline's stages against brute force, each on its own input."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from brindle.llm import common, pii
from tests.llm.test_minhash import brute_classes
from tests.llm.test_rows import base_pii, pieces_hold
from tests.llm.test_substring import brute


def test_stages(spark, sf_dir, documents):
    docs, columns = documents, documents.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        if k < 4:
            assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in documents.schema]
        after = out.collect()
        if k == 0:
            assert {r.doc_id for r in after} <= before.keys() and len(after) >= 0.95 * len(before)
        elif k == 1:
            classes = brute_classes([(i, r.text) for i, r in before.items()])
            assert sorted(r.doc_id for r in after) == sorted(set(classes.values()))
        elif k == 2:
            left = brute([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in after} == {i for i, (n, gone, _) in left.items() if gone < n or not n}
            for r in after:
                assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == left[r.doc_id][0] - left[r.doc_id][1]
                assert r.n_chars == (len(r.text) if left[r.doc_id][1] else before[r.doc_id].n_chars)
        elif k == 3:
            assert len(after) == len(before)
            for r in after:
                assert r.text == pii.redacted(before[r.doc_id].text, pii.spans(before[r.doc_id].text)) and not base_pii(r.text)
        else:
            pieces_hold(after, {i: r.text for i, r in before.items()})
        docs = spark.createDataFrame(after, out.schema) if k < 4 else None


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100


def test_odd_rows(spark, odd, empty, sf_dir):
    """Nulls, empty and long texts, repeated rows, and columns whose names the stages use themselves."""
    more = odd.withColumns({c: F.lit("y") for c in ("key", "copy_", "rest", "doc", "marks", "class_id")})
    for docs in (odd, more, empty):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            if k < 4:
                assert out.columns == docs.columns
                docs = common.written(out, "stage")
            else:
                assert out.count() >= docs.count()


def test_rows_of_one_id(spark, sf_dir):
    """Each row is judged by its own text at every stage."""
    base = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    other = " ".join(f"else{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    rows = [(1, base), (2, "start " + base + " " + other), (3, base + " mail me@x.org"), (3, other), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {(r.doc_id, (r.text or "")[:5]) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()}
    # Of id 3 one text only can be found alike to another document.
    assert left - {(3, "worda")} == {(1, "worda"), (2, "start"), (3, "elsea"), (4, ""), (5, "")}
    got = sorted((r.doc_id, r.text or "", r.n_chars) for r in corpus_pipeline.passages(spark, docs, sf_dir).collect())
    assert [(i, n) for i, _, n in got] == [(1, len(base)), (2, len("start " + other)), (3, len("mail me@x.org")), (4, 0), (5, 0)]
    assert got[1][1] == "start " + other and got[2][1] == "mail me@x.org"  # the other row of id 3 is a passage of 2
