"""Language identification: held-out accuracy, and fusion against plain Python."""

import math

import numpy as np
from pyspark.sql import functions as F

from brindle.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars >= 40")
    train, held = docs.where("doc_id % 4 <> 0"), docs.where("doc_id % 4 = 0")
    model = langid.fitted(train.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared")))
    got = langid.identify(held, declared_col=None, host_col=None, model=model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.language == r.lang for r in got]) >= 0.95


def test_clean_documents_stay(spark):
    got = langid.op4_langid(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    assert len(got) == 1000
    # What the query says of the language isn't counted here: it has seen ``lang``.
    assert np.mean([r.kept for r in got]) >= 0.97


def test_fusion_matches_plain_python(spark):
    counts = {"aa": np.ones(langid.BUCKETS), "bb": np.ones(langid.BUCKETS)}
    counts["aa"][langid.trigrams("xyz xyz")] += 4000
    counts["bb"][langid.trigrams("uvw uvw")] += 4000
    model = langid.TrigramModel(counts)
    rows = [(1, "xyz", "aa", "h.one"), (2, "uvw", "aa", "h.one"), (3, "xyz uvw", None, "h.one"), (4, "q", "bb", "g.two"), (5, "42!", "aa", "g.two"), (6, "xyz xyz", "zz", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in langid.identify(df, suffix=F.regexp_extract("source", r"([^.]*)$", 1), model=model).collect()}

    def soft(x):
        e = [math.exp(v - max(x)) for v in x]
        return [v / sum(e) for v in e]

    logs = {i: model.scores(t) for i, t, _, _ in rows}
    alone = {i: soft(x) for i, x in logs.items() if x}
    host = {i: h or "" for i, _, _, h in rows}
    add = lambda ids: [sum(x) for x in zip(*(alone[i] for i in ids), strict=True)]
    smooth = lambda own, above: [(n + 5 * p) / (sum(own) + 5) for n, p in zip(own, above, strict=True)]
    whole = smooth(add(alone), [1 / 3] * 3)
    for i, _, said, _ in rows:
        if i not in alone:
            assert (got[i].language, got[i].kept) == ("und", False)
            continue
        end = host[i].rpartition(".")[2] if host[i] else ""
        above = smooth(add(j for j in alone if (host[j].rpartition(".")[2] if host[j] else "") == end), whole)
        prior = smooth([max(0.0, n - o) for n, o in zip(add(j for j in alone if host[j] == host[i]), alone[i], strict=True)], above)
        known = said in ("aa", "bb")
        want = soft([a + math.log(p) + (math.log(0.9 if said == k else 0.05) if known else 0) for a, p, k in zip(logs[i], prior, model.languages, strict=True)])
        assert got[i].language == model.languages[int(np.argmax(want))]
        assert abs(got[i].probability - max(want)) < 1e-5


def test_pages(spark):
    got = langid.pages_language(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 50 and sum(r.kept for r in got) >= 45


def test_odd_rows(odd, empty):
    got = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert not got[1].kept and not got[2].kept and not got[5].kept
    assert langid.identify(odd).count() == 10 and langid.identify(empty).count() == 0


def test_a_rare_declared_language_has_a_model(spark):
    rng = np.random.default_rng(6)
    made = lambda letters: " ".join("".join(rng.choice([*letters], 5)) for _ in range(30))
    rows = [(i, made("abcdefg"), "aa", "h") for i in range(600)] + [(1000 + i, made("tuvwxyz"), "zz", "h") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = langid.identify(df, sample=20).where("doc_id >= 1000").collect()
    assert [(r.language, r.kept) for r in got] == [("zz", True)] * 8
