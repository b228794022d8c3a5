"""Substring dedup against brute force."""

import hashlib
import random
import re

import pytest

from brindle.llm import substring


def brute(rows, window=50):
    first, out = {}, {}
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    for i in sorted(split):
        for s in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][s : s + window]), i)
    for i, words in split.items():
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.op2_substring(spark, f"/root/testdata/{sf}").collect()}
    assert got == brute(rows)


@pytest.mark.parametrize(("batches", "vocabulary"), [(1, 2), (3, 3), (6, 400)])
def test_repetitive_texts_and_batches(spark, batches, vocabulary):
    rng = random.Random(vocabulary)
    passages = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(10, 70))] for _ in range(12)]
    rows = []
    for i in rng.sample(range(1000), 70):
        words = [w for _ in range(rng.randrange(1, 6)) for w in rng.choice(passages)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
        rows.append((i, "\t ".join(words)))
    rows += [(2000, "a " * 300), (2001, "a " * 49), (2002, "a " * 51), (2003, "b a " * 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.words, r.removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substring.dedup(df, batches=batches).collect()}
    assert got == brute(rows)


def made(rng, rows, vocabulary=300):
    passages = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(30, 90))] for _ in range(8)]
    return [(i, " ".join(w for _ in range(rng.randrange(1, 5)) for w in rng.choice(passages))) for i in rows]


def results(df):
    return {r.doc_id: (r.words, r.removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()}


def test_an_index_goes_on_in_another_session(spark, tmp_path):
    """Batches over two sessions with compaction between them equal one load of all."""
    rng = random.Random(3)
    rows = made(rng, range(90))
    schema = "doc_id long, text string"
    index = substring.FingerprintIndex(spark, str(tmp_path / "index"))
    got = {}
    for k in range(3):
        got |= results(index.add(spark.createDataFrame(rows[15 * k : 15 * (k + 1)], schema)))
    assert [r["level"] for r in index.runs] == [1]
    assert len([p for p in (tmp_path / "index").iterdir() if "_run_" in p.name]) == 1
    other = spark.newSession()
    for name in [t.name for t in other.catalog.listTables() if t.name.startswith("brindle_")]:
        other.sql(f"drop table {name}")  # a new session's catalog knows nothing of them
    again = substring.FingerprintIndex.open(other, str(tmp_path / "index"))
    for k in range(3, 6):
        got |= results(again.add(other.createDataFrame(rows[15 * k : 15 * (k + 1)], schema)))
    assert sorted(r["level"] for r in again.runs) == [1, 1]
    assert got == brute(rows)


def test_no_run_is_shuffled(spark):
    """The join of a batch with earlier runs: an exchange on the side of the batch only."""
    rng = random.Random(4)
    index = substring.FingerprintIndex(spark, fanout=8)
    for k in range(3):
        index.add(spark.createDataFrame(made(rng, range(50 * k, 50 * k + 50)), "doc_id long, text string"))
    plan = index.met(index.runs.pop())._jdf.queryExecution().executedPlan().toString()
    joins = plan.count("SortMergeJoin")
    assert joins == 2
    for part in plan.split("SortMergeJoin")[1:]:
        left = part[: part.index("Exchange")]  # the run comes first in the join
        assert "Bucketed: true" in left and "brindle_run" in left


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, "x " + long), (2, "other words " * 40), (2, "x " + long), (3, "other words " * 40)]
    got = sorted((r.doc_id, r.words, r.removed) for r in substring.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 60, 0), (2, 61, 60), (2, 61, 60), (2, 80, 0), (3, 80, 80)]


def test_odd_rows(odd, empty):
    got = substring.dedup(odd).collect()
    assert len(got) == 10 and all(r.removed == 0 for r in got)
    assert {r.kept for r in got if r.doc_id == 5} == {""}
    assert substring.dedup(empty).count() == 0
