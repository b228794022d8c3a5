"""Quality rules against SQL and brute force."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from brindle.llm import line_quality


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    want = con.execute(line_quality.op1_sql())
    names = [c[0] for c in want.description]
    got = line_quality.op1_line_quality(spark, f"/root/testdata/{sf}")
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())


def brute_repeats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(runs)
    return len({i + k for i, r in enumerate(runs) if n[r] > 1 for k in range(5)})


def test_repeated_words(spark):
    texts = ["", "a b c d e", "a b c d e a b c d e", "x x x x x x x", "a b c d e f a b c d e g h i j k b c d e f", "a b c d " * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", line_quality.repeated_words(line_quality.common.words_of(F.col("t"))).alias("n")).collect()
    assert {r.t: r.n for r in got} == {t: brute_repeats(t) for t in texts}


def test_depleted_documents_go_and_copies_stay(spark):
    foot = "Follow us on our pages for more news of 2024 every day"
    own = ["".join("abcdefghij"[int(c)] for c in str(1000 + i)) for i in range(40)]
    rows = [(i, f"{foot} \n{own[i]} words of document {own[i]} that nobody else has written down at all so far", "h") for i in range(40)]
    rows += [(100 + i, f"{foot.upper()}\n{foot}\nonly {own[i]} a few other words stand here in this one", "h") for i in range(40)]
    rows += [(200 + i, "an exact copy of one text that is on many pages of the host\nwith two lines", "h") for i in range(60)]
    rows += [(300, f"{foot}\n{foot}\nfew other words", "other")]
    got = {r.doc_id: r for r in line_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_docs=20).collect()}
    assert all(got[i].kept and got[i].n_line_words == 12 for i in range(40))
    assert not any(got[100 + i].kept for i in range(40)) and got[100].n_line_words == 24
    assert all(got[200 + i].kept and got[200 + i].n_line_words == 0 for i in range(60)) and got[300].n_line_words == 0


def test_odd_rows(odd, empty):
    got = line_quality.judge(odd.withColumn("h", F.lit(1)), min_docs=1, share=0.0).collect()
    assert len(got) == 10 and line_quality.judge(empty).count() == 0
    by_id = {r.doc_id: r for r in got}
    assert (by_id[2].n_words, by_id[2].base_failed, by_id[2].kept) == (0, True, False)
    assert {r.n_line_words for r in got if r.doc_id == 4} == {80}
    assert by_id[6].n_line_words == 4 and by_id[None].n_words == 7


def test_boilerplate_lines_leave_the_texts(spark):
    rows = [(i, f"Menu {i % 10}  Home\n text of {i}x, its own line\n\nmenu 3 home\nend\n", "h") for i in range(30)] + [(100, "Menu 1 Home\nother", "g"), (101, None, "h"), (None, "menu 0 home", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_quality.cleaned(df, min_docs=31).collect()}
    want = {i: f" text of {i}x, its own line\n\nend\n" for i in range(30)} | {100: "Menu 1 Home\nother", 101: None, None: ""}
    assert got == want
