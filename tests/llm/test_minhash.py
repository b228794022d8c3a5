"""Near-duplicates against brute force."""

import numpy as np
import pytest

from brindle.llm import minhash
from brindle.llm.components import components
from brindle.llm.shingles import jaccard, shingles, word_hashes


def brute_classes(rows, threshold=0.8):
    """Smallest id reachable by pairs of at least the threshold."""
    ids = sorted({i for i, t in rows if i is not None})
    text = {i: (t or "") for i, t in rows if i is not None}
    sets = {i: set(zip(*[text[i].split()[k:] for k in range(5)], strict=False)) or ({tuple(text[i].split())} - {()}) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_classes_match_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash.op9_minhash(spark, f"/root/testdata/{sf}").collect()}
    assert got == {i: (c, i == c) for i, c in brute_classes(rows).items()}


@pytest.mark.parametrize("small", [2, 64])
def test_chains_and_large_buckets(spark, small):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 120)]
    rows = []
    for i in range(60):  # a chain in which neighbours are alike and the ends are not
        rows.append((1000 - i, " ".join(words)))
        words[rng.integers(0, 120)] = f"x{i}"
    rows += [(i, " ".join(["a", "line", "all", "share", "here", "and", *(f"y{rng.integers(0, 10**6)}" for _ in range(9))])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash.classes(df, small=small, block=16).collect()}
    assert got == brute_classes(rows)


def test_signature_agreement_is_weighted_similarity():
    rng = np.random.default_rng(5)
    for _ in range(6):
        elements = rng.integers(0, 2**63, 80).astype(np.uint64)
        a, b = rng.uniform(1, 6, 80), rng.uniform(1, 6, 80)
        a[:20] = 0
        both = np.concatenate([elements[a > 0], elements])
        owner = np.repeat([0, 1], [(a > 0).sum(), 80])
        with np.errstate(over="ignore"):
            s = minhash.signatures(both, np.concatenate([a[a > 0], b]), owner, 2, 4000)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_repeats_of_a_passage_do_not_hide_a_pair(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(25):  # x, x+x, x+x+x and ten times x, and a text in which half of x stands five times
        x = [f"w{n}" for n in rng.integers(0, 10**6, 120)]
        for k, text in enumerate((x, x * 2, x * 3, x * 10, x[:60] * 5 + x[60:])):
            rows.append((10 * i + k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash.classes(df).collect()}
    assert got == brute_classes(rows) and set(got.values()) == {10 * i for i in range(25)}


def test_shingles_of_short_texts():
    assert len(shingles(word_hashes(b""))[0]) == 0
    assert len(shingles(word_hashes(b"one two"))[0]) == 1
    a, b = (shingles(word_hashes(t))[0] for t in (b"a b c d e f", b"a b c d e g"))
    assert jaccard(a, b) == 1 / 3


def test_odd_rows(odd, empty):
    got = minhash.classes(odd).collect()
    assert len(got) == 10 and minhash.classes(empty).count() == 0
    assert {(r.doc_id, r.class_id, r.kept) for r in got} == {(None, None, True)} | {(i, i, True) for i in range(1, 9)}


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, local):
    edges = [(i, i + 1) for i in range(50)] + [(100 + i, 100) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), local=local).collect()}
    want = {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), local=local).count() == 0


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, one), (2, two), (3, one + " x"), (3, two + " x"), (3, two + " x"), (4, "c d e f g h")]
    got = minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = lambda i: sorted((r.class_id, r.kept) for r in got if r.doc_id == i)
    assert of(1) == [(1, True)] and of(2) == [(2, True)] and of(4) == [(4, True)]
    assert of(3) in ([(1, False), (3, True), (3, True)], [(2, False), (2, False), (3, True)])
    assert len({r.copy for r in got if r.doc_id == 3}) == 2


def test_recall_by_similarity(spark):
    """Pairs of every similarity from the threshold on share a band in 0.9 of cases at least, those of repeats too."""
    rng = np.random.default_rng(11)
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1.0)):
        found = tried = 0
        while tried < 150:
            n = int(rng.integers(20, 400))
            words = [f"w{i}" for i in rng.integers(0, 10**6, n)]
            other = list(words)
            for i in rng.integers(0, n, int(n * rng.uniform(0, 0.06))):
                other[i] = f"x{rng.integers(0, 10**6)}"
            other = other * int(rng.integers(1, 4))
            a, b = (shingles(word_hashes(" ".join(w).encode()))[0] for w in (words, other))
            if not low <= jaccard(a, b) < high:
                continue
            owner = np.repeat([0, 1], [len(a), len(b)])
            keys = minhash.band_keys(minhash.signatures(np.concatenate([a, b]), np.ones(len(owner)), owner, 2, minhash.BANDS * minhash.ROWS), minhash.BANDS, minhash.ROWS)
            tried += 1
            found += bool(set(keys[0]) & set(keys[1]))
        assert found >= 0.98 * tried, (low, found, tried)
