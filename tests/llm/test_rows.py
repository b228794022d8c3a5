"""Operators that judge row by row, against brute force."""

import hashlib
import random
import re
import struct
import tempfile
import time
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brindle.llm import bpe, packing, pii, secrets_scan, url_filter

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# --- urls


def test_url_filter_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    want = sorted(con.execute(url_filter.op3_sql()).fetchall())
    got = sorted(tuple(r) for r in url_filter.op3_url_filter(spark, sf_dir).collect())
    assert got == want


def test_url_rules_and_terms(spark):
    urls = ["http://WWW.Example.com/en/1", "http://a.example.com/en", "http://example.com/en/?x", "http://notexample.com/en/", "https://x.net/es/1#f", "https://net", None, "", "no scheme porn", "http://x.org/cheap/pills", "http://x.org/cheapest-pills", "http://x.org/cheap/cheap", "http://x.org/xXx", "a://b://c/d", "http://x.net:80/fr/", "http://x.org/p%6Frn", "http://x.org/%2541porn", "http://x.org/buy/free/farm", "http://x.org/casino/nude", "http://x.org/casino/buy/free"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert [got[i].rule for i in range(7)] == ["www.example.com/en/", "com/", "example.com/en/", "com/", "net/es/", None, None]
    assert [got[i].verdict for i in range(len(urls))] == ["allow", "allow", "block", "allow", "block", "allow", "allow", "allow", "block", "allow", "allow", "allow", "block", "allow", "allow", "block", "allow", "allow", "block", "block"]
    assert (got[13].host, got[13].path) == ("b:", "//c/d")
    assert url_filter.judge(df.limit(0)).count() == 0
    terms = spark.createDataFrame([("Pills", 1), ("pills", 3), ("cheap", 1), (None, 9), ("", 9), ("x", 0)], "term string, weight int")
    assert url_filter.vocabulary_of(terms) == {"pills": 3, "cheap": 1}
    got = {r.page_id: (r.weight, r.verdict) for r in url_filter.judge(df, vocabulary=terms).collect()}
    assert got[9] == (4, "block") and got[10] == (3, "allow") and got[11] == (1, "allow")


def test_percent_codes_match_sql(spark):
    rng = random.Random(9)
    urls = [f"http://x.org/{''.join(rng.choice(['%', '2', '5', '4', '6', '1', 'F', 'f', '3', 'porn', '/', 'D', '%70orn', 'p%6fr%6E', '%2d', 'sex']) for _ in range(10))}" for _ in range(3000)]
    df = spark.createDataFrame([*enumerate(urls)], "page_id long, url string")
    con = duckdb.connect()
    pages = df.toPandas()  # noqa: F841 (DuckDB reads it by name)
    assert sorted(con.execute(url_filter.op3_sql()).fetchall()) == sorted(tuple(r) for r in url_filter.judge(df).collect())


# --- packing


def pieces_hold(pieces, texts):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc, text in texts.items():
        want = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(want))
            assert p.ids_crc32 == zlib.crc32(want[at : at + p.length].tobytes())
            at += p.length
        assert at == len(want)
    padding = 0
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding, sum(p.length for p in pieces), by_sequence


def test_packing_covers_every_id(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    padding, total, _ = pieces_hold(packing.op5_packing(spark, sf_dir).collect(), texts)
    assert padding <= 0.01 * total


def test_packing_of_odd_rows(odd, empty):
    once = odd.dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in once.collect()}
    pieces_hold(packing.digests(packing.pack(once)).collect(), texts)
    assert packing.digests(packing.pack(odd)).groupBy().sum("length").first()[0] > 0
    assert packing.pack(empty).count() == 0


def test_packing_of_long_runs(spark):
    long = {i: c * n for i, (c, n) in enumerate([(" ", 3_000_000), ("\n", 1_200_000), ("\t", 1_100_000), ("\u3000", 1_100_000), ("a", 1_000_000), ("-", 1_000_000)])}
    texts = long | {10: "before " + " " * 20_000 + "after <|endoftext|> it", 11: None}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    pieces_hold(packing.digests(packing.pack(df)).collect(), texts)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", " " * 10_001, "\u3000" * 10_000, "x", "'ll", "12", "\U0001f600"]), max_size=8).map("".join))
def test_ids_of_any_text(text):
    path = public_tokenizers.path(packing.TOKENIZER)
    assert packing.token_ids(text, path).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1023), max_size=60))
def test_assignment_is_whole_and_balanced(lengths):
    out = packing.assign(lengths, 1024, 1.0, 0.01)
    for i, n in enumerate(lengths):
        parts = sorted((s, m) for j, s, m, _, _ in out if j == i)
        assert sum(m for _, m in parts) == n and all(a + m == b for (a, m), (b, _) in zip(parts, parts[1:], strict=False))
    used = defaultdict(int)
    for _, _, m, s, _ in out:
        used[s] += m
    assert [used[s] for s in range(len(used))] == packing.capacities(sum(lengths), 1024)


# --- personal data

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def base_pii(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(CARD, text):
        digits = re.sub("[ -]", "", m[0])
        odd, even = digits[-1::-2], digits[-2::-2]
        if 12 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(pii.KINDS[k], s, e) for s, k, e in sorted(out)]


def test_pii_matches_brute_force(spark, sf_dir):
    for sf in (sf_dir, "/root/testdata/sf0.01"):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        for r in pii.op6_pii(spark, sf).collect():
            want = base_pii(texts[r.doc_id] or "")
            assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in want))
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in want) for x in pii.BASE)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab1.5 @-+()_%4\u00e90:/", max_size=60))
def test_pii_base_on_any_text(text):
    assert [x for x in pii.spans(text) if x[0] in pii.BASE] == base_pii(text)


def test_pii_added_spans(odd, empty):
    text = "IBAN: GB82 WEST 1234 5698 7654 32, account no. 12345678; ftp://joe:pw@h.org/x http://h.org/x GB82WEST"
    found = {(k, text[s:e]) for k, s, e in pii.spans(text) if k not in pii.BASE}
    assert found == {("account", "GB82 WEST 1234 5698 7654 32"), ("account", "12345678"), ("address", "ftp://joe:pw@h.org/x")}
    assert pii.redacted(text, pii.spans(text)) == "IBAN: <ACCOUNT>, account no. <ACCOUNT>; <ADDRESS> http://h.org/x GB82WEST"
    assert pii.find(odd).count() == 10 and pii.find(empty).count() == 0
    clean = pii.redact(odd)
    assert clean.schema == odd.schema
    assert {r.text for r in clean.where("doc_id is null or doc_id = 2").collect()} == {None, "a text without an id, mail <EMAIL>"}


# --- secrets

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets_scan.KINDS[k], s, e) for s, k, e in sorted(out)]


def test_secrets_match_brute_force(spark, sf_dir):
    for sf in (sf_dir, "/root/testdata/sf0.01"):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        for r in secrets_scan.op8_secrets(spark, sf).collect():
            want = base_secrets(texts[r.doc_id] or "")
            assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in want))
            assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in want) for x in secrets_scan.BASE)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "api_key", "APIKEY", " ", ":", "=", '"', "a1b2c3", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "x", ".", "to\u212aen=abcdef", "\u017fecret=abcdef"]), max_size=14).map("".join))
def test_secret_base_on_any_text(text):
    got = [(k, s, e) for k, s, e, _ in secrets_scan.spans(text, secrets_scan.Grammar({}, []))]
    assert got == base_secrets(text)


def drawn(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def ordinary_tokens(rng, n):
    """Words, names, file names, dates, versions, identifiers and addresses."""
    word = lambda: drawn(rng, LOWER, rng.randint(3, 12))
    kinds = [
        word, lambda: word().upper(), lambda: word().capitalize() + word().capitalize(), lambda: f"{word()}_{rng.randrange(2000, 2030)}.pdf", lambda: f"/usr/lib/{word()}/{word()}.so.{rng.randrange(9)}",
        lambda: f"20{rng.randrange(10, 30)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}", lambda: f"v{rng.randrange(9)}.{rng.randrange(99)}.{rng.randrange(999)}-rc{rng.randrange(9)}",
        lambda: "-".join(drawn(rng, DIGITS + "abcdef", k) for k in (8, 4, 4, 4, 12)), lambda: f"10.{rng.randrange(1000, 9999)}/{word()}.{rng.randrange(10**6)}", lambda: f"{word()}-{word()}-{word()}", lambda: drawn(rng, DIGITS, 16),
    ]
    return [rng.choice(kinds)() for _ in range(n)]


def test_grammar_learns_formats_and_leaves_words_alone(spark, odd, empty):
    """Held-out recall of three formats, and precision on held-out ordinary tokens of many makes."""
    rng = random.Random(7)
    formats = {
        "assign": lambda: "ghp_" + drawn(rng, LOWER + LOWER.upper() + DIGITS, 36),
        "access": lambda: "AKIA" + drawn(rng, LOWER.upper() + DIGITS, 16),
        "hex": lambda: drawn(rng, DIGITS + "abcdef", 40),
    }
    grammar = secrets_scan.Grammar({k: [f() for _ in range(300)] for k, f in formats.items()}, ordinary_tokens(rng, 20_000))
    for make in formats.values():
        assert sum(grammar.like(make()) for _ in range(300)) >= 0.95 * 300
    words = ordinary_tokens(rng, 20_000)
    assert sum(map(grammar.like, words)) <= 0.001 * len(words)
    fresh = [formats["assign"]() for _ in range(50)]
    assert sum("learned" in {k for k, *_ in secrets_scan.spans(f"a {t} b", grammar)} for t in fresh) >= 47
    assert len(grammar.formats["assign"].states) < 200
    assert secrets_scan.find(odd, secrets_scan.learn(odd)).count() == 10
    assert secrets_scan.find(empty, secrets_scan.learn(empty)).count() == 0


def plain_alergia(strings, alpha):
    """State merging on copied trees: a state is [counts, children], red states and what leads to them."""
    root = [{}, {}]
    for text in strings:
        at = root
        for c in text:
            at[0][c] = at[0].get(c, 0) + 1
            if c == secrets_scan.END:
                break
            at = at[1].setdefault(c, [{}, {}])
    total = lambda s: sum(s[0].values())

    def alike(a, b):
        m, n = total(a), total(b)
        if m and n:
            limit = np.sqrt(0.5 * np.log(2 / alpha)) * (m**-0.5 + n**-0.5)
            if any(abs(a[0].get(c, 0) / m - b[0].get(c, 0) / n) > limit for c in {*a[0], *b[0]}):
                return False
        return not (m and n) or all(alike(t, b[1][c]) for c, t in a[1].items() if c in b[1])

    def fold(a, b):
        for c, n in b[0].items():
            a[0][c] = a[0].get(c, 0) + n
        for c, t in b[1].items():
            if c not in a[1]:
                a[1][c] = t
            elif a[1][c] is not t:
                fold(a[1][c], t)

    red = [root]
    while True:
        blue = [(s, c, t) for s in red for c, t in sorted(s[1].items()) if not any(t is r for r in red)]
        if not blue:
            return red
        s, c, t = max(blue, key=lambda x: total(x[2]))
        twin = next((r for r in red if alike(r, t)), None)
        if twin is None:
            red.append(t)
        else:
            s[1][c] = twin
            fold(twin, t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="dhl", max_size=6), min_size=1, max_size=60), st.sampled_from([0.05, 0.5, 1.5]))
def test_merging_equals_a_plain_version(strings, alpha):
    strings = [s + secrets_scan.END for s in strings]
    got, want = secrets_scan.Automaton(strings, alpha), plain_alergia(strings, alpha)
    assert [dict(got.counts[s]) for s in got.states] == [r[0] for r in want]


def test_every_token_is_scored():
    """Against a scan token by token: no shape is left out before it is scored."""
    rng = random.Random(5)
    grammar = secrets_scan.Grammar({"hex": [drawn(rng, "0123456789abcdef", 40) for _ in range(200)]}, ordinary_tokens(rng, 3000))
    for _ in range(200):
        text = " ".join(rng.choice([*ordinary_tokens(rng, 2), drawn(rng, "0123456789abcdef", rng.randrange(4, 60)), "token=abcdef123", "key"]) for _ in range(12))
        base = base_secrets(text)
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text):
            apart = all(e <= m.start() or s >= m.end() for _, s, e in base)
            if len(m[0]) >= 6 and apart and grammar.score(m[0]) is not None:
                want.append(m.span())
        assert [(s, e) for k, s, e, _ in secrets_scan.spans(text, grammar) if k == "learned"] == want


def test_a_long_text_is_scanned_in_linear_time():
    rng = random.Random(6)
    grammar = secrets_scan.Grammar({"hex": [drawn(rng, "0123456789abcdef", 40) for _ in range(200)]}, ordinary_tokens(rng, 3000))
    text = "token=abcdef123456 word 0123456789abcdef01234567 or 00112233445566778899aa\n" * 14_000
    before = time.process_time()
    assert len(secrets_scan.spans(text, grammar)) >= 28_000
    assert time.process_time() - before < 20


# --- BPE


def test_bpe_matches_the_library(spark, sf_dir):
    for sf in (sf_dir, "/root/testdata/sf0.01"):
        texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        got = {r.doc_id: r for r in bpe.op10_bpe(spark, sf).collect()}
        assert got.keys() == texts.keys()
        for i, text in texts.items():
            ids = TOKENIZER.encode(text, add_special_tokens=False).ids
            assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)))
            assert got[i].decoded_sha256 == sha(TOKENIZER.decode(ids, skip_special_tokens=False))


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "\x1c", "\x85", "hello", "'s", "12", "é", "\U0001f600"]), max_size=12).map("".join))
def test_bpe_on_any_text(text):
    codec = bpe.Codec(bpe.model_at(public_tokenizers.path("byte_bpe_50k.json")), None)
    ids = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert codec.decode(codec.encode(text)) == TOKENIZER.decode(ids, skip_special_tokens=False)


def test_latin_pattern_cuts_alike():
    every = "".join(f"a{chr(c)} {chr(c)}{chr(c)}1{chr(c)} '{chr(c)}\n" for c in range(0x250))
    assert bpe.words_in(every) == bpe._ANY_WORDS(every)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60))
def test_latin_pattern_on_any_text(text):
    assert bpe.words_in(text) == bpe._ANY_WORDS(text)


def test_long_words_merge_alike():
    model = bpe.model_at(public_tokenizers.path("byte_bpe_50k.json"))
    for word in ("ab" * 3000, "x" * 5000, "the" * 40, "qwertyuiop" * 30):
        assert model.merge(word.encode()) == TOKENIZER.encode(word, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(entries=st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=4), max_size=40), others=st.lists(st.binary(max_size=6), max_size=20))
def test_lexicon_gives_ids_of_its_words_only(entries, others):
    path = Path(tempfile.mkdtemp()) / "l.bin"
    path.write_bytes(bpe.compiled([*entries.items()]))
    lexicon = bpe.Lexicon(str(path))
    for w in {*entries, *others}:
        assert lexicon.get(w) == (struct.pack(f"<{len(entries[w])}I", *entries[w]) if w in entries else None)


@pytest.mark.parametrize("words", [0, 50])
def test_bpe_of_odd_rows(odd, empty, words):
    done = bpe.recode(odd, words=words).collect()
    assert sorted((r.decoded for r in done), key=str) == sorted(((r.text or "") for r in odd.select("text").collect()), key=str)
    assert bpe.recode(empty, words=words).count() == 0


def test_a_rare_kind_of_secret_is_learned(spark):
    rows = [(i, f"some ordinary words of text {i}") for i in range(300)] + [(1000 + i, f"key AKIA{i:016d} end") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(secrets_scan.learn(df, sample=5).formats) == {"access"}


def test_grammar_is_counted_over_all_documents(spark):
    """Equal to one fitted on all tokens at hand: 6,000 documents, more credentials than 400, tokens of any length."""
    rng = random.Random(9)
    texts = [" ".join([*ordinary_tokens(rng, 4), f"token={drawn(rng, DIGITS + 'abcdef', 18)}" if i % 10 == 0 else "end", "x" * 300 if i == 77 else ""]) for i in range(6000)]
    df = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labelled, ordinary = {}, set()
    for t in texts:
        base = secrets_scan.base_spans(t)
        for k, _, e, v in base:
            labelled.setdefault(k, set()).add(t[v:e])
        ordinary |= {x for *_, x in secrets_scan.tokens_outside(t, base)}
    got, want = secrets_scan.learn(df), secrets_scan.Grammar({k: sorted(v) for k, v in labelled.items()}, sorted(ordinary))
    assert got.formats["assign"].total[0] >= len(labelled["assign"]) > 400 and got.ordinary.makes.total() == len(ordinary) > 10_000
    assert (got.ordinary.counts, got.above, got.rest) == (want.ordinary.counts, want.above, want.rest)
    assert {k: (a.counts, a.next) for k, a in got.formats.items()} == {k: (a.counts, a.next) for k, a in want.formats.items()}


def test_a_credential_without_a_label_is_found_among_all_tokens(spark):
    """It is one of the tokens that the threshold is made of, and still found."""
    rng = random.Random(10)
    key = lambda: "ghp_" + drawn(rng, LOWER + LOWER.upper() + DIGITS, 36)
    rows = [(i, " ".join([*ordinary_tokens(rng, 5), f"token={key()}" if i % 4 == 0 else "end"])) for i in range(800)] + [(900, f"here is {key()} to use")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets_scan.find(df, secrets_scan.learn(df)).where("doc_id = 900").head().found
    assert [s.kind for s in found] == ["learned"]
