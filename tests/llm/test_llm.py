"""Text operators against brute force on small texts, and their SQL on the small tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from oracle import same

from wavetide.llm import codes, encode, leaks, queries, spans

NASTY = [None, "", "   ", "a", "<|endoftext|> is text", "naïve ﬁ İstanbul ΟΔΟΣ ß", "👩‍👩‍👧 नमस्ते 日本語", "\u0000﻿ ", "x" * 70_000, "ab " * 30_000, "é́" * 50]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def docs_of(spark, texts, extra="sig long, lo long, text_ string, ids string"):
    return spark.createDataFrame([(i, t, i, i, "x", "y") for i, t in texts], f"doc_id long, text string, {extra}")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    df = queries.QUERIES[name](spark, f"{DATA}/sf0.001")
    if name in queries.SQL:
        _, ours, theirs = same(df, queries.SQL[name], f"{DATA}/sf0.001")
        assert (ours, theirs) == ([], [])
    else:
        df.collect()


# 8
def test_encode_and_decode(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(encode.TOKENIZER)
    own.encode_special_tokens = True
    texts = list(enumerate(NASTY)) + [(None, "null id"), (3, "a")]
    got = encode.encode(docs_of(spark, texts))
    assert rows(got) == sorted(((i, own.encode(t or "", add_special_tokens=False).ids) for i, t in texts), key=repr)
    assert 50256 not in [x for r in got.collect() for x in r.ids]
    assert rows(encode.decode(got)) == sorted(((i, t or "") for i, t in texts), key=repr)
    assert rows(encode.encode(docs_of(spark, []))) == []
    broken = spark.createDataFrame([(1, [own.encode("👩", add_special_tokens=False).ids[0]]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert rows(encode.decode(broken)) == [(1, "�"), (2, ""), (3, "")]


def test_token_spans(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(encode.TOKENIZER)
    own.encode_special_tokens = True
    for r in encode.encode_with_spans(docs_of(spark, enumerate(NASTY))).collect():
        text = NASTY[r.doc_id] or ""
        want = own.encode(text, add_special_tokens=False)
        assert r.ids == want.ids and len(r.split) == len(r.ids)
        assert [(a, b) for a, b in zip(r.starts, r.ends)] == [tuple(x) for x in _spans_by_hand(text, own, r.ids)]
        if r.ids:
            assert r.starts[0] == 0 and r.ends[-1] == len(text) and not r.split[0]


def _spans_by_hand(text, own, ids):
    table = encode.token_bytes(encode.TOKENIZER)[0]
    owner = [k for k, c in enumerate(text) for _ in c.encode()]
    at = 0
    for i in ids:
        n = len(table[i])
        yield owner[at], owner[at + n - 1] + 1
        at += n


# 9
def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word.lower().replace("ς", "σ"))
            word = ""
    return out


def leaks_by_hand(docs, items, size):
    out = {}
    for i, t in docs:
        d = words(t)
        for j, u in items:
            w = words(u)
            best = 0
            for a in range(len(d)):
                for b in range(len(w)):
                    n = 0
                    while a + n < len(d) and b + n < len(w) and d[a + n] == w[b + n]:
                        n += 1
                    best = max(best, n)
            if best >= size and i is not None and j is not None:
                out[i, j] = max(best, out.get((i, j), 0))
    return sorted(((i, j, n) for (i, j), n in out.items()), key=repr)


@pytest.mark.parametrize("item_chars", [8_000_000, 300])
def test_leaks(spark, monkeypatch, item_chars):
    monkeypatch.setattr(leaks, "ITEM_CHARS", item_chars)
    rng = random.Random(1)
    vocabulary = ["Alpha", "beta", "γάμμα", "ΟΔΟΣ", "δ4", "日本", "x"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, make(rng.randrange(3, 14))) for k in range(12)] + [(50, ["same"] * 9)]
    docs = []
    for k in range(60):
        text = make(rng.randrange(0, 30))
        if k % 2:
            w = rng.choice(items)[1]
            a = rng.randrange(len(w))
            text[5:5] = [x.swapcase() for x in w[a : a + 8]]
        docs.append((k, rng.choice([", ", "\n+", "--", "_"]).join(text)))
    docs += [(70, None), (71, ""), (72, "same " * 50), (None, "same " * 50), (73, "Same-same " * 4), (5, docs[5][1])]
    told = [(k, " ".join(w), 1) for k, w in items] + [(60, None, 1), (61, "", 1), (None, "same " * 20, 1), (3, " ".join(items[3][1]), 1)]
    df = spark.createDataFrame(told, "item_id long, text string, doc_id long")
    got = leaks.find_leaks(docs_of(spark, docs).repartition(3), df, 5)
    assert rows(got.select("doc_id", "item_id", "n_words")) == leaks_by_hand(docs, [(a, b) for a, b, _ in told], 5)
    clean = leaks.without_leaks(docs_of(spark, docs), got)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {r.doc_id for r in got.collect()}
    assert rows(leaks.find_leaks(docs_of(spark, docs), df.limit(0), 5)) == rows(leaks.find_leaks(docs_of(spark, []), df, 5)) == []


def test_suffix_array_and_places():
    rng = np.random.default_rng(2)
    tokens = rng.integers(1, 4, 300)
    order = leaks.suffix_array(tokens, 300)
    assert order.tolist() == sorted(range(300), key=lambda k: tokens[k:].tolist())
    wanted = np.array([tokens[k : k + 6] for k in range(290)])
    lo, hi = leaks.bisect(tokens, order, wanted, False), leaks.bisect(tokens, order, wanted, True)
    for k in range(290):
        assert sorted(order[lo[k] : hi[k]]) == [j for j in range(295) if tokens[j : j + 6].tolist() == wanted[k].tolist()]
    tests = leaks.TestSuffixes.of([(7, "a b c d e f")], 4)
    got = leaks.search_shard(pa.array(["x b C d-E z", "a b c d", None, "a b c", "q a b c d e f g"]), tests)
    assert [g.tolist() for g in got] == [[0, 1, 4], [7, 7, 7], [4, 4, 6], [1, 0, 0], [1, 0, 1]]


# 10
def spans_by_hand(docs, span):
    where = {}
    for i, t in docs:
        for s in range(len(t or "") - span + 1):
            where.setdefault(t[s : s + span], set()).add(i)
    out = set()
    shared = {}
    for i, t in docs:
        if i is not None:
            for s in range(len(t or "") - span + 1):
                if len(where[t[s : s + span]] - {None}) > 1:
                    shared.setdefault(i, set()).update(range(s, s + span))
    for i, chars in shared.items():
        run = sorted(chars)
        start = run[0]
        for a, b in zip(run, [*run[1:], None]):
            if b != a + 1:
                out.add((i, start, a + 1))
                start = b
    return sorted(out, key=repr)


def made_up_docs(seed, n, alphabet):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    stock = [make(rng.randrange(10, 60)) for _ in range(8)]
    docs = []
    for k in range(n):
        parts = [make(rng.randrange(0, 25))]
        for _ in range(rng.randrange(0, 4)):
            w = rng.choice(stock)
            a = rng.randrange(len(w))
            parts += [w[a:] if rng.random() < 0.5 else w, make(rng.randrange(0, 8))]
        docs.append((k, "".join(parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "short"), (n + 3, stock[0] + "!" + stock[0]), (None, stock[1]), (n + 4, "ab" * 60), (n + 5, "ab" * 45), (n + 6, "z" * 100), (3, docs[3][1]), (4, docs[7][1] + "?")]
    return docs


@pytest.mark.parametrize(("alphabet", "group", "most", "hot"), [("ab", 64, 500, 10_000), ("ab", 1, 3, 5), ("abcdefgh日👩é", 64, 0, 2), ("abcdefgh日👩é", 2, 20, 30)])
def test_shared_spans(spark, monkeypatch, alphabet, group, most, hot):
    """Broadcast and shuffled, with and without hot signatures."""
    monkeypatch.setattr(spans, "HOT", hot)
    monkeypatch.setattr(spans, "BITS", 1 << (7 if hot == 2 else 27))
    docs = made_up_docs(len(alphabet), 50, alphabet)
    got = spans.shared_spans(docs_of(spark, docs).repartition(4), 16, group, (most, most))
    assert rows(got) == spans_by_hand(docs, 16)


def test_no_row_of_a_key_is_left_out(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    rows_ = spark.range(-50, 20_000).withColumnRenamed("id", "k")
    left = {r.k for r in spans.maybe_in(rows_, keys, ["k"]).collect()}
    assert set(range(0, 3000, 3)) <= left and len(left) < 1100


def test_anchors_and_joint_windows():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 20, 200).astype(np.uint64) << np.uint64(40)
    assert spans.anchors(tokens, 13).tolist() == [k + int(np.argmin(tokens[k : k + 13])) for k in range(188)]
    texts = pa.array(["".join(rng.choice(list("abc"), 120)), "short", "".join(rng.choice(list("abc"), 90))])
    codes_, offsets = codes.code_points(texts)
    sig, text, anchor, s0, s1, ctx = spans.compact_windows(codes_, offsets, 30, 8, 2)
    for t, n in ((0, 120), (2, 90)):
        covered = [s for a, b in zip(s0[text == t], s1[text == t]) for s in range(a, b + 1)]
        assert covered == list(range(n - 29))  # each start once
    one = spans.compact_windows(codes_, offsets, 30, 8, 1)
    # each joint window lies within one window of the first hash
    assert all(any(a >= c and b <= d and x == y for c, d, y, u in zip(one[3], one[4], one[2], one[1]) if u == t) for a, b, x, t in zip(s0, s1, anchor, text))


def test_shared_spans_of_many_copies(spark):
    text = "".join(chr(97 + (k * k + k // 3) % 26) for k in range(900))
    docs = [(k, f"{k:>04d}" * (k % 3) + text[(k % 5) * 7 : 600 + k]) for k in range(120)] + [(500, text[:255]), (501, text[300:])]
    assert rows(spans.shared_spans(docs_of(spark, docs))) == spans_by_hand(docs, 256)
    share = {r.doc_id: (r.n_chars, r.n_shared) for r in spans.shared_share(docs_of(spark, docs), spans.shared_spans(docs_of(spark, docs))).collect()}
    assert share[500] == (255, 0) and share[1][1] <= share[1][0]
    assert rows(spans.shared_spans(docs_of(spark, []))) == []


def test_hashes_of_stretches():
    c, offsets = codes.code_points(pa.array(["abcabc", None, "日👩", "abc"]))
    assert offsets.tolist() == [0, 6, 6, 8, 11]
    h = codes.Stretches(c)
    a = h.of(np.array([0, 3, 8, 1]), np.array([3, 6, 11, 4]))
    assert a[0] == a[1] == a[2] != a[3] and h.windows(3)[0] == a[0]


def test_the_rest_does_not_need_this_subpackage():
    import pathlib

    root = pathlib.Path(spans.__file__).parent.parent
    for p in root.rglob("*.py"):
        if p.parent.name != "llm":
            assert "wavetide.llm" not in p.read_text(), p
