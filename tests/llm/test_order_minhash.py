"""Order MinHash against the plain definition, and its likeness against edits of known size."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from poseframes.llm import order_minhash as M
from poseframes.llm import queries as L

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string"


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def plain(text):
    """The signature, one k-mer and one permutation at a time."""
    seen, numbered = Counter(), []
    for at in range(max(len(text) - M.K + 1, min(len(text), 1))):
        h = 0
        for c in text[at : at + M.K]:
            h = (h * 0x100000001B3 + ord(c) + 1) % 2**64
        h = mixed(h)
        numbered.append((mixed((h + seen[h] * 0x9E3779B97F4A7C15) % 2**64) >> 32, at, h))
        seen[h] += 1
    out = []
    for f in M._FACTORS.tolist():
        least = sorted((e * f % 2**32, at, h) for e, at, h in numbered)[: M.PER]
        x = len(least)
        for _, _, h in sorted(least, key=lambda k: k[1]):
            x = mixed((x ^ h) * 0x9E3779B97F4A7C15 % 2**64)
        out.append(x >> 48)
    return np.array(out, "<u2").tobytes()


def expected(rows):
    """doc_id: the query's other columns, for distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out, made = {}, {}
    for k, (i, t) in enumerate(rows):
        following, n = rows[(k + 1) % len(rows)][1], len(t) // 4
        other = t[: len(t) - n] + following[:n]
        a, b, c = (made.setdefault(x, plain(x)) for x in (t, other, following))
        out[i] = (len(t), hashlib.sha256(other.encode()).hexdigest(), a.hex(), b.hex(), M.likeness(a, b), M.likeness(a, c))
    return out


def texts(rng):
    words = ["été", "the", "cat", "sat", "🙂🙂", "on", "a", "mat\n", "abc" * 4]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 10, 60, 200]))) for _ in range(60)]


def test_rows_equal_the_plain_definition(spark):
    rng = random.Random(1)
    some = texts(rng)
    rows = [(None, "nobody's text, at the beginning"), *((7 * i - 50, t) for i, t in enumerate(some)), (1000, None), (1001, "x"), (1002, some[20]), (1003, some[20]), (1004, "abcdefgh"), (1005, "abcdefg")]
    want = expected(rows)
    rng.shuffle(rows)
    for parts in (1, 7):
        got = {r["doc_id"]: tuple(r)[1:] for r in M.fingerprints(spark.createDataFrame(rows, KINDS).repartition(parts)).collect()}
        assert got == want


def test_whole_table_of_documents(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = {r["doc_id"]: tuple(r)[1:] for r in L.QUERIES["op12_order_minhash"](spark, SF).collect()}
    assert got.keys() == {i for i, _ in rows}
    order = sorted(rows)
    for k in range(0, len(order), 9):  # every ninth in full, the plain way being slow
        (i, t), (_, following) = order[k], order[(k + 1) % len(order)]
        n = len(t or "") // 4
        other = (t or "")[: len(t or "") - n] + (following or "")[:n]
        assert got[i][:2] == (len(t or ""), hashlib.sha256(other.encode()).hexdigest())
        if len(t or "") < 4000:
            assert got[i][2:4] == (plain(t or "").hex(), plain(other).hex())
    own = [g for g in got.values() if g[0] > 400]
    assert np.mean([g[4] > g[5] for g in own]) > 0.9 and 0.2 < np.mean([g[4] for g in own]) < 0.7


def test_long_texts_are_taken_in_classes(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abc") for _ in range(3000))
    other = text[:2200] + "".join(rng.choice("abd") for _ in range(900))
    want = [plain(text), plain(other)]
    assert M.signatures(text, other, 2200) == want
    for held, piece, block in ((700, 256, 64), (100, 1000, 4096), (1 << 21, 50, 7)):
        with monkeypatch.context() as m:
            m.setattr(M, "HELD", held)
            m.setattr(M, "PIECE", piece)
            m.setattr(M, "BLOCK", block)
            assert M.signatures(text, other, 2200) == want and M.signatures(text) == want[:1]


def test_likeness_tells_order_and_edits(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(6))
    near, far, moved = [], [], []
    for _ in range(30):
        a = [word() for _ in range(400)]
        b = [w if rng.random() > 0.01 else word() for w in a]
        c = a[200:] + a[:200]
        s = [M.signatures(" ".join(x))[0] for x in (a, b, [word() for _ in range(400)], c)]
        near.append(M.likeness(s[0], s[1]))
        far.append(M.likeness(s[0], s[2]))
        moved.append(M.likeness(s[0], s[3]))
    assert min(near) > 0.5 and max(far) < 0.1 and 0.3 < np.mean(moved) < 0.7  # half of the pairs turn round


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None)] * 3, [(5, "Only one.")], [(5, "One and the same text.")] * 40])
def test_odd_tables(spark, rows):
    got = M.fingerprints(spark.createDataFrame(rows, KINDS)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = rows[0][1] or ""
        n = len(t) // 4
        assert r["fingerprint"] == plain(t).hex() and r["near_next"] == 1 and r["edited_fingerprint"] == plain(t[: len(t) - n] + t[:n]).hex()


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a text", 1, 2, "x"), (2, "another", 3, 4, "y")], "doc_id long, `a.b` string, part int, n_chars int, head string")
    assert {r["doc_id"]: r["n_chars"] for r in M.fingerprints(df, text="a.b").collect()} == {1: 6, 2: 7}
