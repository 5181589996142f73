"""Tokens, counts, quality and language: per-document operators against plain versions."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from poseframes.llm import byte_bpe as B
from poseframes.llm import compression_bands as Q
from poseframes.llm import language_id as L
from poseframes.llm import token_counts as T
from poseframes.llm.common import ranks_of

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "it's  we'll\n\n x", "naïve 漢字 😀 ", "ab" * 9000, "word " * 8000, " " * 500 + "=" * 300, "<|endoftext|> </s> ▁ ▁▁a"]
TEXTS += ["".join(random.Random(i).choice("ab th'é\n1 ") for _ in range(300)) for i in range(20)]
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(RANKS), special_tokens={})


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)] + [(3, "a", "z")], "doc_id long, text string, ids string")


def test_bpe_equals_the_library(docs):
    got = {r["doc_id"]: r for r in B.digest_documents(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        ids = TIK.encode_ordinary(t or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_bpe_round_trip(docs):
    both = B.decode_documents(B.encode_documents(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    assert all(bytes(r["decoded"]) == (TEXTS[r["doc_id"]] or "").encode() for r in both) and len(both) == len(TEXTS) + 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab '\n\t1é漢s tlre#—"), max_size=120))
def test_halves_join_to_the_whole(text):
    bpe = B.encoder(RANKS, public_tokenizers.PATTERN)
    old, B.LEAF_CHARS = B.LEAF_CHARS, 5
    try:
        assert bpe.matches(text) == bpe.pattern.findall(text)
        assert bpe.encode(text) == TIK.encode_ordinary(text)
    finally:
        B.LEAF_CHARS = old


def test_joins_make_the_tokens(monkeypatch):
    """Every match that is not one token comes out of joins, and the definition sees windows only."""
    bpe = B.ByteBPE(RANKS, public_tokenizers.PATTERN)
    joined, windows = [], []
    join, merge = bpe.join, bpe.merge
    monkeypatch.setattr(bpe, "join", lambda a, b: joined.append(join(a, b)) or joined[-1])
    monkeypatch.setattr(bpe, "merge", lambda data: windows.append(data) or merge(data))
    rng = random.Random(21)
    words = {"".join(rng.choice("aeiouklmnprstéü漢9#") for _ in range(rng.randint(2, 40))) for _ in range(400)}
    for w in words:
        joined.clear()
        ids = bpe.encode_match(w)
        assert ids == TIK._encode_single_piece(w.encode()) and (len(ids) == 1 or len(w.encode()) <= B.SHORT or joined[-1] == ids)
    assert max(map(len, windows)) < 40 and sum(len(x) > 24 for x in windows) < 0.02 * len(windows)


def test_texts_are_matched_by_halves(monkeypatch):
    bpe, seams = B.ByteBPE(RANKS, public_tokenizers.PATTERN), []
    join = bpe.join_matches
    monkeypatch.setattr(bpe, "join_matches", lambda a, b: seams.append(1) or join(a, b))
    text = "some words, 12 more…  and it's\n\nso on " * 3000
    assert bpe.encode(text) == TIK.encode_ordinary(text) and len(seams) >= len(text) // B.LEAF_CHARS - 1
    assert bpe.decode(TIK.encode_ordinary(text)) == text.encode()


def test_counts_equal_the_library(docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r["doc_id"]: r for r in T.token_counts(docs, MODEL, limit=100).collect()}
    for i, t in enumerate(TEXTS):
        n = len(lib.encode(t or ""))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 100)


def test_parts_add_up():
    whole = T.text_lengths([t or "" for t in TEXTS], MODEL, part_chars=1 << 30)
    for size in (1, 3, 64):
        assert T.text_lengths([t or "" for t in TEXTS], MODEL, part_chars=size, batch_bytes=50) == whole


def test_quality(spark):
    rng = random.Random(12)
    prose = " ".join("".join(rng.choice("th on er an in re ed of to is at en or es ti ha st nd ing tion ble ly ou the and".split()) for _ in range(rng.randint(1, 4))) for _ in range(900))
    noise = "".join(chr(rng.randint(0x21, 0x7E)) + " " * (rng.random() < 0.1) for _ in range(9000))
    texts = [None, "", "a b", prose, prose[:700], noise, "one two three " * 200, "Line a\nLine a\n \n \nx # <", prose + "\n" + "ab " * 4000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ratio int")
    got = {r["doc_id"]: r for r in Q.compression_bands(df).collect()}
    for i, t in enumerate(texts):
        words = (t or "").split()
        win = list(zip(words, words[1:], words[2:]))
        rep = {j + d for j, w in enumerate(win) if win.count(w) > 1 for d in range(3)} if len(win) < 1500 else None
        assert got[i]["n_words"] == len(words) and got[i]["word_chars"] == sum(map(len, words))
        assert rep is None or got[i]["n_repeat_words"] == len(rep)
    assert (got[7]["n_dup_lines"], got[7]["n_symbols"]) == (1, 2)
    assert [got[i]["kept"] for i in range(9)] == [False, False, False, True, True, False, False, False, False]
    assert got[6]["base_failed"] and not got[5]["base_failed"]


def _prose(rng, parts):
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))


def test_language(spark):
    rng = random.Random(13)
    parts = {"aa": ["ka", "ko", "ri", "mu"], "bb": ["sch", "ung", "ein", "öl"], "cc": ["ção", "lh", "nh", "os"]}
    rows = [(i, _prose(rng, parts[k]), k, 0) for i, k in ((i, rng.choice("abc") * 2) for i in range(300))] + [(900, None, "aa", 0), (901, "123 !?", "bb", 0), (902, "", "cc", 0), (903, "ka ko", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r["doc_id"]: r for r in L.identify(df, L.learn(df), keep=("doc_id",)).collect()}
    tested = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(tested) > 40 and sum(got[r[0]]["lang_pred"] == r[2] for r in tested) >= 0.98 * len(tested)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902)) and all(0 <= r["score"] <= 1 for r in got.values())
    held = {r["doc_id"]: r["h"] for r in df.select("doc_id", L.held_out().alias("h")).collect()}
    assert held == {r[0]: zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows}
    nothing = L.identify(df, L.learn(df.where("lang is null"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert L.identify(df.limit(0), L.learn(df.limit(0))).collect() == []


def test_folded_weights_are_kernel_ridge_regression(monkeypatch):
    """Against Nyström features and ridge regression with the kernel spelled out."""
    monkeypatch.setattr(L, "LANDMARKS", 8)
    rng = random.Random(14)
    parts = {"aa": ["ka", "ko", "ri"], "bb": ["sch", "ung", "öl"], "cc": ["ção", "lh", "os"]}
    labels = [rng.choice(["aa", "aa", "bb", "cc"]) for _ in range(40)]
    texts = [_prose(rng, parts[x]) for x in labels]
    model = L.fit(L.presence(texts), labels)

    def grams(text):
        spaced = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split(" "))
        slots = {int(i) for i in np.flatnonzero(L.presence([spaced])[0])}
        assert len(slots) > 3
        return slots

    sets = [grams(t) for t in texts]
    k = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    seen, turns = {}, []
    for i, x in enumerate(labels):
        seen[x] = seen.get(x, -1) + 1
        turns.append((seen[x], i))
    marks = [sets[i] for _, i in sorted(turns)[:8]]
    values, vectors = np.linalg.eigh(np.array([[k(a, b) for b in marks] for a in marks]))
    root = vectors[:, values > 1e-6 * values[-1]] / np.sqrt(values[values > 1e-6 * values[-1]])
    feature = lambda s: np.append(np.array([k(s, m) for m in marks]) @ root, 1.0)
    x = np.array([feature(s) for s in sets])
    weight = np.array([len(labels) / (3 * labels.count(c)) for c in labels])
    for j, lang in enumerate(("aa", "bb", "cc")):
        goal = np.array([1.0 if c == lang else -1.0 for c in labels])
        w = np.linalg.solve((x.T * weight) @ x + L.RIDGE * np.eye(x.shape[1]), (x.T * weight) @ goal)
        for t in texts[:10] + ["ka ko sch", "öl öl os"]:
            row = L.presence([t])[0]
            folded = row @ model.weights[:, j] / row.sum() ** 0.5 + model.bias[j]
            assert abs(folded - feature(grams(t)) @ w) < 1e-3


def test_presence_is_that_of_plain_grams():
    def mix(x):
        x = x * 0x9E3779B97F4A7C15 % 2**64
        return x ^ x >> 31

    rng = random.Random(16)
    for text in ("", "123 !", "a", "É b", "Ab-ab 12 ab", "".join(rng.choice("abCé1 .\n") for _ in range(300))):
        plain = "".join(c if c.isalpha() else " " for c in text.lower())
        while "  " in plain:
            plain = plain.replace("  ", " ")
        slots = set()
        if plain.strip():
            # one space may stand at either end
            for n in L.ORDERS:
                for i in range(len(plain) - n + 1):
                    h = 0
                    for c in plain[i : i + n]:
                        h = (h * 0x100000001B3 + mix(ord(c) + 1)) % 2**64
                    slots.add(((h + n) * 0x9E3779B97F4A7C15 % 2**64) >> 48)
        assert set(np.flatnonzero(L.presence([text])[0]).tolist()) == slots, text


def test_presence_of_long_texts(monkeypatch):
    rng = random.Random(15)
    texts = ["".join(rng.choice("abc é1-  ") for _ in range(n)) for n in (0, 3, 50, 400, 2000)] + ["  " * 300 + "ab" + " 1" * 200 + "c", "123"]
    whole = L.presence(texts)
    for size in (1, 5, 17, 100):
        monkeypatch.setattr(L, "PIECE", size)
        assert (L.presence(texts) == whole).all()


def test_language_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "ka ko ri", "aa", 1.5, "x")], "doc_id long, text string, lang string, score double, lang_pred string")
    got = L.identify(df, L.learn(df), keep=tuple(df.columns), names=("p", "q"))
    assert got.columns == [*df.columns, "p", "q"] and got.first()["score"] == 1.5
    with pytest.raises(ValueError):
        L.identify(df, L.learn(df), keep=("score",))


def test_fit_reads_bits_and_keeps_little():
    """From bits as from bytes, without all of them or the landmarks spread out at once."""
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 256, (600, L.SLOTS // 8), np.uint8) & rng.integers(0, 256, (600, L.SLOTS // 8), np.uint8)
    labels = [("aa", "bb", "cc")[i % 3] for i in range(600)]
    tracemalloc.start()
    model = L.fit(bits, labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    plain = L.fit(np.unpackbits(bits, axis=1), labels)
    assert np.array_equal(model.weights, plain.weights) and np.array_equal(model.bias, plain.bias)
    assert most < 64 << 20, most
