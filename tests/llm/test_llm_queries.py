"""The registered queries over whole tables: against their SQL, or against libraries and plain loops."""

import hashlib
import os

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import zstandard

from poseframes.llm import compression_bands as Q
from poseframes.llm import queries as L
from poseframes.llm import training_order as O
from poseframes.llm.common import ranks_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(L.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    got, want = L.QUERIES[name](spark, SF).toPandas(), duck.execute(L.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) == len(want)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    for c in columns:
        if got[c].dtype == np.float64:
            assert np.allclose(got[c], want[c], rtol=1e-9)
        else:
            assert (got[c] == want[c]).all(), c


def test_op4_held_out_languages(spark):
    got = L.QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    lang = dict(duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet' where lang is not null and regexp_matches(text, '[a-zA-Z]')").fetchall())
    own = got[got.held_out & got.index.isin(list(lang))]
    assert len(own) > 100 and (own.lang_pred == [lang[i] for i in own.index]).mean() > 0.97 and got.score.between(0, 1).all()


def test_op5_verdicts(spark, texts):
    bands, zstd = Q.Bands(), zstandard.ZstdCompressor(level=3)
    for r in L.QUERIES["op5_compression_bands"](spark, SF).collect():
        text = texts[r["doc_id"]] or ""
        words, data = text.encode().split(), text.encode()
        seen: dict = {}
        for i in range(len(words) - 2):
            seen.setdefault(tuple(words[i : i + 3]), []).append(i)
        repeated = len({i + d for at in seen.values() if len(at) > 1 for i in at for d in range(3)})
        lines = [x for x in text.split("\n") if x.encode().split()]
        failed = len(words) < 50 or 100 * repeated > 50 * len(words)
        assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"], r["base_failed"]) == (len(words), repeated, len(lines) - len(set(lines)), failed)
        assert (r["word_chars"], r["n_symbols"]) == (sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"))
        if not data:
            assert not r["kept"] and r["ratio"] is None
            continue
        ratio = len(zstd.compress(data)) / len(data)
        low, high = [(lo, hi) for below, lo, hi in bands.whole if below is None or len(data) < below][0]
        full = [data[i * 4096 : (i + 1) * 4096] for i in range(len(data) // 4096)]
        bad = sum(not bands.chunk[0] <= len(zstd.compress(x)) / 4096 <= bands.chunk[1] for x in full)
        assert (r["ratio"], r["bad_chunks"]) == (ratio, bad)
        assert r["kept"] == (not failed and low <= ratio <= high and bad <= bands.bad_chunks * len(full))


def test_op7_whole_order(spark, texts):
    got = L.QUERIES["op7_training_order"](spark, SF).collect()
    sequences = {(i, p): t.encode()[p * O.LENGTH : (p + 1) * O.LENGTH] for i, t in texts.items() if t for p in range(-(-len(t.encode()) // O.LENGTH))}
    assert sorted(r["slot"] for r in got) == list(range(len(sequences)))
    assert {(r["doc_id"], r["part"]): r["sha256"] for r in got} == {k: hashlib.sha256(v).hexdigest() for k, v in sequences.items()}


def test_op8_and_op9_equal_the_libraries(spark, texts):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in L.QUERIES["op8_byte_bpe"](spark, SF).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    got = pd.DataFrame(L.QUERIES["op9_token_counts"](spark, SF).collect(), columns=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    assert got.n_tokens.tolist() == [len(lib.encode(texts[i] or "")) for i in got.doc_id] and (got.over_limit == (got.n_tokens > 4096)).all()
