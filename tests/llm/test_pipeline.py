"""The stages against plain versions, and the columns they keep."""

import corpus_pipeline as C
import public_tokenizers
import tiktoken

from poseframes.llm import language_id as L
from poseframes.llm.common import cut, ranks_of

SF = "/root/testdata/sf0.001"


def grams(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def targets(docs):
    """Words wanted of each source: weights 3, 1, 2 in turn, 150% in all, none above twice its size."""
    sizes = {}
    for name, n in docs.values():
        sizes[name] = sizes.get(name, 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, out, left, total = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}, set(names), 1.5 * sum(sizes.values())
    while left:
        share = {s: (total - sum(out.values())) * weight[s] / sum(weight[x] for x in left) for s in left}
        full = {s for s in left if share[s] > 2 * sizes[s]}
        out |= {s: 2 * sizes[s] for s in full} if full else share
        left = left - full if full else set()
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES:
        docs = cut(stage(spark, docs, SF), name)
        kept[name] = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
    source = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.learn(frame)
    names, scores = L.predict(model, [r["text"] for r in source.values()])
    first = {i for i, n, s in zip(source, names, scores) if n != "und" and s >= L.ACCEPT}
    assert {r["doc_id"] for r in kept["language_id"]} == first

    ids = sorted(first)
    sets, up = [grams(source[i]["text"]) for i in ids], list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    second = {ids[i] for i in range(len(ids)) if root(i) == i}
    assert {r["doc_id"] for r in kept["jaccard_join"]} == second

    seen: dict[bytes, int] = {}
    third = {}
    for i in sorted(second):
        data = source[i]["text"].encode()
        gone = bytearray(len(data))
        for j in range(len(data) - 49):
            if seen.setdefault(data[j : j + 50], i) < i:
                gone[j : j + 50] = b"\1" * 50
        text, out, at = source[i]["text"], [], 0
        for c in text:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                out.append(c)
            at += n
        third[i] = "".join(out)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept["suffix_dedup"]} == {i: (t, len(t)) for i, t in third.items()}

    mixed = [r["doc_id"] for r in kept["source_mix"]]
    assert set(mixed) <= set(third) and max(map(mixed.count, mixed)) <= 2
    words = sum(len(t.split()) for t in third.values())
    assert abs(sum(len(third[i].split()) for i in mixed) - 1.5 * words) < 0.5 * words
    for name, target in targets({i: (source[i]["source"], len(third[i].split())) for i in third}).items():
        own = [i for i in mixed if source[i]["source"] == name]
        taken, largest = sum(len(third[i].split()) for i in own), max(len(third[i].split()) for i in third if source[i]["source"] == name)
        assert abs(taken - target) <= max(2 * largest, 0.1 * target), (name, taken, target)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert sorted((r["doc_id"], r["n_tokens"]) for r in kept["byte_bpe"]) == sorted((i, len(enc.encode_ordinary(third[i]))) for i in mixed)


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns that clash, an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, _size long, key long, marks string, rep long"
    words = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota", "kappa lambda my"]
    prose = lambda i: " ".join(words[(i * j) % 4] + f" w{i * 7 % 31}x{j}" for j in range(1, 40))
    rows = [(i, prose(i), "aa", "s" if i % 3 else None, 1, 0.5, "x", 3, 4, "m", 5) for i in range(40)]
    rows += [(100, None, None, None, None, None, None, None, None, None, None), (101, "", "aa", "s", 0, *rows[0][5:]), (None, prose(3), "aa", "s", 9, *rows[0][5:])]
    rows += [rows[5], rows[5], (102, prose(7) + " the end", None, "s", 1, *rows[0][5:]), (103, "long text " * 60_000, "aa", "s", 1, *rows[0][5:]), (104, "123 !", "aa", "s", 5, *rows[0][5:])]
    frame = spark.createDataFrame(rows, schema)
    for docs in (frame, frame.limit(0)):
        for name, stage in C.STAGES:
            got = cut(stage(spark, docs, SF), name)
            kept = [r["doc_id"] for r in got.collect()]
            if name != "byte_bpe":
                assert got.columns == frame.columns
                assert {r["key"] for r in got.collect()} <= {4, None}
            if name == "language_id" and docs is frame:
                assert not {100, 101, 104} & set(kept) and kept.count(5) == 3 and {102, 103, None} <= set(kept)
            if name == "jaccard_join" and docs is frame:
                assert 102 not in kept and kept.count(5) == 3 and None in kept
            if name == "suffix_dedup" and docs is frame:
                assert len(kept) == docs_before and all(r["n_chars"] == len(r["text"]) for r in got.collect() if r["text"] is not None)
            docs_before = len(kept)
            docs = got if name != "byte_bpe" else docs
        if docs_before == 0:
            break
