"""Against brute force: every 50-byte string of every document."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from poseframes.llm import suffix_dedup as S
from poseframes.llm.run_length_index import RunLengthIndex


def brute(rows, k=50):
    seen, out = {}, []
    rows = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0))
    for i, b in rows:
        if i is not None:
            for j in range(len(b) - k + 1):
                w = b[j : j + k]
                seen[w] = min(seen.get(w, i), i)
    for i, b in rows:
        on = np.zeros(len(b), bool)
        for j in range(len(b) - k + 1):
            if i is not None and seen[b[j : j + k]] < i:
                on[j : j + k] = True
        spans = int((np.diff(np.r_[False, on, False].astype(int)) == 1).sum())
        out.append((i, len(b), int(on.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~on].tobytes()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _id int")
    got = S.removal_digest(df).collect()
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got], key=str)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéü漢") for _ in range(rng.randint(1, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 25))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        rows.append((rng.choice([i, i, i, -i]), rng.choice(" \n").join(parts)))
    rows += [(500, None), (501, ""), (502, "ab" * 400), (503, "xab" + "ab" * 400), (504, "a" * 49), (505, "a" * 49), (None, passages[0] * 3), (506, passages[0] * 3)]
    rows += [(600, passages[1] * 2), (600, passages[1] * 2), (601, passages[2] + "!"), (601, passages[3] + passages[2])]
    assert run(spark, rows) == brute(rows)


def test_long_texts_are_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 64)
    rng = random.Random(6)
    base = "".join(rng.choice("abcd ") for _ in range(900))
    rows = [(i, base[rng.randint(0, 300) : rng.randint(400, 900)] + rng.choice("xyz") + base[:200]) for i in range(12)]
    doc, pos, size, *_ = S.segments([t.encode() for _, t in rows], 50)
    for d, (_, t) in enumerate(rows):  # the segments' strings are all strings of the text, once each
        own = np.concatenate([np.arange(p, p + n) for p, n in zip(pos[doc == d], size[doc == d])])
        assert sorted(own.tolist()) == list(range(len(t.encode()) - 49))
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_index_gives_matching_statistics():
    rng = random.Random(7)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 90))) for _ in range(30)]
    index = RunLengthIndex(texts, np.arange(30), 50)
    joined = b"\0".join(texts)
    patterns = [bytes(rng.choice(b"abz") for _ in range(rng.randint(1, 60))) for _ in range(20)] + texts[:5]
    for p, at, length, _, where in index.stream(patterns):
        for i, j, n, w in zip(p, at, length, where):
            tail = patterns[i][j:]
            assert joined[w : w + n] == tail[:n]
            assert n == max(m for m in range(len(tail) + 1) if m == 0 or any(tail[:m] in t for t in texts))


def test_shortened_texts_are_whole_characters(spark):
    a = "é" * 40 + "z"
    df = spark.createDataFrame([(1, a, "x"), (2, "ü" + a + "q", "x"), (3, None, "x")], "doc_id int, text string, _spans string")
    got = {r["doc_id"]: r["text"] for r in S.remove_repeats(df).collect()}
    assert got == {1: a, 2: "üq", 3: None}


def around_one_anchor(n=60):
    """Documents that hold one phrase between neighbours of which some recur."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 7)))
    left, right = ([" ".join(word() for _ in range(12)) for _ in range(7)] for _ in range(2))
    phrase = "the very phrase that everybody has"
    return [(i, f"{rng.choice(left) if rng.random() < 0.5 else word() * 9} {phrase} {rng.choice(right) if rng.random() < 0.5 else word() * 9}") for i in range(n)]


def asked(rows, hot, here):
    docs = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["key", "text"])
    return S._decide(pa.Table.from_batches(list(S._send([docs], 50, 1, here))), hot).to_pylist()


def test_forms_of_a_hot_anchor_are_not_indexed_together():
    rows = around_one_anchor()
    every = asked(rows, 10**9, 10**9)
    fringe = [m["at"] for m in every if m["kind"] in S._FRINGES]
    assert max(map(fringe.count, set(fringe))) > 40 and not any(m["kind"] == S._STRINGS for m in every)
    for hot, here in ((5, 10**9), (10**9, 5)):  # found out in the bucket, and in the task
        some = asked(rows, hot, here)
        fringe = [m["at"] for m in some if m["kind"] in S._FRINGES]
        assert max(map(fringe.count, set(fringe)), default=0) <= 5
        assert {(m["id"], m["pos"]) for m in every if m["kind"]} <= {(m["id"], m["pos"]) for m in some}  # none is left out


def test_a_task_tells_the_bucket_of_a_hot_anchor():
    """Two tasks: one with many forms of an anchor, one with a single one that they share strings with."""
    rows = around_one_anchor()
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in part]), pa.array([t for _, t in part])], names=["key", "text"]) for part in (rows, [(99, rows[0][1][:-3])])]
    sent = [x for b in batches for x in S._send([b], 50, 1, 5)]
    marks = S._decide(pa.Table.from_batches(sent), 10**9).to_pylist()
    hot = {m["at"] for m in marks if m["kind"] == S._STRINGS and m["id"] != 99}
    assert hot and not any(m["at"] in hot for m in marks if m["kind"] in S._FRINGES)
    assert any(m["at"] in hot for m in marks if m["id"] == 99 and m["kind"] == S._STRINGS)


def copied():
    """One anchor in many forms, and copies of some documents."""
    rows = around_one_anchor()
    return rows + [(100 + i, "before " * (i % 3) + rows[i][1] + " after") for i in range(20)]


def judged(rows, hot=10**9):
    """Verdicts on documents in one bucket and one index, without Spark."""
    marks = sorted(asked(rows, hot, 10**9), key=lambda m: (m["id"], m["kind"], m["pos"]))
    claims = next(S._merge([pa.Table.from_pylist(marks, schema=S._ASKED).to_batches()[0]])).to_pylist()
    wanted = {}
    for m in claims:
        wanted.setdefault(m["id"], []).append(m)
        if m["kind"] == S._CLAIM:
            wanted.setdefault(m["owner"], []).append(m | {"kind": S._REGION, "pos": m["at"]})
    texts = [(i, t, wanted.get(i, [])) for i, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in texts]), pa.array([t for _, t, _ in texts]), pa.array([w for _, _, w in texts], pa.list_(pa.struct(list(S._ASKED))))], names=["key", "text", "v_asked"])
    return S._search(pa.Table.from_batches(list(S._copies([batch], 50, 1, 0, 1))), 50)


def test_the_index_decides(monkeypatch):
    """Every string that goes is one that matching statistics found; without matches none does."""
    rows = copied()
    assert sum(judged(rows)["len"].to_pylist()) > 1000
    stream = RunLengthIndex.stream
    monkeypatch.setattr(RunLengthIndex, "stream", lambda self, p: ((a, b, np.minimum(c, 49), d, e) for a, b, c, d, e in stream(self, p)))
    assert judged(rows).num_rows == 0


def test_wrong_claims_are_refused(monkeypatch):
    """Hashes that often agree by chance make claims that the index refuses: what goes is right."""
    rows = copied()
    right, whole = {}, {}
    for i, t in sorted(rows):
        data = t.encode()
        right[i] = {j for j in range(len(data) - 49) if whole.setdefault(data[j : j + 50], i) < i}
    real = S._segments

    def weak(texts, k):
        doc, start, size, anchor, seg = real(texts, k)
        return doc, start, size, anchor, (seg % np.uint64(3) + np.uint64(1)) << np.uint64(40)

    monkeypatch.setattr(S, "_segments", weak)
    found = judged(rows).to_pylist()
    assert found
    for m in found:
        assert set(range(m["v_pos"] + m["lo"], m["v_pos"] + m["lo"] + m["len"])) <= right[m["v_id"]]


def test_columns_of_any_name(spark):
    a = "a passage that is long enough to be found again, word for word, somewhere else"
    schema = "doc_id int, text string, _id int, _codes int, key int, v_id int, c0 int, c1 int, marks int, _spans int"
    df = spark.createDataFrame([(i, t, *range(8)) for i, t in ((1, a), (2, a + "!"), (None, a), (None, a), (3, ""))], schema)
    got = S.remove_repeats(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"], *r[2:]) for r in got.collect()) == sorted((i, t, *range(8)) for i, t in ((1, a), (2, "!"), (0, a), (0, a), (3, "")))
    spans = S.repeated_spans(df)
    assert spans.columns == [*df.columns, "_spans_"] and {r["_spans_"][1] for r in spans.where("doc_id = 2").collect()} == {len(a)}


def test_hot_anchors_equal_brute_force(spark, monkeypatch):
    rows = around_one_anchor() + [(70, around_one_anchor()[3][1]), (70, around_one_anchor()[4][1] + "x"), (None, around_one_anchor()[5][1])]
    for forms, here in ((0, 10**9), (5, 10**9), (10**9, 0), (10**9, 5), (3, 3)):
        monkeypatch.setattr(S, "HOT_FORMS", forms)
        monkeypatch.setattr(S, "HOT_HERE", here)
        assert run(spark, rows) == brute(rows)


def test_buckets_that_get_claims_alone(spark, monkeypatch):
    """Of many buckets, as a large corpus has, a short chunk fills few with segments, and its claims go to others as well."""
    rows = copied()
    docs = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["key", "text"])
    sent = [r for b in S._send([docs], 50, 5000, 10**9) for r in b.to_pylist()]
    assert any(r["n"] == 0 and r["claims"] for r in sent)
    apart = [m for r in sent for m in S._decide(pa.Table.from_pylist([r]), 10**9).to_pylist()]
    assert sorted(apart, key=str) == sorted(asked(rows, 10**9, 10**9), key=str)
    monkeypatch.setattr(S, "HASH_BYTES", 40)
    assert run(spark, rows) == brute(rows)


def test_segments_of_periodic_text_are_told_apart(spark):
    """Sizes 25 and 29 differ in the bit in which the last bytes, e and a, do, four bytes apart in a text of period four."""
    rows = [(1, "the " * 49 + "heintion heintio"), (2, "the " * 50 + "hainea haine"), (3, "the " * 49 + "heintion heintio again")]
    *_, size, _, seg = S.segments([t.encode() for _, t in rows], 50)
    assert all(len(set(size[seg == x])) == 1 for x in set(seg.tolist()))
    assert run(spark, rows) == brute(rows)


def test_order_of_suffixes():
    from poseframes.llm.run_length_index import DEPTH, _suffix_order

    rng = np.random.default_rng(4)
    for alphabet, n in ((2, 300), (4, 900), (1, 70), (200, 500)):
        text = np.r_[rng.integers(1, alphabet + 1, n), 0, rng.integers(1, alphabet + 1, n), 0].astype(np.int16)
        text[n // 2 : n] = text[: n - n // 2]
        order, prefix, _ = _suffix_order(text, 50)
        raw = [tuple(text[i:]) for i in range(len(text))]
        assert order.tolist() == sorted(range(len(text)), key=raw.__getitem__)
        cut = [tuple(np.r_[text[i : i + DEPTH], np.zeros(DEPTH, np.int16)][:DEPTH]) for i in range(len(text))]
        assert all((prefix[i] == prefix[j]) == (cut[i] == cut[j]) for i in range(0, len(text), 7) for j in range(0, len(text), 5))
