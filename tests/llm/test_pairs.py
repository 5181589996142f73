"""Similar documents and vectors against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from poseframes.llm import components as C
from poseframes.llm import embedding_dedup as E
from poseframes.llm import jaccard_join as J
from poseframes.llm.components import connected_components


def components(n, links):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def grams(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize(("block", "here", "piece"), [(1 << 19, 64, 1 << 20), (100, 2, 7)])
def test_jaccard_equals_all_pairs(spark, monkeypatch, block, here, piece):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "ASKING", block)
    monkeypatch.setattr(J, "HOT_HERE", here)
    monkeypatch.setattr(J, "PIECE", piece)
    monkeypatch.setattr(J, "BUCKET", 1000)
    monkeypatch.setattr(J, "CROWD", here // 8 + 1)
    rng = random.Random(9)
    texts = []
    for _ in range(12):
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 40)) for _ in range(rng.choice([1, 2, 3, 12, 30, 80, 200]))]
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(["é", "X1", "a1", "漢"])
            texts.append(rng.choice([" ", "\n", "\t "]).join(w[: rng.choice([len(w), len(w) - 1])]).replace("a", rng.choice("aA")))
    texts += [None, "", " \t", "one", "ONE", "two words", "Two words", "x " * 5000, "x " * 4000]
    sets = [grams(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, rep string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.similar_documents(df).collect()}
    want = components(len(texts), links)
    assert len(set(want)) < len(want) - 10
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("block", [1 << 19, 200])
def test_jaccard_at_the_threshold(spark, monkeypatch, block):
    """Families of a few texts, links just above and just below the limit, larger and smaller partners."""
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(block)
    texts = []
    for f in range(120):
        n = rng.choice([3, 5, 12, 19, 20, 21, 40, 100, 190, 400])
        base = [f"f{f}w{i}" for i in range(n + 2)]
        for _ in range(rng.randint(2, 4)):
            lost, new = rng.randint(0, n // 9 + 1), rng.randint(0, n // 18 + 1)
            w = base[: len(base) - lost] if rng.random() < 0.5 else base[lost:]
            w = w + [f"f{f}n{rng.randint(0, 10**6)}" for _ in range(new)] if rng.random() < 0.7 else w
            texts.append(" ".join(w))
    sets = [grams(t) for t in texts]
    own = [int(t.split("w")[0][1:]) if "w" in t else -1 for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if own[i] == own[j] and sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    want = components(len(texts), links)
    assert len(texts) * 0.3 < len(set(want)) < len(texts) * 0.9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in J.similar_documents(df).collect()} == dict(enumerate(want))


def test_jaccard_family_with_edits_in_common_is_in_few_groups(spark, monkeypatch):
    """Copies of one text too far from each other to link, with four words for all edits: each asks
    every other group of the family, so that these must not become more with its size."""
    tables, write = {}, J.cut

    def kept(df, label):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(J, "cut", kept)
    rng = random.Random(600)
    texts = []
    for _ in range(600):
        w = [f"i{i}" for i in range(150)]
        for i in rng.sample(range(150), 6):
            w[i] = f"e{rng.randrange(4)}"
        texts.append(" ".join(w))
    found = {r["component_id"] for r in J.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(found) > 200
    assert tables["groups"].select("grp").distinct().count() <= 8


def test_jaccard_repeats_and_no_rows(spark):
    df = spark.createDataFrame([(4, "a b c"), (4, "a b c"), (9, "A b c"), (9, "q r s"), (None, "a b c")], "doc_id int, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in J.similar_documents(df).collect() if r["doc_id"]) == [(4, 4), (4, 4), (9, 4), (9, 4)]
    assert J.similar_documents(df.limit(0)).collect() == []


def test_jaccard_joins_all_texts_of_a_document(spark):
    rows = [(1, "x one text here"), (2, "y other text here"), (5, "x one text here"), (5, "y other text here"), (8, "z"), (9, None), (9, "z")]
    got = {(r["doc_id"], r["component_id"]) for r in J.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (8, 8), (9, 8)}
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(90))
    rows = [(3, a), (4, b), (5, a + " more"), (5, b + " more")]
    assert {r["component_id"] for r in J.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {3}


@pytest.mark.parametrize("here", [64, 1])
def test_hashes_of_one_class_only_are_not_shared(here):
    rng = np.random.default_rng(3)
    sketches = [np.unique(rng.integers(0, 400, 40)) for _ in range(30)]
    batches = [pa.record_batch({"rep": pa.array(range(i, i + 10)), "tag": pa.array([7] * 10, pa.int32()), "n": pa.array([len(s) for s in sketches[i : i + 10]]), "sketch": pa.array([s.tolist() for s in sketches[i : i + 10]], pa.list_(pa.int64()))}) for i in (0, 10, 20)]
    sent = [x for b in batches for x in J._send([b], 4, here)]
    got: dict = {}
    for bucket in range(4):
        own = pa.Table.from_batches(sent)
        own = own.filter(pa.compute.equal(own["bucket"], bucket))
        for r in J._shared(own).to_pylist() if own.num_rows else ():
            assert (r["tag"], r["n"]) == (7, len(sketches[r["rep"]]))
            assert r["df"] > 1
            got.setdefault(r["rep"], []).append(r["token"])
    many = [set(s.tolist()) for s in sketches]
    assert {i: sorted(t) for i, t in got.items()} == {i: sorted(x for x in s if sum(x in o for o in many) > 1) for i, s in enumerate(many)}


@pytest.mark.parametrize(("block", "small"), [(1024, 64), (16, 64), (1024, 1), (16, 4)])
def test_vectors_equal_all_pairs(spark, monkeypatch, block, small):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "SMALL", small)
    monkeypatch.setattr(E, "LOT", 100)
    rng = np.random.default_rng(10)
    base = rng.standard_normal((6, 32))
    x = np.vstack([b + rng.standard_normal((25, 32)) * s for b, s in zip(base, (0.1, 0.2, 0.25, 0.3, 0.4, 0.5))])
    x = np.vstack([x, np.repeat(x[:1], 40, 0), x[:3] * 7])
    label = [int(i) for i in rng.integers(0, 2, len(x))]
    rows = [(i, [float(v) for v in row], lab) for i, (row, lab) in enumerate(zip(x, label))]
    odd = [None, [], [0.0] * 32, [1.0] * 31 + [None], [float("nan")] * 32, [float("inf")] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], None)]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None])
    np.fill_diagonal(linked, False)
    comp = components(len(x), np.argwhere(linked))
    want = {i: (int(n), c, i == c) for i, (n, c) in enumerate(zip(linked.sum(1), comp))} | {1000 + i: (0, 1000 + i, True) for i in range(6)} | {1006: (1, 1006, True), 1007: (1, 1006, False), 2000: (0, 2000, True)}
    df = spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, label int, class string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.near_duplicates(df).collect()}
    found = sum(v[0] for v in got.values())
    assert found >= 0.99 * sum(v[0] for v in want.values())
    assert all(got[k][0] <= want[k][0] for k in want) and {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


@pytest.mark.parametrize("n", [400, 3200])
def test_vectors_recall_and_work(n):
    """Pairs at 0.93 to 0.95 of one label: how many meet, and how many others do, at two sizes."""
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((n // 2, 64))
    side -= (side * x[: n // 2]).sum(1, keepdims=True) * x[: n // 2]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.93, 0.95, (n // 2, 1))
    x[n // 2 :] = cosine * x[: n // 2] + np.sqrt(1 - cosine**2) * side
    p = E.tables_for(n, 0.93)
    keys = E.hashes(x, p)
    met = (keys[: n // 2] == keys[n // 2 :]).any(1).mean()
    assert met >= 0.97
    vain = sum(int((c * (c - 1) // 2).sum()) for c in (np.unique(keys[:, t], return_counts=True)[1] for t in range(p.tables)))
    assert vain <= n * p.tables * (E.SPARE + 0.5)  # in proportion to vectors and tables, not to pairs


def test_links_of_a_label_only(spark):
    """A third of the vectors in one family, in two labels, with columns of any name."""
    rng = np.random.default_rng(12)
    centre = rng.standard_normal(16)
    rows = [(i, [float(v) for v in (centre + rng.standard_normal(16) * 0.1 if i % 3 == 0 else rng.standard_normal(16))], f"{i % 2}", 7) for i in range(300)]
    df = spark.createDataFrame(rows, "v long, e array<float>, class string, label int")
    got = {r["v"]: r for r in E.near_duplicates(df, id_col="v", label="class", embedding="e").collect()}
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.93) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(linked, False)
    want = components(300, np.argwhere(linked))
    assert {i: r["component_id"] for i, r in got.items()} == dict(enumerate(want))
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * linked.sum() > 3000


def test_components(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (500, None)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = components(600, [(a, b) for a, b in links if b is not None])
    assert got == {i: want[i] for i in {x for a, b in links if b is not None and a != b for x in (a, b)}}


def test_stars_end_at_once(spark, monkeypatch):
    """Links that are stars around the least id need no round, others end as soon as they are."""
    cuts = []
    cut = C.cut
    monkeypatch.setattr(C, "cut", lambda df, label: cuts.append(label) or cut(df, label))
    run = lambda links: {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert run([(5, 1), (1, 7), (1, 7), (4, 3), (2, 2), (None, 1)]) == {1: 1, 5: 1, 7: 1, 3: 3, 4: 3} and cuts == ["links"]
    assert run([]) == {} and cuts == ["links"] * 2
    assert run([(1, 3), (2, 3)]) == {1: 1, 2: 1, 3: 1} and cuts == ["links"] * 3 + ["stars"]
    assert run([(1, 2), (2, 3)]) == {1: 1, 2: 1, 3: 1}
