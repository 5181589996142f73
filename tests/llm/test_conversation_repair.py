"""Repair of conversations against a search of all edits by plain dynamic programming."""

import hashlib
import random
import zlib

import pytest

from poseframes.llm import conversation_repair as R

KINDS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Cost, letters and turns: rows are (role, text, gone, cut)."""
    best = {0: (0, "", ())}

    def insert(best):
        for _ in range(3):
            for i, (c, a, t) in list(best.items()):
                j = R.NEXT[i]
                way = (c + 5, a + "I", (*t, R.ROLES[j] + ":"))
                best[j] = min(best.get(j, way), way)
        return best

    for role, text, gone, cut in rows:
        then = {}
        for i, (c, a, t) in insert(best).items():
            ways = [(i, (c + 2, a + "D", t))]
            if not gone:
                j, own = R.NEXT[i], "-sua".index(role[:1]) if role[:1] and role[:1] in "sua" else 0
                if own == j or own == 1 and i == 0:
                    ways.append((own, (c + 5 * cut, a + "K", (*t, f"{role}:{text}"))))
                ways.append((j, (c + 1 + 5 * cut, a + "R", (*t, f"{R.ROLES[j]}:{text}"))))
            for j, way in ways:
                then[j] = min(then.get(j, way), way)
        best = then
    best = insert(best)
    return min(best[i] for i in (0, 3) if i in best)


def expected(rows):
    """The query's row for each conversation of (conv_id, turn, role, text)."""
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            bare = text.rstrip(SPACES)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marked.append((role, text, fault in (0, 1), fault == 2))
        cost, letters, turns = cheapest(marked)
        numbers = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out[conv] = (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(turns).encode()).hexdigest())
    return out


def check(spark, rows):
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repaired_damage(spark.createDataFrame(rows, KINDS)).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k], k


def random_rows(rng, convs, longest):
    texts = ["Yes.", "No", "", " \n", "Why?\t", "Because of that!", "a . ", "é ß", "x" * 3000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "U", "admin"]
    return [(c, rng.choice([t, t, t, None, t // 2]), rng.choice(roles), rng.choice([*texts, None, f"{t} {c}.", f"{t}"])) for c in [None, *range(convs)] for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_search(spark, seed):
    check(spark, random_rows(random.Random(seed), 120, 14))


def test_long_conversations_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    for _ in range(200):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 2, 3, 5, 6, 7, 8, 10, 11]) for _ in range(rng.randint(0, 40)))
        whole = R.search(codes)[1]
        with monkeypatch.context() as m:
            m.setattr(R, "WHOLE", 0)
            m.setattr(R, "BLOCK", rng.choice([1, 2, 5, 16]))
            assert "".join(R.edits(codes)) == whole
    check(spark, [(1, t, rng.choice(["user", "assistant", "system"]), f"{t}{rng.choice(['.', '.', '!', ''])}") for t in range(3000)])


def test_bound_is_never_above_the_cost(spark):
    rng = random.Random(9)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 6, 7, 8, 9]) for _ in range(rng.randint(0, 12)))
        rows = [(("x", "system", "user", "assistant")[c & 3], "", c & 8, bool(c & 4)) for c in codes]
        cost, letters = R.search(codes)
        assert R._Bound(codes)(0, 0) <= cost and (cost, letters) == cheapest(rows)[:2]


def test_copies_of_one_row(spark):
    """One conversation that is mostly one row, in one turn and in many."""
    rows = [(7, 3, "user", "Same.")] * 5000 + [(7, t, "user", "Same.") for t in range(4, 900)] + [(7, 2, "assistant", "Other.")] + [(c, 0, "user", "Hi.") for c in range(20)]
    check(spark, rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], KINDS)
    assert R.repaired_damage(empty).collect() == [] and R.repair(empty).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(dropped, 0, "user", "Gone.")])
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")], KINDS)
    more = df.select("*", F.lit(1).alias("n"), F.lit(2).alias("seq"), F.lit("x").alias("edit"), F.lit(3).alias("a.b"), F.lit(0).alias("copies"))
    assert [tuple(r)[1:] for r in R.repair(more).orderBy("seq").collect()] == [(0, "K", 1, 0, None, "user", "user", "Hi."), (1, "K", 1, 1, None, "assistant", "assistant", "Ho.")]
    named = df.withColumnRenamed("role", "who is").withColumnRenamed("text", "a.b")
    assert R.repair(named, role="who is", text="a.b").count() == 2
