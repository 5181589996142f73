"""Structure repair of conversations: the cheapest edits that make the turns alternate.

A row may be kept (K, free), given the role user or assistant (R, 1) or deleted (D, 2); an empty turn
may be inserted before any row or at the end (I, 5). Blank and repeated rows have to go; a truncated
row that stays costs 5 more. What is left has to read ``(s?(ua)+)?`` in the initials of its roles.
Of equally cheap edits those whose letters come first in ASCII are taken.

Each conversation is searched by iterative-deepening A*: a depth-first search that tries edits in
the order D, I, K, R, does not go where cost so far plus a lower bound of the rest is above the
bound, and starts again with the next bound if nothing is found. A table keeps, for each row and
state of the grammar, with how much money left the search failed there; it stays valid from bound to
bound. All costs are whole, so bounds go up by one, and the first path that is accepted is the answer.

A conversation of over WHOLE live rows is searched in blocks of BLOCK rows, once for each pair of
grammar states before and after a block; the cheapest way to each state is carried on. This loses
nothing: edits of a block end with its last row, so two equally cheap ways are never each other's
beginning and what comes first in a block comes first in the whole.

Rows are dealt out by conversation once. First a byte for each row comes, then the rows again with
their texts, in order: a task holds the bytes of one conversation and a batch of its texts. A
conversation that is most of the table still passes one task as a stream, since the digest of its
text can only be made in order; copies of a row are counted before they are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseframes.llm.common import bound_batches, trimmed

#: Costs of the edits, and what a truncated row costs that stays.
KEEP, RETAG, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
#: Bits of a row's code. Its last two: the role's initial (0 is none of the three).
S, U, A, CUT, GONE = 1, 2, 3, 4, 8
#: Grammar states: at the start, after s, u, a. The role that may come next without choice, and the
#: states in which a conversation may end.
ROLES, NEXT, ENDS = {U: "user", A: "assistant"}, (U, U, A, U), frozenset((0, A))
#: Live rows up to which a conversation is searched whole, rows of a block beyond; rows and characters
#: that are put out in one go.
WHOLE, BLOCK, ROWS, CHARS = 512, 64, 1000, 1 << 22


class _Bound:
    """Least cost of the rest from a row and a state: rows that have to be edited whatever the others
    become, and half the neighbours with one role, as an edit may part two of them."""

    def __init__(self, codes: bytes):
        n = len(codes)
        self.base, self.systems, self.pairs = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        last = 0  # the clean role that follows, if no other live row lies between
        for i in range(n - 1, -1, -1):
            c = codes[i]
            self.base[i], self.systems[i], self.pairs[i] = self.base[i + 1], self.systems[i + 1], self.pairs[i + 1]
            if c & GONE:
                self.base[i] += DELETE
            elif c & CUT:
                self.base[i], last = self.base[i] + min(DELETE, TRUNCATED), 0
            elif c == S:
                self.systems[i], last = self.systems[i] + 1, 0
            elif c == 0:
                self.base[i], last = self.base[i] + RETAG, 0
            else:
                self.pairs[i], last = self.pairs[i] + (c == last), c

    def __call__(self, i: int, state: int) -> int:
        return self.base[i] + max(0, self.systems[i] - (state == 0)) + (self.pairs[i] + 1) // 2


def search(codes: bytes, start: int = 0, ends: frozenset[int] = ENDS, tail: bool = True) -> tuple[int, str]:
    """Cost and letters of the cheapest edits from a state to one of ``ends``; ``tail`` tells if turns
    may be inserted after the last row. There has to be a way."""
    n, least = len(codes), _Bound(codes)
    failed: dict[tuple[int, int], int] = {}
    bound = least(0, start)
    while True:
        path, letters = [[0, start, 0, 0]], []
        while path:
            top = path[-1]
            i, state, cost, edit = top
            if edit == 0 and i == n and state in ends:
                return cost, "".join(letters)
            code = codes[i] if i < n else -1
            for edit in range(edit, 4):
                if edit == 0:
                    if code < 0:
                        continue
                    to, letter = (i + 1, state, cost + DELETE), "D"
                elif edit == 1:
                    if code < 0 and not tail:
                        continue
                    to, letter = (i, NEXT[state], cost + INSERT), "I"
                elif code < 0 or code & GONE:
                    continue
                else:
                    extra = TRUNCATED if code & CUT else 0
                    role = code & 3
                    if edit == 2:
                        if role != NEXT[state] and not (role == S and state == 0):
                            continue
                        to, letter = (i + 1, role, cost + KEEP + extra), "K"
                    else:
                        to, letter = (i + 1, NEXT[state], cost + RETAG + extra), "R"
                if to[2] + least(to[0], to[1]) <= bound and failed.get(to[:2], -1) < bound - to[2]:
                    top[3] = edit + 1
                    path.append([*to, 0])
                    letters.append(letter)
                    break
            else:
                failed[i, state] = bound - cost
                path.pop()
                if letters:
                    letters.pop()
        bound += 1


def _reachable(codes: bytes, start: int, end: int) -> bool:
    if end == start or end in (U, A):
        return end == start or bool(codes)
    return start == 0 and end == S and any(c & 3 == S and not c & GONE for c in codes)


def edits(codes: bytes) -> list[str]:
    """The letters for a conversation's rows, in pieces. Each row has one letter that is not I; an I
    stands before the row that it is inserted before."""
    if sum(not c & GONE for c in codes) <= WHOLE:
        return [search(codes)[1]]
    ways = {0: (0, 0)}  # state: cost, place among the ways in the order of their letters
    steps: list[dict[int, tuple[int, str]]] = []
    for at in range(0, len(codes), BLOCK):
        block = codes[at : at + BLOCK]
        found: dict[int, tuple[int, int, str, int]] = {}
        for start, (cost, place) in ways.items():
            for end in range(4):
                if _reachable(block, start, end):
                    more, letters = search(block, start, frozenset((end,)), False)
                    way = (cost + more, place, letters, start)
                    found[end] = min(found.get(end, way), way)
        steps.append({end: (start, letters) for end, (_, _, letters, start) in found.items()})
        order = sorted(found, key=lambda e: found[e][1:3])
        ways = {end: (found[end][0], order.index(end)) for end in found}
    finish = {0: "", S: "II", U: "I", A: ""}
    state = min(ways, key=lambda e: (ways[e][0] + INSERT * len(finish[e]), ways[e][1]))
    pieces = [finish[state]]
    for step in reversed(steps):
        state, letters = step[state]
        pieces.append(letters)
    return pieces[::-1]


_FAULTS = (None, "blank", "duplicate", "truncated")


def _edited(schema: pa.Schema) -> pa.Schema:
    return pa.schema([
        pa.field("conv_id", schema.field("conv_id").type), ("seq", pa.int64()), ("edit", pa.string()), ("times", pa.int64()), pa.field("turn", schema.field("turn").type),
        ("fault", pa.string()), ("was", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ])


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each conversation, from its codes and then its rows."""
    codes, letters, state, seq, out, size, schema = bytearray(), None, 0, 0, [], 0, None

    def put(conv, edit, times, turn, fault, was, role, text):
        nonlocal seq, size
        out.append((conv, seq, edit, times, turn, fault, was, role, text))
        seq += 1
        size += len(text or "")

    def insert(conv, edit):
        nonlocal state
        state = NEXT[state]
        put(conv, edit, 1, None, None, None, ROLES[state], "")

    def flush():
        nonlocal out, size
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
        out, size = [], 0
        return made

    conv = None
    for batch in batches:
        schema = schema or _edited(batch.schema)
        for row in batch.to_pylist():
            if row["second"] == 0:
                if row["place"] == 1:
                    if letters is not None:
                        for x in letters:
                            insert(conv, x)
                    codes, letters, state, seq, conv = bytearray(), None, 0, 0, row["conv_id"]
                codes.append(row["code"])
                continue
            if letters is None:
                letters = (x for piece in edits(bytes(codes)) for x in piece)
            edit = next(letters)
            while edit == "I":
                insert(conv, edit)
                edit = next(letters)
            fault, n = _FAULTS[row["fault"]], row["n"]
            if edit == "D":
                put(conv, "D", n if row["code"] & GONE else 1, row["turn"], fault, row["role"], None, None)
            else:
                state = row["code"] & 3 if edit == "K" else NEXT[state]
                put(conv, edit, 1, row["turn"], fault, row["role"], row["role"] if edit == "K" else ROLES[state], row["text"])
            if n > 1 and not row["code"] & GONE:  # copies of a row, right behind it
                put(conv, "D", n - 1, row["turn"], "duplicate", row["role"], None, None)
            if len(out) >= ROWS or size >= CHARS:
                yield flush()
    if letters is not None:
        for x in letters:
            insert(conv, x)
    if out:
        yield flush()


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """One row for each edit, ``conv_id, seq, edit, times, turn, fault, was, role, text``.

    ``seq`` numbers the edits of a conversation from 0; ``was`` is the role before, ``role`` and
    ``text`` are those after, null for what is deleted. ``times`` is above 1 for copies that are
    deleted together. Rows of one conversation stay in one partition, in order.

    Rows are taken by turn (nulls first), rows of one turn by role and then text, byte by byte. Null
    roles and texts count as one space. A row's first fault counts: blank (only white space),
    duplicate (same role and text as a row before), truncated (the last character that is not white
    space is none of ``.!?``). ``copies`` may name a column of how often a row stands there. A null
    conversation is one of its own, long texts are passed on as they are, other columns are ignored,
    an empty table gives an empty one.
    """
    bound_batches(conversations.sparkSession)
    c = lambda name: F.col(f"`{name}`")
    rows = conversations.select(
        c(conv_id).alias("conv_id"), c(turn).alias("turn"), F.coalesce(c(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(c(text).cast("string"), F.lit(" ")).alias("text"), (c(copies).cast("long") if copies else F.lit(1).cast("long")).alias("n"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).repartition("conv_id")
    rows = rows.withColumn("place", F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long"))
    again = F.row_number().over(W.partitionBy("conv_id", "role", "text").orderBy("place")) > 1
    bare = F.rtrim("text", F.lit(SPACES))
    fault = F.when(bare == "", 1).when(F.col("again"), 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(0)
    code = code + F.when(F.col("fault").isin(1, 2), GONE).when(F.col("fault") == 3, CUT).otherwise(0)
    rows = rows.withColumn("again", again).withColumn("fault", fault).withColumn("code", code).withColumn("second", F.explode(F.array(F.lit(0), F.lit(1))))
    stays = (F.col("second") == 1) & ~F.col("fault").isin(1, 2)
    rows = rows.select("conv_id", "second", "place", "turn", F.when(F.col("second") == 1, F.col("role")).alias("role"), F.when(stays, F.col("text")).alias("text"), "n", "fault", "code")
    rows = rows.sortWithinPartitions("conv_id", "second", "place")
    kinds = rows.schema
    out = T.StructType([
        T.StructField("conv_id", kinds["conv_id"].dataType), T.StructField("seq", T.LongType()), T.StructField("edit", T.StringType()), T.StructField("times", T.LongType()),
        T.StructField("turn", kinds["turn"].dataType), T.StructField("fault", T.StringType()), T.StructField("was", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    return rows.mapInArrow(trimmed(_apply), out)


#: Costs of edits that turn up in a digest: what a truncated row costs is added to them.
_COST = {"K": KEEP, "R": RETAG, "D": DELETE, "I": INSERT}
_LEGAL = ("su", "ua", "au")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Digest:
    """Counts of one conversation, fed with its edits in order."""

    def __init__(self, conv):
        self.conv, self.count, self.audit, self.hash, self.kept = conv, dict.fromkeys(_COUNTS, 0), [], hashlib.sha256(), 0
        self.before, self.first, self.turn, self.turns = None, None, None, 0

    def add(self, edit, times, turn, fault, was, role, text):
        count = self.count
        self.audit.append(edit * times)
        count["cost"] += _COST[edit] * times
        if fault:
            count[fault] += times
            if fault == "truncated" and edit != "D":
                count["cost"] += TRUNCATED
        if edit != "D":
            self.hash.update(f"{chr(10) * (self.kept > 0)}{role}:{text}".encode())
            self.kept += 1
        if edit == "I":
            return
        initial = was[:1]
        count["illegal"] += times - 1 if initial * 2 not in _LEGAL else 0
        count["illegal"] += self.before is not None and self.before + initial not in _LEGAL
        self.before = initial
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1

    def row(self):
        if self.turns:
            self.count["gaps"] = int(self.turn - self.first + 1 - self.turns)
        return (self.conv, *(self.count[c] for c in _COUNTS), "".join(self.audit), self.hash.hexdigest())


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out, schema = None, [], None
    for batch in batches:
        schema = schema or pa.schema([batch.schema.field("conv_id"), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for conv, seq, *edit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if seq == 0:
                if now:
                    out.append(now.row())
                now = _Digest(conv)
            now.add(*edit)
        if len(out) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
            out = []
    if now:
        out.append(now.row())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)


def digest(edited: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of what
    ``repair`` returns: a row for each conversation that has rows. Numbers are those of the rows before
    repair, the hash is that of ``role:text`` lines after it."""
    fields = [T.StructField("conv_id", edited.schema["conv_id"].dataType), *(T.StructField(c, T.LongType()) for c in _COUNTS), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    return edited.mapInArrow(trimmed(_digests), T.StructType(fields))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows hurt by a checksum of conversation and turn. Of
    twenty, one goes, one loses its text, one its full stops, one comes twice, one is given to the
    user. Nulls read as one space, but a null turn stays null."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("_kind")
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind).where("_kind <> 0")
    hurt = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), hurt.alias("text"), F.when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


def repaired_damage(conversations: DataFrame) -> DataFrame:
    """``digest`` of the damaged conversations, with a row for each conversation that there was:
    zeros, an empty audit and the hash of nothing for those of which no row is left."""
    found = digest(repair(damaged(conversations), copies="copies")).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    df = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    empty = {**dict.fromkeys(_COUNTS, F.lit(0).cast("long")), "audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return df.select("conv_id", *(F.coalesce(c, v).alias(c) for c, v in empty.items()))


def _oracle() -> str:
    """All edits by dynamic programming over rows, for DuckDB: the best way to each of the four states
    is a struct that compares by cost and letters. Ids and turns have to be whole numbers."""
    kind = "STRUCT(c BIGINT, l VARCHAR, t VARCHAR)"

    def way(state: int, add: str, letter: str, line: str, only: str = "true") -> str:
        s = f"s{state}"
        return f"CASE WHEN {s} IS NOT NULL AND {only} THEN {{'c': {s}.c + {add}, 'l': {s}.l || '{letter}', 't': {s}.t || {line}}}::{kind} END"

    put = lambda i, j: way(i, str(INSERT), "I", f"'{ROLES[j]}:' || chr(10)")
    # a third turn that is inserted in one place would lead back
    opened = lambda rows: f"SELECT * REPLACE (least(s2, {put(0, 2)}, {put(1, 2)}, {put(3, 2)}) AS s2) FROM ({rows})"
    closed = lambda rows: f"SELECT * REPLACE (least(s3, {put(2, 3)}) AS s3) FROM ({rows})"
    padded = lambda rows: closed(opened(closed(rows)))
    drop = lambda i: way(i, str(DELETE), "D", "''")
    keep = lambda i, own: way(i, f"{KEEP} + stay", "K", "role || ':' || text || chr(10)", f"NOT gone AND initial = '{own}'")
    tag = lambda i, j: way(i, f"{RETAG} + stay", "R", f"'{ROLES[j]}:' || text || chr(10)", "NOT gone")
    to = [drop(0), f"least({drop(1)}, {keep(0, 's')})"]
    to += [f"least({drop(j)}, {', '.join(f'{keep(i, own)}, {tag(i, j)}' for i in before)})" for j, own, before in ((U, "u", (0, S, A)), (A, "a", (U,)))]
    halved = ", ".join(f"c{k + 1} AS (SELECT i, CASE WHEN n % 2 = 1 THEN xor(n // 2, 3988292384) ELSE n // 2 END AS n FROM c{k})" for k in range(8))
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    step = "SELECT w.*, role, text, initial, gone, stay FROM ways w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.pos = w.pos + 1"
    last = "SELECT w.* FROM ways w JOIN (SELECT conv_id, max(pos) AS pos FROM rows GROUP BY conv_id) m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND w.pos = m.pos"
    return f"""
WITH RECURSIVE c0 AS (SELECT range AS i, range AS n FROM range(256)), {halved}, crc AS (SELECT list(n ORDER BY i) AS t FROM c8),
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(string_split({key}, ''), lambda x: ascii(x)::BIGINT), lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind FROM conversations, crc),
hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM kinds)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM hurt),
marked AS (SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
  coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal FROM numbered),
faulty AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN again THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM marked),
rows AS (SELECT *, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN {TRUNCATED} ELSE 0 END AS stay FROM faulty),
ways(conv_id, pos, s0, s1, s2, s3) AS (SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'l': '', 't': ''}}::{kind}, NULL::{kind}, NULL::{kind}, NULL::{kind} FROM rows
  UNION ALL SELECT conv_id, pos + 1, {', '.join(to)} FROM ({padded(step)})),
ended AS (SELECT conv_id, least(s0, s3) AS best FROM ({padded(last)})),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
  count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM rows GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.l, '') AS audit, sha256(coalesce(left(best.t, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted n ON o.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE_SQL = _oracle()
