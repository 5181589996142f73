"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct shingles of k words, as 64-bit hashes. With similarity at
least t, a set of n shingles misses at most e = floor((1 - t) n) of its own in any partner, so any
e + 1 of its shingles hold one of the partner's. A sketch is the set's smallest hashes, half as
many again as e + 1 and a few.

* Equal sets are one class. Tasks send the hashes of sketches, packed by bucket, and learn which of
  them other classes have. Of a hash that many classes of one task have, only the number travels.
* Classes whose sketches share a hash are put into groups by a shared hash and a band of set sizes,
  cut into blocks of bounded bytes. It is the least of those that are not rare beside the others, so
  that an edit, which many copies have in common by chance, does not part a text from its family.
* The token-group matrix has a row for each shared hash and group with a member that has it: the
  least and greatest size of those members, and how far their sketches reach.
* A class asks only with the rarest of its sketch: of the first e + 1 by how often they were seen,
  those that any other class has. Most classes ask with none. It does not ask groups whose sketches
  all reach less far than its own: of a pair, the one whose sketch reaches less far finds the other.
* For each class and group found, the overlap of the class's set with the group's union bounds its
  overlap with any member; only groups that qualify are opened, and members are compared whole.

Groups are opened in three turns: each with its own members; then, where many classes of one
component ask the same group, one of them; then every asking class whose component does not yet hold
the whole group. Only asks that can no longer change a component are left out, so a large family of
near copies, which the first turns join, is not compared pair by pair.

Why nothing is lost: take a linked pair and let Q be the one whose sketch reaches less far (whose
largest hash is smaller). What the two share of Q's sketch is then in both sketches, and Q's sketch
lacks at most e of it, so any e + 1 of its hashes, in whatever order Q takes them, hold a shared one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes.llm.common import cut, small_batches, text_or_empty, trim, trimmed
from poseframes.llm.components import Forest, components_sql, connected_components

#: Shingles (8 bytes each) of the members of one block, and of those that ask it in one task.
BLOCK, ASKING = 1 << 19, 1 << 20
#: Hashes that a task gathers before it packs them, and the most classes among them.
CHUNK, CHUNK_CLASSES = 300_000, 60_000
#: Hashes for each bucket, and classes of one task from which on a hash is not sent one by one.
BUCKET, HOT_HERE = 500_000, 64
_OFTEN = 1 << 15
#: A hash that is this many times rarer than the middle one of a sketch does not name its group.
RARE = 2
#: Classes of one component that ask one group, from which on one of them asks first.
CROWD = 8
#: Bytes of text whose words are split in one go, and words whose hashes are remembered.
PIECE, MEMO = 1 << 20, 80_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SPACE = b" \t\n\v\f\r"


def _word_hashes(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    if len(memo) > MEMO:
        memo.clear()
    for w in set(words).difference(memo):
        memo[w] = digest(w)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def _pieces(data: bytes):
    """The text in pieces that end where white space begins."""
    at = 0
    while len(data) - at > PIECE:
        end = at + PIECE
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def shingles(text: str, k: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of the text with A-Z lower-cased; of the
    whole sequence, if it has fewer words; empty without words."""
    w = np.concatenate([_word_hashes(p.split(), memo) for p in _pieces(text.encode().lower())])
    if not len(w):
        return w
    span = min(k, len(w))
    h = np.full(len(w) - span + 1, span, np.uint64)
    for i in range(span):
        h = (h ^ w[i : len(w) - span + 1 + i]) * _A
        h ^= h >> np.uint64(29)
        h = h * _B + _C
    h ^= h >> np.uint64(32)
    return np.unique(h)


def misses(n: int, percent: int) -> int:
    """How many of n shingles a partner can lack: overlap * 100 >= percent * n must hold."""
    return n - -(-percent * n // 100)


def sketch_size(n: int, percent: int) -> int:
    e = misses(n, percent)
    return min(n, (e + 1) * 3 // 2 + 6)


def _digest(s: np.ndarray) -> bytes | None:
    """Of a whole set: two sums of its hashes and its size."""
    if not len(s):
        return None
    mixed = np.bitwise_xor.reduce((s ^ (s >> np.uint64(17))) * _B)
    return int(mixed).to_bytes(8, "little") + int(s.sum(dtype=np.uint64)).to_bytes(8, "little") + len(s).to_bytes(4, "little")


def _tag() -> Column:
    return F.hash("digest")


def _sketches(rows: DataFrame, k: int, percent: int, kind: str) -> DataFrame:
    """``id, n, digest, sketch`` of a table ``id, text``."""

    def run(batches):
        memo: dict[bytes, int] = {}
        for b in small_batches(batches, 500):
            found = []
            for x in b.column(1).to_pylist():
                s = shingles(x, k, memo)
                low = s[: sketch_size(len(s), percent)].copy().view(np.int64) if len(s) else None
                found.append((len(s), _digest(s), low))
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True))], names=["id", "n", "digest", "sketch"])

    return rows.mapInArrow(trimmed(run), f"id {kind}, n long, digest binary, sketch array<long>")


def _packed_sets(rows: DataFrame, k: int, kind: str) -> DataFrame:
    """``rep, digest, packed`` (the whole set) of a table ``rep, text``."""

    def run(batches):
        memo: dict[bytes, int] = {}
        for b in small_batches(batches, 100):
            sets = [shingles(x, k, memo) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "digest", "packed"])

    return rows.mapInArrow(trimmed(run), f"rep {kind}, digest binary, packed binary")


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _pack(rep, tag, n, of, token, buckets: int, here: int) -> pa.RecordBatch:
    """One row a bucket: its hashes and the classes that have them. A hash that more than ``here``
    classes of the chunk have is known to be shared: with their number it goes back by whichever
    bucket its place falls in, and one row more (a number below 0) tells its own bucket."""
    by_rep = np.argsort(rep, kind="stable")
    rep, tag, n = rep[by_rep], tag[by_rep], n[by_rep]
    nth = np.empty(len(by_rep), np.int64)
    nth[by_rep] = np.arange(len(by_rep))
    of = nth[of]
    distinct, at, many = np.unique(token, return_inverse=True, return_counts=True)
    seen = np.where(many > here, np.minimum(many, _OFTEN) * _OFTEN, 0)[at]  # after all that are sent one by one
    told = distinct[many > here]
    bucket = np.where(seen > 0, (token ^ of.astype(np.uint64)) * _A >> np.uint64(32), token * _B >> np.uint64(32)) % np.uint64(buckets)
    of, token, seen = np.r_[of, np.zeros(len(told), np.int64)], np.r_[token, told], np.r_[seen, -many[many > here]]
    bucket = np.r_[bucket, (told * _B >> np.uint64(32)) % np.uint64(buckets)].astype(np.int32)
    order = np.lexsort((of, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[b] : cuts[b + 1]]
        used, short = np.unique(of[own], return_inverse=True)
        who = _squeeze(np.diff(rep[used], prepend=0), n[used].astype("<i4"), tag[used].astype("<i4"))
        rows.append((b, len(own), len(used), who, token[own].tobytes(), _squeeze(short.astype("<u2"), seen[own].astype("<i4"))))
    names = ["bucket", "n", "classes", "who", "tokens", "places"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _send(batches, buckets: int, here: int):
    """Packed hashes of a table ``rep, tag, n, sketch``."""
    held: list[tuple] = []
    count = 0

    def packed():
        base = np.cumsum([0, *(len(h[0]) for h in held)])
        of = np.concatenate([h[3] + b for h, b in zip(held, base)])
        return _pack(*(np.concatenate([h[i] for h in held]) for i in range(3)), of, np.concatenate([h[4] for h in held]), buckets, here)

    for b in small_batches(batches, 1000):
        sizes = b.column(3).value_lengths().to_numpy(zero_copy_only=False)
        flat = b.column(3).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        held.append((*(b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)), np.repeat(np.arange(len(sizes)), sizes), flat))
        count += len(flat)
        if count >= CHUNK or sum(len(h[0]) for h in held) > CHUNK_CLASSES - 1000:
            yield packed()
            held, count = [], 0
    if held:
        yield packed()


def _shared(table: pa.Table) -> pa.Table:
    """``rep, tag, n, df, token``: hashes of classes in this bucket that another class has, and how
    often they were seen."""
    z = zstandard.ZstdDecompressor()
    rep, tag, n, of, token, seen = ([] for _ in range(6))
    classes = 0
    for rows, used, who, tokens, places in zip(*(table[c].to_pylist() for c in ("n", "classes", "who", "tokens", "places")), strict=True):
        who, places = z.decompress(who), z.decompress(places)
        rep.append(np.cumsum(np.frombuffer(who[: 8 * used], np.int64)))
        n.append(np.frombuffer(who[8 * used : 12 * used], "<i4"))
        tag.append(np.frombuffer(who[12 * used :], "<i4"))
        of.append(np.frombuffer(places[: 2 * rows], "<u2").astype(np.int64) + classes)
        seen.append(np.frombuffer(places[2 * rows :], "<i4").astype(np.int64))
        token.append(np.frombuffer(tokens, np.uint64))
        classes += used
    rep, tag, n, of, token, seen = map(np.concatenate, (rep, tag, n, of, token, seen))
    asked = np.flatnonzero(seen <= 0)
    distinct, at = np.unique(token[asked], return_inverse=True)
    df = np.bincount(at, np.where(seen[asked] < 0, -seen[asked], 1), len(distinct)).astype(np.int64)[at]
    plain = seen[asked] == 0
    keep = asked[plain & (df > 1)]
    total = seen.copy()
    total[asked] = df
    keep = np.concatenate([keep, np.flatnonzero(seen > 0)])
    own = of[keep]
    return pa.table({"rep": pa.array(rep[own]), "tag": pa.array(tag[own]), "n": pa.array(n[own]), "df": pa.array(total[keep]), "token": pa.array(token[keep].view(np.int64))})


def _open_group(met: pa.Table, percent: int) -> pa.Table:
    """Links between the asking classes and the members of one block, as a spanning forest. A row
    is a member, or asks, or both."""
    asks, member = (np.array(met[c].to_pylist(), bool) for c in ("asks", "member"))
    sets = [np.frombuffer(x, np.uint64) for x in met["packed"].to_pylist()]
    reps = met["rep"].to_pylist()
    first: dict = {}
    node = [first.setdefault(r, i) for i, r in enumerate(reps)]
    members = np.flatnonzero(member)
    forest = Forest(len(reps))
    if len(members) and asks.any():
        sizes = np.array([len(sets[m]) for m in members])
        flat = np.concatenate([sets[m] for m in members])
        order = np.argsort(flat, kind="stable")
        union, start = np.unique(flat[order], return_index=True)
        stop = np.append(start[1:], len(flat))
        owner = np.repeat(np.arange(len(members)), sizes)[order]
        root = np.array([node[m] for m in members])
        for q in np.flatnonzero(asks):
            n = len(sets[q])
            at = np.searchsorted(union, sets[q])
            there = (at < len(union)) & (union[np.minimum(at, len(union) - 1)] == sets[q])
            held = sketch_size(n, percent)
            if there[:held].sum() < held - misses(n, percent) or 100 * there.sum() < percent * n:
                continue  # the group's union lacks too much for any member to link
            at = at[there]
            many = stop[at] - start[at]
            ends = np.cumsum(many)
            overlap = np.bincount(owner[np.arange(ends[-1]) - np.repeat(ends - many - start[at], many)], minlength=len(members))
            for m in np.unique(root[100 * overlap >= percent * (n + sizes - overlap)]):
                forest.link(int(m), node[q])
    roots = forest.roots()
    moved = [i for i in range(len(reps)) if node[i] == i and roots[i] != i]
    kind = met.schema.field("rep").type
    out = pa.table({"a": pa.array([reps[i] for i in moved], kind), "b": pa.array([reps[roots[i]] for i in moved], kind)})
    trim(met.nbytes)
    return out


def _links(sets: DataFrame, roles: DataFrame, keys: list[str], percent: int, kind: str) -> DataFrame:
    """What the groups of ``roles`` (``rep, tag, asks, member`` and ``keys``) find when opened."""
    met = sets.join(roles.hint("merge"), ["rep", "tag"]).select(*keys, "rep", "packed", "asks", "member")
    return met.groupBy(*keys).applyInArrow(lambda table: _open_group(table, percent), f"a {kind}, b {kind}")


def _candidates(classes: DataFrame, total: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of a table ``rep, tag, n, sketch, reach``: classes that share a hash, ``rep, tag, n, grp, asks``
    (whether they ask at all); and which other groups each asks, ``rep, tag, n, grp``."""
    buckets, here = total // BUCKET + 1, HOT_HERE
    kind = classes.schema["rep"].dataType.simpleString()
    sent = classes.select("rep", "tag", "n", "sketch").mapInArrow(trimmed(lambda b: _send(b, buckets, here)), "bucket int, n long, classes long, who binary, tokens binary, places binary")
    some = sent.groupBy("bucket").applyInArrow(_shared, "rep long, tag int, n int, df long, token long")
    some = some.groupBy(F.col("rep").cast(kind).alias("rep"), "tag").agg(F.any_value("n").cast("long").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    first = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    held = F.least(F.col("n"), F.floor(first * 3 / 2) + 6)  # sketch_size
    asks = F.greatest(F.lit(0), F.least(first - (held - F.size("shared")), F.size("shared"))).cast("int")
    band = F.floor(F.log(F.col("n").cast("double")) / (2 * math.log(100 / min(percent, 95)))).cast("int")
    tokens = F.col("shared")["token"]
    middle = F.element_at("shared", F.floor(F.size("shared") / 2).cast("int") + 1)["df"]
    key = F.array_min(F.filter("shared", lambda s: RARE * s["df"] >= middle)["token"])
    some = some.select("rep", "tag", "n", band.alias("band"), key.alias("key"), tokens.alias("tokens"), asks.alias("asks"), (held - F.size("shared")).alias("alone"))
    some = cut(some.join(classes.select("rep", "tag", "reach").hint("merge"), ["rep", "tag"]), "shared")

    blocks = some.groupBy("key", "band").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    some = some.join(blocks, ["key", "band"]).withColumn("grp", F.xxhash64("key", "band", F.pmod(F.xxhash64("rep", "tag"), "blocks"))).drop("blocks", "key")
    some = cut(some, "groups")
    # Of a group's members that have the hash: the least and greatest size, and how far a sketch reaches.
    matrix = some.select("grp", "n", "reach", F.explode("tokens").alias("token")).groupBy("grp", "token").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("reach").alias("far"))
    asked = some.where("asks > 0").select("rep", "tag", "n", "reach", "alone", F.col("grp").alias("own"), F.posexplode(F.slice("tokens", F.lit(1), F.col("asks"))).alias("nth", "token"))
    # A partner's size is at least so much of the other's, and it has a hash that both share. What a class
    # lacks in a partner of size m is at most n - percent (n + m) / (100 + percent), and the rarest hashes
    # up to that number hold a shared one: larger partners are asked with fewer.
    near = (100 * F.col("high") >= percent * F.col("n")) & (percent * F.col("low") <= 100 * F.col("n")) & (F.col("own") != F.col("grp")) & (F.col("reach") <= F.col("far"))
    least = F.greatest("low", F.ceil(percent * F.col("n") / 100))
    near = near & (F.col("alone") + F.col("nth") <= F.col("n") - F.ceil(percent * (F.col("n") + least) / (100 + percent)))
    asking = asked.join(matrix, (asked["token"] == matrix["token"]) & near).groupBy("rep", "tag", "n", "grp").agg(F.count("*").alias("hits"))
    return some.select("rep", "tag", "n", "grp", (F.col("asks") > 0).alias("asks")), cut(asking, "asking")


def _still_open(asking: DataFrame, some: DataFrame, component: DataFrame) -> DataFrame:
    """Asks whose class is not in one component with the whole group yet; ``at``: the class's
    component, ``asks_here``: how many of it ask this group."""
    at = F.coalesce("component", "rep").alias("at")
    by_grp = some.join(component, F.col("rep") == F.col("id"), "left").select("grp", at).groupBy("grp").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    left = asking.join(component, F.col("rep") == F.col("id"), "left").select(*asking.columns, at).join(by_grp, "grp").where("at != low or at != high")
    return left.select(*asking.columns, "at", F.count("*").over(W.partitionBy("grp", "at")).alias("asks_here"))


def _turn(open_: DataFrame, some: DataFrame, sets: DataFrame, percent: int, kind: str) -> DataFrame:
    """Links that the groups which are asked in ``open_`` find."""
    parts = F.ceil(F.sum("n").over(W.partitionBy("grp")) / ASKING)
    asks = open_.select("rep", "tag", "grp", parts.alias("parts")).select("rep", "tag", "grp", F.pmod(F.xxhash64("rep", "tag"), "parts").alias("part"), F.lit(True).alias("asks"), F.lit(False).alias("member"))
    members = some.select("rep", "tag", "grp").join(open_.groupBy("grp").agg(F.ceil(F.sum("n") / ASKING).alias("parts")), "grp")
    members = members.select("rep", "tag", "grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(False).alias("asks"), F.lit(True).alias("member"))
    return cut(_links(sets, asks.unionByName(members), ["grp", "part"], percent, kind), "links")


def similar_documents(docs: DataFrame, k: int = 3, percent: int = 90, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row its id, ``n_shingles`` and ``component_id``: the least id that links reach.

    Two documents link when 100 * intersection >= percent * union of their sets. Null, empty and
    blank texts have an empty set and link with nothing. Equal sets link with each other. Rows that
    share an id are one document with the links of each of its texts. Ids must be integers; rows
    whose id is null are not compared and have a null component. Other columns are ignored, an
    empty table gives an empty one.

    Shuffled are the sketches, the shared hashes, the texts once by id, and the sets of classes that
    ask or are asked. Groups are blocks of bounded bytes and those who ask are dealt in parts, so no
    similar set of documents, however large, comes to one task; tasks return a forest of links,
    never pairs.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    sketches = cut(_sketches(rows, k, percent, kind), "sketches")
    total = sketches.agg(F.sum(F.size("sketch").cast("long"))).first()[0] or 0
    # A class is its least id and a short tag, which tells apart the texts of one id. A sketch reaches to
    # its largest hash; hashes are unsigned.
    reach = F.element_at("sketch", -1).bitwiseXOR(F.lit(-(1 << 63)))
    classes = sketches.where(F.col("digest").isNotNull() & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value(reach).alias("reach"))
    some, asking = _candidates(classes.withColumn("tag", _tag()), total, percent)

    met = some.groupBy("grp").agg(F.count("*").alias("members"), F.max("asks").alias("any"))
    own = some.join(met.where("members > 1 and any"), "grp").select("rep", "tag", "grp")
    other = asking.select("grp").distinct().join(some, "grp").select("rep", "tag")
    needed = own.select("rep", "tag").unionByName(asking.select("rep", "tag")).unionByName(other).distinct()
    # What is needed grows with the corpus: hints keep Spark from sending it to all executors.
    texts = rows.where(F.col("id").isNotNull()).join(needed.select(F.col("rep").alias("id")).distinct().hint("merge"), "id", "left_semi")
    sets = _packed_sets(texts, k, kind).withColumn("tag", _tag()).drop("digest")
    sets = cut(sets.join(needed.hint("merge"), ["rep", "tag"], "left_semi"), "sets")

    roles = own.join(some.select("rep", "tag", "asks"), ["rep", "tag"]).withColumn("member", F.lit(True))
    links = cut(_links(sets, roles, ["grp"], percent, kind), "links")
    open_ = cut(_still_open(asking, some, links.select(F.col("a").alias("id"), F.col("b").alias("component"))), "open")
    best = open_.where(F.col("asks_here") >= CROWD).groupBy("grp", "at").agg(F.max(F.struct("hits", "rep", "tag", "n")).alias("best")).select("grp", "best.*")
    best = cut(best, "best")
    if not best.isEmpty():
        links = links.unionByName(_turn(best, some, sets, percent, kind))
        component = cut(connected_components(links, "a", "b"), "components")
        crowd = _still_open(open_.where(F.col("asks_here") >= CROWD).select(*asking.columns), some, component)
        open_ = cut(open_.where(F.col("asks_here") < CROWD).unionByName(crowd), "open")
        links = component.select(F.col("id").alias("a"), F.col("component").alias("b"))  # joins the same
    links = links.unionByName(_turn(open_, some, sets, percent, kind))

    # Documents with several texts join the classes of all of them.
    held = cut(sketches.select("id", "digest").join(classes.select("digest", "rep"), "digest").select("id", "rep"), "held")
    several = held.groupBy("id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most").select("id", "least")
    more = held.join(several, "id").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    component = connected_components(links.unionByName(more), "a", "b")
    per_rep = held.join(component.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("component_id"))
    per_id = per_rep.groupBy("id").agg(F.min("component_id").alias("component_id"))
    return sketches.select("id", "n").join(per_id, "id", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


#: For DuckDB: all pairs of documents that share a shingle. Ids must be distinct.
ORACLE_SQL = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
  FROM flat a JOIN flat b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM met WHERE 100 * common >= 90 * (n + m - common)),
{components_sql("documents", "doc_id")}
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets s JOIN components c ON c.id = s.doc_id
"""
