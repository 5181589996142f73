"""Removal of byte strings that an earlier document has, by run-length compressed indexes.

Every k-byte string has an anchor, the ANCHOR-byte string in it of least hash. Neighbouring strings
of one anchor form a segment, so equal strings are always in segments of equal anchors, and the
corpus can be dealt out by anchor.

* Tasks send hashes of anchors and segments only, packed by bucket of the anchor. Buckets find
  candidates: a segment with the hash of an earlier document's claims to repeat it, and an earliest
  segment whose anchor has other forms in other documents may share some strings with them.
* Claims come together by document and are merged to passages. The earlier document's text of each
  passage goes to an index (``run_length_index``), in pieces of bounded size dealt out by document
  and place. The later document's text of it is streamed through that index, and a string goes where
  the matching statistics reach k bytes with a match in a smaller document. Of many documents that
  claim one passage, one is streamed for all; the others learn its verdict by a join.
* The earliest segments of an anchor in several forms are indexed together and streamed as well.
* An anchor with many forms would fill one index. Each of its strings is then a passage of its own,
  dealt out by its own hash, so different surroundings of one anchor spread while equal strings
  still meet. Tasks with more than HOT_HERE forms of an anchor do so at once and tell the anchor's
  bucket; so a bucket gets few forms a task of even the most frequent anchor.

Verdicts carry a digest of the text they are about, and each row checks it against its own text.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseframes.llm.common import cut, fields, fresh, small_batches, trim, trimmed
from poseframes.llm.run_length_index import DEPTH, RunLengthIndex

#: Bytes of an anchor.
ANCHOR = 20
#: Segments that a task gathers before it packs them, and the most documents among them.
CHUNK, CHUNK_DOCS = 200_000, 60_000
#: Bytes that are hashed in one go, and strings of a passage that are dealt out together.
BLOCK_BYTES, PIECE = 1 << 18, 512
#: Bytes of text for each bucket of hashes, and for each index. What repeats is a part of a text.
HASH_BYTES, INDEX_BYTES = 6 << 20, 1 << 20
#: Forms of one anchor that may share an index, and that one task may send to its bucket.
HOT_FORMS, HOT_HERE = 4096, 64

_BASE = 0xD6E8FEB86659FD93
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Polynomial hashes of all substrings of each size, from those of powers of two."""
    powers, h, n = [], data.astype(np.uint64) + np.uint64(1), 1
    while n <= max(sizes):
        powers.append((n, h))
        if len(h) <= n:
            break
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
    out = []
    for size in sizes:
        got, done = None, 0
        for n, h in powers:
            if size & n:
                if got is None:
                    got = h
                else:
                    most = max(0, len(data) - done - n + 1)
                    got = got[:most] * np.uint64(pow(_BASE, n, 1 << 64)) + h[done : done + most]
                done += n
        out.append(got if got is not None and done == size else np.empty(0, np.uint64))
    return out


def segments(texts: list[bytes], k: int):
    """Arrays of document number, start, number of strings, anchor hash and segment hash.

    Texts are taken in pieces and blocks of BLOCK_BYTES; segments end where pieces do."""
    pieces = [(d, at, t[at : at + BLOCK_BYTES + k - 1]) for d, t in enumerate(texts) for at in range(0, len(t) - k + 1, BLOCK_BYTES)]
    blocks, size = [], BLOCK_BYTES
    for p in pieces:
        if size + len(p[2]) > BLOCK_BYTES:
            blocks.append([])
            size = 0
        blocks[-1].append(p)
        size += len(p[2])
    found = [_NOTHING]
    for block in blocks:
        piece, start, n, anchor, seg = _segments([p[2] for p in block], k)
        doc, base = (np.array(x, np.int64) for x in list(zip(*block))[:2])
        found.append((doc[piece], start + base[piece], n, anchor, seg))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(5))


_NOTHING = (*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64), np.empty(0, np.uint64))


def _segments(texts: list[bytes], k: int):
    """Of pieces in one go. A k-byte string belongs to a segment with those beside it that have the
    same least hash of ANCHOR bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n, w = len(data) - k + 1, k - ANCHOR + 1
    small, whole = _hashes(data, (ANCHOR, k))
    least, width = _mix(small), 1
    while 2 * width <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < w:
        least = np.minimum(least[:n], least[w - width : w - width + n])
    of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    valid = of[:n] == of[k - 1 :]
    edge = np.ones(n + 1, bool)
    edge[1:n] = (least[1:n] != least[: n - 1]) | (of[1:n] != of[: n - 1]) | (valid[1:] != valid[:-1])
    bounds = np.flatnonzero(edge)
    start, size = bounds[:-1], np.diff(bounds)
    keep = valid[start]
    start, size = start[keep], size[keep]
    if len(size) and size.max() > w:  # periodic text: cut, so that two k-byte strings cover a segment
        parts = -(-size // w)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(size, parts) - nth * w
        start, size = np.repeat(start, parts) + nth * w, np.minimum(left, w)
    doc = of[start].astype(np.int64)
    # Two strings cover it. The last is mixed before the size goes in: strings that differ in the last byte alone have hashes
    # that differ by as much, and in periodic text the size could make up for that.
    seg = _mix(whole[start] + _mix(_mix(whole[start + size - 1]) ^ size.astype(np.uint64)) * _A)
    first = np.cumsum(sizes) - sizes
    return doc, start - first[doc], size, _mix(least[start]), seg


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _planes(x: np.ndarray) -> np.ndarray:
    """The bytes of numbers, all first ones first; there may be no numbers."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where rows in order differ from the row before."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


#: Flags of a segment on its way to the buckets: its anchor has many forms in its chunk.
_HOT = 1
#: What a row asks of the indexes: a passage claims to repeat another; a segment shares its anchor
#: with other forms (if of no smaller document, it is indexed only; if of no greater, streamed only);
#: each string of a segment is to be dealt out. A region is what others claim.
_CLAIM, _FRINGE, _STRINGS, _REGION, _FIRST, _LAST = range(6)


def _merged(doc, pos, n, owner, at):
    """Claims in order of document and place: neighbours that continue each other are one."""
    new = _starts(doc, owner, at - pos)
    new[1:] |= pos[1:] != (pos + n)[:-1]
    first = np.flatnonzero(new)
    return doc[first], pos[first], (np.add.reduceat(n, first) if len(first) else n), owner[first], at[first]


def _pack(ids, doc, pos, size, anchor, seg, buckets: int, here: int) -> pa.RecordBatch:
    """One row a bucket: segments of its anchors, and claims that are known already, by document.
    Of an anchor with many forms here the bucket need not decide: its segments are dealt out by
    place, and a row of size 0 tells its bucket."""
    short = (anchor >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((pos, ids[doc], seg, short))
    a, s, d = short[order], seg[order], ids[doc[order]]
    new_a, new_s = _starts(a), _starts(a, s)
    at_a, at_s, in_a, in_s = np.flatnonzero(new_a), np.flatnonzero(new_s), np.cumsum(new_a) - 1, np.cumsum(new_s) - 1
    later = d > d[at_s][in_s]
    many = np.add.reduceat(new_s.astype(np.int64), at_a) > here
    claims = [d[later], pos[order[later]], size[order[later]], d[at_s][in_s][later], pos[order[at_s]][in_s][later]]
    by_doc = np.lexsort((claims[1], claims[0]))
    claims = _merged(*(c[by_doc] for c in claims))
    hot, told = many[in_a] & ~later, order[at_a[many]]  # one row of each such anchor
    keep = np.r_[order[~later], told]
    flags = np.r_[np.where(hot[~later], _HOT, 0), np.zeros(len(told))].astype(np.uint8)
    doc, pos, size, short, seg = (x[keep] for x in (doc, pos, size, short, seg))
    size[len(keep) - len(told) :] = 0
    by_place = _mix(pos.astype(np.uint64) + ids[doc].astype(np.uint64))
    bucket = ((np.where(flags & _HOT, by_place, _mix(short.astype(np.uint64))) & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32)
    claimed = ((_mix(claims[0].astype(np.uint64)) & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32)
    order, by_bucket = np.lexsort((pos, doc, bucket)), np.argsort(claimed, kind="stable")
    cuts, claim_cuts = (np.searchsorted(x, np.arange(buckets + 1)) for x in (bucket[order], claimed[by_bucket]))
    rows = []
    for b in np.flatnonzero(np.diff(cuts) + np.diff(claim_cuts)):
        own, asked = order[cuts[b] : cuts[b + 1]], by_bucket[claim_cuts[b] : claim_cuts[b + 1]]
        used, nth = np.unique(doc[own], return_inverse=True)
        places = _squeeze(_planes(nth.astype("<u2")), _planes(pos[own].astype("<u4")), size[own].astype(np.uint8), flags[own])
        hashes = short[own].tobytes() + seg[own].view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
        rows.append((b, len(own), _squeeze(np.diff(ids[used], prepend=0)), hashes, places, _squeeze(*(_planes(c[asked].astype(np.int64)) for c in claims)) if len(asked) else None))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "n", "ids", "hashes", "places", "claims"])


def _unpack(n: int, ids: bytes, hashes: bytes, places: bytes):
    """Document, place, size, flags, anchor and form (48 bits of its hash) of each segment."""
    z = zstandard.ZstdDecompressor()
    used = np.cumsum(np.frombuffer(z.decompress(ids), np.int64))
    raw = np.frombuffer(z.decompress(places), np.uint8)
    nth = raw[: 2 * n].reshape(2, n).T.copy().view("<u2")[:, 0] if n else np.empty(0, np.int64)
    pos = raw[2 * n : 6 * n].reshape(4, n).T.copy().view("<u4")[:, 0].astype(np.int64) if n else np.empty(0, np.int64)
    seg = np.zeros((n, 8), np.uint8)
    seg[:, :6] = np.frombuffer(hashes[4 * n :], np.uint8).reshape(n, 6)
    return used[nth], pos, raw[6 * n : 7 * n].astype(np.int64), raw[7 * n :], np.frombuffer(hashes[: 4 * n], np.uint32), seg.view(np.uint64).reshape(n)


def _send(batches, k: int, buckets: int, here: int):
    held: list[tuple] = []
    count = docs = 0

    def packed():
        ids = np.concatenate([h[0] for h in held])
        base = np.cumsum([0, *(len(h[0]) for h in held)])
        doc = np.concatenate([h[1][0] + b for h, b in zip(held, base)])
        return _pack(ids, doc, *(np.concatenate([h[1][i] for h in held]) for i in range(1, 5)), buckets, here)

    for part in small_batches(batches, 500):
        found = segments([x.encode() for x in part.column(1).to_pylist()], k)
        if len(found[0]):
            held.append((part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), found))
            count, docs = count + len(found[0]), docs + part.num_rows
        if count >= CHUNK or docs >= CHUNK_DOCS - 500:
            yield packed()
            held, count, docs = [], 0, 0
    if held:
        yield packed()


#: ``owner`` and ``at``: whose passage a claim is about and where it starts; a fringe has its anchor in ``at``.
_ASKED = pa.schema([("kind", pa.int8()), ("id", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("owner", pa.int64()), ("at", pa.int32())])
_KINDS = "kind byte, id long, pos int, n int, owner long, at int"


def _table(parts: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(np.concatenate([p[i] for p in parts]), f.type) for i, f in enumerate(schema)], schema=schema)


def _decide(table: pa.Table, hot: int) -> pa.Table:
    """What the segments of a bucket of anchors ask of the indexes."""
    rows = [table[c].to_pylist() for c in ("n", "ids", "hashes", "places")]
    parts = [_unpack(*row) for row in zip(*rows, strict=True)]
    columns = [np.concatenate([p[i] for p in parts]) for i in range(6)]
    nothing = np.empty(0, np.int64)
    out: list[tuple] = [(np.empty(0, np.int8), *(nothing,) * 5)]
    z = zstandard.ZstdDecompressor()
    for packed in table["claims"].to_pylist():
        if packed is not None:
            raw = np.frombuffer(z.decompress(packed), np.uint8)
            claims = [x.T.copy().view(np.int64)[:, 0] for x in raw.reshape(5, 8, -1)]
            out.append((np.full(len(claims[0]), _CLAIM, np.int8), *claims))

    def take(rows: list[np.ndarray], chosen: np.ndarray, kind: int, owner: np.ndarray | None = None, at: np.ndarray | None = None) -> None:
        doc, pos, size, _, anchor, _ = (x[chosen] for x in rows)
        zero = np.zeros(len(doc), np.int64)
        out.append((np.full(len(doc), kind, np.int8), doc, pos, size, zero if owner is None else owner[chosen], anchor.view(np.int32).astype(np.int64) if at is None else at[chosen]))

    is_hot = columns[3] & _HOT > 0
    take(columns, is_hot, _STRINGS)
    told = np.unique(columns[4][columns[2] == 0])
    rows = [x[~is_hot & (columns[2] > 0)] for x in columns]
    if len(rows[0]):
        order = np.lexsort((rows[1], rows[0], rows[5], rows[4]))
        rows = [x[order] for x in rows]
        doc, pos, _, _, anchor, seg = rows
        new_a, new_s = _starts(anchor), _starts(anchor, seg)
        at_a, at_s, in_a, in_s = np.flatnonzero(new_a), np.flatnonzero(new_s), np.cumsum(new_a) - 1, np.cumsum(new_s) - 1
        least, at = doc[at_s][in_s], pos[at_s][in_s]
        forms, is_told = np.add.reduceat(new_s.astype(np.int64), at_a), np.isin(anchor[at_a], told)
        many_docs = np.minimum.reduceat(doc, at_a) != np.maximum.reduceat(doc, at_a)
        busy = is_told | (many_docs & (forms > hot))
        later = doc > least  # others are places of the form in its least document
        take(rows, later, _CLAIM, least, at)
        take(rows, ~later & busy[in_a], _STRINGS)
        low, high = np.minimum.reduceat(doc, at_a)[in_a], np.maximum.reduceat(np.where(later, least, doc), at_a)[in_a]
        fringe = ~later & (many_docs & (forms > 1) & ~busy)[in_a]
        before, after = fringe & (doc > low), fringe & (doc < high)
        take(rows, before & after, _FRINGE)
        take(rows, after & ~before, _FIRST)
        take(rows, before & ~after, _LAST)
    return _table(out, _ASKED)


def _merge(batches):
    """Rows in order of document, kind and place, with claims merged and cut where the claimed
    passage enters another piece of PIECE strings."""
    for b in batches:
        kind, doc, pos, n, owner, at = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns)
        claim = kind == _CLAIM
        d, p, m, o, a = _merged(*(x[claim] for x in (doc, pos, n, owner, at)))
        pieces = (a + m - 1) // PIECE - a // PIECE + 1
        row = np.repeat(np.arange(len(d)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.maximum(a[row], (a[row] // PIECE + nth) * PIECE)
        stop = np.minimum(a[row] + m[row], (a[row] // PIECE + nth + 1) * PIECE)
        claims = (np.full(len(row), _CLAIM, np.int8), d[row], p[row] + start - a[row], stop - start, o[row], start)
        rest = (kind[~claim].astype(np.int8), *(x[~claim] for x in (doc, pos, n, owner, at)))
        yield from _table([claims, rest], _ASKED).to_batches()


def _lists(column: pa.Array, *names: str) -> tuple[np.ndarray, ...]:
    """Row number and fields of all structs in a column of lists."""
    row = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = column.flatten()
    return row, *(flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names)


_FRINGES = (_FRINGE, _FIRST, _LAST)
_COPIES = pa.schema([("to", pa.int32()), *_ASKED, ("data", pa.binary())])


def _copies(batches, k: int, text: int, key: int, buckets: int):
    """The bytes that a row was asked for, and the index they go to; strings are rows of their own."""
    for part in small_batches(batches, 500):
        texts = [(x or "").encode() for x in part.column(text).to_pylist()]
        row, kind, pos, n, owner, at = _lists(part.column(part.num_columns - 1), "kind", "pos", "n", "owner", "at")
        sizes, ids = np.array([len(t) for t in texts]), part.column(key).to_numpy(zero_copy_only=False)
        good = pos + n + k - 1 <= sizes[row]  # rows may share an id
        row, kind, pos, n, owner, at = (x[good] for x in (row, kind, pos, n, owner, at))
        # what is claimed of one piece, by however many, is sent once, from first to last
        region, piece = kind == _REGION, pos // PIECE
        order = np.lexsort((pos, piece, region, row))
        row, kind, pos, n, owner, at, region, piece = (x[order] for x in (row, kind, pos, n, owner, at, region, piece))
        first = np.flatnonzero(_starts(row, region, piece) | ~region)
        stop = np.maximum.reduceat(pos + n, first) if len(first) else pos
        row, kind, pos, owner, at = (x[first] for x in (row, kind, pos, owner, at))
        n = stop - pos
        where = np.where(np.isin(kind, _FRINGES), at.astype(np.uint64), _mix(owner.astype(np.uint64)) + (at // PIECE).astype(np.uint64))
        where = ((_mix(where) & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32)
        one = np.where(kind == _STRINGS, n, 1)
        own = np.repeat(np.arange(len(row)), one)
        pos = pos[own] + np.arange(len(own)) - np.repeat(np.cumsum(one) - one, one)
        n = np.where(kind == _STRINGS, 1, n)[own]
        data = [texts[r][p : p + m + k - 1] for r, p, m in zip(row[own], pos, n)]
        columns = (where[own], kind[own].astype(np.int8), ids[row[own]], pos, n, owner[own], at[own])
        yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, _COPIES)), pa.array(data, pa.binary())], schema=_COPIES)


def digest(data: bytes) -> int:
    """Of a text, as a signed 64-bit integer."""
    x = xxhash.xxh3_64_intdigest(data)
    return x - (1 << 64) if x >> 63 else x


_VERDICTS = pa.schema([*(pa.field(f"v_{f.name}", f.type) for f in _ASKED), ("digest", pa.int64()), ("lo", pa.int32()), ("len", pa.int32())])


def _search(table: pa.Table, k: int) -> pa.Table:
    """Index what is claimed and the fringes of a bucket, stream claims and fringes through it, and
    give the runs of strings that a smaller document has."""
    kind, ids = (table[c].to_numpy() for c in ("kind", "id"))
    data = table["data"].to_pylist()
    kept, streamed = np.flatnonzero((kind != _CLAIM) & (kind != _LAST)), np.flatnonzero((kind != _REGION) & (kind != _FIRST))
    if not len(kept) or not len(streamed):
        return _VERDICTS.empty_table()
    index = RunLengthIndex([data[i] for i in kept], ids[kept], k)
    patterns, own = [data[i] for i in streamed], ids[streamed]
    sizes = np.array([len(p) for p in patterns])
    base = np.cumsum(sizes) - sizes
    gone = np.zeros(int(sizes.sum()) + 1, bool)  # strings end before patterns do: a run never meets the next
    for pattern, at, length, row, pos in index.stream(patterns):
        hit = np.flatnonzero(length >= k)
        p = pattern[hit]
        less = index.least_owner(row[hit], pos[hit]) < own[p]
        gone[base[p[less]] + at[hit][less]] = True
    edges = np.flatnonzero(np.diff(np.r_[False, gone]))
    lo, hi = edges[::2], edges[1::2]
    p = np.searchsorted(base, lo, side="right") - 1
    rows = pa.array(streamed[p])
    found = [table[f.name].combine_chunks().take(rows) for f in _ASKED]
    digests = pa.array([digest(patterns[i]) for i in p], pa.int64())
    out = pa.table([*found, digests, pa.array((lo - base[p]).astype(np.int32)), pa.array((hi - lo).astype(np.int32))], schema=_VERDICTS)
    del index
    trim(table.nbytes)
    return out


def _spans(text: bytes, pos, n, digests, lo, length, k: int) -> list[int]:
    """Starts and ends of the maximal runs of a text that its verdicts cover."""
    good = np.array([digest(text[p : p + m + k - 1]) == d for p, m, d in zip(pos.tolist(), n.tolist(), digests.tolist())], bool)
    delta = np.zeros(len(text) + 1, np.int32)
    start = (pos + lo)[good]
    np.add.at(delta, start, 1)
    np.add.at(delta, start + length[good] + k - 1, -1)
    on = np.cumsum(delta[:-1]) > 0
    return np.flatnonzero(np.diff(np.r_[False, on, False])).tolist()


def _verdicts(rows: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """``m_id, marks``: for each key the runs of strings that go, as ``pos, n, digest`` (of the
    text that was judged) and ``lo, len`` (what goes of it)."""
    size = rows.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    hash_buckets, index_buckets = size // HASH_BYTES + 1, size // INDEX_BYTES + 1
    hot, here, at, of = HOT_FORMS, HOT_HERE, rows.columns.index(text), rows.columns.index("key")
    usable = rows.where((F.octet_length(text) >= k) & F.col(id_col).isNotNull()).select("key", text)
    sent = usable.mapInArrow(trimmed(partial(_send, k=k, buckets=hash_buckets, here=here)), "bucket int, n long, ids binary, hashes binary, places binary, claims binary")
    asked = sent.groupBy("bucket").applyInArrow(lambda t: _decide(t, hot), _KINDS)
    asked = cut(asked.repartition("id").sortWithinPartitions("id", "kind", "pos").mapInArrow(trimmed(_merge), _KINDS), "asked")
    claims = asked.where(F.col("kind") == _CLAIM)
    passage = ["owner", "at", "n"]
    one = claims.groupBy(*passage).agg(F.min(F.struct("id", "pos")).alias("one"))  # which document is streamed for all
    streamed = one.select(F.lit(_CLAIM).cast("byte").alias("kind"), "one.id", "one.pos", "n", "owner", "at")
    indexed = one.select(F.lit(_REGION).cast("byte").alias("kind"), F.col("owner").alias("id"), F.col("at").alias("pos"), "n", "owner", "at")

    def copies(wanted: DataFrame) -> DataFrame:
        # Rows are joined twice, here and for the result: with the same columns, so that texts are shuffled once.
        by_id = wanted.groupBy(F.col("id").alias("v_id")).agg(F.collect_list(F.struct("kind", "pos", "n", "owner", "at")).alias("v_asked"))
        run = trimmed(partial(_copies, k=k, text=at, key=of, buckets=index_buckets))
        return rows.join(by_id, F.col("key") == F.col("v_id")).drop("v_id").mapInArrow(run, f"to int, {_KINDS}, data binary")

    forms = copies(streamed.unionByName(indexed).unionByName(asked.where(F.col("kind").isin(*_FRINGES))))
    strings = asked.where(F.col("kind") == _STRINGS)
    some_strings = not strings.isEmpty()
    if some_strings:
        strings = cut(copies(strings).select("id", "pos", "data", F.xxhash64("data").alias("own")), "strings")
        several = strings.groupBy("data").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min("own").alias("own")).where("least < most")
        to, zero = F.pmod("own", F.lit(index_buckets)).cast("int").alias("to"), F.lit(0)
        both = ((_REGION, "least"), (_CLAIM, "most"))  # one place each in the index and in the stream
        for kind, who in both:
            forms = forms.unionByName(several.select(to, F.lit(kind).cast("byte").alias("kind"), F.col(who).alias("id"), zero.alias("pos"), F.lit(1).alias("n"), F.col("least").alias("owner"), F.lit(-1).alias("at"), "data"))
    verdicts = cut(forms.groupBy("to").applyInArrow(lambda t: _search(t, k), ", ".join(f"v_{x}" for x in _KINDS.split(", ")) + ", digest long, lo int, len int"), "verdicts")
    for_all = verdicts.where((F.col("v_kind") == _CLAIM) & (F.col("v_at") >= 0)).select(*(f"v_{c}" for c in passage), "digest", "lo", "len")
    marks = claims.join(for_all, [F.col(c) == F.col(f"v_{c}") for c in passage]).select("id", "pos", "n", "digest", "lo", "len")
    fringe = verdicts.where(F.col("v_kind").isin(*_FRINGES)).select(F.col("v_id").alias("id"), F.col("v_pos").alias("pos"), F.col("v_n").alias("n"), "digest", "lo", "len")
    marks = marks.unionByName(fringe)
    if some_strings:
        own = verdicts.where("v_at = -1").select("digest", F.col("v_owner").alias("least"), "lo", "len")
        later = strings.select("id", "pos", F.lit(1).alias("n"), _digests("data").alias("string")).join(own, F.col("string") == F.col("digest")).where("id > least")
        marks = marks.unionByName(later.select("id", "pos", "n", "digest", "lo", "len"))
    return marks.groupBy(F.col("id").alias("m_id")).agg(F.collect_list(F.struct("pos", "n", "digest", "lo", "len")).alias("marks"))


@F.arrow_udf(T.LongType())
def _digests(data: pa.Array) -> pa.Array:
    return pa.array([digest(x) for x in data.to_pylist()], pa.int64())


def _with_spans(docs: DataFrame, k: int, text: str, id_col: str, finish, schema: str) -> DataFrame:
    """``finish`` of the rows of ``docs``, their texts as bytes and the spans that go."""
    if not max(ANCHOR, DEPTH) <= k <= 2 * DEPTH:
        raise ValueError(f"k must be {max(ANCHOR, DEPTH)} to {2 * DEPTH}")
    names = docs.columns
    # Inside, columns go by number: those of docs may have any names.
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    at, of = names.index(text), names.index(id_col)
    # Rows without an id have a key too, so that they spread and no join has to leave them out first.
    keyed = rows.withColumn("key", F.coalesce(F.col(f"c{of}").cast("long"), F.xxhash64(f"c{at}")))
    marks = _verdicts(keyed, f"c{of}", f"c{at}", k)
    joined = keyed.join(marks, F.col("key") == F.col("m_id"), "left").drop("m_id", "key")

    def run(batches):
        for b in small_batches(batches, 500):
            texts = [(x or "").encode() for x in b.column(at).to_pylist()]
            row, *found = _lists(b.column(len(names)), "pos", "n", "digest", "lo", "len")
            good = b.column(of).is_valid().to_numpy(zero_copy_only=False)[row]
            row, found = row[good], [x[good] for x in found]
            cuts = np.searchsorted(row, np.arange(b.num_rows + 1))
            spans = [_spans(t, *(x[lo:hi] for x in found), k) if hi > lo else [] for t, lo, hi in zip(texts, cuts, cuts[1:])]
            yield finish(pa.RecordBatch.from_arrays(b.columns[: len(names)], names=names), texts, spans)

    return joined.mapInArrow(trimmed(run), schema)


def repeated_spans(docs: DataFrame, k: int = 50, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` and ``_spans`` (``_spans_`` and so on if it has such a
    column): starts and ends, in turn, of the maximal runs of UTF-8 bytes covered by a k-byte string
    that also starts in a document with a smaller id.

    A null text is empty. A row whose id is null loses nothing and takes nothing from others. Rows
    that share an id lose nothing to each other. Texts under k bytes lose nothing. Extra columns are
    carried along whatever their names, an empty table gives an empty one. Ids must be integers,
    texts shorter than 2 GB, k from 28 to 56.
    """
    (name,) = fresh(docs.columns, "_spans")

    def finish(rows: pa.RecordBatch, texts: list[bytes], spans: list[list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(spans, pa.list_(pa.int64()))], names=[*rows.schema.names, name])

    return _with_spans(docs, k, text, id_col, finish, f"{fields(docs.schema)}, `{name}` array<long>".removeprefix(", "))


def kept_bytes(text: bytes, spans: list[int]) -> bytes:
    """What is left of a text."""
    edges = [0, *spans, len(text)]
    return b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def whole_characters(text: bytes, spans: list[int]) -> list[int]:
    """The spans, narrowed to the characters that they hold whole."""
    out = []
    for a, b in zip(spans[::2], spans[1::2]):
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out += [a, b]
    return out


def removal_digest(docs: DataFrame, k: int = 50, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (of the bytes that are left);
    cases are those of ``repeated_spans``."""

    def finish(rows: pa.RecordBatch, texts: list[bytes], spans: list[list[int]]) -> pa.RecordBatch:
        sha = [hashlib.sha256(kept_bytes(t, s)).hexdigest() for t, s in zip(texts, spans)]
        columns = [[len(t) for t in texts], [sum(s[1::2]) - sum(s[::2]) for s in spans], [len(s) // 2 for s in spans]]
        return pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(sha, pa.string())], names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    docs = docs.select(id_col, text)
    return _with_spans(docs, k, text, id_col, finish, f"{fields(docs.select(id_col).schema)}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, k: int = 50, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with each text shortened. Characters that a span covers in part stay whole; null
    texts stay null, and texts of which nothing is left become empty."""
    at = docs.columns.index(text)

    def finish(rows: pa.RecordBatch, texts: list[bytes], spans: list[list[int]]) -> pa.RecordBatch:
        left = [kept_bytes(t, whole_characters(t, s)).decode() for t, s in zip(texts, spans)]
        shorter = pa.array(left, pa.string(), mask=rows.column(at).is_null().to_numpy(zero_copy_only=False))
        return pa.RecordBatch.from_arrays([shorter if i == at else c for i, c in enumerate(rows.columns)], names=rows.schema.names)

    return _with_spans(docs, k, text, id_col, finish, fields(docs.schema))


#: For DuckDB: every 50-byte string of every document, as hexadecimal digits. Ids must be distinct.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
strings AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM strings) WHERE least < doc_id),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM gone)) GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
kept AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS runs,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k
  FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
