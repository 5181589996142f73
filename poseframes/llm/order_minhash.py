"""Document fingerprints: Order MinHash, which is sensitive to edit distance.

Every k-mer of a text gets the number of its occurrences before it. Each of SKETCHES permutations
selects the PER least of these numbered k-mers, puts them back into text order, and hashes the tuple:
one number of the signature. Two texts agree in a number if they share the selected k-mers in one
order, so repeats and moved passages tell, unlike with sets of k-mers. Likeness is the share of
numbers that agree.

An edited text that keeps a text's beginning shares that part's k-mers and their occurrence numbers,
so both are made in one go: k-mers of the common beginning, of the one end and of the other.

Texts are dealt out once, by ranges of the id, and pass through a task in order: a text, what the next
one lends it, and the next one's signature meet there. Only the last text of each range and the first
of the following one meet in a second step, of as many rows as there are ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poseframes.llm.common import bound_batches, cut, text_or_empty, trim, trimmed

#: Characters of a k-mer, numbers of a signature, k-mers of a tuple.
K, SKETCHES, PER = 8, 64, 2
#: Numbered k-mers that are held at once: the k-mers of longer texts are taken in classes by their
#: hash, one after the other. Characters that are hashed in one go, k-mers that are permuted in one go.
HELD, PIECE, BLOCK = 1 << 21, 1 << 20, 4096
#: Bits of a sort key that say where a k-mer is; the others are its hash.
_AT = np.uint64(22)
_MASK = np.uint64((1 << 22) - 1)
_BASE, _GOLDEN = np.array([0x100000001B3], np.uint64), np.uint64(0x9E3779B97F4A7C15)
#: Bits of a selected k-mer's key that hold its place, so that ties go to the earlier one.
_PLACE, _PLACES, _TOP = np.uint64(32), np.uint64((1 << 32) - 1), np.uint32((1 << 32) - 1)
#: A permutation multiplies a mixed hash of 32 bits by an odd number.
_FACTORS = np.random.default_rng(12).integers(0, 1 << 31, SKETCHES, np.uint32) * np.uint32(2) + np.uint32(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmer_hashes(text: str) -> np.ndarray:
    """A hash of each of the text's k-mers; of the whole text if it is shorter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return codes
    width, h, power = 1, codes, _BASE
    while width * 2 <= K and len(h) > width:  # from hashes of so many characters to those of twice as many
        h = h[:-width] * power + h[width:]
        width, power = 2 * width, power * power
    if width < K:  # a short text, or k is no power of two
        h = codes[: max(1, len(codes) - K + 1)].copy()
        for i in range(1, min(K, len(codes))):
            h = h * _BASE + codes[i : i + len(h)]
    return _mixed(h)


def _pieces(text: str, start: int) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of the k-mers that begin at ``start`` or later, with the place of the first."""
    n = max(len(text) - K + 1, min(len(text), 1))
    for lo in range(start, n, PIECE):
        yield lo, kmer_hashes(text[lo : min(lo + PIECE, n) + K - 1])


def _least(keys: list[np.ndarray]) -> np.ndarray:
    """The PER least of these keys in each permutation."""
    every = np.hstack(keys)
    return every if every.shape[1] <= PER else np.sort(every, 1)[:, :PER]


def _selected(entry: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The PER least numbered k-mers of each permutation as keys: the permuted hash, then the place."""
    keys, rows = [], np.arange(SKETCHES)
    for lo in range(0, len(entry), BLOCK):
        y, here = _FACTORS[:, None] * entry[None, lo : lo + BLOCK], at[lo : lo + BLOCK]
        for k in range(min(PER, len(here))):
            if k:
                y[rows, i] = _TOP
            i = y.argmin(1)
            keys.append(((y[rows, i].astype(np.uint64) << _PLACE) | here[i].astype(np.uint64))[:, None])
    return _least(keys or [np.empty((SKETCHES, 0), np.uint64)])


def _signature(keys: np.ndarray, kmer_at: Callable[[np.ndarray], np.ndarray]) -> bytes:
    """Two bytes for each permutation, from its k-mers in text order."""
    at = np.sort((keys & _PLACES).astype(np.int64), 1)
    h = np.full(SKETCHES, at.shape[1], np.uint64)
    for i in range(at.shape[1]):
        h = _mixed((h ^ kmer_at(at[:, i])) * _GOLDEN)
    return (h >> np.uint64(48)).astype("<u2").tobytes()


def _one_by_one(text: str) -> Callable[[np.ndarray], np.ndarray]:
    return lambda at: np.array([kmer_hashes(text[i : i + K])[0] for i in at.tolist()], np.uint64)


def _entries(kmer: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Hashes of k-mers with their occurrence numbers: those of a beginning, of the rest of one text,
    and of the rest of another one, which does not count the occurrences in the rest of the first."""
    order = np.sort((kmer & ~_MASK) | np.arange(len(kmer), dtype=np.uint64))
    new = np.flatnonzero((order[1:] ^ order[:-1]) > _MASK) + 1
    order = (order & _MASK).astype(np.int64)
    first = np.zeros(len(order), np.int64)
    first[new] = new
    np.maximum.accumulate(first, out=first)
    number = np.arange(len(order)) - first
    if len(sizes) > 2 and sizes[0] + sizes[1] < len(kmer):
        end = sizes[0] + sizes[1]
        before = np.zeros(len(order) + 1, np.int64)
        np.cumsum((order >= sizes[0]) & (order < end), out=before[1:])
        theirs = np.flatnonzero(order >= end)
        number[theirs] -= before[theirs] - before[first[theirs]]
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = number
    return (_mixed(kmer + occurrence * _GOLDEN) >> np.uint64(32)).astype(np.uint32)


def signatures(text: str, other: str | None = None, common: int = 0) -> list[bytes]:
    """Of a text, and of another one that begins with the same ``common`` characters."""
    ends = [text] if other is None else [text, other]
    shared = max(0, common - K + 1) if other is not None and min(map(len, ends)) >= K else 0  # k-mers in the common beginning
    parts = [(0, text[: shared + K - 1] if shared else ""), *((shared, e) for e in ends)]
    total = shared + sum(max(0, len(e) - K + 1 - shared) for e in ends)
    if total <= HELD:
        hashes = [np.concatenate([h for _, h in _pieces(e, start)] or [np.empty(0, np.uint64)]) for start, e in parts]
        sizes = [len(h) for h in hashes]
        kmer = np.concatenate(hashes)
        entry = _entries(kmer, sizes) if len(kmer) else np.empty(0, np.uint32)
        keys, lo = [], 0
        for (start, _), n in zip(parts, sizes, strict=True):
            keys.append(_selected(entry[lo : lo + n], np.arange(start, start + n)))
            lo += n
        of = [np.concatenate([hashes[0], h]) for h in hashes[1:]]
        return [_signature(_least([keys[0], k]), h.__getitem__) for k, h in zip(keys[1:], of, strict=True)]
    classes, found = -(-total // HELD), [[] for _ in ends]
    for c in range(classes):
        hashes, places, sizes = [], [], []
        for start, e in parts:
            own = [(h[mine], lo + mine) for lo, h in _pieces(e, start) for mine in [np.flatnonzero(h % np.uint64(classes) == c)]]
            hashes += [h for h, _ in own]
            places += [at for _, at in own]
            sizes.append(sum(len(h) for h, _ in own))
        kmer, at = np.concatenate(hashes), np.concatenate(places)
        del hashes, places
        if not len(kmer):
            continue
        entry, (a, b) = _entries(kmer, sizes), (sizes[0], sizes[0] + sizes[1])
        both = _selected(entry[:a], at[:a])
        for into, lo, hi in zip(found, (a, b), (b, len(entry)), strict=False):
            into += [both, _selected(entry[lo:hi], at[lo:hi])]
        trim(8 * len(kmer) * 8)
    return [_signature(_least(keys), _one_by_one(e)) for keys, e in zip(found, ends, strict=True)]


def likeness(a: bytes, b: bytes) -> float:
    """The share of permutations in which two signatures agree."""
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


class _Text:
    """A text with what is known of it: the signature of itself and of its edited form."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.own, self.edited, self.digest, self.near = doc_id, text, None, None, None, 0.0

    def edit(self, following: str) -> None:
        size = len(self.text) // 4
        keep = len(self.text) - size
        other = self.text[:keep] + following[:size]
        self.digest = hashlib.sha256(other.encode("utf-8", "surrogatepass")).digest()
        self.own, self.edited = signatures(self.text, other, keep)
        self.near = likeness(self.own, self.edited)

    def row(self, following: bytes) -> tuple:
        return None, self.doc_id, None, None, len(self.text), self.digest, self.own, self.edited, self.near, likeness(self.own, following)


_MADE = "part int, doc_id {}, text string, head string, n_chars long, digest binary, own binary, edited binary, near_edited double, near_next double"
ROWS = 500


def _schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("doc_id", kind), ("text", pa.string()), ("head", pa.string()), ("n_chars", pa.int64()), *((c, pa.binary()) for c in ("digest", "own", "edited")), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range's texts but the last; then one with the last text and the first."""
    before = now = head = schema = None
    out: list[tuple] = []
    for batch in batches:
        schema = schema or _schema(batch.schema.field(0).type)
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if now is None:
                head = text
            else:
                now.edit(text)
                if before is not None:
                    out.append(before.row(now.own))
                before = now
            now = _Text(doc_id, text)
            if len(out) >= ROWS:
                yield _batch(out, schema)
                out = []
    if now is not None:
        if before is not None:
            out.append(before.row(signatures(now.text)[0]))
        out.append((TaskContext.get().partitionId(), now.doc_id, now.text, head, None, None, None, None, None, None))
        yield _batch(out, schema)


def _paired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the texts that end a range, each with the one that begins the next."""
    for batch in batches:
        schema = _schema(batch.schema.field(0).type)
        for doc_id, text, head in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            last = _Text(doc_id, text)
            last.edit(head)
            yield _batch([last.row(signatures(head)[0])], schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of
    every row.

    The edited text has the beginning of the next text by ascending id (after the last: of the first)
    in place of its last quarter, in code points. Null ids come first, rows of one id in the order of a
    hash of their texts. A null text counts as empty; the signature of an empty text is one of its own,
    so two empty texts are alike and no other is like them. A text shorter than K is one k-mer. Texts
    of any length are taken whole: above HELD k-mers in several passes over the text. Repeated rows are
    each other's neighbours, other columns are ignored, an empty table gives an empty one.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    made = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(trimmed(_in_order), _MADE.format(kind)), "fingerprints")
    ends = made.where("part IS NOT NULL").select("part", "doc_id", "text", "head")
    parts = ends.select("part")  # as many rows as there are ranges
    following = parts.select("part", F.lead("part").over(W.orderBy("part")).alias("next")).crossJoin(F.broadcast(parts.agg(F.min("part").alias("least"))))
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("first"))
    pairs = ends.join(following.select("part", F.coalesce("next", "least").alias("next")), "part").join(heads, "next").select("doc_id", "text", F.col("first").alias("head"))
    done = made.where("part IS NULL").unionByName(pairs.mapInArrow(trimmed(_paired), _MADE.format(kind)))
    number = lambda c: F.lower(F.hex(c))
    return done.select(
        F.col("doc_id").alias(id_col), "n_chars", number("digest").alias("edited_sha256"), number("own").alias("fingerprint"), number("edited").alias("edited_fingerprint"), "near_edited", "near_next"
    )
