"""Byte-level BPE by monoid tree reduction.

A stretch of bytes is encoded by halves, down to single bytes. Two encoded neighbours are joined by
encoding the bytes of a few tokens on both sides of the seam again; the window grows until its outer
tokens fit the tokens beside it. Two tokens fit if their joint bytes encode to just these two. In byte-level BPE
a list of tokens is the encoding of its bytes exactly when all neighbours fit, so what lies
outside the window is then proven stable. Texts are split into matches of the pattern in the same
way: halves first, then a window over the seam is matched again until its ends meet the ends that
the right half already has.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from poseframes.llm.common import ranks_of, small_batches, text_or_empty, trimmed

#: Characters up to which a text is matched in one go.
LEAF_CHARS = 1 << 11
#: Token ids that one step of decoding joins.
LEAF_IDS = 1 << 9
#: Characters beside a seam on which a match may depend besides its own: a contraction has three.
LOOK = 3
#: Entries of the memos: packed matches, short stretches of them, what neighbours encode to. A full memo is
#: set aside as the older half, from which what is asked for again moves back. Matches of more than
#: LONGEST characters and stretches of more than SHORT bytes are not kept, so memos are small.
MEMO, MEMO_PARTS = 120_000, 80_000
LONGEST, SHORT = 48, 8
#: Bytes of a window up to which neighbours are looked through one by one.
PLAIN = 128

_NONE = 1 << 62


class ByteBPE:
    """An encoder for the ranks of a ``.tiktoken`` file and a pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks_of(path)
        self.bytes_of = dict(zip(self.ranks.values(), self.ranks, strict=True))
        self.pattern = regex.compile(pattern)
        self._joined = _Memo(self._joined_anew, MEMO_PARTS)
        self._short = _Memo(self._by_halves, MEMO_PARTS)
        self._packed = _Memo(self._pack, MEMO)
        self._short.update({bytes([i]): [self.ranks[bytes([i])]] for i in range(256)})

    def merge(self, data: bytes) -> list[int]:
        """The definition, for windows over a seam: join the neighbours of least rank, leftmost first,
        while any has one."""
        if len(data) > PLAIN:
            return self._merge_long(data)
        rank = self.ranks.get
        starts = list(range(len(data) + 1))
        joint = [rank(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
        while joint:
            least = min(joint)
            if least == _NONE:
                break
            i = joint.index(least)
            del joint[i], starts[i + 1]
            if i < len(joint):
                joint[i] = rank(data[starts[i] : starts[i + 2]], _NONE)
            if i:
                joint[i - 1] = rank(data[starts[i - 1] : starts[i + 1]], _NONE)
        return [rank(data[a:b]) for a, b in pairwise(starts)]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same by a heap of neighbours and a linked list of parts, so that time grows with
        n log n. A neighbour in the heap counts while its two parts still begin and end where they did."""
        rank, n = self.ranks.get, len(data)
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            j = after[i]
            if j is None or j >= n or end[j] != stop:
                continue
            end[i], after[i], after[j] = stop, after[j], None
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(data[i : end[after[i]]])) is not None:
                    heappush(heap, (r, i, end[after[i]]))
            if before[i] >= 0 and (r := rank(data[before[i] : stop])) is not None:
                heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = after[i]
        return out

    def _joined_anew(self, pair: int) -> list[int] | bool:
        """What two neighbours encode to; False if they fit."""
        a, b = pair >> 32, pair & 0xFFFFFFFF
        ids = self.merge(self.bytes_of[a] + self.bytes_of[b])
        return ids != [a, b] and ids

    def fits(self, a: int, b: int) -> bool:
        return self._joined[a << 32 | b] is False

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both."""
        if not left or not right:
            return left or right
        joined = self._joined
        window = joined[left[-1] << 32 | right[0]]
        if window is False:
            return left + right
        if (len(left) == 1 or joined[left[-2] << 32 | window[0]] is False) and (len(right) == 1 or joined[window[-1] << 32 | right[1]] is False):
            return left[:-1] + window + right[1:]
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[-a:] + right[:b]))) if a + b > 2 else window
            fits_left = a == len(left) or self.fits(left[-a - 1], window[0])
            fits_right = b == len(right) or self.fits(window[-1], right[b])
            if fits_left and fits_right:
                return left[:-a] + window + right[b:]
            a, b = a if fits_left else 2 * a, b if fits_right else 2 * b

    def _by_halves(self, data: bytes) -> list[int]:
        if len(data) < 2:
            return [self.ranks[data]] if data else []
        half = len(data) // 2
        left, right = data[:half], data[half:]
        if len(right) > SHORT:
            return self.join(self.encode_bytes(left), self.encode_bytes(right))
        return self.join(self._short[left], self._short[right])

    def encode_bytes(self, data: bytes) -> list[int]:
        """By halves; those of few bytes are remembered."""
        return self._short[data] if len(data) <= SHORT else self._by_halves(data)

    def encode_match(self, match: str) -> list[int]:
        """A match that is a token as a whole is that token: the library's rule, whatever merges give."""
        data = match.encode()
        whole = self.ranks.get(data)
        return self.encode_bytes(data) if whole is None else [whole]

    def _pack(self, match: str) -> bytes:
        ids = self.encode_match(match)
        return struct.pack(f"<{len(ids)}I", *ids)

    def matches(self, text: str) -> list[str]:
        """What ``pattern.findall(text)`` gives, by halves."""
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        half = len(text) // 2
        return self.join_matches(self.matches(text[:half]), self.matches(text[half:]))

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        # A match of the left half holds if text behind it shows where it ends, and no contraction
        # could start in it; the others are matched again with the text that follows.
        seam = []
        while left and (not seam or sum(map(len, seam)) < LOOK):
            seam.insert(0, left.pop())
        while left and sum(map(len, seam)) < LOOK + len(seam[0]):
            seam.insert(0, left.pop())
        taken = 1
        while True:
            taken = min(taken, len(right))
            window = "".join(seam) + "".join(right[:taken])
            old, at, ends = len(window) - sum(map(len, right[:taken])), 0, {}
            for k in range(taken + 1):
                ends[old] = k
                old += len(right[k]) if k < taken else 0
            fresh = []
            for m in self.pattern.finditer(window):
                at = m.end()
                if at + LOOK > len(window) and taken < len(right):
                    break
                fresh.append(m.group())
                if at in ends and (ends[at] or taken == len(right)):
                    return left + fresh + right[ends[at] :]
            if taken == len(right):
                return left + fresh
            taken *= 2

    def encode_packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        packed, pack = self._packed, self._pack
        return b"".join([packed[m] if len(m) <= LONGEST else pack(m) for m in self.matches(text)])

    def encode(self, text: str) -> list[int]:
        return unpack(self.encode_packed(text))

    def decode(self, ids) -> bytes:
        """Bytes of the ids, joined up the tree."""
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class _Memo(dict):
    """Results of a function, kept in two halves."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def unpack(packed: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Every document's token ids (little-endian unsigned 32-bit integers) and their number.

    A null text is empty: no ids. Other columns are ignored, repeated rows give repeated results,
    an empty table an empty one. Nothing is shuffled.
    """

    def encode(batches):
        bpe = encoder(ranks_path, pattern)
        for b in small_batches(batches):
            packed = [bpe.encode_packed(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(packed, pa.binary())], names=[id_col, "n_tokens", "ids"])

    rows = docs.select(id_col, text_or_empty(text).alias(text))
    return rows.mapInArrow(trimmed(encode), f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Adds ``decoded`` (bytes) to what ``encode_documents`` returns; null ids give null."""

    def decode(batches):
        bpe = encoder(ranks_path, pattern)
        for b in small_batches(batches):
            data = [None if x is None else bpe.decode(unpack(x)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(data, pa.binary())], names=[*b.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "decoded")
    return encoded.drop("decoded").mapInArrow(trimmed(decode), f"{fields}, decoded binary")


def digest_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode, then decode, and keep digests of both (lowercase hex of SHA-256), in one pass."""

    def digest(batches):
        bpe = encoder(ranks_path, pattern)
        for b in small_batches(batches):
            packed = [bpe.encode_packed(x) for x in b.column(1).to_pylist()]
            decoded = [hashlib.sha256(bpe.decode(unpack(x))).hexdigest() for x in packed]
            ids = [hashlib.sha256(x).hexdigest() for x in packed]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(id_col, text_or_empty(text).alias(text))
    return rows.mapInArrow(trimmed(digest), f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
