"""Quality rules from compression: zstandard ratios of whole texts and of fixed chunks.

Repetitive text compresses too well, noise hardly at all. How well ordinary prose compresses
depends on how much of it there is, so each band of lengths has limits of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from poseframes.llm.common import record_batch, small_batches, text_or_empty, trimmed

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: Characters from which on a text is counted in pieces, and those of a piece.
LONG, PIECE = 1 << 20, 1 << 18


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio compressed bytes / bytes. ``whole``: (bytes below which it holds or
    None, least, most). Full chunks have one length and so one pair of limits; a text fails if
    more than ``bad_chunks`` of its full chunks are outside."""

    whole: tuple[tuple[int | None, float, float], ...] = (
        (500, 0.48, 0.85), (1_000, 0.455, 0.78), (2_000, 0.45, 0.70), (4_000, 0.435, 0.65),
        (8_000, 0.415, 0.62), (16_000, 0.40, 0.60), (64_000, 0.38, 0.60), (None, 0.36, 0.60),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.43, 0.70)
    bad_chunks: float = 0.3
    level: int = 3


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_OUT = pa.schema([*((c, pa.int64()) for c in _COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()), ("bad_chunks", pa.int64())])


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated three-word windows.

    ``bytes.split()`` splits at the six ASCII white-space characters and nothing else. A text of over
    LONG characters is counted in pieces, with 64-bit hashes for its windows and lines: 16 bytes a
    word at a time instead of some hundreds.
    """
    if len(text) > LONG:
        return _counts_in_pieces(text)
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = 0
    for line in text.split("\n"):
        if line in seen:
            lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        first: dict[tuple, int] = {}
        covered = bytearray(len(words))
        for i, w in enumerate(windows):
            j = first.setdefault(w, i)
            if j != i:
                covered[i : i + 3] = covered[j : j + 3] = b"\1\1\1"
        repeated = sum(covered)
    return len(words), chars, symbols, lines, repeated


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters that end before white space."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[at:end]
        at = end


def _counts_in_pieces(text: str) -> tuple[int, int, int, int, int]:
    digest = xxhash.xxh3_64_intdigest
    n, windows, carry = 0, [], np.empty(0, np.uint64)
    for piece in _pieces(text):
        words = piece.encode().split()
        n += len(words)
        h = np.r_[carry, np.fromiter(map(digest, words), np.uint64, len(words))]
        if len(h) > 2:
            w = h[:-2]
            for more in (h[1:-1], h[2:]):
                w = (w ^ (w >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + more
            windows.append(w)
        carry = h[-2:]
    window = np.concatenate(windows) if windows else carry[:0]
    del windows
    order = np.sort(window)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    del order
    covered = np.zeros(n, bool)
    for lo in range(0, len(window) if len(twice) else 0, PIECE):
        w = window[lo : lo + PIECE]
        at = lo + np.flatnonzero(twice[np.minimum(np.searchsorted(twice, w), len(twice) - 1)] == w)
        for i in range(3):
            covered[at + i] = True
    seen: set[int] = set()
    lines = at = 0
    while at <= len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        line = text[at:end]
        if line.strip(SPACES):
            h = digest(line.encode())
            lines += h in seen
            seen.add(h)
        at = end + 1
    chars = len(text) - sum(map(text.count, SPACES))
    return n, chars, sum(map(text.count, SYMBOLS)), lines, int(covered.sum())


def verdict(data: bytes, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple[bool, float | None, int]:
    """Whether the text is within its bands, its ratio, and the full chunks outside theirs."""
    if not data:
        return False, None, 0
    ratio = len(zstd.compress(data)) / len(data)
    least, most = next((lo, hi) for below, lo, hi in bands.whole if below is None or len(data) < below)
    size = bands.chunk_bytes
    chunks = [len(zstd.compress(data[i : i + size])) / size for i in range(0, len(data) - size + 1, size)]
    bad = sum(not bands.chunk[0] <= r <= bands.chunk[1] for r in chunks)
    return least <= ratio <= most and bad <= bands.bad_chunks * len(chunks), ratio, bad


def compression_bands(docs: DataFrame, bands: Bands = Bands(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document its base counts, ``base_failed``, ``kept``, the whole text's ratio and the
    number of full chunks outside their limits.

    A null text has no words, fails the base rules and has a null ratio; so has an empty one.
    Texts of any length are judged whole; a task holds a long one, its bytes and 16 bytes for each of
    its words. Other columns are ignored, repeated rows give repeated results, an empty table an
    empty one. Nothing is shuffled.
    """

    def judge(batches):
        zstd = zstandard.ZstdCompressor(level=bands.level)
        for b in small_batches(batches):
            rows = []
            for x in b.column(1).to_pylist():
                n, chars, symbols, lines, repeated = base_counts(x)
                failed = n < 50 or 100 * repeated > 50 * n
                fine, ratio, bad = verdict(x.encode(), bands, zstd)
                rows.append((n, chars, symbols, lines, repeated, failed, fine and not failed, ratio, bad))
            out = record_batch(_OUT, *(zip(*rows, strict=True) if rows else [[]] * len(_OUT)))
            yield pa.RecordBatch.from_arrays([b.column(0), *out.columns], names=[id_col, *_OUT.names])

    rows = docs.select(id_col, text_or_empty(text).alias(text))
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return rows.mapInArrow(trimmed(judge), f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, {counts}, base_failed boolean, kept boolean, ratio double, bad_chunks long")
