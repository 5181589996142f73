"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poseframes.llm.common import byte_batches, record_batch, small_batches, text_or_empty, trimmed

#: UTF-8 bytes (about) that one call of the library encodes.
BATCH_BYTES = 1 << 20
#: Longer texts are split at safe boundaries into parts of about this many characters.
PART_CHARS = 1 << 15

_OUT = pa.schema([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_META = "▁"


class _Piece:
    """A sentencepiece model. A part may end before a space that follows a non-space: no piece
    of the vocabulary spans such a place (checked on load), and the space itself is what the
    library puts before any text, so the next part starts behind it."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        n = spec.normalizer_spec
        self.splits = (
            n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces and not n.precompiled_charsmap
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and not any(re.search(f"[^{_META}]{_META}", p.piece) for p in spec.pieces)
            and not any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in spec.pieces)
        )

    def parts(self, text: str, most: int) -> list[str]:
        if not self.splits or len(text) <= most:
            return [text]
        out, start = [], 0
        while len(text) - start > most:
            at = text.find(" ", start + most)
            while at > 0 and (text[at - 1] in f" {_META}"):
                at = text.find(" ", at + 1)
            if at < 0 or at + 1 >= len(text):
                break
            out.append(text[start:at])
            start = at + 1
        out.append(text[start:])
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.lib.encode(texts, num_threads=1)]


class _Json:
    """A model of the tokenizers library; its texts are never split."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()

    def parts(self, text: str, most: int) -> list[str]:
        return [text]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.lib.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _model(path: str):
    return _Json(path) if path.endswith(".json") else _Piece(path)


def text_lengths(texts: list[str], model_path: str, part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES) -> list[int]:
    """Tokens of each text: parts of long texts and whole short ones go in batches of equal bytes."""
    model, owner, units = _model(model_path), [], []
    for i, text in enumerate(texts):
        for part in model.parts(text, part_chars):
            owner.append(i)
            units.append(part)
    counts = [0] * len(texts)
    for group in byte_batches(units, batch_bytes):
        for k, n in zip(group, model.lengths([units[k] for k in group]), strict=True):
            counts[owner[k]] += n
    return counts


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document its id, UTF-8 bytes, tokens and whether they are more than ``limit``.

    A null text counts as empty (0 bytes, 0 tokens). Other columns are ignored, repeated rows
    give repeated results and an empty table an empty one. Nothing is shuffled; each Arrow batch
    returns two numbers a row. ``model_path`` must exist on the executors.
    """

    def lengths(batches):
        for b in small_batches(batches):
            texts = b.column(1).to_pylist()
            out = record_batch(_OUT, [len(x.encode()) for x in texts], text_lengths(texts, model_path))
            yield pa.RecordBatch.from_arrays([b.column(0), *out.columns], names=[id_col, "n_bytes", "n_tokens"])

    rows = docs.select(id_col, text_or_empty(text).alias(text))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(trimmed(lengths), f"`{id_col}` {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
