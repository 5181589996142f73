"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (n = 1 to 4) that both have, divided by
the root of the product of how many each has. Nyström landmarks turn it into a few features, and
one-versus-rest ridge regression in them gives a linear score for each language. Since the kernel
with a landmark is itself an inner product of n-gram presence, features and regression fold into
one matrix with a row for each n-gram slot, and a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes.llm.common import fields, small_batches, trimmed

ORDERS = (1, 2, 3, 4)
#: n-grams share this many slots.
SLOTS = 1 << 16
#: The fit reads at most so many labelled rows in all; each language has an equal share.
FIT_ROWS = 1_200
#: Of these, so many are landmarks.
LANDMARKS = 200
RIDGE = 1e-2
#: Documents that are scored by one product, and characters whose n-grams are taken in one go.
BLOCK, PIECE = 64, 1 << 19
#: Slots whose weights are made at once.
STRIP = 1 << 12
UNKNOWN = "und"
#: Below this score even the best classifier plainly denies the text; very short texts stay above it.
ACCEPT = 0.3

_MUL, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _spaced(text: str, after_letter: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code points with a space for what is no letter, and which of them stay: all letters, and of
    others in a row the first."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    return np.where(letter, codes, np.uint32(32)), letter | np.r_[after_letter, letter[:-1]][: len(letter)]


def presence(texts: list[str]) -> np.ndarray:
    """Which n-gram slots each text has, as bytes 0 or 1. Texts are lower-cased and what is not a
    letter counts as one space; a text without letters has no slot. PIECE characters, of one text or
    of several, are taken in one go."""
    out = np.zeros((len(texts), SLOTS), np.uint8)
    rows, codes, size = [], [], 0
    for i, text in enumerate(texts):
        low, after_letter, kept = text.lower(), True, []
        for at in range(0, len(low), PIECE):
            own, keep = _spaced(low[at : at + PIECE], after_letter)
            after_letter = bool(own[-1] != 32)
            kept.append(own[keep])
        own = np.concatenate(kept) if kept else np.empty(0, np.uint32)
        if not (own != 32).any():
            continue
        for at in range(0, len(own), PIECE):
            part = own[at : at + PIECE + max(ORDERS) - 1]
            if size + len(part) > PIECE and rows:
                _mark(out, rows, codes)
                rows, codes, size = [], [], 0
            rows.append(i)
            codes.append(part)
            size += len(part)
    if rows:
        _mark(out, rows, codes)
    return out


def _mark(out: np.ndarray, rows: list[int], parts: list[np.ndarray]) -> None:
    """Set the slots of the n-grams of each part in its row of ``out``."""
    of = np.repeat(np.arange(len(parts), dtype=np.int64), [len(p) for p in parts])
    row = np.array(rows, np.int64)[of] * SLOTS
    one = (np.concatenate(parts).astype(np.uint64) + np.uint64(1)) * _MUL
    one ^= one >> np.uint64(31)
    gram, flat = one, out.reshape(-1)
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            gram = gram[:-1] * _STEP + one[n - 1 :]
        if len(gram) == 0:
            break
        if n in ORDERS:
            inside = of[: len(gram)] == of[n - 1 :]
            slot = ((gram + np.uint64(n)) * _MUL) >> np.uint64(48)
            flat[(row[: len(gram)] + slot.astype(np.int64))[inside]] = 1


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # SLOTS x languages
    bias: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    """Presence divided by the root of its number of slots."""
    x = x.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    return x


def _slots(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes 0 or 1, from such rows or from their bits."""
    return rows if rows.shape[1] == SLOTS else np.unpackbits(rows, axis=1)


def fit(rows: np.ndarray, labels: list[str]) -> Model:
    """Nyström features of presence rows and a ridge regression to +1 and -1 for each label. The rows
    may be bits, eight slots a byte: BLOCK of them and of the landmarks are spread out at once."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model((), np.zeros((SLOTS, 0), np.float32), np.zeros(0, np.float32))
    turn: dict[str, int] = {}
    order = sorted(range(len(labels)), key=lambda i: (turn.update({labels[i]: turn.get(labels[i], -1) + 1}) or turn[labels[i]], i))
    marks = order[:LANDMARKS]
    kernel = np.empty((len(labels), len(marks)))
    for j in range(0, len(marks), BLOCK):
        some = _unit(_slots(rows[marks[j : j + BLOCK]])).T
        for i in range(0, len(labels), BLOCK):
            kernel[i : i + BLOCK, j : j + BLOCK] = _unit(_slots(rows[i : i + BLOCK])) @ some
    some = None
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values[-1] if values[-1] > 0 else values > 0
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([kernel @ root, np.ones((len(labels), 1))])
    goal = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # each label counts as much as any other, however many rows it has
    weight = np.sqrt(len(labels) / (len(languages) * np.array([labels.count(x) for x in labels])))[:, None]
    a = features * weight
    found = np.linalg.solve(a.T @ a + RIDGE * np.eye(a.shape[1]), a.T @ (goal * weight))
    shares, marks = root @ found[:-1], _slots(rows[marks])
    size = np.sqrt(np.maximum(marks.sum(1, keepdims=True, dtype=np.float32), 1))
    weights = np.empty((SLOTS, len(languages)), np.float32)
    for i in range(0, SLOTS, STRIP):
        weights[i : i + STRIP] = (marks[:, i : i + STRIP] / size).T @ shares
    return Model(languages, weights, found[-1].astype(np.float32))


def predict(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """The language that claims each text most, and its value of -1 to 1 carried to 0 to 1."""
    names, scores = [], []
    for i in range(0, len(texts), BLOCK):
        x = presence(texts[i : i + BLOCK])
        size = x.sum(1, dtype=np.int64)
        if not model.languages:
            names += [UNKNOWN] * len(x)
            scores += [0.0] * len(x)
            continue
        value = (x.astype(np.float32) @ model.weights) / np.sqrt(np.maximum(size, 1))[:, None] + model.bias
        best = value.argmax(1)
        top = np.clip((value[np.arange(len(x)), best] + 1) / 2, 0, 1)
        names += [model.languages[b] if n else UNKNOWN for b, n in zip(best, size, strict=True)]
        scores += [float(t) if n else 0.0 for t, n in zip(top, size, strict=True)]
    return names, scores


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the fit never reads."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Model:
    """A model from at most FIT_ROWS rows that have a text and a language and are not held out:
    an equal share of each language, in the order of a hash of the id. The driver gets their n-gram
    slots as SLOTS bits a row, however long they are."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.xxhash64(F.col(id_col)).alias("turn"), F.col(text).alias("text")
    )
    n = rows.select("lang").distinct().count()
    if n == 0:
        return fit(np.zeros((0, SLOTS), np.uint8), [])
    first = W.partitionBy("lang").orderBy("turn", "id")
    chosen = rows.select("id", "lang", "turn").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= max(1, FIT_ROWS // n)).limit(FIT_ROWS)
    chosen = rows.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"], "left_semi")  # FIT_ROWS ids

    def bits(batches):
        for b in small_batches(batches, BLOCK):
            packed = np.packbits(presence(b.column(3).to_pylist()), axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([x.tobytes() for x in packed], pa.binary())], names=["id", "lang", "turn", "slots"])

    kinds = f"id {rows.schema['id'].dataType.simpleString()}, lang string, turn long, slots binary"
    got = chosen.select("id", "lang", "turn", "text").mapInArrow(trimmed(bits), kinds).orderBy("turn", "id", "slots").limit(FIT_ROWS).collect()
    return fit(np.frombuffer(b"".join(r["slots"] for r in got), np.uint8).reshape(len(got), -1), [r["lang"] for r in got])


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` of every row, its language and its score, called ``names``. Only the text
    is read for a prediction. A null text or one without letters is ``und`` with score 0, and so is
    all if the model has learned no language. Repeated rows give repeated results, an empty table an
    empty one. Kept columns may have any names but those in ``names``, else the call raises.
    """
    if {n.lower() for n in names} & {c.lower() for c in keep}:
        raise ValueError(f"a kept column is called like one of {names}")
    at = keep.index(text) if text in keep else len(keep)

    def run(batches):
        for b in small_batches(batches, BLOCK):
            found, scores = predict(model, [x or "" for x in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*keep, *names])

    rows = docs.select(*keep, *([] if text in keep else [text]))
    kinds = fields(rows.select(*keep).schema)
    return rows.mapInArrow(trimmed(run), f"{kinds}, `{names[0]}` string, `{names[1]}` double")
