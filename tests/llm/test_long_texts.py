"""Very long texts and matches: the same results as for short ones, in bounded time and memory."""

import random
import resource
import subprocess
import sys
import time

import public_tokenizers
import pytest

from poseframes.llm import byte_bpe as B
from poseframes.llm import compression_bands as C

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_counts_in_pieces(monkeypatch):
    rng = random.Random(2)
    words = ["a", "the", "é", "lorem", "x$y", "#", "zwölf", "\x85", "b"]
    for size in (0, 1, 2, 3, 7, 50, 400, 3000):
        for spaces in (" ", " \n", " \n\t\x0b\x0c\r"):
            text = "".join(rng.choice(words) + rng.choice(spaces) * rng.choice([1, 1, 1, 3]) for _ in range(size))
            text += rng.choice(["", "\n", text[: len(text) // 3]])
            want = C.base_counts(text)
            with monkeypatch.context() as m:
                m.setattr(C, "LONG", -1)
                m.setattr(C, "PIECE", rng.choice([1, 5, 64, 1 << 18]))
                assert C.base_counts(text) == want


def test_counts_of_a_hundred_megabytes():
    code = f"""
import random, resource, sys
sys.path.insert(0, {repr(sys.path[0])})
import zstandard
from poseframes.llm import compression_bands as C
rng = random.Random(1)
words = [("".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 9)))) for _ in range(5000)]
line = " ".join(rng.choice(words) for _ in range(200_000))
text = "\\n".join(line[i:] for i in range(0, 80))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
print(len(text), C.base_counts(text)[0], C.verdict(text.encode(), C.Bands(), zstandard.ZstdCompressor(level=3))[1] < 1, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr
    size, n, fine, kilobytes = out.stdout.split()
    assert int(size) > 100_000_000 and int(n) > 15_000_000 and fine == "True" and int(kilobytes) < 1_000_000


def test_long_merges_are_the_definition(monkeypatch):
    e = B.ByteBPE(PATH, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for alphabet in ("ab", "etaoinshrdlu", "abcdefghijklmnop", "éèàß", "the and of "):
        for size in (0, 1, 2, 3, 40, 300, 1500):
            data = "".join(rng.choice(alphabet) for _ in range(size)).encode()
            with monkeypatch.context() as m:
                m.setattr(B, "PLAIN", 1 << 30)
                want = e.merge(data)
            assert e._merge_long(data) == want


@pytest.mark.parametrize("seed", range(3))
def test_a_match_of_a_megabyte(seed):
    """Random letters keep some seams unsettled for thousands of bytes."""
    e = B.ByteBPE(PATH, public_tokenizers.PATTERN)
    rng = random.Random(seed)
    text = "".join(rng.choice("abcdefghijklmnop") for _ in range(1_000_000))
    began = time.process_time()
    got = e.encode_match(text)
    assert time.process_time() - began < 20  # four to eight seconds on a busy machine, minutes before
    assert got == e._merge_long(text.encode()) and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 4_000_000


def test_no_neighbours_are_merged_twice():
    import public_tokenizers

    e = B.ByteBPE(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    merge, seen = e.merge, []
    e.merge = lambda data: seen.append(data) or merge(data)
    got = e.encode_match("zqxjkvwpyg")
    assert b"".join(e.bytes_of[i] for i in got) == b"zqxjkvwpyg"
    assert len(seen) == len(set(seen))
