"""Fill-in-middle against slicing plain strings, on texts that are hard to chunk."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import fill_in_middle as fim


def plain(doc_id, text):
    text, n = text or "", len(text or "")
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def _texts():
    rng = random.Random(3)
    shared = ["".join(rng.choices("aäß語🙂 <PSM>\n", k=rng.randint(1, 900))) for _ in range(6)]
    for i in range(150):
        text = "".join(rng.choice(shared) if rng.random() < 0.7 else chr(rng.randint(32, 0x2FFF)) for _ in range(i % 9))
        yield text.replace("<P>", "").replace("<S>", "").replace("<M>", "") if i % 4 else text
    yield from (None, "", "<", "<P", "<P>", "x<S>y", "<<M>>", "a" * 40_000, "🙂" * 9_000, "<P" * 5_000, "<M" * 9000 + "<M>")


def test_every_text_equals_plain_slicing(spark):
    rows = list(enumerate(_texts())) + [(None, "no id at all"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x"))
    found = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    expected = sorted(repr((i, *plain(i, t), t or "")) for i, t in rows)
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected
    assert {r.form for r in found.select("form").distinct().collect()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_markers_are_found_across_any_chunks(size):
    cache = fim.ChunkCache()
    for text in ("ab<P>cd", "<S>", "x<M>", "<P<S<M", "a>b<", "ä<P>ö", "<P<P>"):
        data = text.encode()
        ends = [*range(size, len(data), size), len(data)]
        for doc_id in range(40):
            n, form, prefix, middle, output = plain(doc_id, text)
            assert fim.transform(doc_id, data, ends, cache) == (n, form, prefix, middle, output.encode())


def test_cuts_follow_the_content_and_the_blocks_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 256, 60_000).astype(np.uint8)
    places = fim.cut_places(shared)
    assert 100 < len(places) < 500
    ahead = rng.integers(0, 256, 777).astype(np.uint8)
    moved = fim.cut_places(np.concatenate((ahead, shared)))
    inside = places[places >= fim.WINDOW]
    assert set(inside + 777) <= set(moved.tolist())
    monkeypatch.setattr(fim, "_BLOCK", 1000)
    assert fim.cut_places(shared).tolist() == places.tolist()


def test_the_rolling_hash_equals_its_definition():
    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog " * 40, np.uint8)
    cuts = set(fim.cut_places(data).tolist())
    for i in range(len(data)):
        value = sum(int(fim._GEAR[data[i - k]]) << k for k in range(min(32, i + 1))) % (1 << 32)
        assert (i + 1 in cuts) == (value >> (32 - fim.CUT_BITS) == 0)


def test_the_cache_is_bounded_and_changes_nothing():
    small, large = fim.ChunkCache(2_000), fim.ChunkCache()
    chunks = [bytes([i % 251, i % 7]) * 50 for i in range(500)] * 2
    assert [small(c) for c in chunks] == [large(c) for c in chunks] == list(map(fim.summary_of, chunks))
    assert small.bytes <= 2_000 + 400 and len(small.known) < len(large.known)
