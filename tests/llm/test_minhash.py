"""MinHash fingerprints and classes against plain sets of shingles."""

import hashlib
import random

import numpy as np
import pytest

from jobloom.llm import minhash as mh

SHAPE = "doc_id long, text string"


def shingle_set(text):
    words = [w for w in (text or "").translate(str.maketrans("ABCXYZ\t\n\v\f\r", "abcxyz" + " " * 5)).split(" ") if w]
    size = min(5, len(words))
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def _texts(number, rng):
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ne", "ü", "st", "語")]
    return [" ".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(number)]


@pytest.mark.parametrize("block", [1, 1 << 18])
def test_shingles_are_those_of_plain_sets(monkeypatch, block):
    monkeypatch.setattr(mh, "_BLOCK", block)
    rng = random.Random(2)
    seen = {}
    for text in [*_texts(60, rng), "", " \n", "one", "A b C", "a b c d e", "x" * 5000 + " y"]:
        hashes, plain = set(mh.shingles(text.encode()).tolist()), shingle_set(text)
        assert len(hashes) == len(plain)
        for shingle in plain:
            words = shingle.split(" ")
            own = mh.shingles(shingle.encode()).tolist()
            assert len(own) == 1 and own[0] in hashes
            assert seen.setdefault(own[0], words) == words


def test_signature_is_the_least_of_each_permutation():
    hashes = mh.shingles(b"some words that make a few shingles of five words each " * 30)
    for i in (0, 1, 77, 127):
        least = min((int(mh._A[i, 0]) * x + int(mh._B[i, 0])) % (1 << 64) for x in hashes.tolist())
        assert mh.signature(mh.least_values(hashes))[i] == least >> 16 & 0xFFFF
    assert all(a % 2 for a in mh._A[:, 0].tolist())


def test_parts_give_the_signature_of_the_whole():
    rng = random.Random(4)
    for text in [*_texts(80, rng), "", " ", "a", "a b c d e f", "a  b   c    "]:
        for cut in {0, len(text), rng.randint(0, len(text)), rng.randint(0, len(text))}:
            other = rng.choice(["", " ", "tail of words", text[:7], "x"])
            own, edited = mh.edited_signature(text[:cut].encode(), other.encode(), text[cut:].encode())
            assert (own == mh.text_signature(text)).all()
            assert (edited == mh.text_signature(text[:cut] + other)).all()


def test_likeness_estimates_jaccard():
    rng = random.Random(6)
    gaps = []
    for text in _texts(300, rng):
        words = text.split()
        for i in range(0, len(words), rng.randint(5, 40)):
            words[i] = "changed"
        other = " ".join(words)
        estimate = mh.likeness(mh.text_signature(text), mh.text_signature(other))
        gaps.append(estimate - jaccard(shingle_set(text), shingle_set(other)))
    assert abs(np.mean(gaps)) < 0.01 and np.std(gaps) < 0.06


def naive_rows(rows):
    key = lambda r: -(1 << 63) if r[0] is None else r[0]
    ids = sorted({key(r) for r in rows})
    first = {i: min((t or "" for d, t in rows if key((d,)) == i), key=str.encode) for i in ids}
    for doc_id, text in rows:
        text = text or ""
        after = first[ids[(ids.index(key((doc_id,))) + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, other, next_one = map(mh.text_signature, (text, edited, after))
        yield (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(),
            other.tobytes().hex(), float((own == other).mean()), float((own == next_one).mean()),
        )


@pytest.mark.parametrize("kind", ["plain", "one id", "hot ids", "one row", "few"])
def test_rows_equal_the_naive_ones(spark, kind):
    rng = random.Random(8)
    texts = _texts(90, rng) + ["", None, "ü" * 50_000]
    ids = {
        "plain": rng.sample(range(-1000, 1000), len(texts)), "one id": [5] * len(texts),
        "hot ids": [rng.choice([3, 3, 3, 9, 9, 9, None, *range(12)]) for _ in texts],
        "one row": [1], "few": [4, 2, None],
    }[kind]
    rows = list(zip(ids, texts)) + [(ids[0], texts[0])] * 2
    docs = spark.createDataFrame(rows, SHAPE).repartition(5)
    found = mh.fingerprint_documents(docs).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, naive_rows(rows)))


def test_classes_are_those_of_all_pairs(spark):
    rng = random.Random(9)
    texts = [t for t in _texts(60, rng) if len(t.split()) > 40]
    for text in list(texts[:25]):
        for _ in range(4):  # near copies, and some less near
            words = text.split()
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = "new" + rng.choice("abc")
            texts.append(" ".join(words))
    texts += ["", None, " ", "same same", texts[3], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), SHAPE)
    root = list(range(len(texts)))
    sets = list(map(shingle_set, texts))
    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= mh.LEAST_LIKENESS and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    found = {r.doc_id: r.component_id for r in mh.near_duplicates(docs).collect()}
    assert found == dict(enumerate(root))
    assert len(set(root)) < len(texts) - 20
