"""Quality rules against plain histograms, and what the limits must catch."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from jobloom.llm import quality_divergence as qd

SHAPE = "doc_id long, text string, lang string"


def _distance(a, b):
    """Jensen-Shannon distance of two dictionaries of counts, from the definition."""
    n, m = sum(a.values()), sum(b.values())
    found = 0.0
    for key in a.keys() | b.keys():
        p, q = a.get(key, 0) / n, b.get(key, 0) / m
        for x in (p, q):
            if x:
                found += x * math.log2(x / ((p + q) / 2)) / 2
    return math.sqrt(max(found, 0))


def _class(c):
    if c == " ":
        return "space"
    if c in "\t\n\v\f\r":
        return "white"
    if ord(c) < 0x20 or 0x7F <= ord(c) < 0xA0:
        return "control"
    if ord(c) < 0x250 and c.islower():
        return "lower"
    if ord(c) < 0x250 and c.isupper():
        return "upper"
    if ord(c) < 0x80:
        return "digit" if c.isdigit() else "point" if c in ".,;:!?'\"()-" else "sign"
    return "other"


def _words(text):
    out, run = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            run += c
        elif run:
            out.append(run)
            run = ""
    return out


def _corpus(share=0.5):
    rng = random.Random(11)
    common = {"xx": [f"c{chr(97 + i // 9)}{chr(97 + i % 9)}" for i in range(50)], "yy": [f"ü{chr(97 + i // 9)}{chr(97 + i % 9)}É" for i in range(50)]}
    rows = []
    for i in range(160):
        lang = "xx" if i % 2 else "yy"
        words = [rng.choice(common[lang]) if rng.random() < share else "".join(rng.choices("mnopqrst", k=7)) for _ in range(rng.randint(90, 200))]
        rows.append((i, " ".join(words) + ". 12, A-B (c);\n", lang))
    return rows, common


def test_distances_equal_plain_histograms(spark):
    rows, _ = _corpus()
    docs = spark.createDataFrame(rows, SHAPE)
    known = qd.references(docs)
    found = {r.doc_id: r for r in qd.judge(docs).collect()}
    classes, words = ({lang: Counter() for lang in ("xx", "yy")} for _ in range(2))
    for _, text, lang in rows:
        classes[lang].update(map(_class, text))
        words[lang].update(_words(text))
    tops = {lang: sorted(c, key=lambda w: (-c[w], w.encode()))[:50] for lang, c in words.items()}
    assert {lang: set(tops[lang]) for lang in tops} == {lang: set(w) for lang, w in zip(known.languages, known.words)}

    def shares(counts, top):
        return {**{w: counts[w] for w in top}, "": sum(counts.values()) - sum(counts[w] for w in top)}

    for i, text, lang in rows:
        own, own_words = Counter(map(_class, text)), Counter(_words(text))
        by_class = {x: _distance(own, c) for x, c in classes.items()}
        by_word = {x: _distance(shares(own_words, tops[x]), shares(words[x], tops[x])) for x in tops}
        assert found[i].class_distance == pytest.approx(by_class[lang], abs=1e-9)
        assert found[i].word_distance == pytest.approx(by_word[lang], abs=1e-9)
        # Without a known language the nearest one counts.
        near = known.distances(text, "zz")
        assert near[0] == pytest.approx(min(by_class.values()), abs=1e-9)
        assert near[2] == pytest.approx(min(by_word.values()), abs=1e-9)


@pytest.mark.parametrize("share", [0.2, 0.35, 0.6])
def test_a_text_without_common_words_fails_whatever_their_share(spark, share):
    rows, _ = _corpus(share)
    junk = " ".join("".join(random.Random(i).choices("mnopqrst", k=7)) for i in range(150)) + ". 12 ;\n"
    found = {r.doc_id: r.kept for r in qd.judge(spark.createDataFrame([*rows, (-1, junk, None)], SHAPE)).collect()}
    assert not found.pop(-1) and np.mean(list(found.values())) > 0.8


def test_much_junk_does_not_widen_a_limit(spark):
    rows, _ = _corpus()
    signs = [(1000 + i, "".join(random.Random(i).choices("#$%&{}[]~^ ", k=600)), "xx") for i in range(12)]
    plain = {r.doc_id: r for r in qd.judge(spark.createDataFrame(rows, SHAPE)).collect()}
    both = {r.doc_id: r for r in qd.judge(spark.createDataFrame(rows + signs, SHAPE)).collect()}
    assert not any(both[i].kept for i, _, _ in signs)
    assert np.mean([both[i].kept for i, _, _ in rows]) > 0.95


def test_labelled_good_stay_and_most_labelled_bad_go(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = qd.judge(docs).join(labels.where("quality is not null"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) == 1.0
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.45
