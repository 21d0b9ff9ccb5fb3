"""What op10 sees and counts, by hand-made texts and brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import toxicity
from jobloom.llm import toxicity_votes as tv


def _prose(n, seed, letters="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(letters, k=6)) for _ in range(n))


def _tables(spark, rows):
    """Documents and labels of (text, toxic), all outside the held-out fold."""
    ids = [i for i in range(4 * len(rows)) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, rows)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, x) for i, (_, x) in zip(ids, rows)], "doc_id long, toxic int")


def _mined(spark, rows):
    labelled = toxicity._labelled(*_tables(spark, rows))
    totals = toxicity._totals(labelled)
    return totals, {r.feature for r in toxicity._typical(toxicity._counted(labelled), *totals).collect()}


def test_unlike_texts_that_share_a_word_are_counted_apart(spark):
    toxic = [f"the of and to in is zorgulent {_prose(30, i)}" for i in range(12)]
    clean = [f"the of and to in is {_prose(30, 100 + i)}" for i in range(150)]
    totals, mined = _mined(spark, [(t, 1) for t in toxic] + [(t, 0) for t in clean])
    assert totals == (12, 150)
    assert "zorgulent" in mined and not {"the", "and"} & mined


def test_copies_count_once(spark):
    base = _prose(400, 1)
    rows = [(base, 1)] * 20 + [(base.upper() + " \n", 1)] * 5 + [(_prose(30, 100 + i), 0) for i in range(150)]
    totals, mined = _mined(spark, rows)
    assert totals == (1, 150) and mined == set()
    near = [toxicity._copy_key(f"{base} zorgulent{c}") == toxicity._copy_key(base) for c in "abcdefghij"]
    assert np.mean(near) > 0.8


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(" ".join(rng.choices(["alpha", "alpine", "beta", "betas", "été", "étés", "gamma", "x"], k=rng.randint(1, 6))) + f" {_prose(8, i)}", int(i % 5 == 0)) for i in range(300)]
    labelled = toxicity._labelled(*_tables(spark, rows))
    found = {r.feature: (r.a, r.b) for r in toxicity._counted(labelled).collect()}
    texts = defaultdict(dict)
    for text, toxic in rows:
        texts[toxic][toxicity._copy_key(text)] = min(texts[toxic].get(toxicity._copy_key(text), "~"), " ".join(sorted(set(tv.words_of(text)))))
    counts = {x: Counter(f for w in texts[x].values() for f in _plain_features(set(w.split()))) for x in (0, 1)}
    assert found == {f: (a, counts[0][f]) for f, a in counts[1].items() if a >= toxicity.LEAST_TEXTS}


def _plain_features(words):
    found = {w for w in words if len(w) > 2}
    for n in tv.BEGINNINGS:
        for begun in {w[:n] for w in words if len(w) > n}:
            times = sum(w.startswith(begun) and len(w) > n for w in words)
            found |= {begun + "~"} | {f"{begun}~{k}" for k in tv.SEVERAL if times >= k}
    return found


def test_features_by_definition():
    for text in ("Eine größere Überraschung, été!", "achlich achlicher achlichste achliches achl", "", "𝒳𝒳𝒳𝒳𝒳x ½ x_y"):
        words = set(tv.words_of(text))
        assert tv.features_of(words) == _plain_features(words)
        cues = tv.Cues({f: i for i, f in enumerate(sorted(_plain_features(words)))})
        assert cues.of_words(words, 0) == list(range(len(cues.place)))


@pytest.mark.parametrize("name,text", [
    ("masked", "what an 1d10t he is"), ("masked", "such a m*r*n"), ("spaced", "you i d i o t there"),
    ("stretched", "idiooooot"), ("address", "you are such an idiot"), ("address", "du bist ein Trottel"),
    ("phrase", "now shut up please"), ("phrase", "halt die Fresse"), ("repeated", "idiot here, idiot there"),
    ("shouted", "an IDIOT"), ("several lists", "a worthless idiot"),
])
def test_patterns(name, text):
    words = tv.words_of(text)
    seen = tv.patterns_of(text, words, set(words))
    assert seen >> tv.PATTERNS.index(name) & 1
    for plain in ("the shut door", "a b c d e f", "1 2 3", "see you later", None, "", "www.some.example.org 10.5 a*b"):
        words = tv.words_of(plain)
        assert tv.patterns_of(plain, words, set(words)) == 0


def test_lucky_words_of_a_blurred_beginning_go():
    counts = {"achlichab": (14, 2), "achlich~3": (40, 1), "loser": (86, 0), "lose~": (86, 14)}
    around = {"achlich~": (45, 27, 30), "lose~": (86, 14, 6)}
    assert tv.distinct_features(counts, around, 0.05) == ["achlich~3", "loser", "lose~"]
    assert tv.without_blurred({"loser": (86, 0), "lose~": (86, 14), "mild~": (5, 0)}) == ["loser", "mild~"]
    assert tv.beyond_chance(10, 0, 0.5) == pytest.approx(10 * math.log(2))


def test_votes_and_clean_voters():
    cues = tv.Cues({"bomente~": 0, "bomente~2": 1, "bomente~3": 2, "idiot": 3})
    rows = [cues.of(t) for t in ("bomentexa bomentexb bomentexc", "bomentexa", "nothing here", "an idiot, idiot!")]
    votes = cues.votes(rows)
    three, one, none, listed = votes.tolist()
    assert sum(three[: cues.families]) == 1 and three[-2:] == [0, 0]
    assert sum(one[: cues.families]) == 1 and one[-2:] == [0, -1]
    assert sum(map(abs, none)) == 1 and none[-2:] == [-1, 0]
    assert sum(listed) >= 3 and listed[-2:] == [0, 0]
    assert (cues.built_in() == cues.built_in().T).all()


def test_label_model_sums_equal_plain_ones_and_it_learns(spark):
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.2
    accuracy = np.array([0.9, 0.8, 0.7, 0.75])
    fires = rng.random((4000, 4)) < np.where(truth[:, None], accuracy, 0.004)
    votes = np.concatenate((fires, -(~fires.any(axis=1)).astype(np.int8)[:, None]), axis=1).astype(np.int8)
    kinds = spark.createDataFrame([(v.tobytes(), 1) for v in votes], "votes binary, n long")
    known = toxicity._by_label(votes[:400], truth[:400])
    model = toxicity.LabelModel(known, 0.2, np.eye(5, dtype=bool))
    plain = model.sums(votes, np.ones(4000))
    assert np.abs(toxicity.vote_sums(kinds, model.sums, 5) - plain).max() < 0.01
    model.fit(kinds, 3)
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.97
    assert model.accuracy[1][0, 2] > model.accuracy[1][2, 2]


def test_the_sample_bounds_the_classifier_only(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 3)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 5)
    rows = [(f"zorgulent {_prose(30, i)}", 1) if i < 30 else (_prose(30, i), 0) for i in range(430)]
    docs, labels = _tables(spark, rows)
    seen = {}
    by_label, model_of = toxicity._by_label, toxicity.LabelModel

    def looked_at(known, prior, built_in):
        seen.update(known=known[:, 0, 0].tolist(), prior=prior)
        return model_of(known, prior, built_in)

    monkeypatch.setattr(toxicity, "LabelModel", looked_at)
    model = toxicity.fit(docs, labels)
    # Three toxic texts are too few to mine from; thirty in 430 are not.
    assert set(model.cues.place) <= {"zorgulent", "zorg~", "zorgu~", "zorgul~", "zorgule~"} and model.cues.place
    assert seen["known"] == [400, 30] and seen["prior"] == 30 / 430
    assert by_label is toxicity._by_label


def test_sample_is_weighted_back_to_all_groups():
    weight = toxicity._sample_weights(np.array([1, 1, 0, 0, 0]), (10, 99))
    assert weight.tolist() == [5, 5, 33, 33, 33]


def test_a_score_at_the_threshold_is_toxic(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    exact = F.when(F.col("text") == "a", F.lit(0.7)).otherwise(F.lit(0.699999999))
    monkeypatch.setattr(toxicity, "fit", lambda *_: None)
    monkeypatch.setattr(toxicity, "toxicity_of", lambda *_: exact)
    found = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, docs).collect()}
    assert found == {1: 1, 2: 0}
    assert [r.doc_id for r in toxicity.without_toxic(docs, docs).collect()] == [2]


def test_held_out_recall_by_language(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(docs, labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = scored.where("toxic is not null").collect()
    recall = {lang: np.mean([r.predicted for r in rows if r.toxic and r.lang == lang]) for lang in ("en", "fr", "de", "es")}
    floors = {"en": 0.89, "fr": 0.9, "de": 0.7, "es": 0.85}
    assert all(recall[lang] >= floor for lang, floor in floors.items()), recall
    assert sum(r.predicted for r in rows if not r.toxic) <= 6
