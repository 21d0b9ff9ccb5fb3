"""The URL models against plain dictionaries of n-grams."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobloom.llm import url_model


def _plain(text):
    return "\x01" * 4 + "".join("0" if c in "123456789" else c.lower() if "A" <= c <= "Z" else c for c in text)


class Naive:
    def __init__(self, texts):
        self.after, self.total = Counter(), Counter()
        for text in texts:
            padded = _plain(text)
            for i in range(4, len(padded)):
                for k in range(5):
                    self.after[padded[i - k : i], padded[i]] += 1
                    self.total[padded[i - k : i]] += 1

    def log(self, text):
        padded, found = _plain(text), []
        for i in range(4, len(padded)):
            chance = 1 / 256
            for k in range(5):
                context = padded[i - k : i]
                chance = (self.after[context, padded[i]] + 4 * chance) / (self.total[context] + 4)
            found.append(math.log(chance))
        return sum(found) / len(found)


def _urls(number):
    rng = random.Random(5)
    hosts = ["a.org", "good.example.com", "x.example.org", "bäd.net", "Shop.NET", "语.com"]
    paths = ["/fr/", "/de/", "/es/", "/en/1", "/p/", "/kauf?x", "/Über/ü", ""]
    return [f"https://{rng.choice(hosts)}{rng.choice(paths)}{rng.randint(0, 40) * rng.randint(0, 9)}" for _ in range(number)]


def test_scores_and_threshold_equal_the_naive_models(spark):
    urls = _urls(400) + ["https://" + "long." * 4000 + "net/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({c: F.lit("x") for c in ("gram", "score", "fold")})
    rows = url_model.judge(pages).collect()
    verdict = {r.host + r.path: r.verdict for r in rows if r.rule}
    sides = {s: sorted(t for t, v in verdict.items() if v == s) for s in ("allow", "block")}
    models = {s: Naive(t) for s, t in sides.items()}
    judged = [r for r in rows if not r.rule]
    assert len(judged) > 100 and {r.verdict for r in judged} == {"allow", "block"}
    for r in judged:
        text = r.host + r.path
        assert r.score == pytest.approx(models["allow"].log(text) - models["block"].log(text), abs=1e-9)
    fold = lambda t: zlib.crc32(t.encode()) % 5
    fits = {s: Naive([t for t in texts if fold(t)]) for s, texts in sides.items()}
    held = [(s, fits["allow"].log(t) - fits["block"].log(t)) for s, texts in sides.items() for t in texts if not fold(t)]
    table = spark.createDataFrame(held, "verdict string, score double")
    threshold = url_model.threshold_of(table)
    assert all((r.score >= threshold) == (r.verdict == "allow") for r in judged)
    errors = lambda x: sum((v < x) / sum(s == "allow" for s, _ in held) if s == "allow" else (v >= x) / sum(s == "block" for s, _ in held) for s, v in held)
    assert errors(threshold) <= min(errors(v) for _, v in held) + 1e-9


def test_ties_and_missing_sides(spark):
    same = spark.createDataFrame([("allow", 0.5), ("allow", 1.0), ("block", -1.0), ("block", 0.5)], "verdict string, score double")
    assert -1.0 < url_model.threshold_of(same) <= 1.0
    assert url_model.threshold_of(same.where("verdict = 'allow'")) == 0.0
    pages = spark.createDataFrame([(1, "https://a.org/x"), (2, "https://b.net/y"), (3, "https://b")], "page_id long, url string")
    assert [r.verdict for r in url_model.judge(pages).orderBy("page_id").collect()] == ["allow", "allow", "block"]


def test_a_score_at_the_threshold_is_allowed(spark, monkeypatch):
    pages = spark.createDataFrame(list(enumerate(_urls(60))), "page_id long, url string")
    top = max(r.score for r in url_model.judge(pages).where("score is not null").collect())
    monkeypatch.setattr(url_model, "threshold_of", lambda _: top)
    found = url_model.judge(pages).where("score is not null").collect()
    assert {r.verdict for r in found if r.score == top} == {"allow"}
    assert {r.verdict for r in found if r.score < top} <= {"block"}


def test_no_join_is_a_broadcast_of_what_grows(spark, monkeypatch):
    plans = []
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    staged, threshold_of = url_model.stage, url_model.threshold_of
    monkeypatch.setattr(url_model, "stage", lambda df, name: seen(df) or staged(df, name))
    monkeypatch.setattr(url_model, "threshold_of", lambda df: seen(df) or threshold_of(df))
    pages = spark.createDataFrame(list(enumerate(_urls(200))), "page_id long, url string")
    seen(url_model.judge(pages))
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)
