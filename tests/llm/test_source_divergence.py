"""The divergence audit against every term of every pair, without a tree."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobloom.llm import source_divergence as sd

SHAPE = "text string, lang string, source string"


def naive(rows):
    groups, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        groups[lang, source].update(terms)
        langs[lang].update(terms)
        docs[lang].update(set(terms))
    found = []
    for lang in langs.keys() | {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= sd.LEAST_DOCUMENTS]

        def shares(counts):
            below = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // below for t in kept}

        own = {s: shares(c) for (g, s), c in groups.items() if g == lang}
        whole = shares(langs[lang])
        for source, p in own.items():
            pairs = [(-sum(abs(p[t] - q[t]) for t in kept), other.encode()) for other, q in own.items() if other != source]
            terms = [(whole[t] - p[t], t.encode()) for t in kept if groups[lang, source][t] and p[t] > whole[t]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[: sd.MOST_TERMS])):
                found += [(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(listed, 1)]
    return sorted(found)


def _rows(seed, sources, words):
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        lang, source = rng.choice(["en", "de", None]), rng.choice(sources)
        bias = len(source or "") % 5
        text = " ".join(rng.choices(words, weights=[1 + (j + bias) % 6 * (j % 3) for j in range(len(words))], k=rng.randint(0, 60)))
        rows.append((text, lang, source))
    # A source of its own terms, repeats of a row, a null text, a language without kept terms.
    rows += [("Only here only HERE", "en", "lone")] * 35 + [(None, "en", "silent"), (None, None, None)]
    rows += [("ein paar seltene Worte", "xx", "a"), ("mehr davon", "xx", "b"), ("", "yy", "alone")]
    return rows


@pytest.mark.parametrize("sources", [["a"], ["a", "bb", None, "ddd"], [f"s{'x' * (i % 7)}{i}" for i in range(14)]])
def test_audit_equals_the_naive_one(spark, sources):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)] + ["ÄÖ", "été", "語", "İx"]
    rows = _rows(len(sources), sources, words)
    docs = spark.createDataFrame(rows, SHAPE).withColumns({c: F.lit("x") for c in ("term", "n", "p", "rank", "value")})
    found = sorted(tuple(r) for r in sd.audit(docs).collect())
    assert found == naive(rows)


def _summed(batches):
    found = Counter()
    for batch in batches:
        for row in batch.to_pylist():
            found[row["lang"], row["a"], row["b"]] += row["value"]
    return {k: v for k, v in found.items() if v}


def test_tree_equals_all_terms_one_by_one(monkeypatch):
    rng = random.Random(4)
    zero = {f"s{i:02}": rng.randint(1, 9) for i in range(12)}
    paths = []
    for _ in range(600):
        sources = sorted(rng.sample(sorted(zero), rng.randint(1, 6)))
        nodes = [{"source": s, "n": (n := rng.randint(1, 3)), "p": 10 * n + zero[s], "z": zero[s]} for s in sources]
        paths.append((rng.choice(["de", "en"]), nodes, rng.randint(1, 4)))
    paths.sort(key=lambda r: (r[0], [(x["source"], x["n"]) for x in r[1]]))
    expected = Counter()
    for lang, nodes, times in paths:
        for j, b in enumerate(nodes):
            for a in nodes[:j]:
                none = abs(a["z"] - b["z"])
                both, left, right = abs(a["p"] - b["p"]), abs(a["p"] - b["z"]), abs(b["p"] - a["z"])
                expected[lang, a["source"], b["source"]] += times * (both - none - (left - none) - (right - none))
    node = pa.struct([("source", pa.string()), ("n", pa.int64()), ("p", pa.int64()), ("z", pa.int64())])
    columns = [pa.array(c, k) for c, k in zip(zip(*paths), (pa.string(), pa.list_(node), pa.int64()))]
    table = pa.table(columns, names=["lang", "path", "times"])
    for held, size in ((1 << 21, 1000), (1 << 21, 7), (1, 1), (60, 13)):
        monkeypatch.setattr(sd, "NODES_HELD", held)
        found = _summed(sd._corrections(iter(table.to_batches(size))))
        assert found == {k: v for k, v in expected.items() if v}
    assert [*sd._corrections(iter([]))] == []


def test_counts_do_not_depend_on_what_a_task_holds(monkeypatch):
    rows = _rows(5, ["a", "b", None], [f"t{chr(97 + i % 26)}" for i in range(40)])[:200]
    table = pa.table([pa.array(c, pa.string()) for c in zip(*rows)], names=["text", "lang", "source"])

    def counted():
        found = Counter()
        for batch in sd._counted(iter(table.to_batches(9))):
            for r in batch.to_pylist():
                found[r["lang"], r["source"], r["term"], "n"] += r["n"]
                found[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return found

    whole = counted()
    monkeypatch.setattr(sd, "COUNTS_HELD", 5)
    assert counted() == whole


def test_counts_beyond_bigint_do_not_overflow(spark):
    counted = spark.sql("SELECT 900000000000L AS n, 9000000000000L AS total, 3000000L AS v")
    p = counted.select(sd.share(F.col("n"), F.col("total"), F.col("v"))).first()[0]
    assert p == 1 + 1_000_000_000 * (900_000_000_000 + 5) // (9_000_000_000_000 + 15_000_000)


def test_empty_tables(spark):
    assert sd.audit(spark.createDataFrame([], SHAPE)).collect() == []
    only = spark.createDataFrame([(None, None, None), ("", "", "b")], SHAPE)
    assert sorted(tuple(r) for r in sd.audit(only).collect()) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
