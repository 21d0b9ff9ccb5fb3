"""The operators against brute force, the installed libraries, and held-out labels."""

import random
import zlib

import numpy as np
import pytest
import xxhash

from jobloom.llm import (
    catalog, components, consistent_shards, decontaminate, license_scan, quality_divergence,
    sentencepiece_codec, simhash_dedup, token_files, url_model,
)

DATA = "/root/testdata/sf0.001"


def _texts(spark, name="documents", key="doc_id"):
    return {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/{name}.parquet").select(key, "text").collect()}


def _roots(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(5)
    pairs = {tuple(sorted(random.sample(range(300), 2), reverse=True)) for _ in range(170)}
    pairs |= {(400 + i + 1, 400 + i) for i in range(60)} | {(600 + i, 600) for i in range(1, 80)}
    edges = spark.createDataFrame(sorted(pairs), "high long, low long")
    found = {r.node: r.root for r in components.components(edges).collect()}
    expected = _roots({n for p in pairs for n in p}, pairs)
    assert {n: r for n, r in expected.items() if n != r} == found


def test_fingerprint_by_hand():
    def plain(text):
        words = [w for w in text.translate(str.maketrans("\t\n\v\f\r", " " * 5)).split(" ") if w]
        size = min(3, len(words))
        hashes = [
            xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42)
            for i in range(len(words) - size + 1)
        ] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)

    for text in ("", "one", "one two", "a b c", "a b c a b c a b", "ü x  y\tz\n\nw"):
        assert simhash_dedup.text_fingerprint(text) % (1 << 64) == plain(text)
    assert simhash_dedup.text_fingerprint("A B C") == simhash_dedup.text_fingerprint("a b c")


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_pair_within_the_radius_is_linked(spark, distance):
    random.seed(distance)
    values = []
    for _ in range(150):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), distance):
            b ^= 1 << bit
        values += [a, b]
    far = [random.getrandbits(64) for _ in range(100)]
    signed = [v - (1 << 64) if v >> 63 else v for v in {*values, *far}]
    frame = spark.createDataFrame([(v,) for v in signed], "print long")
    found = {(r.high, r.low) for r in simhash_dedup.links(frame).collect()}
    expected = {
        (a, b) for a in signed for b in signed if a > b and ((a ^ b) % (1 << 64)).bit_count() <= 3
    }
    assert found <= expected
    nodes = set(signed)
    assert _roots(nodes, found) == _roots(nodes, expected)


def test_a_crowd_is_one_component(spark):
    random.seed(9)
    centre = random.getrandbits(63)
    crowd = {centre ^ (1 << random.randrange(62)) ^ (1 << random.randrange(62)) for _ in range(400)} | {centre}
    frame = spark.createDataFrame([(v,) for v in sorted(crowd)], "print long")
    links = [(r.high, r.low) for r in simhash_dedup.links(frame).collect()]
    pairs = [(a, b) for a in crowd for b in crowd if a > b and (a ^ b).bit_count() <= 3]
    assert _roots(crowd, links) == _roots(crowd, pairs)
    assert len(links) <= len(crowd) * 1057


def test_simhash_query_against_all_pairs(spark):
    rows = simhash_dedup.op1_simhash_dedup(spark, DATA).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    near = [(a, b) for a in prints for b in prints if a > b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {r.doc_id: r.component_id for r in rows} == _roots(prints, near)


def test_winnowing_misses_no_shared_span():
    random.seed(3)
    for _ in range(300):
        shared = [str(random.randrange(9)) for _ in range(decontaminate.SPAN)]
        kept = []
        for _ in range(2):
            around = [[str(random.randrange(9)) for _ in range(random.randrange(25))] for _ in range(2)]
            words = decontaminate.Words(" ".join(around[0] + shared + around[1]))
            grams = decontaminate._grams(words.hashes, decontaminate.K)
            first = len(around[0])
            places = decontaminate.winnowed(grams)
            kept.append({p - first for p in places if first <= p <= first + decontaminate.SPAN - decontaminate.K})
        assert kept[0] & kept[1]


def test_words_of_bytes_are_words():
    random.seed(2)
    for _ in range(2000):
        text = "".join(random.choice(["a", "B", "é", "0", "_", " ", "\n", "-", "Z9", "日", "'"]) for _ in range(12))
        assert decontaminate.Words(text)[:] == decontaminate.words_of(text)


def test_license_bounds_lose_nothing():
    templates = license_scan.Templates()
    random.seed(4)
    base = [decontaminate.words_of(t) for _, t in license_scan.TEMPLATES]
    for words in base * 6:
        words = list(words)
        for _ in range(random.randrange(1 + len(words) // 6)):
            at = random.randrange(len(words))
            words[at : at + random.randrange(2)] = random.choice([[], ["new"], ["other", "words"]])
        bigrams = set(zip(words, words[1:]))
        best = max(
            ((2 * len(bigrams & set(zip(b, b[1:]))) / (len(bigrams) + len(set(zip(b, b[1:])))), -i) for i, b in enumerate(base)),
        ) if bigrams else (0, 0)
        found = templates.best(words)
        assert (found is None) == (best[0] < license_scan.LEAST_DICE)
        assert found is None or (found.dice, -found.order) == best


def test_token_ids_are_those_of_the_whole_text():
    encoder = token_files.WordEncoder(token_files.tokenizer_file())
    random.seed(1)
    parts = ["a", "B", "é", "ß", "1", " ", "  ", "\n", "\n\n", "\t", "'s", "don't", ".", "!!", "🙂", "日本",
             " ", "<|endoftext|>", "&&&", "_", "́", "\r\n", "²", "word", "Other"]
    for _ in range(5000):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 14)))
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), np.uint16).tolist() == ids


def test_token_query(spark):
    rows = token_files.op3_token_files(spark, DATA).collect()
    encoder, start = token_files.WordEncoder(token_files.tokenizer_file()), 0
    by_id = {r.doc_id: r for r in rows}
    for doc_id, text in sorted(_texts(spark).items()):
        ids = [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(by_id[doc_id]) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_code_lengths_are_best_and_bounded():
    random.seed(6)
    counts = np.array([random.choice([0, 1, 2, 5, 1000, 10**6]) for _ in range(400)])
    lengths = token_files.code_lengths(counts, 30).astype(int)
    heap = sorted(int(c) for c in counts if c)
    cost = 0
    while len(heap) > 1:
        a, b, *heap = heap
        cost += a + b
        heap = sorted([*heap, a + b])
    assert (lengths * counts).sum() == cost
    short = token_files.code_lengths(counts, 9).astype(int)
    assert short.max() <= 9 and sum(2.0 ** -n for n in short if n) <= 1
    assert ((short > 0) == (counts > 0)).all()


def test_pouring_fills_every_shard():
    points, owners = consistent_shards.ring(8, 16)
    random.seed(7)
    for total in (0, 5, 1000, 12345):
        arcs = np.bincount([min(int(random.paretovariate(1)), len(points)) for _ in range(total)], minlength=len(points) + 1)
        runs = consistent_shards.pour(arcs, np.append(owners, owners[0]), consistent_shards.capacities(total, 8))
        shard, slot = runs.of(np.arange(total)) if total else (np.empty(0), np.empty(0))
        sizes = np.bincount(shard.astype(int), minlength=8)
        assert sizes.sum() == total and sizes.max() - sizes.min() <= 1
        for s in range(8):
            assert sorted(slot[shard == s]) == list(range(sizes[s]))


def test_slack_limits_movement():
    random.seed(8)
    keys = np.sort(np.array([random.getrandbits(64) - (1 << 63) for _ in range(20000)]))

    def placed(shards, slack):
        points, owners = consistent_shards.ring(shards)
        arc = np.searchsorted(points, keys)
        runs = consistent_shards.pour(
            np.bincount(arc, minlength=len(points) + 1), np.append(owners, owners[0]),
            consistent_shards.capacities(len(keys), shards, slack),
        )
        return runs.of(np.arange(len(keys)))[0]

    before, after = placed(8, 0.2), placed(9, 0.2)
    assert np.bincount(before).max() <= np.ceil(len(keys) / 8 * 1.2)
    assert (before != after).mean() < 0.25


def test_repeated_words_by_brute_force():
    random.seed(10)
    for _ in range(200):
        words = [random.choice("abc") for _ in range(random.randrange(60))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert quality_divergence.repeated_words(words) == len(covered)


def test_url_rules(spark):
    urls = ["http://a.ORG/x", "http://org/", "http://notorg/x", "https://b.example.org/es/1?q", "http://example.org/en/12",
            "http://x.example.org/en/2", "http://c.com/fr/#t", "http://c.com/de/", "http://c.com/fr", "nothing", None, "http://a.org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_model.judge(pages).collect()}
    assert found[0] == ("a.org", "/x", "org/", "allow")
    assert found[1][2] == "org/" and found[2][2] is None
    assert found[3] == ("b.example.org", "/es/1", "example.org/es/", "block")
    assert found[4][2:] == ("example.org/en/1", "block") and found[5][2:] == ("org/", "allow")
    assert found[6] == ("c.com", "/fr/", "com/fr/", "allow") and found[7][2:] == ("com/de/", "block")
    assert found[8][2] is None and found[9] == ("", "", None, "block") == found[10]
    assert found[11][:3] == ("a.org", "", None)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_codec.Pieces.load(sentencepiece_codec.model_file())


def test_viterbi_against_all_paths(pieces):
    numbers = {p: i for i, p in enumerate(pieces.pieces) if p}
    random.seed(11)
    words = ["▁" + "".join(random.choice("aeinrst.é日") for _ in range(random.randrange(9))) for _ in range(150)]
    for word, ids in zip(words, pieces._segment_many(words), strict=True):
        best = [0.0] + [float("-inf")] * len(word)
        for end in range(1, len(word) + 1):
            for begin in range(end):
                if word[begin:end] in numbers:
                    best[end] = max(best[end], best[begin] + pieces.scores[numbers[word[begin:end]]])
            if word[end - 1] not in numbers:
                best[end] = max(best[end], best[end - 1] + pieces.unknown_score)
        ids = np.frombuffer(ids, np.int32).tolist()
        plain = sum(pieces.scores[i] for i in ids if pieces.pieces[i])
        unknown = sum(c not in numbers for c in word)
        assert ids == pieces._segment(word)
        assert plain + unknown * pieces.unknown_score == pytest.approx(best[-1])
        assert pieces.decode(ids) == word[1:]


def test_trie_holds_its_strings():
    random.seed(12)
    strings = {bytes(random.choices(range(256), k=random.randint(1, 5))): i for i in range(3000) for _ in [0]}
    trie = sentencepiece_codec.DoubleArrayTrie(strings)
    for key, number in strings.items():
        state = 0
        for byte in key:
            step = trie.base[state] + byte + 1
            assert trie.check[step] == state
            state = step
        assert trie.value[state] == number


@pytest.mark.parametrize("name,truth", [("op9_language_id", "lang"), ("op10_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, truth):
    folder = "/root/testdata/sf0.01"
    found = catalog.queries()[name](spark, folder)
    known = spark.read.parquet(f"{folder}/{'documents' if truth == 'lang' else 'labels'}.parquet")
    rows = found.where("held_out").join(known.select("doc_id", truth), "doc_id").collect()
    if truth == "lang":
        assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    else:
        assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.02
        assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.6


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = corpus_pipeline.run(spark, DATA).collect()
    kept = {r.doc_id for r in rows}
    assert 0 < len(rows) == len(kept) < docs.count()
    assert all(r.round_trip for r in rows)
    now = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        now = step(spark, now, DATA)
        assert now.columns == docs.columns
    assert {r.doc_id for r in now.select("doc_id").collect()} == kept
