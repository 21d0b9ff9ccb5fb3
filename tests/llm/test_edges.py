"""Every operator on nulls, empty and long texts, repeats, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

from jobloom.llm import (
    consistent_shards, decontaminate, fill_in_middle, language_id, license_scan, minhash,
    quality_divergence, sentencepiece_codec, simhash_dedup, token_files, toxicity, url_model,
)
from jobloom.session import new_run_folder

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("print", "row", "place", "score", "found", "rank", "shard", "ids", "seeds", "hit_id", "root",
            "n", "form", "output", "range", "sent", "at", "node", "mark")
LONG = "many words make one very long line of text " * 30_000
ROWS = [
    (1, "the cat sat on the mat and the dog ran far away from the big red house", "en", "a", 1),
    (1, "the cat sat on the mat and the dog ran far away from the big red house", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (None, " \t\n ", None, "b", 4),
    (None, "der Hund und die Katze sind im Haus", "de", "b", 4),
    (4, "--- 123 ¿?   🙂", "xx", "b", 4),
    (5, "one\ntwo  three\n\nfour\t five ", None, None, 1),
    (6, LONG, "en", "c", 1),
]
LABELS = [(1, 1, 0), (2, 0, None), (3, 0, 1), (None, 1, 1), (3, 1, 0)]
ITEMS = [(7, "dog ran far away"), (7, "dog ran far away"), (8, None), (9, ""), (None, "katze sind im"),
         (10, "cat sat on the mat and the dog ran far away from")]


def _docs(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, SHAPE)
    return docs.withColumns({name: F.lit("extra") for name in CLASHING})


def _labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))


def _items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("place", F.lit(1))


def _token_files(spark, docs):
    folder = new_run_folder(spark, "test-tokens")
    token_files.write(docs, folder, token_files.tokenizer_file())
    return token_files.digests(spark, folder)


PER_ROW = {
    "simhash": lambda s, d: simhash_dedup.near_duplicate_classes(d),
    "license": lambda s, d: license_scan.scan_documents(d),
    "tokens": _token_files,
    "shards": lambda s, d: consistent_shards.shard_documents(d),
    "quality": lambda s, d: quality_divergence.judge(d),
    "pieces": lambda s, d: sentencepiece_codec.encode_and_decode(d, sentencepiece_codec.model_file()),
    "contamination": lambda s, d: decontaminate.contamination(d, _items(s)),
    "language": lambda s, d: language_id.identify(d),
    "toxicity": lambda s, d: toxicity.score_documents(d, _labels(s)),
    "middle": lambda s, d: fill_in_middle.fill_in_middle(d),
    "minhash": lambda s, d: minhash.fingerprint_documents(d),
    "minhash classes": lambda s, d: minhash.near_duplicates(d),
    "urls": lambda s, d: url_model.judge(
        d.withColumn("url", F.concat(F.lit("http://a.org/"), "text")).withColumn("page_id", F.col("doc_id"))
    ),
}
FILTERS = {
    "simhash": lambda s, d: simhash_dedup.keep_one_of_each(d),
    "contamination": lambda s, d: decontaminate.without_benchmark(d, _items(s)),
    "language": lambda s, d: language_id.in_known_language(d),
    "toxicity": lambda s, d: toxicity.without_toxic(d, _labels(s)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, name):
    found = PER_ROW[name](spark, _docs(spark)).collect()
    assert len(found) == len(ROWS)
    key = "page_id" if name == "urls" else "doc_id"
    assert sorted(str(r[key]) for r in found) == sorted(str(r[0]) for r in ROWS)
    # Repeated rows have equal results but for where they are put.
    same = [r.asDict() for r in found if r[key] == 1]
    for row in same:
        for placed in ("start", "slot", "shard"):
            row.pop(placed, None)
    assert same[0] == same[1]


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, _docs(spark, [])).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns(spark, name):
    docs = _docs(spark)
    found = FILTERS[name](spark, docs)
    assert found.columns == docs.columns
    assert 0 < found.count() <= len(ROWS)
    assert FILTERS[name](spark, _docs(spark, [])).collect() == []


def test_defined_results(spark):
    docs = _docs(spark)
    prints = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup.near_duplicate_classes(docs).collect()}
    assert {(2, "0" * 16, 2), (3, "0" * 16, 2), (None, "0" * 16, 2)} <= prints
    kept = [r.doc_id for r in simhash_dedup.keep_one_of_each(docs).collect()]
    assert kept.count(1) == 1 and 2 in kept and 3 not in kept
    hit = {r.doc_id: r for r in decontaminate.contamination(docs, _items(spark)).collect() if r.doc_id}
    assert (hit[1].n_words, hit[1].n_hit, hit[1].n_items) == (17, 12, 2)
    assert hit[2].n_words == 0 and not hit[2].contaminated
    languages = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect() if r.doc_id}
    assert languages[2] == languages[3] == languages[4] == "und"
    base = {r.doc_id: r for r in quality_divergence.judge(docs).collect() if r.doc_id}
    assert base[2].base_failed and base[6].base_failed and not base[2].kept
    assert base[6].n_repeat_words == base[6].n_words == 270_000
    pieces = sentencepiece_codec.encode_and_decode(docs, sentencepiece_codec.model_file()).collect()
    assert all(r.round_trip for r in pieces)


def test_without_labels_or_items_nothing_breaks(spark):
    docs = _docs(spark)
    assert toxicity.score_documents(docs, _labels(spark, [])).where("predicted = 1").count() == 0
    assert decontaminate.contamination(docs, _items(spark, [])).where("contaminated").count() == 0
