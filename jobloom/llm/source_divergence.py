"""Source divergence audit with a frequent-pattern tree.

How unlike are the sources of a language in their terms? For each pair of sources the
differences of all kept terms are summed. Most terms occur in few sources, so the sum is
taken as if no term occurred, V times the difference of the two zero shares, and corrected:

* by what each source's own terms change while the other has none, from running sums over
  the shares of one source, and
* by what terms that both sources have change beyond that.

The second part is a frequent-pattern tree. A term is the path of its (source, count) pairs
in the order of sources; terms with equal paths are one path with a multiplicity. Paths
that begin alike share nodes, and a node's multiplicity is that of all paths through it. The
correction of two sources depends on a node and one of its ancestors alone, so it is worked
out once for each such combination and taken times the node's multiplicity.

The tree is never held whole. Paths that begin alike come to one task, sorted, which builds
the tree of some of them at a time (NODES_HELD); a node that two such parts share has its
multiplicity in two parts, whose corrections add up. Sums by pair are added by a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import LOWER_BYTES, partitions, prepare, table, utf8
from jobloom.session import stage

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
MOST_TERMS = 50  # of the report
# Letters, and all bytes of code points beyond ASCII, in UTF-8.
TERM = re.compile(rb"[a-z\x80-\xff]+")
# Entries that a task holds before it hands them on; their number changes no result.
COUNTS_HELD = 600_000
NODES_HELD = 1 << 21  # rows times the longest path
SHARED_NODES = 6  # paths that begin with the same so many nodes come to one task


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall(utf8(text or "").translate(LOWER_BYTES))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents, summed within the task as
    long as there is room. An empty term stands for the group itself."""
    counts: dict[tuple[str, str], Counter[bytes]] = {}
    docs: dict[tuple[str, str], Counter[bytes]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in docs.items():
            of_group = counts[lang, source]
            yield pa.record_batch(
                [
                    pa.repeat(pa.scalar(lang), len(found)), pa.repeat(pa.scalar(source), len(found)),
                    pa.array(list(found), pa.binary()).cast(pa.string()),
                    pa.array([of_group[term] for term in found], pa.int64()),
                    pa.array(found.values(), pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()
        docs.clear()

    for batch in batches:
        for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
            group = lang or "", source or ""
            if group not in docs:
                counts[group], docs[group] = Counter(), Counter()
            terms = terms_of(text)
            counts[group].update(terms)
            docs[group].update(set(terms))
            docs[group][b""] += 1
        if sum(map(len, docs.values())) > COUNTS_HELD:
            yield from rows()
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of all documents; the empty term has n 0 and counts the
    documents of each group."""
    return (
        docs.select(*(F.col(c).cast("string") for c in ("text", "lang", "source")))
        .mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * v)), in whole numbers that
    cannot overflow."""
    wide = n.cast("decimal(20,0)") + F.lit(SMOOTHING).cast("decimal(2,0)")
    above = F.lit(SCALE).cast("decimal(10,0)") * wide
    below = total + F.lit(SMOOTHING) * v
    return F.lit(1) + F.call_function("div", above, below.cast("decimal(20,0)"))


def _pair_sums(langs: pa.Array, paths: pa.ListArray, times: np.ndarray) -> pa.RecordBatch:
    """(lang, a, b, value) of sorted paths: the corrections of their tree, a before b.

    Nodes stand in columns by depth. A node begins in the first row of a run of paths that
    agree up to it; its multiplicity is that of the run, its ancestors are the entries of that
    row before it. Each depth takes all its nodes and their ancestors at once.
    """
    offsets = paths.offsets.to_numpy().astype(np.int64)
    nodes = paths.values.slice(offsets[0], offsets[-1] - offsets[0])
    names = nodes.field("source").dictionary_encode()
    tongues = langs.dictionary_encode()
    sizes = np.diff(offsets)
    rows, width = len(sizes), int(sizes.max(initial=0))
    at = np.arange(width) < sizes[:, None]

    def spread(values: np.ndarray) -> np.ndarray:
        table = np.zeros((rows, width), np.int64)
        table[at] = values
        return table

    source = spread(names.indices.to_numpy())
    n, p, z = (spread(nodes.field(f).to_numpy()) for f in ("n", "p", "z"))
    lang = tongues.indices.to_numpy().astype(np.int64)
    same = np.zeros((rows, width), bool)
    same[1:] = at[1:] & at[:-1] & (source[1:] == source[:-1]) & (n[1:] == n[:-1])
    same[1:] &= (lang[1:] == lang[:-1])[:, None]
    same = np.logical_and.accumulate(same, axis=1)
    number = len(names.dictionary)
    keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
    for depth in range(1, width):
        first = np.flatnonzero(at[:, depth] & ~same[:, depth])
        if not len(first):
            continue
        often = np.add.reduceat(np.where(at[:, depth], times, 0), first)
        above, above_z = p[first, :depth], z[first, :depth]
        own, own_z = p[first, depth, None], z[first, depth, None]
        change = (
            np.abs(above - own) + np.abs(above_z - own_z)
            - np.abs(above - own_z) - np.abs(own - above_z)
        )
        key = (lang[first, None] * number + source[first, :depth]) * number + source[first, depth, None]
        keys = np.concatenate((keys, key.ravel()))
        keys, at_key = np.unique(keys, return_inverse=True)
        values = np.concatenate((sums, (change * often[:, None]).ravel()))
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at_key, values)
    taken = lambda codes, words: words.take(pa.array(codes))
    return pa.record_batch(
        [
            taken(keys // number // number, tongues.dictionary),
            taken(keys // number % number, names.dictionary),
            taken(keys % number, names.dictionary), pa.array(sums),
        ],
        names=["lang", "a", "b", "value"],
    )


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value) from sorted rows (lang, path, times), some at a time.

    ``path`` has for each source of a term, in order: source, n, its share and its zero share.
    """
    held: list[pa.RecordBatch] = []

    def sums() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        lang, path, times = (table.column(c).chunk(0) for c in ("lang", "path", "times"))
        return _pair_sums(lang, path, times.to_numpy())

    rows = width = 0
    for batch in batches:
        longest = pc.max(pc.list_value_length(batch.column("path"))).as_py() or 0
        if held and (rows + batch.num_rows) * max(width, longest) > NODES_HELD:
            yield sums()
            held, rows, width = [], 0, 0
        if batch.num_rows:
            held.append(batch)
            rows, width = rows + batch.num_rows, max(width, longest)
    if held:
        yield sums()


def tree_corrections(counted: DataFrame) -> DataFrame:
    """(lang, a, b, value), a before b, of rows (lang, source, term, n, p, z) with n > 0.

    A path has one entry for each source of a term, no more.
    """
    node = F.struct("source", "n", "p", "z")
    paths = (
        counted.groupBy("lang", "term").agg(F.array_sort(F.collect_list(node)).alias("path"))
        .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    )
    begun = F.slice("path", 1, SHARED_NODES)
    return (
        paths.repartition(partitions(counted.sparkSession), "lang", begun).sortWithinPartitions("lang", "path")
        .mapInArrow(_corrections, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )


def _own_changes(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): what the terms of a change while b has none of them.

    The sum over a's terms of |p - z_b| - |z_a - z_b| for every b. Shares and questions z_b
    are sorted together; below a question stand the shares whose running number and sum
    answer it.
    """
    shares = counted.groupBy("lang", F.col("source").alias("a"), F.col("p").alias("at")).agg(
        F.count(F.lit(1)).alias("terms")
    )
    pairs = _pairs(groups)
    order = Window.partitionBy("lang", "a").orderBy("at")
    below = order.rangeBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang", "a")
    lined = shares.select(
        "lang", "a", "at", "terms", F.lit(None).cast("string").alias("b"), F.lit(0).alias("z_a")
    ).unionByName(
        pairs.select("lang", "a", F.col("z_b").alias("at"), F.lit(0).alias("terms"), "b", "z_a")
    )
    summed = lined.select(
        "lang", "a", "b", "at", "z_a",
        F.sum("terms").over(below).alias("few"),
        F.sum(F.col("terms") * F.col("at")).over(below).alias("few_sum"),
        F.sum("terms").over(whole).alias("all"),
        F.sum(F.col("terms") * F.col("at")).over(whole).alias("all_sum"),
    ).where(F.col("b").isNotNull())
    distance = (
        F.col("at") * F.col("few") - F.col("few_sum")
        + F.col("all_sum") - F.col("few_sum") - F.col("at") * (F.col("all") - F.col("few"))
    )
    value = distance - F.col("all") * F.abs(F.col("z_a") - F.col("at"))
    return summed.select("lang", "a", "b", value.alias("value"))


def _pairs(groups: DataFrame) -> DataFrame:
    """(lang, a, b, v, z_a, z_b) of all ordered pairs of a language's sources: as many rows as
    the report has."""
    one, other = (
        groups.select("lang", F.col("source").alias(x), "v", F.col("z").alias(f"z_{x}")) for x in "ab"
    )
    return one.join(other.drop("v"), "lang").where(F.col("a") != F.col("b"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others.

    Part ``pair`` has for every group (lang, source) each other source of the language with
    the summed differences of all kept terms. Part ``term`` has the terms that the group has
    above its language's share, the first MOST_TERMS of them. Kept are the terms of at least
    LEAST_DOCUMENTS documents of the language.

    ``docs`` needs text, lang and source; other columns, whatever their names, are not read.
    Nulls count as ''. Groups without terms, or in a language without kept terms, have pairs
    all the same, with value 0 in a language without kept terms. Repeated rows count each
    time. Ties come in the order of the item's UTF-8 bytes. Empty tables give no rows.
    """
    prepare(docs.sparkSession)
    counts = stage(term_counts(docs), "source-term-counts")
    terms = counts.where("term != ''")
    kept_terms = (
        terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= LEAST_DOCUMENTS).select("lang", "term", "lang_n")
    )
    kept = stage(terms.join(kept_terms, ["lang", "term"]).drop("docs"), "source-kept-terms")
    # One row for each language and each group: sums of what tasks counted.
    languages = (
        kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    all_groups = counts.where("term = ''").select("lang", "source")
    nothing = F.lit(0).cast("long")
    groups = stage(
        all_groups.join(languages, "lang", "left").join(totals, ["lang", "source"], "left")
        .select(
            "lang", "source", F.coalesce("v", nothing).alias("v"),
            F.coalesce("total", nothing).alias("total"), F.coalesce("lang_total", nothing).alias("lang_total"),
        )
        .withColumn(
            "z", F.when(F.col("v") > 0, share(nothing, F.col("total"), F.col("v"))).otherwise(nothing)
        ),
        "source-groups",
    )
    # Inner: a kept term has a group. The groups are few beside the terms and Spark measures them.
    shared = stage(
        kept.join(groups, ["lang", "source"])
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
        .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
        .select("lang", "source", "term", "n", "p", "q", "z"),
        "source-shares",
    )
    return _pair_part(shared, groups).unionByName(_term_part(shared))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _pair_part(shared: DataFrame, groups: DataFrame) -> DataFrame:
    base = _pairs(groups).select(
        "lang", "a", "b", (F.col("v") * F.abs(F.col("z_a") - F.col("z_b"))).alias("value")
    )
    own = _own_changes(shared, groups)
    tree = tree_corrections(shared)
    turned = [
        part.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value") for part in (own, tree)
    ]
    summed = base
    for part in (own, tree, *turned):
        summed = summed.unionByName(part)
    pairs = summed.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return _ranked(
        pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    )


def _term_part(shared: DataFrame) -> DataFrame:
    above = shared.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value"),
    )
    return _ranked(above).where(F.col("rank") <= MOST_TERMS)


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


# Every kept term of every group, without a tree.
SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), word AS (
  SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM doc) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM word GROUP BY lang, term HAVING count(*) >= 30
), size AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM doc
), counted AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM word GROUP BY ALL) c USING (lang, source, term)
), total AS (
  SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL
), shares AS (
  SELECT c.lang, c.source, c.term, c.n,
    1 + (CAST(1000000000 AS HUGEINT) * (c.n + 5)) // (t.total + 5 * s.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (c.lang_n + 5)) // (s.total + 5 * s.v) AS q
  FROM counted c JOIN total t USING (lang, source) JOIN size s ON s.lang = c.lang
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS one, y.source AS other, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) d ON d.lang = a.lang AND d.one = a.source AND d.other = b.source
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
WHERE part = 'pair' OR rank <= 50
"""
