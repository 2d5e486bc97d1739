"""Which terms set the sources of a language apart, with whole numbers throughout.

Every source of a language gives each of the language's kept terms (those in at least
``LEAST_DOCUMENTS`` of its documents) the probability ``p = 1 + floor(SCALE * (n + 1) / (N + V))``
of its ``n`` occurrences there among the ``N`` of all ``V`` kept terms. ``floor((p - q)**2 / q)``
tells how far a source is from another source, or from its whole language (``q``).

Late strings. One pass over the texts counts the terms of each task, and the counts are written
with the term and its digest; nothing is shuffled there. From then on only fixed-width
columns move: digests of groups and terms, and counts. The strings stay in the written
files and are read for two things alone:

* The least and the greatest string of each digest that is kept. Where they differ, terms
  have collided: the digest is split, that is counted again by a digest and the
  term's place among those of the digest. A collision can only add to a digest's documents,
  so what is not kept needs no look. Digests of (language, source) are tried with
  one seed after another until no two of the occurring ones are the same.
* The terms of the ranked rows, after a cutoff on the values alone has left few.

Pairs of sources. For each term with an occurrence in one of a pair's sources the values are
summed up by numpy in tasks that hold a part of the terms and a tile of ``TILE`` by ``TILE`` sources;
terms that neither has are alike, so their number times one value is added. No rows for
the pairs of a term are made.

Defined cases. A null text, language or source is an empty one; rows are documents,
so repeated rows count each, and ids play no part. Texts are counted in parts of ``PART`` bytes.
Of equal values the smaller item in UTF-8 comes first. A language without kept terms has
only pairs, with value 0; one with a single source has none. An empty table gives an
empty result. Extra columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authorlink.llm import common

LEAST_DOCUMENTS, TOP, SCALE = 3, 200, 1_000_000_000
#: Bytes of text cut up at a time, and terms of (language, source) that a task counts before it writes them.
PART, TERMS_AT_ONCE = 1 << 20, 1_500_000
#: Sources of a tile; counts of terms in a task that sums up pairs; numbers in a table of such a task.
TILE, COUNTS_PER_TASK, CELLS = 256, 250_000, 2_000_000

# Letters A to Z become small ones, bytes of other alphabets stay, all others separate terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_COUNTED = "lang string, digest long, term string, documents long, sources array<string>, counts array<long>"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of those of ``PART`` bytes."""
    plain = text.translate(_TABLE)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + PART)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _counter(bits: int):
    """Counts per task, a row for each language and term; a row without a digest names all sources of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[str, Counter[bytes]]] = {}
        documents: dict[str, Counter[bytes]] = {}
        held = 0
        for batch in batches:
            for text, lang, source in zip(batch.column("text"), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
                of_group = counts.setdefault(lang, {}).setdefault(source, Counter())
                before, distinct = len(of_group), set()
                for part in _terms(text.as_py()):
                    of_group.update(part)
                    distinct.update(part)
                documents.setdefault(lang, Counter()).update(distinct)
                held += len(of_group) - before + 1
                if held >= TERMS_AT_ONCE:
                    yield from counted(counts, documents)
                    counts, documents, held = {}, {}, 0
        yield from counted(counts, documents)

    def counted(counts: dict, documents: dict) -> Iterator[pa.RecordBatch]:
        for lang, of_source in counts.items():
            sources = sorted(of_source)
            yield rows(lang, [None], [None], [0], np.array([0, len(sources)]), sources, np.arange(len(sources)), [0] * len(sources))
            terms = sorted(documents[lang])
            place = {term: i for i, term in enumerate(terms)}
            at = np.concatenate([np.array([place[t] for t in of_source[s]], np.int64) for s in sources])
            n = np.concatenate([np.array(list(of_source[s].values()), np.int64) for s in sources])
            source = np.repeat(np.arange(len(sources)), [len(of_source[s]) for s in sources])
            order = np.argsort(at, kind="stable")
            source, n = source[order], n[order]
            starts = np.searchsorted(at[order], np.arange(len(terms) + 1))
            for first in range(0, len(terms), 50_000):
                some = terms[first : first + 50_000]
                digests = np.array([xxhash.xxh64_intdigest(t) >> (64 - bits) for t in some], np.uint64).view(np.int64)
                cut = starts[first : first + len(some) + 1]
                part = slice(cut[0], cut[-1])
                yield rows(lang, digests, [t.decode() for t in some], [documents[lang][t] for t in some], cut - cut[0], sources, source[part], n[part])

    def rows(lang: str, digests, terms: list, documents: list, starts: np.ndarray, sources: list, source: np.ndarray, n) -> pa.RecordBatch:
        names = pa.DictionaryArray.from_arrays(pa.array(source, pa.int32()), pa.array(sources, pa.string())).cast(pa.string())
        offsets = pa.array(starts, pa.int32())
        columns = [
            pa.array([lang] * len(terms), pa.string()),
            pa.array(digests, pa.int64()),
            pa.array(terms, pa.string()),
            pa.array(documents, pa.int64()),
            pa.ListArray.from_arrays(offsets, names),
            pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "digest", "term", "documents", "sources", "counts"])

    return run


def counted_terms(docs: DataFrame, bits: int = 64) -> DataFrame:
    """``(lang, digest, term, documents, sources, counts)`` by task, written; nothing is shuffled."""
    columns = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    texts = docs.select(*columns, common.text_or_empty().cast("binary").alias("text"))
    return common.written(texts.mapInArrow(_counter(bits), _COUNTED), "term-counts")


def _key(seed: int, value: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), value)


def _numbered_groups(counted: DataFrame) -> tuple[DataFrame, int]:
    """``(lang_key, source_key, lang, source)`` of all that occur, and the seed whose digests tell them apart."""
    found = counted.where("digest IS NULL").select("lang", F.explode("sources").alias("source")).distinct()
    found = common.written(found, "groups")
    n = found.agg(F.count(F.lit(1)).alias("groups"), F.count_distinct("lang").alias("langs")).first()
    seed = 0
    while True:
        keys = found.select(_key(seed, "lang").alias("lang_key"), _key(seed, "source").alias("source_key"), "lang", "source")
        told = keys.agg(F.count_distinct("lang_key", "source_key").alias("groups"), F.count_distinct("lang_key").alias("langs")).first()
        if told == n:
            return keys, seed
        seed += 1


def _kept(rows: DataFrame, term: list[str], least: int) -> DataFrame:
    """``(*term, source_key, n, in_lang, leads)`` of the terms in ``least`` documents of their language.

    One shuffle, on language and term, serves all sums: rows come combined from the pass over the texts.
    """
    dealt = rows.repartition(*term)
    each = dealt.select(*term, "documents", F.posexplode(F.arrays_zip("source_keys", "counts")).alias("_i", "_one"))
    once = F.when(F.col("_i") == 0, F.col("documents")).otherwise(0)
    of_source = each.groupBy(*term, F.col("_one.source_keys").alias("source_key")).agg(
        F.sum("_one.counts").alias("n"), F.sum(once).alias("documents")
    )
    of_lang = Window.partitionBy(*term)
    leads = F.row_number().over(of_lang.orderBy("source_key")) == 1  # one row of a term
    summed = of_source.withColumns(
        {"in_lang": F.sum("n").over(of_lang), "in_documents": F.sum("documents").over(of_lang), "leads": leads.cast("int")}
    )
    return summed.where(F.col("in_documents") >= least).drop("documents", "in_documents")


def kept_terms(counted: DataFrame, seed: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts as ``_kept`` gives them, and the dictionary ``(digest, place, term)``; digests that terms share are split."""
    keyed = F.transform("sources", lambda source: _key(seed, source)).alias("source_keys")
    fixed = ["lang_key", "digest", "documents", "source_keys", "counts"]
    rows = counted.where("digest IS NOT NULL").select(_key(seed, "lang").alias("lang_key"), "digest", "documents", keyed, "counts", "term")
    kept = _kept(rows.select(*fixed), ["lang_key", "digest"], least)
    first = common.written(kept.withColumn("place", F.lit(0)), "kept-digests")
    # The least and the greatest string of what is kept: a task's rows are combined before they move.
    words = rows.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("greatest"))
    words = common.written(words.join(first.select("digest").distinct(), "digest", "left_semi"), "dictionary")
    collided = words.where("least <> greatest").select("digest")
    clean = words.where("least = greatest").select("digest", F.lit(0).alias("place"), F.col("least").alias("term"))
    if collided.limit(1).count() == 0:
        return first, clean
    shared = common.written(rows.join(collided, "digest", "left_semi"), "shared-digests")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    parted = common.written(shared.select("digest", "term").distinct().withColumn("place", place), "split-digests")
    again = shared.join(parted, ["digest", "term"]).select(*fixed, "place")
    split = _kept(again, ["lang_key", "digest", "place"], least)
    whole = first.join(collided, "digest", "left_anti").select(*split.columns)
    counts = common.written(whole.unionByName(split), "kept-terms")
    return counts, clean.unionByName(parted.select(*clean.columns))


def _probability(n: Column, of: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (of + terms))``, in decimals, which hold the product."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(1)).cast("decimal(19,0)")
    return F.call_function("div", above, (of + terms).cast("decimal(19,0)")) + F.lit(1)


def _value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value")]
    return rows.select(*columns, F.row_number().over(of_group).cast("int").alias("rank"))


def _term_rows(counts: DataFrame, groups: DataFrame, dictionary: DataFrame, top: int) -> DataFrame:
    """The terms that each source has more often than its language, the ``top`` of them by value."""
    group = ["lang_key", "source_key"]
    p, q = _probability(F.col("n"), F.col("size"), F.col("terms")), _probability(F.col("in_lang"), F.col("lang_size"), F.col("terms"))
    told = counts.join(groups.drop("source"), group).select(*group, "digest", "place", p.alias("p"), q.alias("q"))
    told = told.where("p > q").select(*group, "digest", "place", _value(F.col("p"), F.col("q")).alias("value"))
    told = common.written(told, "term-values")
    # The value of the last row that counts; Spark keeps no more than ``top`` rows of a group in a task.
    by_value = Window.partitionBy(*group).orderBy(F.desc("value"), "digest", "place")
    cutoff = told.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    cutoff = cutoff.groupBy(*group).agg(F.min("value").alias("cutoff"))
    near = told.join(cutoff, group).where("value >= cutoff").drop("cutoff")
    named = near.join(dictionary, ["digest", "place"]).join(groups.select(*group, "lang", "source"), group)
    return _ranked(named.withColumnRenamed("term", "item"), "term").where(F.col("rank") <= top)


def _tile_sums(width: int, cells: int):
    """Sums of the values of each ordered pair of a tile's sources over a part of the terms."""

    def run(table: pa.Table) -> pa.Table:
        column = {c: table[c].to_numpy() for c in ("index", "p", "none", "place", "low", "high")}
        counted = table["digest"].is_valid().to_numpy()
        index, place = np.unique(column["index"], return_inverse=True)
        none = np.zeros(len(index), np.int64)
        none[place] = column["none"]
        low, high = int(column["low"][0]), int(column["high"][0])
        asking, asked = (np.flatnonzero(index // width == tile) for tile in (low, high))
        sums = np.zeros((len(index), len(index)), np.int64)
        terms = 0
        if counted.any():
            digest, of_digest = table["digest"].fill_null(0).to_numpy()[counted], column["place"][counted]
            order = np.lexsort((of_digest, digest))
            row = np.cumsum((np.diff(digest[order], prepend=digest[order[0]]) != 0) | (np.diff(of_digest[order], prepend=of_digest[order[0]]) != 0))
            terms = int(row[-1]) + 1
            at, p = place[counted][order], column["p"][counted][order]
            step = max(1, cells // len(index))
            for start in range(0, terms, step):
                part = slice(*np.searchsorted(row, [start, start + step]))
                told = np.repeat(none[None, :], min(step, terms - start), 0)
                told[row[part] - start, at[part]] = p[part]
                for one, others in [(asking, asked)] if low == high else [(asking, asked), (asked, asking)]:
                    for s in one.tolist():
                        apart = told[:, s : s + 1] - told[:, others]
                        sums[s, others] += (apart * apart // told[:, others]).sum(0)
        pairs = [(s, t) for s in asking.tolist() for t in asked.tolist() if s != t]
        if low != high:
            pairs += [(t, s) for s, t in pairs]
        s, t = np.array(pairs, np.int64).reshape(-1, 2).T
        lang = np.full(len(s), table["lang_key"][0].as_py(), np.int64)
        columns = [lang, index[s], index[t], sums[s, t], np.full(len(s), terms, np.int64), none[s], none[t]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["lang_key", "index", "other", "sum", "counted", "none", "other_none"])

    return run


def _pair_rows(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Every source of a language with every other, and the distance between them."""
    n_counts = counts.count()
    # Without terms there is nothing to divide by, and nothing to sum up either.
    zero = F.when(F.col("terms") > 0, _probability(F.lit(0).cast("long"), F.col("size"), F.col("terms"))).otherwise(F.lit(1))
    index = F.row_number().over(Window.partitionBy("lang_key").orderBy("source_key")) - 1
    indexed = common.written(groups.withColumns({"index": index.cast("long"), "none": zero.cast("long")}), "indexed-sources")
    widest = indexed.agg(F.max("index")).first()[0]
    if widest is None:
        widest = 0
    n_tiles = int(widest) // TILE + 1
    parts = common.tasks_for(n_counts * n_tiles, COUNTS_PER_TASK)
    of_source = indexed.select("lang_key", "source_key", "index", "none", "size", "terms")
    told = counts.join(of_source, ["lang_key", "source_key"]).select(
        "lang_key",
        "index",
        "none",
        _probability(F.col("n"), F.col("size"), F.col("terms")).cast("long").alias("p"),
        F.pmod(F.xxhash64("digest", "place"), F.lit(parts)).cast("int").alias("part"),
        "digest",
        "place",
    )
    # Every part of every tile knows all its sources, also those that have none of its terms.
    nothing = [F.lit(0).cast("long").alias("p"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(None).cast("long").alias("digest"), F.lit(0).alias("place")]
    marks = of_source.select("lang_key", "index", "none", *nothing)
    own = F.floor(F.col("index") / TILE).cast("int")
    tiled = told.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    tiled = tiled.withColumns({"low": F.least(own, "other"), "high": F.greatest(own, "other")}).drop("other")
    kind = "lang_key long, index long, other long, sum long, counted long, none long, other_none long"
    summed = tiled.groupBy("lang_key", "low", "high", "part").applyInArrow(_tile_sums(TILE, CELLS), kind)
    summed = summed.groupBy("lang_key", "index", "other").agg(
        F.sum("sum").alias("sum"), F.sum("counted").alias("counted"), F.max("none").alias("p"), F.max("other_none").alias("q")
    )
    lang = indexed.select("lang_key", "index", "lang", "source", "terms")
    other = indexed.select("lang_key", F.col("index").alias("other"), F.col("source").alias("item"))
    whole = summed.join(lang, ["lang_key", "index"]).join(other, ["lang_key", "other"])
    value = F.col("sum") + (F.col("terms") - F.col("counted")) * _value(F.col("p"), F.col("q"))
    return _ranked(whole.withColumn("value", value), "pair")


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, bits: int = 64) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of documents ``(text, lang, source)``; digests have ``bits`` bits."""
    counted = counted_terms(docs, bits)
    keys, seed = _numbered_groups(counted)
    counts, dictionary = kept_terms(counted, seed, least)
    of_source = counts.groupBy("lang_key", "source_key").agg(F.sum("n").alias("size"), F.sum("leads").alias("leads"))
    of_lang = of_source.groupBy("lang_key").agg(F.sum("size").alias("lang_size"), F.sum("leads").alias("terms"))
    sized = keys.join(of_source.drop("leads"), ["lang_key", "source_key"], "left").join(of_lang, "lang_key", "left")
    groups = common.written(sized.fillna(0, ["size", "lang_size", "terms"]), "sized-groups")
    return _pair_rows(counts, groups).unionByName(_term_rows(counts, groups, dictionary, top))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(common.read(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
token AS (SELECT doc, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM token GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM token JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, sum(n) AS size, count(*) AS terms FROM kept GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(CAST(s.size AS HUGEINT), 0) AS size FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM counts GROUP BY ALL) s USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + l.terms) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.size::HUGEINT + l.terms) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""
