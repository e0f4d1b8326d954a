"""Source divergence audit: how far apart the sources of a language are, term by term and pair by pair.

Terms are counted by language and source in blocks of text, then in Spark; a language keeps what enough
of its documents hold. Kept terms are dealt, with all their sources' counts, into blocks of terms. In a
task a block becomes a dense matrix of int64 counts, a row for each source and a column for each term,
and from it one of smoothed shares; all pairs of its rows are compared by broadcasting, some columns at
a time. A task sums the pair matrices of its blocks and keeps one heap of the highest terms for each
source; Spark sums the partial matrices and ranks what the heaps held.

A block has CELLS cells at most (or one column), so it holds fewer terms the more sources there are;
a task works on LEFT rows against all, in a matrix of LEFT x sources. Counts of a source that holds most
rows are summed before the shuffle and by (language, source, term); no task gets a source or a language
as a whole. The result has a row for each pair of sources of a language, as asked.

All arithmetic is of integers: shares are in billionths, by long division where 64 bits would not hold
the product (languages of up to 9 * 10 ** 15 words).

Defined results: null text, lang and source count as empty; rows that share a doc_id are documents each;
a source without terms, or a language that keeps none, has pairs with value 0 for the latter and even
shares for the former, and no term rows; a source that is alone has no pairs; no rows give no rows;
doc_id and other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codalith.llm import common, words

SCALE, MIN_DOCUMENTS, TOP = 1_000_000_000, 3, 200
#: Cells of a block's matrix, cells that a broadcast makes at once, rows that one task compares with all.
CELLS, AT_ONCE, LEFT = 1 << 17, 1 << 19, 256
#: Text that is counted at once.
COUNT_BYTES = 8 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_APART = np.ones(256, bool)
_APART[[*range(97, 123), *range(128, 256)]] = False


def _strings(pool: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of UTF-8 bytes as strings."""
    size = ends - starts
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(np.r_[0, np.cumsum(size)]), pa.py_buffer(words.gather(pool, starts, size))]).cast(pa.string())


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of texts in groups: group, term, occurrences and documents, for each group and term."""
    low = _LOWER[data]
    starts, ends, first = words.bounds(low, offsets, _APART)
    _, leader, which = np.unique(words.exact(low, starts, ends), return_index=True, return_inverse=True)
    n, each = max(1, len(leader)), np.diff(first)
    found, count = np.unique(np.repeat(group, each) * n + which, return_counts=True)
    held = np.unique(np.repeat(np.arange(len(each)), each) * n + which)  # once a document
    _, documents = np.unique(group[held // n] * n + held % n, return_counts=True)
    term = leader[found % n]
    return found // n, _strings(low, starts[term], ends[term]), count, documents


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "df"]
    held: list[pa.RecordBatch] = []

    def rows() -> Iterator[pa.RecordBatch]:
        together = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        lang, source = (together.column(k).combine_chunks().dictionary_encode() for k in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        data, offsets = common.utf8(together.column("text"))
        for i, j in common.chunks(offsets, COUNT_BYTES):
            g, term, n, df = count_terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], group[i:j])
            for at in range(0, len(g), 50_000):
                part = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(g[part] // len(source.dictionary))), source.dictionary.take(pa.array(g[part] % len(source.dictionary))), term[part], pa.array(n[part]), pa.array(df[part])], names)

    for batch in batches:
        held.append(batch)
        if sum(x.column("text").nbytes for x in held) >= COUNT_BYTES:
            yield from rows()
    if held:
        yield from rows()
    common.trim()


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, counts): the terms that enough documents of a language hold, with each of its sources' counts; staged."""
    common.small_batches(docs.sparkSession)
    counted = docs.select("lang", "source", "text").mapInArrow(_counting, "lang string, source string, term string, n long, df long")
    each = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    terms = each.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("counts"))  # an entry for each source
    return common.stage_table(terms.where(F.col("df") >= min_documents).select("lang", "term", "counts"), "terms")


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exactly."""
    x = count + 1
    if not x.size or int(x.max()) < (1 << 63) // SCALE:
        return 1 + x * SCALE // total
    out = np.zeros_like(x + total)
    rest = x + np.zeros_like(out)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return 1 + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q)"""
    apart = p - q
    return apart * apart // q


class _Rows:
    """The sums and heaps of some sources of a language, over the blocks that one task gets."""

    def __init__(self, lang: str, part: int, sources: list[str], top: int):
        self.lang, self.sources, self.top = lang, sources, top
        self.first = part * LEFT
        self.left = sources[self.first : self.first + LEFT]
        self.pairs = np.zeros((len(self.left), len(sources)), np.int64)
        self.heaps: list[list[tuple[int, str]]] = [[] for _ in self.left]

    def add(self, counts: np.ndarray, terms: list[str], totals: np.ndarray) -> None:
        """A block: counts by source and term, terms ascending; totals are the denominators of the sources and, last, of the language."""
        mine = slice(self.first, self.first + len(self.left))
        p = shares(counts, totals[:-1, None])
        step = max(1, AT_ONCE // max(1, len(p)))
        for at in range(0, len(terms), step):
            part = p[:, at : at + step]
            rows = max(1, AT_ONCE // part.size)
            for k in range(0, len(self.left), rows):
                own = part[mine][k : k + rows]
                self.pairs[k : k + rows] += divergence(own[:, None, :], part[None, :, :]).sum(axis=2)
        q = shares(counts.sum(axis=0), totals[-1])
        value = divergence(p[mine], q)
        value[(counts[mine] == 0) | (p[mine] <= q)] = -1
        for heap, row in zip(self.heaps, value):
            best = np.argsort(-row, kind="stable")[: self.top]  # of equal values the smaller term
            heap[:] = heapq.nsmallest(self.top, heap + [(-int(row[k]), terms[k]) for k in best.tolist() if row[k] >= 0])

    def told(self) -> Iterator[tuple]:
        for k, source in enumerate(self.left):
            for item, value in zip(self.sources, self.pairs[k].tolist()):
                if item != source:
                    yield self.lang, source, "pair", item, value
            for value, term in self.heaps[k]:
                yield self.lang, source, "term", term, -value


def _comparing(top: int):
    """Blocks of terms behind their sources' rows, together and sorted, to partial sums of pairs and heaps of terms."""
    names = ["lang", "source", "part", "item", "value"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Rows | None = None
        key = block = None
        sources: list[str] = []
        totals: list[int] = []
        terms: list[str] = []
        cells: list[list] = []

        def close() -> None:
            """Adds the block that has been read."""
            nonlocal state
            if state is None:
                state = _Rows(*key, sources[:-1], top)
            if terms:
                number = {s: k for k, s in enumerate(sources[:-1])}
                counts = np.zeros((len(sources) - 1, len(terms)), np.int64)
                for k, of_term in enumerate(cells):
                    for x in of_term:
                        counts[number[x["source"]], k] = x["n"]
                state.add(counts, terms, np.array(totals, np.int64))

        for batch in batches:
            for lang, left, number, kind, item, total, counts in zip(*(batch.column(k).to_pylist() for k in ("lang", "left", "block", "kind", "item", "total", "counts"))):
                if (key, block) != ((lang, left), number):
                    if key is not None:
                        close()
                    if key != (lang, left) and state is not None:
                        rows = list(state.told())
                        for at in range(0, len(rows), 10_000):
                            yield batch_of(rows[at : at + 10_000])
                        state = None
                    key, block, sources, totals, terms, cells = (lang, left), number, [], [], [], []
                if kind < 2:
                    sources.append(item)
                    totals.append(total)
                else:
                    terms.append(item)
                    cells.append(counts)
        if key is not None:
            close()
            rows = list(state.told())
            for at in range(0, len(rows), 10_000):
                yield batch_of(rows[at : at + 10_000])
        common.trim()

    return run


def divergences(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank: the other sources of the language, and the terms that stand out most."""
    docs = plain(docs)
    terms = kept_terms(docs, min_documents)
    sizes = terms.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("size"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").fillna(0, "size")
    groups = common.stage_table(groups, "groups")
    langs = groups.groupBy("lang").agg(F.count("*").alias("s"), F.sum("size").alias("size")).join(kept, "lang", "left").fillna(0, "v")
    langs = langs.withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("s") / CELLS)).cast("long"), "lefts": F.ceil(F.col("s") / LEFT).cast("long")})
    langs = common.stage_table(langs, "langs")

    dealt = lambda: [F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)).alias("left")]
    none = F.lit(None).cast("array<struct<source: string, n: long>>").alias("counts")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    about = lambda df, kind, item, total: df.select("lang", F.explode(every).alias("block"), "lefts", F.lit(kind).alias("kind"), item.alias("item"), total.alias("total"), none)
    heads = about(groups.join(langs.drop("size"), "lang"), 0, F.col("source"), F.col("size") + F.col("v"))
    whole = about(langs, 1, F.lit(""), F.col("size") + F.col("v"))
    body = terms.join(langs.select("lang", "blocks", "lefts"), "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "lefts", F.lit(2).alias("kind"), F.col("term").alias("item"), F.lit(None).cast("long").alias("total"), "counts")
    rows = heads.unionByName(whole).unionByName(body)
    rows = rows.select("lang", *dealt(), "block", "kind", "item", "total", "counts")
    together = rows.repartition("lang", "left", "block").sortWithinPartitions("lang", "left", "block", "kind", "item")
    parts = common.stage_table(together.mapInArrow(_comparing(top), "lang string, source string, part string, item string, value long"), "compared")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    found = pairs.unionByName(parts.where("part = 'term'"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(common.table(spark, sf_dir, "documents"))


_SHARE = f"1 + {SCALE} * (CAST(%s AS HUGEINT) + 1) // (%s)"
OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS x, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents)
, words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCUMENTS})
, counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term)
, sources AS (SELECT DISTINCT lang, source FROM d)
, of_lang AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang)
, sized AS (SELECT s.lang, s.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = s.lang AND c.source = s.source), 0) AS n FROM sources s)
, p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, {_SHARE % ("coalesce(c.n, 0)", "s.n + v")} AS p
  FROM sized s JOIN kept k USING (lang) JOIN of_lang USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), q AS (
  SELECT lang, term, {_SHARE % ("m", "total + v")} AS q
  FROM (SELECT lang, term, sum(n) AS m FROM counts GROUP BY lang, term) JOIN (SELECT lang, sum(n) AS total FROM counts GROUP BY lang) USING (lang) JOIN of_lang USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
