"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time.

Postings of the wanted terms are made once, by tasks that read whole texts, and written.
The statistics (documents, terms, documents per term) are plain aggregations over them.
The search then runs where the postings are: a task walks its documents block by block,
turns a block into inverted lists and answers every query on them.

For one query and one block

1. lists shorter than the block's ``SHORT`` share are read term at a time and summed into
   accumulators, which are materialised in document order;
2. the accumulators are from then on one more iterator with a known bound, beside the long
   lists: the block is walked in windows of documents, the bound of a window is the sum of
   its largest accumulator and the largest impact of every long list there, and a window
   whose bound is below the query's threshold is skipped unread;
3. in a window that is entered, documents whose accumulator cannot be lifted over the
   threshold by the long lists are skipped, the others are scored in full, document by
   document, by seeks in the long lists.

The threshold is the score of the query's k-th best document so far in the task; it only
rises.  Ties with it are entered, so equal scores are decided by the document ids alone.
A task returns at most k documents per query; a window function with its rank limit pushed
below the shuffle makes the final ranking.

Queries run in blocks of bounded size (``QUERY_TERMS`` pairs of query and term), so what is
broadcast is bounded, whatever the number of queries.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.llm.common import materialise

#: pairs of query and term in one block of queries
QUERY_TERMS = 500_000
#: a block of documents ends at so many documents or postings; documents of one window
BLOCK_DOCS, BLOCK_POSTINGS, WINDOW = 16_384, 4_000_000, 256
#: lists that hold less than this share of a block's documents are summed up front
SHORT = 1 / 16
#: texts handed to Python at once
ROWS = 500
#: fixed value: what separates terms, over UTF-8 bytes; every byte of a character above U+007F belongs to a term
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8 bytes; only A-Z are lower-cased."""
    return _TERM.findall(text.encode("utf-8").lower())


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(query, term) of every distinct query (id and text) with its terms, each once; ``query`` numbers them by
    a hash of id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for x in sorted(set(terms_of(t or ""))):
                    row.append(i)
                    term.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(term, pa.binary())], ["key", "term"])

    kind = queries.schema[key].dataType.simpleString()
    named = queries.select(F.struct(F.col(key).alias("id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest")).alias("key"),
                           F.col(text).alias("text")).dropDuplicates(["key"])
    return named.mapInArrow(run, f"key struct<id:{kind},digest:string>, term binary")


def postings(docs: DataFrame, vocabulary: dict[bytes, int], text: str, doc: str) -> DataFrame:
    """(doc, n, terms, tfs) of every row: its number of terms, the wanted terms it holds (their numbers) and how often."""
    handle = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = handle.value
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                n, terms, tfs = [], [], []
                for t in part.column(1).to_pylist():
                    words = terms_of(t) if t else []
                    found = Counter(x for x in map(wanted.get, words) if x is not None)
                    n.append(len(words))
                    terms.append(list(found))
                    tfs.append(list(found.values()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                                  pa.array(tfs, pa.list_(pa.int32()))], ["doc", "n", "terms", "tfs"])

    kind = docs.schema[doc].dataType.simpleString()
    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"doc {kind}, n long, terms array<int>, tfs array<int>")


class Block:
    """Inverted lists over one block of documents, which are in the order of their ids."""

    def __init__(self, n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        self.size = len(n)
        doc = np.repeat(np.arange(self.size), lengths)
        order = np.lexsort((doc, terms))
        terms, doc, tfs = terms[order], doc[order], tfs[order].astype(np.int64)
        m = 50 + (50 * n * n_docs) // n_terms
        impact = weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[doc]))
        cuts = np.flatnonzero(np.diff(terms)) + 1
        self.docs = dict(zip(terms[np.r_[0, cuts]].tolist(), np.split(doc, cuts))) if len(terms) else {}
        self.impacts = dict(zip(self.docs, np.split(impact, cuts)))
        self.windows = -(-self.size // WINDOW)
        self.bounds: dict[int, np.ndarray] = {}

    def bound(self, term: int) -> np.ndarray:
        """The largest impact of a long list in every window."""
        if term not in self.bounds:
            out = np.zeros(self.windows, dtype=np.int64)
            np.maximum.at(out, self.docs[term] // WINDOW, self.impacts[term])
            self.bounds[term] = out
        return self.bounds[term]

    def search(self, wanted: list[int], best: Best) -> None:
        lists = sorted((t for t in wanted if t in self.docs), key=lambda t: len(self.docs[t]))
        if not lists:
            return
        n_short = sum(len(self.docs[t]) < self.size * SHORT for t in lists)
        short, long = lists[:n_short], lists[n_short:]
        # 1. term at a time: the short lists become one list of summed accumulators
        summed = np.zeros(self.size, dtype=np.int64)
        for t in short:
            summed[self.docs[t]] += self.impacts[t]
        at = np.flatnonzero(summed)
        # 2. document at a time, the accumulators being one bounded iterator among the long lists
        edges = np.arange(0, self.size, WINDOW)
        bound = np.maximum.reduceat(summed, edges) if len(at) else np.zeros(self.windows, dtype=np.int64)
        lift = sum((self.bound(t) for t in long), np.zeros(self.windows, dtype=np.int64))
        bound = bound + lift
        best.raise_to(summed[at])
        for w in np.flatnonzero(bound > 0).tolist():
            if bound[w] < best.threshold:
                continue
            lo, hi = w * WINDOW, min(self.size, (w + 1) * WINDOW)
            score = summed[lo:hi].copy()
            rest = int(lift[w])
            # longest lists last: a document leaves as soon as the lists still to come cannot lift it over the threshold
            alive = np.arange(hi - lo)
            for t in long:
                if rest < best.threshold:
                    alive = alive[score[alive] + rest >= best.threshold]
                    if not len(alive):
                        break
                docs = self.docs[t]
                a, b = np.searchsorted(docs, (lo, hi))
                found = docs[a:b] - lo
                if len(alive) == hi - lo:
                    score[found] += self.impacts[t][a:b]
                elif b > a:
                    place = np.minimum(np.searchsorted(found, alive), b - a - 1)
                    hit = found[place] == alive
                    score[alive[hit]] += self.impacts[t][a:b][place[hit]]
                rest -= int(self.bound(t)[w])
            alive = alive[score[alive] >= max(1, best.threshold)]
            if len(alive):
                best.add(score[alive], alive + lo)


class Best:
    """The k best (score, place) of one query; equal scores: the earlier document id."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.scores, self.docs = np.zeros(0, dtype=np.int64), None
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.threshold = 1

    def raise_to(self, partial: np.ndarray) -> None:
        """``partial``: parts of the scores of documents of the block about to be read; the k-th largest is a lower
        bound of the block's k-th best score."""
        if len(partial) >= self.k:
            self.threshold = max(self.threshold, int(np.partition(partial, len(partial) - self.k)[len(partial) - self.k]))

    def add(self, scores: np.ndarray, places: np.ndarray) -> None:
        self.new.append((scores, places))
        pool = np.concatenate([self.scores, *(s for s, _ in self.new)])
        if len(pool) >= self.k:
            self.threshold = max(self.threshold, int(np.partition(pool, len(pool) - self.k)[len(pool) - self.k]))

    def close_block(self, ids: pa.Array) -> None:
        """Keep the k best of the former ones and of the block's documents (``ids`` by place)."""
        if not self.new:
            return
        scores = np.concatenate([s for s, _ in self.new])
        docs = ids.take(pa.array(np.concatenate([p for _, p in self.new]), pa.int64()))
        self.new = []
        if self.docs is not None:
            scores, docs = np.concatenate([self.scores, scores]), pa.concat_arrays([self.docs, docs])
        order = pa.table({"s": scores, "d": docs}).sort_by([("s", "descending"), ("d", "ascending")]).slice(0, self.k)
        self.scores, self.docs = order.column("s").to_numpy(), order.column("d").combine_chunks()
        if len(self.scores) >= self.k:
            self.threshold = max(self.threshold, int(self.scores[-1]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents in blocks of bounded size, each in the order of its ids (nulls last)."""
    held, docs, found = [], 0, 0

    def flush() -> pa.Table:
        return pa.Table.from_batches(held).combine_chunks().sort_by([("doc", "ascending")])

    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            held.append(part)
            docs += part.num_rows
            found += len(part.column(2).flatten())
            if docs >= BLOCK_DOCS or found >= BLOCK_POSTINGS:
                yield flush()
                held, docs, found = [], 0, 0
    if held:
        yield flush()


def best_of_blocks(bags: DataFrame, queries: dict[int, list[int]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, doc, score): per task the k best documents of every query (numbers of its terms)."""
    handle = bags.sparkSession.sparkContext.broadcast((queries, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = handle.value
        best = {q: Best(k) for q in asked}
        for block in _blocks(batches):
            terms, tfs = (block.column(c).combine_chunks() for c in ("terms", "tfs"))
            lengths = np.diff(terms.offsets.to_numpy())
            lists = Block(block.column("n").to_numpy(), lengths, terms.flatten().to_numpy(), tfs.flatten().to_numpy(), w, n_docs, n_terms)
            ids = block.column("doc").combine_chunks()
            for q, wanted in asked.items():
                lists.search(wanted, best[q])
                best[q].close_block(ids)
        for q, b in best.items():
            if b.docs is not None:
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(b.docs), pa.int32()), b.docs, pa.array(b.scores, pa.int64())],
                                                 ["query", "doc", "score"])

    kind = bags.schema["doc"].dataType.simpleString()
    return bags.mapInArrow(run, f"query int, doc {kind}, score long")


def _search_block(pairs: list, docs: DataFrame, text: str, doc: str, k: int, totals: dict) -> tuple[DataFrame, list] | None:
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in pairs}))}
    keys = sorted({r["key"] for r in pairs}, key=str)
    number = {key: i for i, key in enumerate(keys)}
    queries: dict[int, list[int]] = {i: [] for i in range(len(keys))}
    for r in pairs:
        queries[number[r["key"]]].append(vocabulary[bytes(r["term"])])
    bags = materialise(postings(docs, vocabulary, text, doc), "postings")
    if not totals:
        totals.update(bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first().asDict())
    if not totals["terms"]:
        return None
    # one number per wanted term comes back, at most QUERY_TERMS
    df = {r["t"]: r["df"] for r in bags.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for t, held in df.items():
        weight[t] = math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * held + 1)))
    return best_of_blocks(bags, queries, weight, totals["docs"], totals["terms"], k), keys


def rank(docs: DataFrame, queries: DataFrame, k: int = 50, text: str = "text", doc: str = "doc_id", query: str = "item_id",
         query_text: str = "text") -> DataFrame:
    """(query, rank, doc, score): the ``k`` best documents with a score above 0 of every query.

    Equal scores: the smaller id first, null ids last.  Every row of ``docs`` is a document:
    repeated rows count each, in the statistics too, and each can take a rank.  Null and
    empty texts have no terms: such documents never appear, such queries have no rows.  A
    query is a distinct pair of id and text; rows that repeat it are one query, and an id
    with two texts (or a null id) gets a ranking for each.  Texts are read whole, whatever
    their length.  Other columns, whatever their names, are not read.  Empty tables: empty result.
    """
    spark = docs.sparkSession
    pairs = materialise(query_terms(queries, query, query_text), "query_terms")
    n_blocks = -(-pairs.count() // QUERY_TERMS)
    part: Column = F.pmod(F.xxhash64("key"), F.lit(max(1, n_blocks)))
    kinds = queries.schema[query].dataType.simpleString(), docs.schema[doc].dataType.simpleString()
    found, totals = [], {}
    for b in range(n_blocks):
        rows = pairs.where(part == b).collect()
        answer = _search_block(rows, docs, text, doc, k, totals) if rows else None
        if answer is None:
            continue
        best, keys = answer
        names = spark.createDataFrame([(i, *key) for i, key in enumerate(keys)], f"query int, id {kinds[0]}, digest string")
        place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
        top = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        found.append(top.join(F.broadcast(names), "query").select(F.col("id").alias(query), "rank", F.col("doc").alias("__doc"), "score"))
    if not found:
        return spark.createDataFrame([], f"`{query}` {kinds[0]}, rank int, `{doc}` {kinds[1]}, score long")
    return reduce(DataFrame.unionByName, found).withColumnRenamed("__doc", doc)
