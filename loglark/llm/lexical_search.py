"""Ranked lexical search over posting lists cut into blocks of similar documents.

Documents are dealt out in shards. In each, a term's posting list is clustered by the
similarity of its documents, and each block stores, for every term, the highest share of a
score that any of its documents has from it. Their sum over a query's terms bounds all scores
in the block, so a block is skipped only when no document in it can be among the first k.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import LOWER, UPPER, Stage, stage, with_package

TOP = 50
#: What stands between terms, among ASCII; every other byte of UTF-8 belongs to a term.
_APART = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(_APART + UPPER.encode(), b" " * len(_APART) + LOWER.encode())
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Documents of one shard at most, and entries (document, term); a larger document is a shard of its own.
SHARD_ROWS, SHARD_ENTRIES = 32_768, 4_000_000
#: Documents of one block, expected; directions in which documents are compared for clustering.
BLOCK, DIRECTIONS = 64, 32
#: Terms that so large a share of a shard's documents have are common: nearly every block has their
#: highest share, so one number for the whole shard bounds them and blocks store the others.
COMMON = 1 / 2
#: Summaries that a task holds at once, in numbers.
SUMMARY_NUMBERS = 8_000_000
#: Different terms of the queries that one pass answers; more queries take more passes.
PASS_TERMS = 200_000
#: Documents with a query's rarest terms that are scored for its first threshold, as a multiple of k.
SEEDED = 64
#: Tasks whose first k are merged before those of all.
MERGED = 64

FORWARD = "id long, n long, terms array<int>, tfs array<long>"
FOUND = "item int, id long, score long, task int"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: A-Z in lower case, split at all other ASCII but letters and digits."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _forward(vocabulary: dict[bytes, int]):
    """Per document with a term: how many it has, and which of the vocabulary's how often."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ns, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                counts = Counter(words)
                own = sorted((vocabulary[w], tf) for w, tf in counts.items() if w in vocabulary)
                ids.append(doc_id)
                ns.append(len(words))
                terms.append([t for t, _ in own])
                tfs.append([tf for _, tf in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["id", "n", "terms", "tfs"],
            )

    return rows


def _entries(starts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many entries each document has, and the places of all of them."""
    sizes = starts[docs + 1] - starts[docs]
    ends = np.cumsum(sizes)
    return sizes, np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[docs] - ends + sizes, sizes)


class Shard:
    """Some documents as rows of (term, share of the score), and their posting lists."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, shares: np.ndarray, n_terms: int) -> None:
        self.ids, self.starts, self.terms, self.shares = ids, starts, terms.astype(np.int32), shares
        self.rows = np.repeat(np.arange(len(ids)), np.diff(starts))
        by_term = np.argsort(terms, kind="stable")
        self.postings = self.rows[by_term]
        self.posting_shares = shares[by_term]
        self.lists = np.searchsorted(terms[by_term], np.arange(n_terms + 1))
        #: Each term's highest share, from 0.
        self.highest = np.zeros(n_terms, dtype=np.int64)
        np.maximum.at(self.highest, terms, shares)
        self.common = np.diff(self.lists) > max(COMMON * len(ids), BLOCK)
        #: Rows without the common terms, from which blocks are clustered and summed up.
        rare = ~self.common[terms]
        self.rare_terms, self.rare_shares, self.rare_rows = terms[rare], shares[rare], self.rows[rare]
        self.rare_starts = np.append(0, np.cumsum(np.bincount(self.rare_rows, minlength=len(ids))))
        self.place = None

    def docs(self, term: int) -> np.ndarray:
        return self.postings[self.lists[term] : self.lists[term + 1]]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Scores of all documents, from the query's posting lists alone."""
        out = np.zeros(len(self.ids), dtype=np.int64)
        for t in query:
            out[self.docs(t)] += self.posting_shares[self.lists[t] : self.lists[t + 1]]
        return out

    def scores_of(self, docs: np.ndarray, query: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents. ``weight`` is a zero array by term, for marking the query's."""
        sizes, entries = _entries(self.starts, docs)
        weight[query] = 1
        share = self.shares[entries] * weight[self.terms[entries]]
        weight[query] = 0
        # Every document of a posting list has an entry, so no sum is empty.
        return np.add.reduceat(share, np.cumsum(sizes) - sizes) if len(docs) else np.zeros(0, dtype=np.int64)

    def sketches(self, seed: int = 7) -> np.ndarray:
        """Documents in a few random directions: near in angle here if near by their shares."""
        if self.place is None:
            turn = np.random.default_rng(seed).standard_normal((len(self.highest), DIRECTIONS)).astype(np.float32)
            out = np.zeros((len(self.ids), DIRECTIONS), dtype=np.float32)
            for d in range(DIRECTIONS):
                out[:, d] = np.bincount(self.rare_rows, weights=self.rare_shares * turn[self.rare_terms, d], minlength=len(self.ids))
            self.place = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        return self.place

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The term's documents, those of a block together, and where blocks begin.

        Every BLOCK-th document of the list is the middle of a block; each joins the nearest.
        """
        docs = self.docs(term)
        k = -(-len(docs) // BLOCK)
        if k <= 1:
            return docs, np.zeros(min(len(docs), 1), dtype=np.int64)
        place = self.sketches()[docs]
        near = np.argmax(place @ place[:: len(docs) // k][:k].T, axis=1)
        order = np.argsort(near, kind="stable")
        return docs[order], np.flatnonzero(np.diff(near[order], prepend=-1))

    def summaries(self, docs: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """By block and term the highest share of any of the block's documents; of common terms the shard's."""
        n_terms = len(self.highest)
        out = np.zeros(len(begins) * n_terms, dtype=np.int64)
        block = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(docs))))
        sizes, entries = _entries(self.rare_starts, docs)
        np.maximum.at(out, np.repeat(block * n_terms, sizes) + self.rare_terms[entries], self.rare_shares[entries])
        out = out.reshape(len(begins), n_terms)
        out[:, self.common] = self.highest[self.common]
        return out


class Best:
    """The first k documents of each query so far, by score and then id; a null id comes last."""

    NULL = np.iinfo(np.int64).max

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None) -> None:
        self.k = k
        #: Scores that k documents are known to reach, by query.
        self.floor = np.ones(n, dtype=np.int64) if floor is None else floor
        self.ids = [np.zeros(0, dtype=np.int64)] * n
        self.scores = [np.zeros(0, dtype=np.int64)] * n

    def least(self, q: int) -> int:
        """A score below this is not among the first k; equal ones can be."""
        own = int(self.scores[q][-1]) if len(self.scores[q]) == self.k else 1
        return max(own, int(self.floor[q]))

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        near = scores >= self.least(q)
        ids, scores = np.append(self.ids[q], ids[near]), np.append(self.scores[q], scores[near])
        first = np.lexsort((ids, -scores))[: self.k]
        self.ids[q], self.scores[q] = ids[first], scores[first]


def seed_shard(shard: Shard, seeds: list[np.ndarray], queries: list[np.ndarray], best: Best) -> None:
    """Merge into ``best`` the shard's documents that have one of a query's ``seeds``, its rarest terms."""
    weight = np.zeros(len(shard.highest), dtype=np.int64)
    for q, terms in enumerate(seeds):
        lists = [shard.docs(t) for t in terms]
        docs = np.unique(np.concatenate(lists)) if lists else np.zeros(0, dtype=np.int64)
        if len(docs):
            best.add(q, shard.ids[docs], shard.scores_of(docs, queries[q], weight))


def search_shard(shard: Shard, queries: list[np.ndarray], best: Best) -> tuple[int, int]:
    """Merge the shard's documents into ``best``; how many blocks were asked for and how many were read.

    Terms come by their highest share, from above. A document that matters and is unread has none
    of the terms that came before: it was in their blocks, and one that is left unread there cannot be among
    the first k. So only the terms from here on count in a bound, and when their highest shares
    together stay below the threshold the query is done.
    """
    weight = np.zeros(len(shard.highest), dtype=np.int64)
    unread = np.ones((len(queries), len(shard.ids)), dtype=bool)
    rest: list[np.ndarray] = []
    bounds: list[np.ndarray] = []

    def take(q: int, docs: np.ndarray) -> None:
        docs = docs[unread[q][docs]]
        unread[q][docs] = False
        best.add(q, shard.ids[docs], shard.scores_of(docs, queries[q], weight))

    asking: dict[int, list[int]] = {}
    for q, query in enumerate(queries):
        lengths = shard.lists[query + 1] - shard.lists[query]
        held = query[lengths > 0]
        held = held[np.lexsort((held, -shard.highest[held]))]
        rest.append(held)
        bounds.append(np.cumsum(shard.highest[held][::-1])[::-1])
        for t in held.tolist():
            asking.setdefault(t, []).append(q)

    blocks = read = 0
    at_term = [0] * len(queries)
    together = max(1, SUMMARY_NUMBERS // max(1, len(shard.highest)))
    for t in sorted(asking, key=lambda t: (-int(shard.highest[t]), t)):
        wanting = []
        for q in asking[t]:
            if bounds[q][at_term[q]] >= best.least(q):
                wanting.append((q, rest[q][at_term[q] :]))
            at_term[q] += 1
        if not wanting:
            continue
        docs, begins = shard.blocks(t)
        ends = np.append(begins[1:], len(docs))
        for at in range(0, len(begins), together):
            some = begins[at : at + together]
            base, stop = int(some[0]), int(ends[min(at + together, len(begins)) - 1])
            summary = shard.summaries(docs[base:stop], some - base)
            for q, terms in wanting:
                bound = summary[:, terms].sum(axis=1)
                blocks += len(bound)
                order = np.flatnonzero(bound >= best.least(q))
                order = order[np.argsort(-bound[order], kind="stable")]
                step = 4
                while len(order):
                    now, order = order[:step], order[step:]
                    take(q, np.concatenate([docs[some[b] : ends[at + b]] for b in now]))
                    read += len(now)
                    order = order[bound[order] >= best.least(q)]
                    step *= 2
    return blocks, read


def _shares(n: np.ndarray, counts: np.ndarray, tfs: np.ndarray, terms: np.ndarray, w: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each entry gives to a score: w * ((10^9 tf) div (1000 tf + 20 m)), whole numbers."""
    m = np.array([100 - 50 + 50 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
    return w[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * np.repeat(m, counts)))


def _search(queries: list[np.ndarray], w: np.ndarray, n_docs: int, n_terms: int, k: int, seeds=None, floor=None):
    """The first k of each query among a task's documents: of all, or of those with one of its ``seeds``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best = Best(len(queries), k, floor)
        waiting: list[tuple] = []
        rows = entries = 0

        def work() -> None:
            ids, ns, counts, terms, tfs = (np.concatenate(x) for x in zip(*waiting, strict=True))
            shares = _shares(ns, counts, tfs, terms, w, n_docs, n_terms)
            shard = Shard(ids, np.append(0, np.cumsum(counts)), terms, shares, len(w))
            if seeds is None:
                search_shard(shard, queries, best)
            else:
                seed_shard(shard, seeds, queries, best)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column("id").fill_null(int(Best.NULL)).to_numpy(zero_copy_only=False)
                terms, tfs = part.column("terms"), part.column("tfs")
                counts = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                flat = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                waiting.append((ids, part.column("n").to_numpy(zero_copy_only=False), counts, flat, tfs.flatten().to_numpy(zero_copy_only=False)))
                rows, entries = rows + len(ids), entries + len(flat)
                if rows >= SHARD_ROWS or entries >= SHARD_ENTRIES:
                    work()
                    waiting, rows, entries = [], 0, 0
        if waiting:
            work()
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        for q in range(len(queries)):
            ids, scores = best.ids[q], best.scores[q]
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), q, dtype=np.int32)),
                        pa.array(ids, pa.int64(), mask=ids == Best.NULL),
                        pa.array(scores),
                        pa.array(np.full(len(ids), task, dtype=np.int32)),
                    ],
                    names=["item", "id", "score", "task"],
                )

    return run


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _one_pass(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """Ranked documents of some items, given as (item_id, terms)."""
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in items for w in words}))}
    queries = [np.array(sorted(vocabulary[w] for w in words), dtype=np.int64) for _, words in items]
    forward = Stage(docs.mapInArrow(_forward(vocabulary), FORWARD), "search-documents")
    size = forward.df.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # At most one row per term of the vocabulary, which a pass bounds.
    df = forward.df.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()
    w = np.zeros(len(vocabulary), dtype=np.int64)
    for row in df:
        w[row.t] = math.floor(1000 * math.log((2 * size.n + 2) / (2 * row.df + 1)))
    counted = np.zeros(len(vocabulary), dtype=np.int64)
    for row in df:
        counted[row.t] = row.df
    n_terms = max(size.terms, 1)

    def first(rows: DataFrame) -> DataFrame:
        merged = _ranked(rows.withColumn("task", F.col("task") % MERGED), ["item", "task"], k).drop("rank")
        return _ranked(merged, ["item"], k)

    # The rarest terms of each query, until they have SEEDED * k documents: what the k-th of those
    # scores is a floor for the search of all others. One row per item.
    seeds = []
    for query in queries:
        order = query[np.argsort(counted[query], kind="stable")]
        seeds.append(order[: int(np.searchsorted(np.cumsum(counted[order]), SEEDED * k)) + 1])
    tried = stage(forward.df.mapInArrow(_search(queries, w, size.n, n_terms, k, seeds=seeds), FOUND), "search-seeds")
    floor = np.ones(len(queries), dtype=np.int64)
    for row in first(tried).where(F.col("rank") == k).collect():
        floor[row.item] = row.score
    found = stage(forward.df.mapInArrow(_search(queries, w, size.n, n_terms, k, floor=floor), FOUND), "search-found")
    forward.drop()
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return first(found).join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """The k highest-scoring documents of each item: item_id, rank, doc_id, score.

    A document's score is the sum over the item's different terms of a weight that falls with the
    number of documents holding the term, times a share that grows with how often the document has
    it and falls with its length; all in whole numbers. Equal scores go to the smaller id.
    All documents are searched and whole texts read; a block of documents is left
    unread only if its bound shows that none of it can be among the first k.

    Only the terms of the items are indexed. Items go in passes of about ``pass_terms`` different
    terms at most, by their hash, so what a task and the driver hold is bounded however many there are;
    each pass reads all documents.

    A null text has no terms; an item without terms, or whose terms no document has, has no row.
    Each row of ``items`` is an item of its own, and each of ``docs`` a document of its own, also
    with repeated or null ids (null ids rank last among equal scores). Empty tables give no row;
    other columns are not read.
    """
    docs = with_package(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    wanted = stage(
        items.select(
            F.col(item_col).cast("long").alias("item_id"),
            F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(item_text_col, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))).alias("terms"),
        ).where(F.size("terms") > 0),
        "search-items",
    )
    total = wanted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    passes = max(1, -(-total // pass_terms))
    out = None
    for i in range(passes):
        some = wanted.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(passes)) == i).collect()
        if some or out is None and i == passes - 1:
            found = _one_pass(docs, [(r.item_id, [t.encode("utf-8", "surrogatepass") for t in r.terms]) for r in some], k)
            out = found if out is None else out.unionByName(found)
    return out


SQL = f"""
    with d as (select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as w from documents),
    s as (select row, doc_id, w, len(w) as n from d where len(w) > 0),
    size as (select count(*) as docs, coalesce(sum(n), 0)::bigint as terms from s),
    tf as (select row, t, count(*) as tf from (select row, unnest(w) as t from s) group by all),
    q as (
      select i, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}'))) as t
      from (select row_number() over () as i, * from benchmark)),
    df as (select t, count(*) as df from tf group by 1),
    w as (select t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w from df, size),
    m as (select row, doc_id, 100 - 50 + (50 * n * docs) // terms as m from s, size),
    r as (
      select i, item_id, row, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
      from q join tf using (t) join w using (t) join m using (row) group by all),
    k as (select *, row_number() over (partition by i order by score desc, doc_id) as rank from r where score > 0)
    select item_id, rank, doc_id, score from k where rank <= {TOP}"""
