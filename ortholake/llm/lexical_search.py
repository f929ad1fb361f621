"""Operator 11: ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

One pass over the documents writes the index: for each document its length and the terms of the
queries that it holds. Statistics (N, L, df) are sums over it. A task then goes through its part
of the index in shards of bounded size, and holds for each shard the posting lists (places of
documents in ascending id, and what a document's term adds to a score). A query runs on a shard in two steps:

* term at a time: its short lists are summed up into accumulators, sorted by place. Their sums
  are lower bounds of scores, so they already give a threshold for the k-th best.
* document at a time: from then on the accumulators are one more list, with a bound like any other. The long lists
  and the accumulators carry a largest value per block of places. Blocks whose bounds add up to less
  than the threshold are skipped. In the others, lists that could not even together lift a document to the threshold name no
  candidates; they are only looked up for documents that the other lists name, the largest bound
  first, and a document is given up once what is left cannot lift it to the threshold.

The best k so far of every query pass from shard to shard of a task, so later shards skip more.
At last the tasks' lists of k meet in a two-stage top-k. A block or document is only given up if its bound is
below the threshold, so the result is exact, ties included.

Queries are taken in blocks of ``QUERY_BYTES`` of text, by hash of the query; only such a block and its vocabulary are
ever sent to the tasks. Scores are those of the contract, in 64-bit integers.

Defined results: a null text has no terms; documents without a term count in nothing. Repeated
documents count each and take a rank each. A document without id ranks behind the others of its score. Equal
rows of the query table are one query; an id with several texts is several queries, each with ranks of
its own. Queries without a term, or without a match, have no rows; an empty table of either kind
gives none.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, materialise, table, text_or_empty
from ortholake.operators.seqsets import top_k_per_group

TOP = 20
QUERY_BYTES = 4 << 20       # of query text at once
SHARD_POSTINGS = 1 << 21    # of a shard
SHARD_DOCS = 1 << 18
BLOCK = 128                 # places of a block
SHORT_SHARE = 16            # a list is short if it holds at most one place in so many of the shard

#: Bytes of separators become spaces, A-Z become a-z; bytes outside ASCII belong to terms.
FOLD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# One shard --------------------------------------------------------------------------------
class Shard:
    """Posting lists of documents whose places are in ascending id. ``owner``: place of each posting,
    ``term`` and ``gain``: its term and what one occurrence in a query adds."""

    def __init__(self, size: int, owner: np.ndarray, term: np.ndarray, gain: np.ndarray):
        self.size, self.n_blocks = size, -(-size // BLOCK)
        order = np.lexsort((owner, term))
        self.place, self.gain = owner[order], gain[order]
        t = term[order]
        cut = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.intp)
        self.span = {int(t[a]): (int(a), int(b)) for a, b in zip(cut, [*cut[1:], len(t)], strict=True)}
        self._tops: dict[int, np.ndarray] = {}

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.span[t]
        return self.place[a:b], self.gain[a:b]

    def tops(self, t: int) -> np.ndarray:
        """Largest gain of a term in each block."""
        if t not in self._tops:
            self._tops[t] = block_tops(*self.postings(t), self.n_blocks)
        return self._tops[t]


def block_tops(place: np.ndarray, value: np.ndarray, n_blocks: int) -> np.ndarray:
    out = np.zeros(n_blocks, np.int64)
    if len(place):
        b = place // BLOCK
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
        out[b[cut]] = np.maximum.reduceat(value, cut)
    return out


def kth(values: np.ndarray, k: int) -> int:
    """The k-th largest value, 0 if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def search_shard(shard: Shard, query: dict[int, int], k: int, floor: int, stats: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the documents of a shard that may belong to the best k: all that score at
    least ``floor`` and are among the shard's best k, ties with the last one included.

    ``query``: occurrences by term; ``floor``: a score that k documents elsewhere reach."""
    lists = sorted((shard.span[t][1] - shard.span[t][0], t) for t in query if t in shard.span)
    short = [t for n, t in lists if n * SHORT_SHARE <= shard.size]
    long_ = [t for n, t in lists if n * SHORT_SHARE > shard.size]

    # Term at a time: the short lists as one list of sums.
    if short:
        place = np.concatenate([shard.postings(t)[0] for t in short])
        value = np.concatenate([shard.postings(t)[1] * query[t] for t in short])
        order = np.argsort(place, kind="stable")
        place, value = place[order], value[order]
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        acc_place, acc = place[cut], np.add.reduceat(value, cut)
    else:
        acc_place, acc = np.zeros(0, np.int64), np.zeros(0, np.int64)
    threshold = max(floor, kth(acc, k), 1)

    # Document at a time: the sums and the long lists, least bound first.
    iterators = [(int(acc.max(initial=0)), acc_place, acc, 1, block_tops(acc_place, acc, shard.n_blocks))]
    for t in long_:
        p, g = shard.postings(t)
        tops = shard.tops(t)
        iterators.append((int(tops.max(initial=0)) * query[t], p, g, query[t], tops * query[t]))
    iterators.sort(key=lambda x: x[0])
    reach = np.cumsum([x[0] for x in iterators])               # bound of an iterator with all lesser ones
    bound = np.sum([x[4] for x in iterators], axis=0)
    blocks = np.flatnonzero(bound >= threshold)
    found_place, found = [], []
    # Stretches of blocks in document order; the first one is small, as it sharpens the threshold.
    at, step = 0, 4
    while at < len(blocks):
        some = blocks[at:at + step]
        at, step = at + step, min(step * 4, 1 << 10)
        some = some[bound[some] >= threshold]
        if not len(some):
            continue
        lo, hi = int(some[0]) * BLOCK, (int(some[-1]) + 1) * BLOCK
        open_ = np.zeros(int(some[-1]) - int(some[0]) + 1, bool)
        open_[some - some[0]] = True
        lead = int(np.searchsorted(reach, threshold))          # the iterators below it name no candidates
        names = []
        for _, p, _, _, _ in iterators[lead:]:
            a, b = np.searchsorted(p, (lo, hi))
            part = p[a:b]
            names.append(part[open_[part // BLOCK - some[0]]])
        cand = np.unique(np.concatenate(names)) if names else np.zeros(0, np.int64)
        score = np.zeros(len(cand), np.int64)
        for i in range(len(iterators) - 1, -1, -1):
            _, p, g, times, _ = iterators[i]
            if not len(cand):
                break
            if len(p):
                where = np.minimum(np.searchsorted(p, cand), len(p) - 1)
                hit = p[where] == cand
                score[hit] += g[where[hit]] * times
            if i:
                alive = score + reach[i - 1] >= threshold
                cand, score = cand[alive], score[alive]
            if stats is not None:
                stats["looked_up"] += len(cand)
        good = score >= threshold
        found_place.append(cand[good])
        found.append(score[good])
        if good.any():
            threshold = max(threshold, kth(np.concatenate(found), k))
    if stats is not None:
        stats["blocks"] += shard.n_blocks
        stats["skipped"] += shard.n_blocks - len(blocks)
    if not found:
        return acc_place[:0], acc[:0]
    place, score = np.concatenate(found_place), np.concatenate(found)
    good = score >= threshold
    return place[good], score[good]


# Spark ----------------------------------------------------------------------------------
def query_blocks(queries: DataFrame, id_col: str, text_col: str, block_bytes: int = QUERY_BYTES) -> Iterator[list[tuple[object, str, Counter]]]:
    """Blocks of distinct queries (id, key, terms with their counts), of about ``block_bytes`` of text each."""
    q = queries.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).distinct()
    q = materialise(q.withColumn("key", F.sha2(F.to_json(F.struct("id", "text")), 256)), "queries")
    total = q.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for b in range(n):
        rows = q.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == b).orderBy("key").toLocalIterator()
        block = [(r["id"], r["key"], Counter(terms(r["text"]))) for r in rows]
        if block:
            yield block


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms array<int>, tfs array<int>): length of every document in terms, and the
    terms of the vocabulary in it."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)      # at most a block of queries

    def make():
        number = shared.value.get

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            size, ends, who, often = [], [0], [], []
            for text in b.column(1):
                words = terms(text.as_py())
                held = Counter(map(number, words))
                held.pop(None, None)
                size.append(len(words))
                who.extend(held.keys())
                often.extend(held.values())
                ends.append(len(who))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (who, often)]
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

        return work

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return by_batch(rows, f"id {kind}, n long, terms array<int>, tfs array<int>", make)


def search_block(docs: DataFrame, block: list[tuple[object, str, Counter]], k: int, id_col: str, text_col: str) -> DataFrame:
    """(query, id, score): for each query (its number in the block) the best k of each task."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, _, c in block for t in c}))}
    index = materialise(build_index(docs, vocabulary, id_col, text_col), "index")
    total = index.filter("n > 0").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    n_docs, length = total["N"], total["L"] or 0
    # As many rows as the block has terms.
    df = {r["t"]: r["df"] for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator()}
    weight = np.array([term_weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    wanted = [{vocabulary[t]: n for t, n in c.items()} for _, _, c in block]
    shared = docs.sparkSession.sparkContext.broadcast((weight, wanted))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, wanted = shared.value
        best: list[list[tuple]] = [[] for _ in wanted]         # (-score, id is null, id), best first
        held, postings, n, id_type = [], 0, 0, None

        def flush():
            rows = pa.Table.from_batches(held)
            rows = rows.take(pc.sort_indices(rows.column("id"), null_placement="at_end")).combine_chunks()
            ids, size = rows.column("id"), np.asarray(rows.column("n"))
            lists, tfs = (rows.column(c).combine_chunks() for c in ("terms", "tfs"))
            owner = np.repeat(np.arange(len(size)), np.diff(np.asarray(lists.offsets)))
            t, tf = np.asarray(lists.flatten()), np.asarray(tfs.flatten()).astype(np.int64)
            m = 75 + (25 * size * n_docs) // length
            shard = Shard(len(size), owner, t, weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[owner])))
            for q, query in enumerate(wanted):
                floor = -best[q][-1][0] if len(best[q]) == k else 0
                place, score = search_shard(shard, query, k, floor)
                if len(place):
                    names = ids.take(pa.array(place)).to_pylist()
                    best[q] = heapq.nsmallest(k, [*best[q], *((-s, x is None, x) for s, x in zip(score.tolist(), names, strict=True))],
                                              key=lambda x: x if x[2] is not None else x[:2])

        for b in batches:
            id_type = b.schema.field("id").type
            held.append(b)
            postings, n = postings + len(b.column(2).flatten()), n + b.num_rows
            if postings >= SHARD_POSTINGS or n >= SHARD_DOCS:
                flush()
                held, postings, n = [], 0, 0
        if held:
            flush()
        rows = [(q, x, -s) for q, found in enumerate(best) for s, _, x in found]
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], id_type), pa.array(cols[2], pa.int64())], names=["query", "id", "score"])

    return index.filter("size(terms) > 0").mapInArrow(run, f"query int, id {kind}, score long")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  query_id: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query id, rank, doc id, score): the ``k`` best documents of each query."""
    spark = docs.sparkSession
    id_type, q_type = docs.schema[id_col].dataType, queries.schema[query_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item {q_type}, rank int, id {id_type.simpleString()}, score long")
    for block in query_blocks(queries, query_id, query_text, query_bytes):
        best = materialise(search_block(docs, block, k, id_col, text_col).withColumn("salt", F.spark_partition_id()), "best")
        top = top_k_per_group(best, "query", [F.col("score").desc(), F.col("id").asc_nulls_last()], k, salt_col="salt")
        names = spark.createDataFrame([(i, x[0]) for i, x in enumerate(block)], f"query int, item {q_type}")
        out = out.unionByName(top.join(F.broadcast(names), "query").select("item", "rank", "id", "score"))    # one block of queries
    return out.select(F.col("item").alias(query_id), "rank", F.col("id").alias(id_col), "score")


def op11_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(ts)) AS total FROM d WHERE len(ts) > 0),
m AS (SELECT r, doc_id, 75 + (25 * CAST(len(ts) AS BIGINT) * n_docs) // CAST(total AS BIGINT) AS m FROM d, c WHERE len(ts) > 0),
p AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
q AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)),
w AS (SELECT q, item_id, t, count(*) AS times FROM (SELECT q, item_id, unnest(ts) AS t FROM q) GROUP BY q, item_id, t),
f AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM p, c WHERE t IN (SELECT t FROM w) GROUP BY t, n_docs),
s AS (SELECT q, item_id, doc_id, r, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM w JOIN f USING (t) JOIN p USING (t) JOIN m USING (r) GROUP BY q, item_id, doc_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM k WHERE place <= {TOP}"""
