"""Passages of held-out items inside a corpus, by a distributed positional inverted index.

The index holds all words of the corpus and is built once, whatever is sought later. Each task inverts its documents in
blocks: a row is a term, the documents of the block that hold it (by their number in the block) and its positions in each.
Rows are laid out by a hash of
the term, sorted by term, hot terms over several tasks; the count of documents of each term is written beside them. Items
are sought from their rarest terms: if a text holds at least ``share`` of an item's n words, it holds at least
``k - floor((1 - share) n)`` of any k of them, so the lists of the rarest k positions are intersected: first by document,
then after adjusting them by the item's offsets, with a drift of n. Only documents that pass both are gathered with all of
the item's lists and checked: an exact phrase, or a longest common subsequence inside a window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.llm.words import words
from tallyweir.session import cut, scratch, small_side

SHARE, SPAN = 0.55, 1.5
#: of an item's words, the part that must be met among its rarest ones before a document is looked into
MET = 0.2
#: bytes of item words sought at once; a larger set is sought in parts, each against the same index
ITEM_BYTES = 16_000_000
#: terms, or terms of items, that are broadcast to the readers of the index; more are joined by a shuffle
BROADCAST_TERMS = 200_000
#: documents and words that a task inverts at once
BLOCK_TEXTS, BLOCK_WORDS = 4_000, 1_000_000
#: a posting row; of document i the positions end at ends[i]. The row of a whole block has no term, and the documents' ids
POSTINGS = "bucket int, term string, n int, block bigint, docs array<int>, ends array<int>, positions array<int>, ids array<bigint>"


def item_parts(items: DataFrame, size: int = ITEM_BYTES) -> Iterator[dict[int, list[str]]]:
    """The words of each item with any, in parts of about ``size`` bytes; of items that share an id the texts are one after the other."""
    part: dict[int, list[str]] = {}
    own: dict[str, str] = {}
    held, last = 0, None
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        ws = words(row["text"])
        if held > size and row["item_id"] != last:
            yield part
            part, own, held = {}, {}, 0
        last = row["item_id"]
        if ws:
            part.setdefault(last, []).extend(own.setdefault(w, w) for w in ws)
            held += sum(map(len, ws)) + 8 * len(ws)
    if part:
        yield part


def item_words(items: DataFrame) -> dict[int, list[str]]:
    """The words of each item with any."""
    return {k: v for part in item_parts(items) for k, v in part.items()}


def bucket_of(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % buckets


def inverted(texts: list[list[str]], docs: list[int], block: int, keep: set[str] | None, buckets: int) -> pa.RecordBatch:
    """A block of tokenised documents in the order of POSTINGS: one row per term, and the block's own in bucket -1."""
    vocabulary: dict[str, int] = {}
    ids = [np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in ws), np.int64, len(ws)) for ws in texts]
    sizes = np.array([len(ws) for ws in texts], dtype=np.int64)
    term, doc = np.concatenate(ids), np.repeat(np.arange(len(texts)), sizes)
    position = np.arange(len(term)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if keep is not None:
        wanted = np.array([w in keep for w in vocabulary])[term]
        term, doc, position = term[wanted], doc[wanted], position[wanted]
    order = np.argsort(term, kind="stable")
    term, doc, position = term[order], doc[order], position[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(doc) != 0)][: len(term)])  # of each (term, document)
    heads = np.flatnonzero(np.r_[True, np.diff(term[starts]) != 0][: len(starts)])  # of each term
    first = np.r_[starts[heads], len(term)]  # of each term, among the positions
    ends = np.r_[starts[1:], len(term)][: len(starts)] - np.repeat(first[:-1], np.diff(np.r_[heads, len(starts)]))
    names = [*np.array([*vocabulary], dtype=object)[term[first[:-1]]]]
    rows, by_term = len(names), np.r_[heads, len(starts), len(starts)]
    lists = lambda offsets, values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
    columns = [
        pa.array([*(bucket_of(w, buckets) for w in names), -1], pa.int32()), pa.array([*names, None], pa.string()), pa.array(np.r_[np.diff(by_term[:-1]), len(docs)], pa.int32()), pa.array(np.full(rows + 1, block), pa.int64()),
        lists(by_term, doc[starts]), lists(by_term, ends), lists(np.r_[first, len(term)], position), pa.array([None] * rows + [docs], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "term", "n", "block", "docs", "ends", "positions", "ids"])


def build_index(documents: DataFrame, terms: set[str] | None, path: str, buckets: int | None = None) -> DataFrame:
    """Writes the positional index of documents (doc_id, text) to path: postings, and the documents of each term. terms: None for all.

    Returns the postings one by one: term, doc_id, positions. buckets: of the terms, spark.sql.shuffle.partitions by default.
    """
    spark = documents.sparkSession
    wanted, count = spark.sparkContext.broadcast(terms), buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def postings(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[list[str]] = []
        docs: list[int] = []
        held, block = 0, TaskContext.get().partitionId() << 32
        for batch in it:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words(text)
                if not ws:
                    continue
                texts.append(ws)
                docs.append(doc)
                held += len(ws)
                if len(texts) == BLOCK_TEXTS or held >= BLOCK_WORDS:
                    yield inverted(texts, docs, block, wanted.value, count)
                    texts, docs, held, block = [], [], 0, block + 1
        if texts:
            yield inverted(texts, docs, block, wanted.value, count)

    rows = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(postings, POSTINGS)
    # Rebalanced, not merely hashed: a bucket with hot terms is split over several tasks.
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/postings")
    index = postings_of(spark, path)
    index.where("bucket >= 0").groupBy("bucket", "term").agg(F.sum("n").alias("n")).sortWithinPartitions("bucket", "term").write.mode("overwrite").parquet(f"{path}/terms")
    spark.createDataFrame([(count,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    return with_ids(spark, path, index.where("bucket >= 0").select("term", "block", exploded())).select("term", "doc_id", "positions")


def exploded() -> Column:
    """struct(doc, positions) of each document of a posting row."""
    start = lambda i: F.coalesce(F.get("ends", i - 1), F.lit(0))
    return F.inline(F.transform("docs", lambda d, i: F.struct(d.alias("doc"), F.slice("positions", start(i) + 1, F.get("ends", i) - start(i)).alias("positions"))))


def with_ids(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """rows (block, doc) with doc_id, from the rows of the blocks themselves."""
    return rows.join(postings_of(spark, path).where("bucket = -1").select("block", "ids"), "block").withColumn("doc_id", F.get("ids", F.col("doc"))).drop("block", "doc", "ids")


def postings_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTINGS).parquet(f"{path}/postings")


def least_of(share: float, n: int) -> int:
    """The least whole number that is ``share`` of n or more; share is taken as the decimal that it is written as."""
    return ceil(Fraction(str(share)) * n)


def probes(texts: dict[int, list[str]], df: dict[str, int], share: float = SHARE) -> list[tuple[int, str, int, int, int]]:
    """(item_id, term, offset, n, need) of the rarest positions of each item; need of them must be met."""
    out = []
    for item, ws in texts.items():
        n = len(ws)
        need = max(1, ceil(MET * n))
        lacking = n - least_of(share, n)
        k = min(n, lacking + need)
        need = k - lacking
        rarest = sorted(range(n), key=lambda i: (df.get(ws[i], 0), ws[i], i))[:k]
        out += [(item, ws[i], i, n, need) for i in rarest]
    return out


def longest_in_order(item: list[str], hits: list[tuple[int, str]], span: int, least: int = 1) -> tuple[int, int, int]:
    """(words of the item met in order, first, last position) of the best window of ``span`` positions that meets ``least`` or more; bit-parallel.

    A window is looked into only if the item's words in it, in any order, are enough for more than the best so far.
    """
    at: dict[str, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    many = {w: bits.bit_count() for w, bits in at.items()}
    full, best, end, met = (1 << len(item)) - 1, (0, -1, -1), 0, 0
    held: dict[str, int] = {}
    for a, (start, first) in enumerate(hits):
        while end < len(hits) and hits[end][0] < start + span:
            w = hits[end][1]
            held[w] = held.get(w, 0) + 1
            met += held[w] <= many[w]
            end += 1
        if met >= least and met > best[0]:
            row, last = full, start
            for pos, w in hits[a:end]:
                u = row & at[w]
                new = ((row + u) | (row - u)) & full
                if new != row:
                    last, row = pos, new
            found = len(item) - row.bit_count()
            if found >= least and found > best[0]:
                best = (found, start, last)
        met -= held[first] <= many[first]
        held[first] -= 1
    return best


def leaked_spans(documents: DataFrame, items: DataFrame, share: float = SHARE, span: float = SPAN, index: str | None = None) -> DataFrame:
    """doc_id, item_id, matched, words, share, first_word, last_word, kind (phrase or proximity): the best place of each item in each document that holds at least ``share`` of its words in order within ``span`` times its length.

    index: the path of an index of the documents that build_index() wrote, which is then searched as it is; else one is built.
    Null, empty and wordless texts hold and are nothing; different texts of one doc_id stay apart, the best of them counts;
    other columns are ignored. Words compare as in words.fold. One row per document and item.
    """
    spark = documents.sparkSession
    if index is None:
        index = scratch(spark, "index")
        build_index(documents, None, index)
    found = None
    for part in item_parts(items):
        own = search(spark, index, part, share, span)
        found = own if found is None else found.unionByName(own)
    return spark.createDataFrame([], SPAN_COLUMNS) if found is None else found


def search(spark: SparkSession, path: str, texts: dict[int, list[str]], share: float = SHARE, span: float = SPAN) -> DataFrame:
    """The spans of the items (item_id: words) in the index at path."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    terms = sorted({w for ws in texts.values() for w in ws})
    frame = lambda columns, schema: spark.createDataFrame(pd.DataFrame(columns), schema)
    placed = lambda ws: {"bucket": [bucket_of(w, buckets) for w in ws], "term": ws}
    bounded = lambda d, n: F.broadcast(d) if n <= BROADCAST_TERMS else d
    held = bounded(frame(placed(terms), "bucket int, term string"), len(terms))
    at = [*{bucket_of(w, buckets) for w in terms}]  # the partitions that are read
    counts = spark.read.parquet(f"{path}/terms").where(F.col("bucket").isin(at)).join(held, ["bucket", "term"], "left_semi")
    df = {r["term"]: r["n"] for r in counts.select("term", "n").toLocalIterator()}  # at most the items' terms
    offsets: dict[tuple[int, str], list[int]] = {}
    size: dict[int, tuple[int, int]] = {}
    for item, term, offset, n, need in probes(texts, df, share):
        if term in df:
            offsets.setdefault((item, term), []).append(offset)
        size[item] = (n, need)
    sought = {**placed([t for _, t in offsets]), "item_id": [i for i, _ in offsets], "n": [size[i][0] for i, _ in offsets], "need": [size[i][1] for i, _ in offsets], "offsets": [*offsets.values()]}
    if not offsets:
        return spark.createDataFrame([], SPAN_COLUMNS)
    probe = bounded(frame(sought, "bucket int, term string, item_id bigint, n int, need int, offsets array<int>"), len(offsets))
    postings = postings_of(spark, path).drop("n")
    rare = postings.where(F.col("bucket").isin([*{*sought["bucket"]}])).join(probe, ["bucket", "term"])
    text = ["block", "doc"]  # a doc_id that comes with different texts is two texts
    met = rare.select("item_id", "need", F.size("offsets").alias("own"), "block", F.explode("docs").alias("doc")).groupBy(*text, "item_id").agg(F.sum("own").alias("met"), F.first("need").alias("need")).where("met >= need")
    likely = cut(met.select(*text, "item_id"))
    # The lists of those documents, adjusted by the item's offsets: places that differ by less than n meet in one of two windows.
    near = rare.select("item_id", "n", "need", "offsets", "block", exploded()).join(small_side(likely, rows=200_000), [*text, "item_id"], "left_semi")
    window = lambda p, o: F.floor((p - o) / F.col("n"))
    windows = F.array_distinct(F.flatten(F.transform("positions", lambda p: F.flatten(F.transform("offsets", lambda o: F.array(F.struct(window(p, o).alias("k"), o.alias("o")), F.struct((window(p, o) - 1).alias("k"), o.alias("o"))))))))
    lined = near.select(*text, "item_id", "need", F.explode(windows).alias("w")).groupBy(*text, "item_id", "w.k").agg(F.count("*").alias("met"), F.first("need").alias("need")).where("met >= need")
    aligned = cut(lined.groupBy(*text).agg(F.array_sort(F.collect_set("item_id")).alias("items")))  # bounded by the items
    lists = postings.where(F.col("bucket").isin(at)).join(held, ["bucket", "term"], "left_semi").select("term", "block", exploded()).join(small_side(aligned.select(*text), rows=200_000), text, "left_semi")
    lists = lists.groupBy(*text).agg(F.collect_list(F.struct("term", "positions")).alias("lists"))  # bounded by one text's words
    known = spark.sparkContext.broadcast(texts)

    def verified(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = known.value
        for batch in it:
            out = []
            for doc, items, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                where: dict[str, set[int]] = {}
                for x in parts:
                    where.setdefault(x["term"], set()).update(x["positions"])
                for item in items:
                    ws = words_of[item]
                    hits = sorted((p, w) for w in {*ws} for p in where.get(w, ()))
                    matched, first, last = longest_in_order(ws, hits, ceil(span * len(ws)), least_of(share, len(ws)))
                    if matched:
                        exact = matched == len(ws) == last - first + 1
                        out.append((doc, item, matched, len(ws), round(matched / len(ws), 4), first, last, "phrase" if exact else "proximity"))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=SPANS.names), schema=SPANS, preserve_index=False)

    spans = with_ids(spark, path, aligned.join(lists, text)).select("doc_id", "items", "lists").mapInArrow(verified, SPAN_COLUMNS)
    rest = [c for c in spans.columns if c not in ("doc_id", "item_id")]
    return spans.groupBy("doc_id", "item_id").agg(F.max_by(F.struct(*rest), F.struct("matched", -F.col("first_word"))).alias("s")).select("doc_id", "item_id", "s.*")


SPAN_COLUMNS = "doc_id bigint, item_id bigint, matched int, words int, share double, first_word int, last_word int, kind string"
SPANS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched", pa.int32()), ("words", pa.int32()), ("share", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32()), ("kind", pa.string())])


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id of every leak."""
    return leaked_spans(documents, items).select("doc_id", "item_id")
