"""Trend keywords, record scores and BM25 retrieval.

Token lists are unnested by explode_outer: from a plain explode Spark infers a filter that computes the list once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.config import Trend, Vocabulary
from gristmill.functions.text import any_of
from gristmill.operators.overlaps import read_table
from gristmill.sources.shared import shared_folder


def trend_keywords(df: DataFrame, tokens: Column, words: Vocabulary, trend: Trend | None = None) -> DataFrame:
    """(token, df, weight): the keywords that most records hold, domain words doubled; ties go by token."""
    t = trend or Trend()
    total = df.select(F.count(F.lit(1)).alias("total"))
    often = df.select("id", F.explode_outer(F.array_distinct(tokens)).alias("token")).where("token is not null").groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= t.least_documents)
    domain = F.col("token").rlike(any_of(words.core + words.generic))
    weight = F.col("df") / F.col("total") * F.when(domain, t.domain_weight).otherwise(1.0)
    return often.join(F.broadcast(total)).select("token", "df", weight.alias("weight")).orderBy(F.desc("weight"), "token").limit(t.keywords)


def record_scores(df: DataFrame, title_tokens: Column, body_tokens: Column, weights: DataFrame, trend: Trend | None = None) -> DataFrame:
    """(id, score, matched): each keyword of the record counts its weight, more if it is in the title. weights is short by its limit."""
    t = trend or Trend()
    short = weights.select("token", "weight").limit(t.keywords)  # as many as there are keywords, so every task can have them
    known = short.agg(F.collect_list("token").alias("_known"))
    # both arrays are cut down to the keywords first, by hash, so that a record of any length makes as many rows at most
    in_title, in_both = F.array_intersect(title_tokens, F.col("_known")), F.array_intersect(F.array_union(title_tokens, body_tokens), F.col("_known"))
    both = df.join(F.broadcast(known)).select("id", in_title.alias("_t"), in_both.alias("_b")).select("id", F.explode_outer("_b").alias("token"), "_t").where("token is not null")
    both = both.withColumn("titled", F.array_contains("_t", F.col("token"))).drop("_t")
    gain = both.join(F.broadcast(short), "token").withColumn("gain", F.col("weight") * F.when(F.col("titled"), t.title_bonus).otherwise(1.0))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("gain")).alias("g"), "token"))), lambda x: x["token"])
    return gain.groupBy("id").agg(F.sum("gain").alias("score"), ordered.alias("matched"))


#: Documents that are counted at once, and scores that a task holds at once.
ROWS, CELLS = 2048, 1 << 21


def bm25(documents: DataFrame, queries: DataFrame, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(query_id, rank, id, score): the k best documents for each query, ties to smaller ids.

    documents: (id, tokens); queries: (query_id, tokens). A document becomes one row of the query terms that it holds, written once;
    no row is made for a posting or for a query and a document. A task gives the best k of its documents for each query.
    """
    spark, id_type, query_type = documents.sparkSession, documents.schema["id"].dataType, queries.schema["query_id"].dataType
    asked, told, weights = shared_folder(spark, "asked"), shared_folder(spark, "told"), shared_folder(spark, "weights")
    queries.select("query_id", F.explode(F.array_distinct("tokens")).alias("term")).where("term is not null").write.parquet(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _terms(read_table(asked))
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                yield _held(batch.slice(first, ROWS), terms)

    schema = T.StructType([T.StructField("id", id_type), T.StructField("length", T.IntegerType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType()))])
    documents.select("id", "tokens").mapInArrow(count, schema).write.parquet(told)
    rows = spark.read.schema(schema).parquet(told)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    rows = rows.where(F.size("terms") > 0)
    once = rows.groupBy("id").count().where("count > 1").isEmpty()
    if not once:  # rows of one id and length count as one document, as its terms add up
        each = rows.select("id", "length", F.explode(F.arrays_zip("terms", "tf")).alias("x")).groupBy("id", "length", F.col("x.terms").alias("term")).agg(F.sum("x.tf").alias("tf"))
        rows = each.groupBy("id", "length").agg(F.collect_list(F.struct("term", "tf")).alias("x")).select("id", "length", F.col("x.term").alias("terms"), F.col("x.tf").alias("tf"))
    often = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    often.join(F.broadcast(stats)).select("term", idf.alias("idf")).write.parquet(weights)
    part = F.struct("length", "terms", "tf")
    parts = rows.select("id", F.array(part).alias("parts")) if once else rows.groupBy("id").agg(F.collect_list(part).alias("parts"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Asked(read_table(asked), read_table(weights))
        for batch in batches:
            yield from wanted.best(batch, k, k1, b)

    found = parts.join(F.broadcast(stats.select("mean"))).mapInArrow(best, T.StructType([T.StructField("query_id", query_type), T.StructField("id", id_type), T.StructField("points", T.LongType())]))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("points"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "id", (F.col("points") / 10_000).alias("score"))


def _terms(asked: pa.Table) -> pa.Array:
    """The distinct terms in order: a term's place is its number in all tasks."""
    terms = asked["term"].combine_chunks().unique()
    return terms.take(pc.sort_indices(terms))


def _held(batch: pa.RecordBatch, terms: pa.Array) -> pa.RecordBatch:
    """(id, length, terms, tf) of (id, tokens): how often each document holds each of the terms, by number."""
    tokens, n, m = batch.column("tokens"), batch.num_rows, max(1, len(terms))
    length = pc.list_value_length(tokens)
    flat = tokens.flatten()
    at = pc.index_in(flat, value_set=terms.cast(flat.type))
    row = np.repeat(np.arange(n), length.fill_null(0).to_numpy(zero_copy_only=False))
    known = at.is_valid().to_numpy(zero_copy_only=False)
    cell, tf = np.unique(row[known] * m + at.drop_null().to_numpy(), return_counts=True)
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(cell // m, minlength=n))].astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((cell % m).astype(np.int32), tf.astype(np.int64))]
    return pa.RecordBatch.from_arrays([batch.column("id"), length.cast(pa.int32()), *lists], names=["id", "length", "terms", "tf"])


class _Asked:
    """The queries of each term, by the term's number, and its weight."""

    def __init__(self, asked: pa.Table, weights: pa.Table) -> None:
        terms, ids = _terms(asked), asked["query_id"].combine_chunks().dictionary_encode("encode")
        term = pc.index_in(asked["term"].combine_chunks(), value_set=terms).to_numpy(zero_copy_only=False).astype(np.int64)
        query = ids.indices.to_numpy().astype(np.int64)
        order = np.lexsort((query, term))
        self.ids, self.term, self.query, self.idf = ids.dictionary, term[order], query[order], np.zeros(len(terms))
        self.idf[weights["term"].to_numpy()] = weights["idf"].to_numpy()

    def best(self, batch: pa.RecordBatch, k: int, k1: float, b: float) -> Iterator[pa.RecordBatch]:
        """(query_id, id, points) of the k best documents of a batch (id, parts, mean); points are rounded scores times 10,000."""
        batch = batch.take(pc.sort_indices(batch.column("id"), null_placement="at_start"))
        parts, n = batch.column("parts"), batch.num_rows
        length, terms, tf = parts.flatten().flatten()
        sizes = pc.list_value_length(terms).to_numpy()
        row = np.repeat(np.repeat(np.arange(n), pc.list_value_length(parts).to_numpy()), sizes)
        code, tf = terms.flatten().to_numpy(), tf.flatten().to_numpy()
        share = b * np.repeat(length.to_numpy(), sizes) / batch.column("mean").to_numpy()[row]
        gain = self.idf[code] * tf * (k1 + 1) / (tf + k1 * (1 - b + share))
        ends, step = np.searchsorted(row, np.arange(n), "right"), max(1, CELLS // max(1, n))
        for low in range(0, len(self.ids) if n else 0, step):
            width = min(step, len(self.ids) - low)
            mine = (self.query >= low) & (self.query < low + width)
            query, often = self.query[mine] - low, np.bincount(self.term[mine], minlength=len(self.idf))
            start, met = np.cumsum(often) - often, often[code]
            upto = np.r_[0, np.cumsum(met)]
            score, first = np.zeros((width, n)), 0
            while first < n:  # so many documents that the terms met stay few
                done = ends[first - 1] if first else 0
                last = min(n, max(first + 1, int(np.searchsorted(upto[ends], upto[done] + CELLS, "right"))))
                these = slice(done, ends[last - 1])
                m, total = met[these], int(upto[ends[last - 1]] - upto[done])
                where = np.arange(total) + np.repeat(start[code[these]] - (upto[these] - upto[done]), m)
                cells = query[where] * (last - first) + np.repeat(row[these] - first, m)
                score[:, first:last] = np.bincount(cells, np.repeat(gain[these], m), width * (last - first)).reshape(width, last - first)
                first = last
            points = np.where(score > 0, np.floor(score * 10_000 + 0.5), -1).astype(np.int64)
            rank = points * n + np.arange(n - 1, -1, -1)  # of equal points the smaller id is higher
            top = np.argpartition(rank, n - k, axis=1)[:, n - k :] if n > k else np.tile(np.arange(n), (width, 1))
            won = np.take_along_axis(points, top, 1)
            q, j = np.nonzero(won >= 0)
            yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(q + low)), batch.column("id").take(pa.array(top[q, j])), pa.array(won[q, j])], names=["query_id", "id", "points"])
