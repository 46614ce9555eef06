"""Ranked lexical search over term-partitioned postings that are visited one after the other.

Terms belong to owners by how many documents hold them: the first owner has the rarest
terms, the last the commonest. Items are bundled; a bundle carries sparse accumulators
(document, score so far) through the owners in turn, and at each owner a cogroup with its
postings adds the integer contributions of the bundle's terms. Documents are dealt to
blocks by a hash, so a bundle travels once for each block, and neither a term that every
document holds nor a large group of copies comes to one task.

Nothing is left out to save work but what can't be among an item's best: an accumulator
whose score and all contributions still to come lie below the score that the block's k-th
best already has, and, in the same way, new accumulators once the terms still to come
can't reach that score. Contributions to come are bounded by the term's largest one over
all documents. The k best of each block meet in the final selection.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready, written
from adtally.llm.words import lowered, pieces

K = 10
#: Documents a block and items a bundle, on average.
BLOCK_DOCS = 4096
BUNDLE_ITEMS = 256
#: An owner has the terms that at most so large a share of the documents holds.
OWNER_SHARES = (1 / 256, 1 / 32, 1 / 8, 1)
#: Terms of documents pass a table of so many marks, set for the items' terms.
MARKS = 1 << 19

_BAGS = "id long, row long, n long, bag array<struct<term:string,tf:long>>"
_STATE = (
    "bundle long, block long, item array<long>, term array<long>, owner array<int>, peak array<long>, "
    "acc_item array<long>, acc_row array<long>, acc_doc array<long>, acc_score array<long>"
)
_FOUND = "item long, row long, doc long, score long"


def bags(rows: DataFrame, id_col: str, text_col: str, marks: bytes | None = None) -> DataFrame:
    """``id, row, n, bag`` for each row: a number of its own, its terms with repeats, and counts by term.

    With ``marks``, terms without a mark are left out of the bag (never out of ``n``). Rows
    are numbered as they are written, so read the result back before it is used.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
        for batch in batches:
            numbers, sizes, ends, terms, tfs = [], [], [0], [], []
            for text in batch.column(1).to_pylist():
                counts = Counter()
                for part, _ in pieces(lowered(text)):
                    counts.update(part.split())
                sizes.append(counts.total())
                kept = counts if marks is None else [t for t in counts if marks[zlib.crc32(t) % MARKS]]
                terms.extend(kept)
                tfs.extend(counts[t] for t in kept)
                ends.append(len(terms))
                numbers.append(row)
                row += 1
            inner = pa.StructArray.from_arrays([pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64())], ["term", "tf"])
            bag = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner).cast(kind)
            arrays = [batch.column(0).cast(pa.int64()), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), bag]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "row", "n", "bag"])

    python_ready(rows)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(counted, _BAGS)


def marks_of(items: DataFrame) -> bytes:
    """One mark for each slot that a term of the items falls into: MARKS bytes, however many terms."""
    slots = items.select(F.explode("bag.term").alias("t")).select((F.crc32(F.col("t").cast("binary")) % MARKS).alias("s"))
    out = bytearray(MARKS)
    for r in slots.distinct().collect():
        out[r.s] = 1
    return bytes(out)


def _arrays(table: pa.Table, name: str) -> np.ndarray:
    """The values of an array column's one row."""
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _add(state: dict, postings: tuple, owner: int, k: int) -> tuple[np.ndarray, ...]:
    """The accumulators of a bundle in one block after ``owner`` has added its contributions."""
    term, row, doc, share = postings
    rows, place = np.unique(np.concatenate([row, state["acc_row"]]), return_inverse=True)
    docs = np.zeros(len(rows), np.int64)
    docs[place] = np.concatenate([doc, state["acc_doc"]])
    at, held = place[: len(row)], place[len(row) :]
    order = np.argsort(term, kind="stable")
    term, at, share = term[order], at[order], share[order]
    out = []
    for item in np.unique(state["item"]):
        mine = state["item"] == item
        own, late = mine & (state["owner"] == owner), mine & (state["owner"] > owner)
        acc = state["acc_item"] == item
        score = np.zeros(len(rows), np.int64)
        score[held[acc]] = state["acc_score"][acc]
        before = state["acc_score"][acc]
        bar = np.partition(before, -k)[-k] if len(before) >= k else 0
        terms = state["term"][own]
        lo, hi = np.searchsorted(term, terms, "left"), np.searchsorted(term, terms, "right")
        for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
            score[at[a:b]] += share[a:b]  # a document holds a term once
        if state["peak"][own].sum() + state["peak"][late].sum() < bar:
            # nothing new can reach the k-th best: only what is carried goes on
            new = np.zeros(len(rows), np.int64)
            new[held[acc]] = score[held[acc]]
            score = new
        kept = np.flatnonzero(score > 0)
        if len(kept) > k:
            bar = np.partition(score[kept], -k)[-k]
            kept = kept[score[kept] + state["peak"][late].sum() >= bar]
        out.append((np.full(len(kept), item), rows[kept], docs[kept], score[kept]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_PLAN, _ACC = ("item", "term", "owner", "peak"), ("acc_item", "acc_row", "acc_doc", "acc_score")


def _visit(owner: int, k: int, last: bool):
    """The cogrouped step at one owner; the last one gives the k best of its block for each item."""

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        state = {c: _arrays(left, c) for c in (*_PLAN, *_ACC)}
        postings = tuple(right.column(c).to_numpy() for c in ("term", "row", "doc", "share"))
        item, row, doc, score = _add(state, postings, owner, k)
        if not last:
            lists = [left.column(c) for c in ("bundle", "block", *_PLAN)]
            lists += [pa.array([x], pa.list_(pa.int64())) for x in (item, row, doc, score)]
            return pa.Table.from_arrays(lists, ["bundle", "block", *_PLAN, *_ACC])
        order = np.lexsort((row, doc, -score, item))
        item, row, doc, score = (x[order] for x in (item, row, doc, score))
        begin = np.r_[True, item[1:] != item[:-1]] if len(item) else np.zeros(0, bool)
        nth = np.arange(len(item)) - np.maximum.accumulate(np.where(begin, np.arange(len(item)), 0))
        best = nth < k
        return pa.table({"item": item[best], "row": row[best], "doc": doc[best], "score": score[best]})

    return step


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_docs: int = BLOCK_DOCS, bundle_items: int = BUNDLE_ITEMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row of ``items``.

    Ids are whole numbers. Equal scores go to the smaller id, a null id last. Each row is a
    document or an item of its own, also where ids or texts repeat. Null and empty texts
    have no terms: such documents are never found, such items find nothing, and so it is
    with empty tables. Other columns are ignored.
    """  # noqa: D205
    spark = docs.sparkSession
    asked = written(bags(items, item_col, item_text_col), "items")
    held = written(bags(docs, id_col, text_col, marks_of(asked)), "bags")
    some = held.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    n_docs, n_words, n_items = some[0], some[1], asked.count()
    if not n_docs or not n_items:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    length = 10 + F.expr(f"(90 * n * {n_docs}L) div {n_words}L")
    each = held.select("row", F.coalesce("id", F.lit((1 << 63) - 1)).alias("doc"), length.alias("m"), F.explode("bag").alias("b"))
    each = each.select("row", "doc", "b.term", F.expr("(1000000000L * b.tf) div (1000 * b.tf + 8 * m)").alias("q"))

    wanted = asked.select(F.col("row").alias("item"), F.explode("bag.term").alias("term"))
    known = each.groupBy("term").agg(F.count("*").alias("df"), F.max("q").alias("top"))
    known = wanted.select("term").distinct().join(known, "term")
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner = sum(F.when(F.col("df") > F.lit(s) * F.lit(n_docs), 1).otherwise(0) for s in OWNER_SHARES[:-1])
    known = known.select("term", owner.alias("owner"), weight.alias("w"), (weight * F.col("top")).alias("peak"))
    known = written(known.withColumn("term_id", F.monotonically_increasing_id()), "terms")

    bundles = -(-n_items // bundle_items)
    routes = wanted.join(known, "term").withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)))
    users = routes.select("bundle", "term", "term_id", "owner", "w").distinct()
    blocks = -(-n_docs // block_docs)
    postings = each.join(users, "term").select(
        "bundle", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.col("term_id").alias("term"),
        "row", "doc", (F.col("w") * F.col("q")).alias("share"), "owner",
    )
    postings = written(postings, "postings")

    plan = F.sort_array(F.collect_list(F.struct("item", "owner", "term_id", "peak")))
    plans = routes.groupBy("bundle").agg(plan.alias("p"))
    empty = F.array().cast("array<long>")
    state = plans.select(
        "bundle", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.col("p.item").alias("item"), F.col("p.term_id").alias("term"), F.col("p.owner").alias("owner"), F.col("p.peak").alias("peak"),
        *[empty.alias(c) for c in _ACC],
    )
    for at in range(len(OWNER_SHARES)):
        last = at == len(OWNER_SHARES) - 1
        own = postings.filter(F.col("owner") == at).select("bundle", "block", "term", "row", "doc", "share")
        both = state.groupBy("bundle", "block").cogroup(own.groupBy("bundle", "block"))
        state = both.applyInArrow(_visit(at, k, last), _FOUND if last else _STATE)
        if not last:
            state = written(state, "bundles")

    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc", "row")
    best = state.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ids = asked.select(F.col("row").alias("item"), F.col("id").alias("item_id"))
    no_id = F.col("doc") == (1 << 63) - 1
    return best.join(ids, "item").select("item_id", "rank", F.when(~no_id, F.col("doc")).alias("doc_id"), "score")
