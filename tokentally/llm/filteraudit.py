"""Filter interaction audit: what five filters remove in each of their 120 orders.

One pass tests four filters on each whole text and names the text by its SHA-256; the
fifth compares a document with the smallest id of equal texts. All that the audit needs of
a document is the set of filters that it fails, so documents are counted in cells: part,
failed set, and how many of them are good or toxic. Equal texts are counted before they
are brought together, so a text of very many copies is a few rows.

Then higher-order SQL functions fold each cell across the array of all orders: a cell is
removed at the first filter of an order that it fails. That gives 600 structs (order and
step) weighted by the cell's counts, and the cells of a part are merged by sums of each
element.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokentally.llm.common import blocks, settle, ship_code, text_bytes

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: Filter A, B and C: least words, least percent of distinct words, most percent of basic capitals.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = re.compile(rb"[#$%&*|]")


def failed(data: bytes, characters: int) -> int:
    """Which of A to D a text fails, a bit each (A is the lowest)."""
    words, distinct = 0, set()
    for block in blocks(data):
        found = block.split()  # bytes.split knows the six characters of the rule and no other
        words += len(found)
        distinct.update(found)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    tests = (
        words < MIN_WORDS,
        100 * len(distinct) < DISTINCT_PERCENT * words,
        100 * capitals > CAPITAL_PERCENT * characters,
        _MARKS.search(data) is not None,
    )
    return sum(bit << i for i, bit in enumerate(tests))


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_pylist()
        found = [(failed(t, n), hashlib.sha256(t).digest()) for n, t in zip(sizes, text_bytes(batch.column(2)))]
        masks, names = pa.array([m for m, _ in found], pa.int32()), pa.array([c for _, c in found], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], masks, names], names=["doc_id", "part", "mask", "content"])


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``[part, mask, n, good, toxic]``: documents of each part by the set of filters they fail.

    ``mask`` has a bit for each filter, A the lowest. E fails for a document whose text
    a smaller ``doc_id`` has; a null id is no smaller one and fails nothing.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(_tested, "doc_id bigint, part string, mask int, content binary")
    text = ["content", "part", "mask"]
    rows = rows.groupBy("doc_id", *text).agg(F.count(F.lit(1)).alias("n"))  # repeated rows
    marks = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.expr("int(quality = 1)").alias("q"), F.expr("int(toxic = 1)").alias("t")
    )
    marks = marks.groupBy("doc_id").agg(F.max("q").alias("q"), F.max("t").alias("t")).where("q = 1 or t = 1")
    rows = rows.join(marks, "doc_id", "left").na.fill(0, ["q", "t"])
    alike = rows.groupBy(*text, "q", "t").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("at_least"),
        F.coalesce(F.sum(F.expr("if(doc_id is null, n, 0)")), F.lit(0)).alias("no_id"),
    )
    of_text = Window.partitionBy("content")  # a row for each part and pair of labels that have this text
    first = F.when(F.col("least") == F.min("least").over(of_text), F.col("at_least")).otherwise(0)
    alike = alike.withColumn("first", first + F.col("no_id"))
    split = F.inline(F.expr("array(named_struct('mask', mask, 'n', first), named_struct('mask', mask + 16, 'n', n - first))"))
    weighed = alike.select("part", "q", "t", split).where("n > 0")
    total = weighed.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("q")).alias("good"), F.sum(F.col("n") * F.col("t")).alias("toxic")
    )
    return settle(total, "cells")


#: Every order as the numbers of its filters.
_ORDER_ARRAY = "array({})".format(", ".join("array({})".format(", ".join(str(FILTERS.index(f)) for f in o)) for o in ORDERS))
_STEP = (
    "named_struct('kept', if(gone or fails, 0L, n), 'removed', if(fails and not gone, n, 0L), 'redundant', if(fails and gone, n, 0L), "
    "'unique_fails', if(mask = shiftleft(1, f), n, 0L), 'good_lost', if(fails and not gone, good, 0L), "
    "'toxic_lost', if(fails and not gone, toxic, 0L))"
)
_STEP = _STEP.replace("fails", "(mask & shiftleft(1, f)) <> 0").replace("unique_(mask & shiftleft(1, f)) <> 0", "unique_fails")
_SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: 600 structs of a cell: a fold over each order that carries whether an earlier filter removed it.
FOLD = (
    f"flatten(transform({_ORDER_ARRAY}, o -> aggregate(o, "
    f"named_struct('gone', false, 'steps', cast(array() as array<struct<{', '.join(f'{c}: bigint' for c in _SUMS)}>>)), "
    "(a, f) -> named_struct('gone', a.gone or (mask & shiftleft(1, f)) <> 0, "
    f"'steps', array_append(a.steps, {_STEP.replace('gone', 'a.gone')})), a -> a.steps)))"
)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each step of each order of the filters does, for each part (``lang``) of ``docs``.

    ``[part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley]``, 600 rows for each part: documents left after the step, removed by it, failing its filter
    but removed earlier, failing its filter only, removed with ``labels.quality`` or ``.toxic``
    of 1, and removed by its filter over all orders, at any step.

    A null text is empty, a null ``lang`` the part of the empty string. Repeated rows count as
    often as they come; equal ids with equal texts are no copies of each other, a null id is never a
    copy. A document whose label rows differ counts as good, and as toxic, if one row says so. Other
    columns are ignored; an empty table has no part and gives an empty result.
    """
    folded = cells(docs, labels).select("part", F.posexplode(F.expr(FOLD)).alias("place", "s"))
    sums = folded.groupBy("part", "place").agg(*[F.sum(f"s.{c}").alias(c) for c in _SUMS])
    order = F.element_at(F.lit(ORDERS), F.expr("place div 5 + 1").cast("int"))
    rows = sums.select("part", order.alias("filter_order"), F.expr("place % 5 + 1").cast("int").alias("step"), *_SUMS)
    of_filter = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))  # 120 rows
    return rows.withColumn("shapley", F.sum("removed").over(of_filter))
