"""Prefix doubling in its plain form: a row for every byte, as a yardstick for suffix_dedup.py and its tests.

Ranks of prefixes of k bytes become ranks of up to 2 k: Spark pairs the rank of each position with that k further on, sorts
the distinct pairs and numbers them in order. A position whose prefix occurs in one document only drops out, and with it
every position whose longer prefix would hold it. The rounds end at `length` bytes, or when nothing is left. Every round
shuffles every position that is left twice, so this moves many times the input (figures in the README).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.llm.common import materialize


def positions(docs: DataFrame) -> DataFrame:
    """(doc, at, rank): every byte of (doc_id, text), ranked by its value."""

    def run(batches):
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                b = np.frombuffer((text or "").encode(), dtype=np.uint8)
                for begin in range(0, len(b), 100_000):
                    part = b[begin : begin + 100_000]
                    yield pd.DataFrame({"doc": doc, "at": np.arange(begin, begin + len(part)), "rank": part.astype(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc long, at long, rank long")


def repeated_positions(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc, at) of the positions whose `length` bytes also start in a document with a smaller id; ids are not null."""
    rows, size = materialize(positions(docs), "bytes"), 1
    while size < length:
        step = min(size, length - size)
        w = W.partitionBy("doc").orderBy("at").rangeBetween(step, step)
        pairs = rows.select("doc", "at", "rank", F.max("rank").over(w).alias("next")).filter("next IS NOT NULL")
        pairs = materialize(pairs, "pairs")
        shared = pairs.groupBy("rank", "next").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most")
        ranked = materialize(shared.orderBy("rank", "next").withColumn("new", F.monotonically_increasing_id()), "ranks")
        rows = materialize(pairs.join(ranked, ["rank", "next"]).select("doc", "at", F.col("new").alias("rank"), "least"), "ranked")
        size += step
    return rows.filter("doc > least").select("doc", "at")
