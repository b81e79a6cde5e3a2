import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from rollbook.llm.common import fingerprint_filter, fold, per_row, unused, word_bounds, word_prints, written


def test_filter_never_loses_a_key(spark):
    keys = spark.range(0, 5000, 7).select(F.col("id").cast("string").cast("binary").alias("key"))
    test = fingerprint_filter(keys, F.col("key"), bits=14)
    rows = spark.range(5000).select("id", test(F.col("id").cast("string").cast("binary")).alias("maybe")).collect()
    assert all(r.maybe for r in rows if r.id % 7 == 0)
    assert sum(r.maybe for r in rows if r.id % 7) < 600  # 715 of 16,384 bits
    assert not any(r[0] for r in spark.range(50).select(fingerprint_filter(keys.limit(0), F.col("key"))(F.lit(b"x"))).collect())


def test_filter_is_not_spelt_out_in_plans(spark):
    keys = spark.range(100).select(F.col("id").cast("string").cast("binary").alias("key"))
    rows = spark.range(300).select(F.col("id").cast("string").cast("binary").alias("key"))
    test = fingerprint_filter(keys, F.col("key"))
    left = rows.where(~test(F.col("key"))).unionByName(rows.where(test(F.col("key"))).join(keys, "key", "left_anti"))
    assert left.count() == 200
    assert len(left._jdf.queryExecution().toString()) < 50_000  # a map of 262,144 bytes is twice that in hexadecimal digits


def test_folds(spark):
    rows = spark.createDataFrame([(i,) for i in [None, *range(200)]], "doc_id long").select("doc_id", fold(F.col("doc_id")))
    assert all(f == (-1 if i is None else zlib.crc32(str(i).encode()) % 5) for i, f in rows.collect())


def test_words_and_their_fingerprints():
    raw = "a  bc\tä\x0bbc \x1c x\n\n" .encode()
    starts, ends = word_bounds(np.frombuffer(raw, np.uint8))
    words = [raw[a:b] for a, b in zip(starts, ends)]
    assert words == re.findall(rb"[^\x20\x09-\x0D]+", raw)
    prints = word_prints(np.frombuffer(raw, np.uint8), starts, ends)
    assert prints[1] == prints[3] and len(set(prints.tolist())) == len(set(words))
    assert len(word_prints(np.zeros(0, np.uint8), *word_bounds(np.zeros(0, np.uint8)))) == 0
    many = b" ".join(str(i).encode() for i in range(200_000))
    codes = np.frombuffer(many, np.uint8)
    assert len(np.unique(word_prints(codes, *word_bounds(codes)))) == 200_000


def test_rows_keep_columns_of_any_name(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, "é", "y")], "`doc id` long, text string, `a.b` string")
    rows = per_row(frame, "n long", ["doc id", "a.b"], "text", lambda raw: (len(raw),)).collect()
    assert sorted(map(tuple, rows)) == [(1, "x", 0), (2, "y", 2)]
    assert unused("Score", ["score", "SCORE_"]) == "Score__"
    assert written(frame, "odd").count() == 2


def test_a_kept_text_is_sent_once(spark):
    """Beside itself it would take twice the memory of a worker's batches."""
    frame = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    out = per_row(frame, "n long", ["doc_id", "text"], "text", lambda x: (len(x),))
    assert sorted(map(tuple, out.collect())) == [(1, "a b", 3), (2, None, 0), (3, "", 0)]
    mapped = out._jdf.queryExecution().analyzed().toString()
    assert mapped.count("AS text#") == 1  # the kept column's own name, at the end
    numbers = frame.selectExpr("doc_id", "doc_id * 10 as text")
    out = per_row(numbers, "n long", ["text"], "text", lambda x: (len(x),))
    assert sorted(map(tuple, out.collect())) == [(10, 2), (20, 2), (30, 2)] and dict(out.dtypes)["text"] == "bigint"
