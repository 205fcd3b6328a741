import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from lectern.functions import speech, tex
from lectern.functions.arrays import AT_ONCE, mapped


def test_mapped_holds_few_texts():
    c = pa.array([None if i % 7 == 0 else "é" * 10_000 for i in range(20 * AT_ONCE + 3)])
    want = pa.array([None if s is None else s[1:] for s in c.to_pylist()])
    tracemalloc.start()
    got = mapped(c, lambda s: s[1:])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.equals(want) and most < c.nbytes / 4  # all of it at once are 40 MB
    assert mapped(c.slice(0, 0), str.upper).equals(pa.array([], pa.string()))


def test_text_functions_take_columns_as_they_lie(spark):
    """No column of Python strings for a whole batch: what pandas functions get."""
    rows = spark.createDataFrame([(0, r"\textit{a} b (see fig. 2)"), (1, None), (2, "")], "i long, t string")
    out = rows.select("i", tex.tex_text(F.col("t"), tex.RUNNING).alias("a"), speech.spoken("t").alias("b"))
    assert tex._udf(tex.RUNNING).evalType != F.pandas_udf(lambda x: x, "string").evalType != speech.spoken.evalType
    assert [tuple(r) for r in out.sort("i").collect()] == [(0, "a b (see fig. 2)", speech.spoken_text(rows.first().t)), (1, None, None), (2, "", "")]
