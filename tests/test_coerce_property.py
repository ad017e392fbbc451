"""Randomized: text coercion equals Python's float() / int(float()) acceptance and values."""

import math
import random

from pyspark.sql import functions as F

from vigil.functions import columns as X

ALPHABET = "0123456789" * 3 + "._eE+- \t" + "infINFaAtyY" + "_"
SPECIALS = ["nan", "+nan", "-NaN", "inf", "+inf", "-Infinity", "infinity", " +1_0.5e-1_0 ", "1__0", "_1", "1_",
            "1e", ".", "-.5", "5.", "1e+5", "0x10", "1.0d", "١", "", "   "]


def py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def py_int(s):
    try:
        return int(float(s))
    except (ValueError, OverflowError):
        return None


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


def samples(n=3000, seed=7):
    rnd = random.Random(seed)
    out = list(SPECIALS)
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 9))))
    return [s for s in out if s.isascii()]


def test_coercion_matches_python(spark):
    texts = samples()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", X.python_float(F.col("t")).alias("f"), X.python_int_of_float(F.col("t")).alias("n")) \
        .orderBy("i").collect()
    bad = [(texts[r.i], r.f, py_float(texts[r.i]), r.n, py_int(texts[r.i])) for r in got
           if not same(r.f, py_float(texts[r.i])) or not (r.n == py_int(texts[r.i]) or
                                                          (py_int(texts[r.i]) is not None and
                                                           abs(py_int(texts[r.i])) > 2**31 - 1 and r.n is None))]
    assert not bad, bad[:10]
