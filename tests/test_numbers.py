import math
import random
import struct

from pyspark.sql import functions as F

from ledgerline.functions.numbers import rounded
from ledgerline.operators import consolidate


def test_rounding_equals_pythons(spark):
    r = random.Random(3)
    values = [2.0005, 0.0625, -0.0625, 0.1875, 0.0, -0.0, -0.0001, 0.0005, 0.0015, 1e-300, 5e-324, 179.9995, -180.0, 51.1234, 9007199254740.99, 1e300, math.inf, -math.inf]
    values += [k / 16000 for k in range(-6000, 6000)] + [(k + 0.5) / 1000 for k in range(10000)] + [math.nextafter((k + 0.5) / 1000, s) for k in range(0, 10000, 7) for s in (0, 999)]
    values += [r.uniform(-180, 180) for _ in range(5000)] + [v for v in (struct.unpack("d", r.randbytes(8))[0] for _ in range(3000)) if v == v]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 3, 6):
        got = [row[0] for row in df.select(rounded(F.col("x"), digits)).collect()]
        want = [float(round(v, digits)) if abs(v) < 2**53 / 10**digits else v for v in values]
        assert [(g, math.copysign(1, g)) for g in got] == [(w, math.copysign(1, w)) for w in want]
    odd = spark.createDataFrame([(None,), (math.nan,)], "x double").select(rounded(F.col("x"), 3)).collect()
    assert odd[0][0] is None and math.isnan(odd[1][0])


def test_place_key_of_coordinates(spark):
    df = spark.createDataFrame([(2.0005, 0.0625), (2.0014, -0.0625), (None, 1.0)], "latitude double, longitude double")
    assert [r.place_key for r in consolidate.with_place_keys(df).collect()] == ["geo:2.001:0.062", "geo:2.001:-0.062", None]
