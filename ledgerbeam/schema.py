"""Schemas of the event tables (fixed names and types)."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = T.StructType([T.StructField(n, T.LongType()) for n in ("run", "luminosityBlock", "event")])
COUNTS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("genTtbarId", "Expanded_genTtbarId", "nAddBJets", "nAddBJetsMulti")])
FINGERPRINT = T.StructType(
    [T.StructField(n, T.FloatType()) for n in ("Generator_x1", "Generator_x2")] + [T.StructField(n, T.IntegerType()) for n in ("Generator_id1", "Generator_id2")]
)
REFERENCE = T.StructType([*KEY, T.StructField("genTtbarId", T.IntegerType())])
SIDECAR = T.StructType([*KEY, *COUNTS, *FINGERPRINT])
LOOKUP = T.StructType([*KEY, *COUNTS, T.StructField("datasetIdx", T.IntegerType())])
LOOKUP_EVENTS = T.StructType([*LOOKUP, *FINGERPRINT])
PRODUCTION = T.StructType([
    T.StructField("genTtbarId", T.IntegerType()), T.StructField("jets", T.ArrayType(T.StructType([T.StructField("pt", T.DoubleType()), T.StructField("eta", T.DoubleType())]))),
    T.StructField("bHadJetIdx", T.ArrayType(T.IntegerType())), T.StructField("bHadFromTop", T.ArrayType(T.BooleanType())),
])
MASK = T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.LongType())))
