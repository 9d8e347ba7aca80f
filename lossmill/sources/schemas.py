"""Declared schemas of the two input registers."""

from __future__ import annotations

from pyspark.sql import types as T

EXPOSURE_REGISTER = T.StructType(
    [
        T.StructField("IDpol", T.LongType()),
        T.StructField("ClaimNb", T.LongType()),
        T.StructField("Exposure", T.DoubleType()),
        T.StructField("Area", T.StringType()),
        T.StructField("VehPower", T.LongType()),
        T.StructField("VehAge", T.LongType()),
        T.StructField("DrivAge", T.LongType()),
        T.StructField("BonusMalus", T.LongType()),
        T.StructField("VehBrand", T.StringType()),
        T.StructField("VehGas", T.StringType()),
        T.StructField("Density", T.LongType()),
        T.StructField("Region", T.StringType()),
    ]
)

CLAIM_REGISTER = T.StructType(
    [
        T.StructField("IDpol", T.LongType()),
        T.StructField("ClaimAmount", T.DoubleType()),
    ]
)
