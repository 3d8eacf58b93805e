"""Golden tables for round names (O-49), dates (O-51) and amounts (O-57/O-58)."""

import json

from pyspark.sql import functions as F

from fundlake.functions import amounts, dates, rounds, variant

ROUND_GOLDENS = [
    ("Seed", "Seed"), ("seed round", "Seed"), ("Pre Seed", "Seed"), ("PRE-SEED", "Pre-Seed"),
    ("series a-1", "Series A"), ("Seed / Series A", "Seed"), ("another round", "Other"),
    ("Series G", "Unknown"), ("Debt Financing", "Unknown"), ("", "Unknown"), (None, "Unknown"),
    ("Unknown", "Unknown"), ("series b extension", "Series B"), ("SERIES D", "Series D"),
]

# (JSON literal of the date value, expected MM/YY or None)
DATE_GOLDENS = [
    ('"03/21"', "03/21"), ('"3-21"', "03/21"), ('"3.2021"', "03/21"), ('"13/21"', "13/21"),
    ('"21/03"', "21/03"), ('"21/3"', "03/21"), ('"2021"', "01/21"), ("2021", "01/21"),
    ("5.21", "05/21"), ("2021.5", "05/21"), ('"2021-3"', "03/21"), ('"2021/13"', "13/21"),
    ('"3/5/2021"', "03/21"), ('"2021-02-30"', "02/21"), ('"1/2/21"', None),
    ('"unknown"', None), ('""', None), ('"March 5, 2021"', "03/21"),
    ('"March 5,2021"', "03/21"), ('"march 05 2021"', "03/21"), ('"Mar 5, 2021"', None),
    ('"June 31, 2021"', None), ('"March 0, 2021"', None), ('"5 March 2021"', None),
    ('"March 2021"', None), ('"2021-03-05T10:00:00"', "03/21"), ('"2021-03-05 10:00"', "03/21"),
    ('"2021-03-05T10:00:00+05:30"', "03/21"), ('"2021-03-05T25:00"', None),
    ('"20210305"', "03/21"), ('"202103"', None), ('"  2021-03 "', "03/21"), ("true", None),
    ('"2021-W10-1"', "03/21"), ('"2020-W53-5"', "01/21"), ('"2021-W53-1"', None),
    ('"February 29, 2020"', "02/20"), ('"February 29, 2021"', None), ("2021.0", "00/21"),
]

AMOUNT_GOLDENS = [
    ("5", 5), ("1.7", 1), ("-5", -5), ("true", 1), ("false", 0), ('"5M"', 0), ("null", 0),
    ("2.0", 2), ("123456789012", 123456789012),
]


def test_round_names(spark):
    df = spark.createDataFrame(ROUND_GOLDENS, "n string, want string")
    got = df.select("want", rounds.fix_round_name(F.col("n")).alias("got")).collect()
    for r in got:
        assert r.got == r.want, r


def test_dates(spark):
    df = spark.createDataFrame([(json.dumps({"d": json.loads(j)}), w) for j, w in DATE_GOLDENS],
                               "j string, want string")
    v = variant.field(variant.parse(F.col("j")), "d")
    staged = dates.with_standardized_date(df.withColumn("t", variant.python_text(v)), "t", "got")
    for r in staged.collect():
        assert r.got == r.want, r
    # The one-expression form agrees with the staged form.
    for r in df.select("want", dates.standardize_date(variant.python_text(v)).alias("got")).collect():
        assert r.got == r.want, r


def test_amounts(spark):
    df = spark.createDataFrame([(f'{{"a": {j}}}', w) for j, w in AMOUNT_GOLDENS], "j string, want long")
    v = variant.field(variant.parse(F.col("j")), "a")
    for r in df.select("j", "want", amounts.coerce_amount(v).alias("got")).collect():
        assert r.got == r.want, r


def test_truthiness(spark):
    cases = [("null", False), ("false", False), ("0", False), ("0.0", False), ('""', False),
             ("[]", False), ("{}", False), ("true", True), ("1", True), ('"x"', True),
             ("[0]", True), ('{"a":null}', True), ('"{}"', True)]
    df = spark.createDataFrame([(f'{{"t": {j}}}', w) for j, w in cases], "j string, want boolean")
    v = variant.field(variant.parse(F.col("j")), "t")
    for r in df.select("j", "want", variant.truthy(v).alias("got")).collect():
        assert r.got == r.want, r
    missing = spark.range(1).select(variant.truthy(variant.field(variant.parse(F.lit("{}")), "t")).alias("t"))
    assert missing.first().t is False
