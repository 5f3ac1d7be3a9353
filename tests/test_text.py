import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from sitefold.functions import codes
from sitefold.functions import text as tx


def values(spark, fn, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_company_name(spark):
    assert values(spark, tx.company_name, [
        "Acme Robotics, Inc.", "ACME & Sons Co", "L.L.C. Holdings LLC", "Company", None, "", "Inc Corp Ltd", "Café  Nine"
    ]) == ["acme robotics", "acme and sons", "l l c holdings", "", "", "", "", "caf nine"]


def test_phone_digits(spark):
    assert values(spark, tx.phone_digits, ["(214) 555-0100", "+1 214 555 0100", "214-555-0100 x12", "123", None]) == [
        "2145550100", "2145550100", "4555010012", "123", ""]


def test_street_address(spark):
    assert values(spark, tx.street_address, [
        "100 Main Street, Suite 4", "Streeter Road", "street street", "main_street", "éstreet", None
    ]) == ["100 main st ste 4", "streeter rd", "st st", "main street", "st", ""]


def test_web_domain(spark):
    assert values(spark, tx.web_domain, [
        "https://www.Acme.example/about?x=1", "acme.example", "HTTP://user:pw@acme.example:8080/", "www.a_b.example/x",
        "not a host/x", None, "",
    ]) == ["acme.example", "acme.example", "acme.example", "a_b.example", "not a host", "", ""]


def test_trim_and_presence(spark):
    assert values(spark, tx.blank_to_null, ["  x \t", " ", "﻿", None]) == ["x", None, None, None]
    assert values(spark, tx.truthy, ["", " ", None, "a"]) == [False, True, False, True]
    assert values(spark, tx.filled, ["", " ", None, "a"]) == [False, False, False, True]
    assert values(spark, tx.nullish_to_null, [" NULL ", "none", "Nonesuch", ""]) == [None, None, "Nonesuch", None]


def plain_dice(a, b):
    if not a or not b:
        return 0.0
    grams = [{f" {s} "[i:i + 2] for i in range(len(s) + 1)} for s in (a, b)]
    return 2 * len(grams[0] & grams[1]) / (len(grams[0]) + len(grams[1]))


def test_dice_against_plain_sets(spark):
    rng = random.Random(7)
    words = ["acme", "robotics", "aa", "a", "dental 9", "9 9 9", "zephyr optics", ""]
    pairs = [(" ".join(rng.sample(words, 2)).strip(), " ".join(rng.sample(words, 2)).strip()) for _ in range(60)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", tx.dice_text(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()
    assert [r.s for r in rows] == [plain_dice(a, b) for a, b in pairs]


def test_fixed4_is_exact(spark):
    rng = random.Random(3)
    xs = [0.74125, 0.00005, 1.0, 0.0, 0.61875] + [rng.randint(0, 80) / 80 * 0.5 + rng.randint(0, 80) / 80 * 0.3 for _ in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r.y for r in df.select("i", tx.fixed4(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [float(Decimal(x).quantize(Decimal("0.0001"), ROUND_HALF_UP)) for x in xs]


def test_codes(spark):
    assert [r.normalized for r in values(spark, codes.site_type, ["s", " H ", "single site", "Regional Headquarters", "Q", "", None])] == [
        "single_site", "headquarters", "single_site", "regional_headquarters", "unknown", "unknown", "unknown"]
    assert [(r.normalized, r.recognized) for r in values(spark, codes.lifecycle, ["dire", "KEEP", "research_deleted", "DELE", None])] == [
        ("published", True), ("unknown", False), ("research_deleted", True), ("deleted", True), ("unknown", False)]


def test_fingerprint_forms(spark):
    df = spark.createDataFrame([("r1", "A"), (None, "A"), ("", "A")], "rid string, n string")
    fp = tx.fingerprint(F.lit("src"), F.col("rid"), {"companyName": F.col("n"), "city": F.lit(None).cast("string")})
    got = [r.f for r in df.select(fp.alias("f")).collect()]
    assert got[0] == "src:r1" and got[1] == got[2] and got[1].startswith("src:hash-") and len(got[1]) == len("src:hash-") + 16


@pytest.mark.parametrize("value,expected", [("Bob [x] \"q\"", '"Bob [x] \\"q\\""'), ("[]", '"[]"')])
def test_json_text(spark, value, expected):
    assert values(spark, tx.json_text, [value]) == [expected]
