import random
import re

import pytest
from pyspark.sql import Row

from tidewright.errors import JobError
from tidewright.functions import pii

VALID, INVALID = "4111 1111 1111 1111", "4111 1111 1111 1112"


def one(spark, text, entities):
    return pii.redact(spark.createDataFrame([(text,)], "t string"), entities).first().t


@pytest.mark.parametrize(
    "entity, text, expected",
    [
        ("USA_SSN", "ssn 123-45-6789.", "ssn ****."),
        ("USA_SSN", "1123-45-6789 123-45-67890 123456789", "1123-45-6789 123-45-67890 123456789"),
        ("USA_SSN", "é123-45-6789é", "é****é"),
        ("CREDIT_CARD", f"a {VALID} b {INVALID} c", f"a **** b {INVALID} c"),
        ("CREDIT_CARD", f"{VALID}", "****"),
        ("CREDIT_CARD", "4111-1111-1111-1111,4111111111111111", "****,****"),
        ("CREDIT_CARD", "41111111111111111111", "41111111111111111111"),
        ("CREDIT_CARD", "", ""),
        ("CREDIT_CARD", None, None),
        ("CREDIT_CARD", f"1234 {VALID}", "1234 ****"),
        ("CREDIT_CARD", f"2 {VALID} 3 {VALID}", "2 **** 3 ****"),
        ("CREDIT_CARD", "378282246310005 1", "**** 1"),
        ("CREDIT_CARD", f"{VALID} {INVALID} {VALID}", f"**** {INVALID} ****"),
        ("CREDIT_CARD", "4222222222222", "****"),
        ("EMAIL", "mail a.b+c@ex-ample.co.uk now", "mail **** now"),
        ("IP_ADDRESS", "10.0.0.255 and 10.0.0.256", "**** and 10.0.0.256"),
        ("PHONE_NUMBER", "call (555) 123-4567 or +1 555-123-4567", "call **** or ****"),
    ],
)
def test_redact(spark, entity, text, expected):
    assert one(spark, text, [entity]) == expected


def test_a_match_inside_a_longer_number_stays(spark):
    # The same digits also occur within a longer run, which is no card.
    text = "4111111111111111 x94111111111111111"
    assert one(spark, text, ["CREDIT_CARD"]) == "**** x94111111111111111"


def test_cards_are_masked_before_phones(spark):
    assert one(spark, f"{VALID} 555-123-4567", ["PHONE_NUMBER", "CREDIT_CARD"]) == "**** ****"


def test_nested_text_and_other_columns(spark):
    schema = "id int, st struct<a:string,n:int>, xs array<string>, m map<string,string>, ys array<struct<s:string>>"
    ssn = "123-45-6789"
    df = spark.createDataFrame(
        [(1, Row(a=ssn, n=2), [ssn, None, "ok"], {"k": f"<{ssn}>"}, [Row(s=ssn)]), (2, None, None, None, None)], schema
    )
    first, second = pii.redact(df, ["USA_SSN"]).collect()
    assert first == Row(id=1, st=Row(a="****", n=2), xs=["****", None, "ok"], m={"k": "<****>"}, ys=[Row(s="****")])
    assert second == Row(id=2, st=None, xs=None, m=None, ys=None)
    assert pii.redact(df, ["USA_SSN"]).schema.simpleString() == df.schema.simpleString()
    found = pii.detect(df, ["USA_SSN", "EMAIL"]).select(pii.DETECTED).collect()
    assert [(d.column, d.n) for d in found[0][0]] == [("st.a", 1), ("xs[]", 1), ("m{}", 1), ("ys[].s", 1)]
    assert found[1][0] == []
    report = {(r.entity, r.column): (r.rows, r.matches) for r in pii.report(df, ["USA_SSN", "EMAIL"]).collect()}
    assert report[("USA_SSN", "xs[]")] == (1, 1) and report[("EMAIL", "m{}")] == (0, 0)


def test_no_python_in_the_plan(spark):
    plan = pii.redact(spark.createDataFrame([("x",)], "t string"), list(pii.ENTITIES))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_unknown_entity(spark):
    with pytest.raises(JobError):
        pii.redact(spark.range(1), ["NOPE"])


def luhn(digits):
    doubled = [int(d) * (1 + at % 2) for at, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def masked_by_hand(text):
    """At each place from the left, the longest number that is a card."""
    out, at = "", 0
    while at < len(text):
        for n in (16, 15, 14, 13):
            found = re.compile(rf"(?<![0-9A-Za-z_])[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9A-Za-z_])").match(text, at)
            if found and luhn(re.sub("[ -]", "", found[0])):
                out, at = out + "****", found.end()
                break
        else:
            out, at = out + text[at], at + 1
    return out


def test_cards_against_brute_force(spark):
    rng = random.Random(3)
    cards = ["4111111111111111", "378282246310005", "30569309025904", "4222222222222", "5500005555555559"]

    def piece():
        kind = rng.randrange(4)
        if kind == 0:
            return "".join(c + rng.choice(["", "", "", " ", "-"]) for c in rng.choice(cards))
        if kind == 1:
            return "".join(rng.choice("0123456789 -") for _ in range(rng.randrange(1, 25)))
        return rng.choice(["a", "_", ", ", " ", "-", "x1"])

    texts = ["".join(piece() for _ in range(rng.randrange(1, 8))) for _ in range(2000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    masked = {r.i: r.t for r in pii.redact(rows, ["CREDIT_CARD"]).collect()}
    wrong = [(t, masked[i], masked_by_hand(t)) for i, t in enumerate(texts) if masked[i] != masked_by_hand(t)]
    assert not wrong, wrong[:3]
    counted = {r.i: sum(d.n for d in r[pii.DETECTED]) for r in pii.detect(rows, ["CREDIT_CARD"]).collect()}
    assert all(counted[i] == masked[i].count("****") for i in counted)
    assert sum(counted.values()) > 500


def test_long_texts_of_labels_are_masked(spark):
    from tidewright.functions.pii import redact

    long = "x@" + "a." * 100_000
    df = spark.createDataFrame([(long + "1",), (long + "com",)], "text string")
    first, second = [row["text"] for row in redact(df, ["EMAIL"]).collect()]
    assert first == long + "1" and second == "****"
