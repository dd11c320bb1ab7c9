import random
import re
import time
from datetime import date, datetime, timedelta
from hashlib import sha256
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from colophon.llm import pii
from colophon.llm.queries import op7_pii

SF = Path("/root/testdata/sf0.001")


def feistel(a, b, a_size, b_size, tweak, key):
    for i in range(8):
        noise = int(sha256(f"{key}|{tweak}|{i}|{a if i % 2 else b}".encode()).hexdigest()[:15], 16)
        a, b = (a, (b + noise) % b_size) if i % 2 else ((a + noise) % a_size, b)
    return a, b


def digits_moved(d, tweak, key):
    left = len(d) // 2
    a, b = feistel(int(d[:left]), int(d[left:]), 10**left, 10 ** (len(d) - left), tweak, key)
    return f"{a:0{left}}{b:0{len(d) - left}}"


def put_back(value, digits):
    rest = iter(digits)
    return "".join(next(rest) if c in "0123456789" else c for c in value)


def luhn(digits):
    doubled = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def day_moved(day, key):
    for name, first, years in (("past", date(1000, 8, 7), 900), ("present", date(1900, 1, 1), 200), ("future", date(2099, 11, 13), 7900)):
        place = (day - first).days
        if 0 <= place < years * 365:
            a, b = feistel(place // 365, place % 365, years, 365, f"date {name}", key)
            return first + timedelta(days=a * 365 + b)


def parsed(value, form):
    try:
        return datetime.strptime(value, form).date()
    except ValueError:
        return None


def shown(day, form):
    return form.replace("%Y", f"{day.year:04}").replace("%m", f"{day.month:02}").replace("%d", f"{day.day:02}")


def one(kind, value, key):
    d = re.sub("[^0-9]", "", value)
    if kind == "email":
        return f"u{sha256(f'{key}|email|{value.lower()}'.encode()).hexdigest()[:16]}@mail.invalid"
    if kind == "date":
        forms = ["%Y-%m-%d"] if "-" in value else ["%d/%m/%Y", "%m/%d/%Y"] if "/" in value else ["%d.%m.%Y"]
        for form in forms:
            if day := parsed(value, form):
                moved = day_moved(day, key)
                while form == "%m/%d/%Y" and moved and moved.day <= 12:
                    moved = day_moved(moved, key)
                return moved and shown(moved, form)
    elif kind == "ssn":
        area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
        if 0 < area < 900 and area != 666 and group and serial:
            a, b = feistel(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key)
            return f"{a + 1 + (a >= 665):03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    elif kind == "ip":
        o = [int(x) for x in value.split(".")]
        if max(o) < 256:
            a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 1 << 16, 1 << 16, "ip", key)
            return f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"
    elif kind == "card" and luhn(d):
        body = digits_moved(d[:-1], "card", key)
        return put_back(value, next(body + c for c in "0123456789" if luhn(body + c)))
    elif kind == "phone" and 7 <= len(d) <= 15:
        code = re.match(r"\+?(\d{1,3})[ .-]?\(|\+(\d{1,3})[ -]", value)
        keep = max(len(d) - 10, len(code[1] or code[2]) if code else 0)
        if len(d) >= keep + 2:
            return put_back(value, d[:keep] + digits_moved(d[keep:], "phone", key))
    return None


def brute_force(text, key):
    counts = dict.fromkeys(pii.KINDS, 0)

    def moved(m):
        kind = next(k for k in pii.KINDS if re.fullmatch(pii.PATTERNS[k], m[0], re.ASCII))
        new = one(kind, m[0], key)
        counts[kind] += new is not None
        return m[0] if new is None else new

    return re.sub(pii.ANY.replace(r"\1", r"\1"), moved, text, flags=re.ASCII), counts


def strange(n):
    rng = random.Random(21)
    parts = ["a.b@x.org", "4263429643439180", "4263-4296-4343-9180", "10.0.0.255", "300.1.1.1", "2024-02-29", "31.12.1899", "12/31/1999"]
    parts += ["31/12/1999", "05/06/2001", "123-45-6789", "666-45-6789", "+49 30 123456", "+33 1 2345 678", "+1 (555) 123-4567", "555-123-4567"]
    parts += ["+4915112345678", "(030) 123-4567", "0999-01-01", "7777-07-07", " ", "x", "\n", "1", "-", ".", "é", "\x01", "\x03\x04", "@", "a"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_query_equals_brute_force(spark, tmp_path):
    rows = list(enumerate(strange(500)))
    if SF.exists():
        rows += [(1000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(500, None), (501, ""), rows[3], rows[3]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found, texts = op7_pii(spark, str(tmp_path)).collect(), dict(rows)
    assert len(found) == len(rows)
    for r in found:
        if texts[r["doc_id"]] is None:
            assert r["text"] is None
            continue
        text, counts = brute_force(texts[r["doc_id"]], pii.TEST_KEY)
        assert r["text"] == text, texts[r["doc_id"]]
        assert {k: r[f"n_{k}"] for k in pii.KINDS} == counts


@pytest.mark.parametrize("value", ["+49 30 123456", "+33 1 2345 678", "12/31/1999", "31.12.1899"])
def test_forms_that_differ_by_country(spark, value):
    rows = [(value,), (f"call {value} now",)]
    found = [r[0] for r in pii.pseudonymize(spark.createDataFrame(rows, "text string"), "k").select("text").collect()]
    assert found[0] != value and found[1] == f"call {found[0]} now"
    assert re.sub(r"\d", "0", found[0]) == re.sub(r"\d", "0", value)
    assert value[0] != "+" or found[0].split(" ")[0] == value.split(" ")[0]


def test_dates_move_within_their_kind(spark):
    days = spark.sql("select explode(sequence(date'1998-01-01', date'2003-12-31')) as d")
    us = days.filter("dayofmonth(d) > 12").select(F.date_format("d", "MM/dd/yyyy").alias("text"))
    got = [r[0] for r in pii.pseudonymize(us, "k").select("text").collect()]
    assert len(set(got)) == len(got) == us.count() and all(int(x[3:5]) > 12 for x in got)


def test_very_long_texts(spark):
    rows = [(1, "a@b" + ".c" * 500_000), (2, "+1" + " 23" * 300_000), (3, "1." * 500_000), (4, "10.0.0.1 " * 50_000), (5, "é" * 500_000 + " 555-123-4567")]
    began = time.perf_counter()
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    found = {r["doc_id"]: r for r in pii.pseudonymize(docs, "k").withColumn("end", F.right("text", F.lit(12))).drop("text").collect()}
    assert found[1]["n_email"] == 1 and found[4]["n_ip"] == 50_000 and found[5]["n_phone"] == 1 and found[5]["end"] != "555-123-4567"
    assert time.perf_counter() - began < 120


def test_empty_table_and_key(spark):
    docs = spark.createDataFrame([(1, "10.0.0.1", 3)], "doc_id int, text string, n_ip int")
    assert pii.pseudonymize(docs.limit(0), "k").count() == 0
    one, two = (pii.pseudonymize(docs, k).first()["text"] for k in "ab")
    assert one != two
    with pytest.raises(TypeError):
        pii.pseudonymize(docs)
