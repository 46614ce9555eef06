"""Spans of personal data against Python's regular expressions and checksums."""

import random
import re
import time

from pyspark.sql import functions as F

from adtally.llm import pii

SCHEMA = "doc_id long, text string, spans string, kind int"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    """The base spans."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def found(spark, rows):
    return pii.find(spark.createDataFrame(rows, SCHEMA)).collect()


def test_base_matches_brute_force(spark):
    rng = random.Random(1)
    bits = ["a", "é", "😀", "@", ".", "-", " ", "+", "(", ")", "\n", "1", "12", "255", "256", "4111111111111111", "0", "x.y", "_", "%", "٣"]
    texts = [None, "", "a@b.c", "a@b.c_d@e.f", "1.2.3.4.5", "01.002.0003.00255", "4111 1111-1111 1111", "+1 (017) 555-7713", "+123456789)"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["x" * 60_000 + "@" + "y.z" * 20_000, "1 " * 40_000, "+1" * 20_000, "a@b.c " * 3000, "1.2.3.4 " * 3000, "." * 50_000 + "@"]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "a@b.c", None, None), (0, None, "", 1)]
    for r in found(spark, rows):
        if r.doc_id is not None:
            base = [(s.kind, s.start, s.end) for s in r.spans if s.kind in ("email", "ip", "card", "phone")]
            assert base == brute(texts[r.doc_id]), texts[r.doc_id][:200]
            assert all((texts[r.doc_id] or "")[s.start : s.end] == s.text for s in r.spans)


def test_checksums_and_context(spark):
    texts = {
        1: "IBAN GB82 WEST 1234 5698 7654 32.", 2: "IBAN GB82 WEST 1234 5698 7654 33.", 3: "DE89370400440532013000",
        4: "my social security number: 219-09-9999", 5: "part 219-09-9999 of the list", 6: "SSN 000-12-3456",
    }
    got = {r.doc_id: [(s.kind, s.text) for s in r.spans if s.kind in ("iban", "ssn")] for r in found(spark, [(i, t, "", 0) for i, t in texts.items()])}
    assert got[1] == [("iban", "GB82 WEST 1234 5698 7654 32")] and got[2] == [] and got[3] == [("iban", "DE89370400440532013000")]
    assert got[4] == [("ssn", "219-09-9999")] and got[5] == [] and got[6] == []
    with_word, without = found(spark, [(1, "call me: +49 30 1234567", "", 0), (2, "+49 30 1234567", "", 0)])
    assert with_word.spans[0].score > without.spans[0].score


def test_long_runs_without_a_match_take_linear_time(spark):
    n = 1_000_000
    runs = ["a" * n + " x@ y", "1" * n + " 1.2.", "a." * (n // 2) + "@", "1." * (n // 2) + "x 1.2", "9" * n + "@", "+1" + " " * n, "A1" * (n // 2)]
    rows = [(i, t, "", 0) for i, t in enumerate(runs)]
    started = time.monotonic()
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found(spark, rows)}
    assert time.monotonic() - started < 60
    assert all(not spans for i, spans in got.items() if i != 3)
    assert got[3] == [("ip", i, i + 7) for i in range(0, n, 8)]


def test_a_routing_number_needs_its_checksum_and_a_context_word(spark):
    texts = ["routing 021000021", "ABA no. 011401533, please", "routing 021000022", "part 021000021", "transit 000000000"]
    got = {r.doc_id: [s.text for s in r.spans if s.kind == "routing"] for r in found(spark, [(i, t, "", 0) for i, t in enumerate(texts)])}
    assert got == {0: ["021000021"], 1: ["011401533"], 2: [], 3: [], 4: []}


def test_an_iban_before_or_after_words_that_look_like_groups(spark):
    es, be, at = "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201"
    de, no, bare = "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "GB82WEST12345698765432"
    texts = {
        f"IBAN {es} BIC CAIXESBB": [es], f"IBAN: {be} BIC: X": [be], f"{at} EUR 20": [at], f"{be} 2024 PAID NOW": [be],
        f"{es} {de}": [es, de], f"{be} {be} {no} EUR": [be, be, no], f"REF AB12 3456 7890 {at} EUR": [at],
        f"é😀 {no} NOK, {bare} BIC, {de}x {es}": [no, bare, es], f"{bare}X": [], f"{es[:-1]}3 BIC": [], es: [es],
    }
    rows = [(i, t, "", 0) for i, t in enumerate(texts)]
    masked = {r.doc_id: r.text for r in pii.mask(spark.createDataFrame(rows, SCHEMA)).collect()}
    for r in found(spark, rows):
        text, want = rows[r.doc_id][1], texts[rows[r.doc_id][1]]
        ibans = [s for s in r.spans if s.kind == "iban"]
        assert [s.text for s in ibans] == want and all(text[s.start : s.end] == s.text for s in ibans), text
        for number in want:
            text = text.replace(number, "[IBAN]", 1)
        assert masked[r.doc_id] == text


def test_masking(spark):
    rng = random.Random(2)
    bits = ["mail a@b.co ", "ip 10.0.0.1, ", "card 4111 1111 1111 1111; ", "call +1 (017) 555-7713 ", "é 12 ", "999.1.1.1 "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(60)]
    texts += [None, "", "a@b.co" * 2000, "plain"]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)
    for r in pii.mask(df).select("doc_id", F.col("text").alias("m")).collect():
        text = texts[r.doc_id]
        if text is None:
            assert r.m is None
            continue
        assert brute(r.m) == []
        if not brute(text):
            assert r.m == text
    assert pii.mask(df).columns == df.columns and pii.mask(df).count() == len(texts)


def test_empty_table_and_no_python(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(spark, []) == []
    plan = pii.find(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
