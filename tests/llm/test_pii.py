import random
import re
import time

from gridcube.llm import pii as P

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def found(spark, texts):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, pii int")
    return [[(s["kind"], s["start"], s["end"]) for s in r.pii] for r in P.with_spans(df).orderBy("doc_id").collect()]


def test_planted_and_odd_texts(spark):
    texts = [None, "", "no data", "a@b.c-d_e@f.g h@i.j", "x@y", "é😀 me.too+1@mail.example.com, ok", "1.2.3.4.5.6.7.8 256.1.1.1 007.08.1.255",
             "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (456) 555-2186 then +12 3", "card +4111 1111 1111 1111", "1.2.3.4@mail.com",
             "99999999999999999999999999999999.1.1.1", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "a@b.c\n" * 300, "+1.2.3.4.5.6.7.8", "@@a@b..c@d.e"]
    got = found(spark, texts)
    assert [[s for s in g if s[0] in P.BASE] for g in got] == [plain(t) for t in texts]


def test_random_texts_equal_plain_patterns(spark):
    rng = random.Random(9)
    parts = ["a", "Z9", "@", ".", "-", " ", "+", "(", ")", "4111111111111111", "255", "256", "0", "12", "é", "\n", "_", "%", "example.com", "1.1.1.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([5, 20, 60]))) for _ in range(600)]
    got = found(spark, texts)
    assert [[s for s in g if s[0] in P.BASE] for g in got] == [plain(t) for t in texts]


def test_checksums_and_context_of_added_kinds(spark):
    got = found(spark, ["IBAN DE89 3704 0044 0532 0130 00 ok", "IBAN DE88 3704 0044 0532 0130 00", "GB82WEST12345698765432.",
                        "my ssn is 123-45-6789", "see 123-45-6789", "part order 123-45-6789", "ssn 000-45-6789"])
    assert [[s[0] for s in g if s[0] not in P.BASE] for g in got] == [["iban"], [], ["iban"], ["ssn"], [], [], []]


def test_iban_ends_at_its_countrys_length(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00",
             "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606"]
    texts = [f"{iban}{after}" for iban in ibans for after in (" EUR 500", " BIC", " 2024 AB", ".", "")] + ["ES91 2100 0418 4502 0005 1333 EUR", "ES91 2100 0418 4502 0005 1332Y"]
    got = [[s for s in g if s[0] == "iban"] for g in found(spark, texts)]
    assert got == [[("iban", 0, len(iban))] for iban in ibans for _ in range(5)] + [[], []]
    df = spark.createDataFrame([(1, "to ES91 2100 0418 4502 0005 1332 EUR 500, AT61 1904 3002 3457 3201 BIC")], "doc_id long, text string")
    assert P.redact(df).first().text == "to [IBAN] EUR 500, [IBAN] BIC"


def test_long_texts_stay_linear(spark):
    long = ["a" * 300_000 + "@", "1" * 300_000 + ".1", "a@" + "b." * 100_000 + "c", "1 " * 100_000, "+" * 100_000 + "1" * 1000, "A" * 200_000]
    began = time.time()
    got = found(spark, long)
    assert time.time() - began < 60 and ("email", 0, 200_003) in got[2]


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd now"), (2, None), (3, "clean"), (4, "+4111 1111 1111 1111 é x@y.zz")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in P.redact(df).collect()}
    assert got == {1: "mail [EMAIL] now", 2: None, 3: "clean", 4: "+[CARD] é [EMAIL]"}
    assert P.redact(df.limit(0)).count() == 0 and P.redact(df).columns == df.columns


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert "Python" not in P.redact(df.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()


def test_context_on_either_side(spark):
    texts = ["my ssn is 123-45-6789 and 123-45-6780", "123-45-6789 is my ssn", "123-45-6789, 123-45-6780 (both ssn)", "123-45-6789" + " x" * 30 + " ssn",
             "ssn" + " x" * 30 + " 123-45-6789", "123-45-6789 order ssn", "social 123-45-6789123-45-6780", "a 1-123-45-6789 ssn"]
    got = found(spark, texts)
    assert [len([s for s in g if s[0] == "ssn"]) for g in got] == [2, 1, 2, 0, 0, 0, 0, 0]


def test_ssn_against_a_plain_search(spark):
    rnd = random.Random(6)
    parts = ["123-45-6789", "987-65-4321", "219-09-9999", "000-12-3456", "ssn", "security", "part", "order", "x" * 20, "1", "-", ",", "\n", "é"]
    texts = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(300)]
    want = []
    for t in texts:
        hits = []
        for m in re.finditer(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", t):
            near = t[max(0, m.start() - 48):m.start()] + "\n" + t[m.end():m.end() + 48]
            has = lambda words: bool(re.search(rf"(?ia)\b(?:{words})", near))
            if not re.search(r"^(?:000|666|9)|-00-|-0000$", m.group()) and 0.4 + 0.3 * has("ssn|social|security") - 0.3 * has("part|order") >= 0.6:
                hits.append((m.start(), m.end()))
        want.append(hits)
    assert [[(s[1], s[2]) for s in g if s[0] == "ssn"] for g in found(spark, texts)] == want
