import hashlib
import random
import re

import pytest
from helpers import documents, rows_of

from tickforge.llm import pii
from tickforge.llm.common import table

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    found = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def spans_of(df):
    return {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["spans"]] for r in rows_of(pii.find_pii(df))}


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@x.de", ".", "-", " ", "+", "4", "12", "255", "256", "(0)", "4539578763621486", "é", "😀", "_", "%",
             "1.2.3.4", "+49 30 12345", "a@b.c_d@e.f", "0001", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    got = spans_of(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]))
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[1] < pii.BASE] == base_spans(t), t


def test_odd_rows(spark):
    long = ["7" * 200_000, "x" * 200_000 + "@", "a@" * 50_000, "1." * 100_000, "+1" + " " * 100_000, "4539578763621486, " * 20_000,
            "a.b-" * 50_000 + "@c.de", "AB12" * 50_000]
    rows = [(1, None, None, None), (2, "", "", ""), (None, "me@x.org", "en", "s"), (3, "me@x.org", "en", "s"), (3, "me@x.org", "en", "s")]
    df = documents(spark, rows + [(10 + i, t, "en", "s") for i, t in enumerate(long)])
    got = rows_of(pii.find_pii(df))
    assert len(got) == len(rows) + len(long)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append([(s["start"], s["kind"], s["end"]) for s in r["spans"]])
    assert by_id[1] == by_id[2] == [[]]
    assert by_id[None] == [[(0, 0, 8)]] and by_id[3] == [[(0, 0, 8)]] * 2
    assert by_id[15] == [[(18 * i, 2, 18 * i + 16) for i in range(20_000)]]
    assert by_id[16] == [[(0, 0, 200_005)]]
    assert by_id[13] == [[(8 * i, 1, 8 * i + 7) for i in range(25_000)]]
    for i in (10, 11, 12, 14, 17):
        assert by_id[i] == [[]], i
    assert rows_of(pii.find_pii(df.limit(0))) == []


@pytest.mark.parametrize("text, spans", [
    ("wire it to GB82 WEST 1234 5698 7654 32 please", ["iban:11:38"]),
    ("GB82WEST12345698765432", ["iban:0:22"]),
    ("GB83WEST12345698765432", []),                          # 2 mod 97
    ("XGB82WEST12345698765432", []),                         # inside a longer run
    ("serial GB82WEST12345698765432", ["iban:7:29"]),        # 0.8 less 0.2
    ("123-45-6789", []),                                     # 0.4 alone
    ("her SSN is 123-45-6789.", ["ssn:11:22"]),
    ("her SSN is 000-45-6789.", []),
])
def test_checksums_and_words_decide_on_added_kinds(spark, text, spans):
    df = documents(spark, [(1, text, "en", "s")])
    (row,) = pii.find_pii(df).select(pii._joined(pii.F.col("spans")).alias("spans")).collect()
    assert [s for s in row.spans.split(",") if s.split(":")[0] in pii.KINDS[pii.BASE:]] == spans


def test_words_nearby_adjust_the_score(spark):
    texts = ["4539578763621486", "my card: 4539578763621486", "order 4539578763621486", "4539578763621486 (visa)",
             "card" + "." * 80 + "4539578763621486", "discard 4539578763621486"]
    got = {r["doc_id"]: [s["score"] for s in r["spans"]] for r in rows_of(pii.find_pii(documents(spark, [(i, t, "", "") for i, t in enumerate(texts)])))}
    assert got == {0: [0.8], 1: [1.0], 2: [0.6], 3: [1.0], 4: [0.8], 5: [0.8]}


def test_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents", "doc_id", "text").collect()}
    got = pii.op12_pii(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        base = base_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert sum(r.n_email for r in got) and sum(r.n_card for r in got)
