import hashlib
import re

from concord.llm import pii, registry

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub(r"[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda: 16 <= len(d) <= 19 and luhn(d),
        "phone": lambda: 8 <= len(d) <= 15,
    }[kind]()


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        out.append([f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if valid(kind, m[0])])
    return out


def check(rows, texts):
    for r in rows:
        spans = base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(s) for s in spans]
        flat = ",".join(x for s in spans for x in s)
        assert r.base_sha256 == hashlib.sha256(flat.encode()).hexdigest()
        assert r.spans.startswith(flat)


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in registry.documents(spark, "/root/testdata/sf0.01").collect()}
    rows = registry.op9_personal_data(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    check(rows, texts)


CASES = [
    "a@b.c_d@e.f x@y a.b@c-d.e.f, é𝄞 q@r.st", "a@b.c.d@e.f@g.h", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111",
    "4111 1111 1111 1111 1 4111  1111 1111 1111", "+1 (017) 555-7713 +12 +1.2.3.4.5.6.7.8 ++49 89 1234 5678 90 1234567", "+1" + " " * 3000 + "2", "9" * 30000, "a" * 60000 + "@", "7@a.bc " * 3000,
    "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 and GB82WEST12345698765433", "ssn 123-45-6789", "no context 123-45-6789", "", None, "5 5", "1\n2",
]


def test_cases(make_docs, spark, tmp_path):
    texts = dict(enumerate(CASES))
    make_docs(texts.items(), clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    rows = registry.op9_personal_data(spark, str(tmp_path)).collect()
    check(rows, texts)
    by_id = {r.doc_id: r.spans for r in rows}
    assert [s.split(":")[0] for s in by_id[10].split(",") if s.startswith("iban")] == ["iban", "iban"]
    assert "ssn:4:15" in by_id[11] and "ssn" not in by_id[12]


def test_context_adjusts_the_score(make_docs):
    row = pii.find_personal_data(make_docs([(1, "x 1.2.3.4"), (2, "the server 1.2.3.4")])).orderBy("doc_id").collect()
    assert [r.ip[0].score for r in row] == [0.6, 0.9]


def test_context_is_read_on_both_sides_and_through_neighbours(make_docs):
    texts = ["SSN: 111-22-3333, 444-55-6666", "111-22-3333 (social security)", "111-22-3333 and 444-55-6666 are social security numbers", "ssn " + "x" * 50 + " 111-22-3333", "111-22-3333" + " " * 50 + "ssn", "é 111-22-3333, é 222-22-3333, é 333-22-3333 ssn"]
    rows = pii.find_personal_data(make_docs(enumerate(texts))).orderBy("doc_id").collect()
    assert [[(s.start, s.end) for s in r.ssn] for r in rows] == [[(5, 16), (18, 29)], [(0, 11)], [(0, 11), (16, 27)], [], [], [(2, 13), (17, 28), (32, 43)]]


def test_empty_table(make_docs):
    assert pii.find_personal_data(make_docs([])).collect() == []


def test_repeated_rows_give_repeated_results(make_docs):
    texts = [(1, "a@b.c 1.2.3.4"), (1, "a@b.c 1.2.3.4"), (1, "+49 89 1234 5678"), (None, "a@b.c 1.2.3.4")]
    rows = sorted(((r.doc_id or 0, len(r.email), len(r.ip), len(r.phone)) for r in pii.find_personal_data(make_docs(texts)).collect()))
    assert rows == [(0, 1, 1, 0), (1, 0, 0, 1), (1, 1, 1, 0), (1, 1, 1, 0)]
