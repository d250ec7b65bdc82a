import random
import re

from skytrace.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": pii.PATTERNS["iban"]}


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        s = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and s % 10 == 0
    if kind == "phone":
        return 8 <= len(d) <= 15
    if kind == "iban":
        b = m.replace(" ", "")
        return 15 <= len(b) <= 34 and int("".join(str(int(c, 36)) for c in b[4:] + b[:4])) % 97 == 1
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(PLAIN[k], text or "") if good(k, m[0])]


def texts():
    r = random.Random(6)
    known = ["a.b+c@x-y.de", "x@y", "a@b.c_d@e.f.g", "@@a@b..c@d.e", "1.2.3.4.5.6.7.8", "255.0.000255.1", "256.1.1.1", "1.2.3",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "+49 (30) 1234567", "+1 2", "+1234567890123456",
             "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88370400440532013000", "+1 5105105105105100 "]
    out = [f"é\U0001F642 {a} card {b}. {a}" for a in known for b in known]
    alphabet = "ab1 2.3@-+4(5)é\n"
    return out + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(3000)]


def test_spans_match_the_plain_patterns(docs, odd):
    rows = list(odd) + [(1000 + i, t) for i, t in enumerate(texts())]
    out = pii.find_pii(docs(rows, clash=True)).collect()
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in out), key=str)
    assert got == sorted(((i, brute(t)) for i, t in rows), key=str)
    assert sum(bool(r.spans) for r in out) > 300


def test_context_raises_the_score(docs):
    rows = [(1, "my credit card: 4111111111111111"), (2, "number 4111111111111111"), (3, "4111111111111111 visa")]
    scores = {r.doc_id: round(r.spans[0].score, 6) for r in pii.find_pii(docs(rows)).collect()}
    assert scores == {1: 0.9, 2: 0.8, 3: 0.9}


def test_long_runs_take_linear_time(docs):
    n = 100_000
    rows = [(1, "a" * n), (2, "1" * n), (3, "1." * n), (4, "+1" * n), (5, "a@" * n), (6, "x@y.z " * 3000), (7, "+" + " 1" * n)]
    out = {r.doc_id: len(r.spans) for r in pii.find_pii(docs(rows)).collect()}
    assert out == {1: 0, 2: 0, 3: n // 4, 4: 0, 5: 0, 6: 3000, 7: 0}


def test_redact(docs, odd):
    rows = list(odd) + [(100, "é a@b.de, +49 (30) 1234567 und 4111 1111 1111 1111."), (101, "no +14111111111111 4111111111111111 x@y.z")]
    df = docs(rows, clash=True)
    out = pii.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[100] == "é [EMAIL], [PHONE] und [CARD]." and got[1] is None and got[2] == ""
    assert got[101] == "no +14111111111111 4111111111111111 [EMAIL]"
    assert all(got[i] == t for i, t in odd)
    assert pii.redact(df.limit(0)).count() == 0
