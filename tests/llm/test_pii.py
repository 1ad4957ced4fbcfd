import hashlib
import re

import pytest

from thalweg.llm import pii

TEXTS = [
    None, "", "nothing here", "mail a.b@c.de, x@y, a@b.c%d@e.f and @x.y", "abc@def@x.y.z..", "a@b.co@d.ef", "1.2.3.4 256.1.1.1 1.2.3.4.5 01.002.0003.4 1.2..3.4.5.6",
    "4111 1111 1111 1111, 4111-1111-1111-1112; 4111111111111111 5", "+1 (499) 555-6503 +12 +1-2-3 ++49 170 1234567. +1 ()", "é +33 1 23 45 67 89é ü@x.de",
    "9" * 5000, "a" * 5000, "a@" * 2000, "1." * 3000, "+1" + " " * 3000, "x" * 300 + "@" + "y" * 300 + ".zz", "٣.٣.٣.٣ +٣٣٣٣٣٣٣٣٣٣",
]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card":
                doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("text", TEXTS)
def test_base(text):
    assert pii.base(text or "") == brute(text)


def test_find(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS * 2)] + [(None, TEXTS[3], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(df).collect())
    want = []
    for i, t, _ in rows:
        found = brute(t)
        n = [sum(k == kind for k, _, _ in found) for kind in PLAIN]
        want.append((str(i), *n, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()))
    assert got == sorted(want)
    assert pii.find(df.limit(0)).count() == 0


def bootstrapped(spark, monkeypatch):
    monkeypatch.setattr(pii, "SUPPORT", 5)
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "371449635398431", "30569309025904", "6011111111111117", "5105105105105100", "4222222222222220"]
    valid = [c for c in cards if pii.luhn(c)]
    rows = [(i, f"Please charge card {c} today.", 0) for i, c in enumerate(valid)]
    rows += [(100 + i, f"Please charge card {c[:-1]}{(int(c[-1]) + 1) % 10} today.", 0) for i, c in enumerate(valid[:1])]
    rows += [(200 + i, f"serial {10**15 + 7 * i} of part {10**9 + i}", 0) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long")


def test_context_finds_unseen(spark, monkeypatch):
    monkeypatch.setattr(pii, "CONFIDENCE", 0.8)
    df = bootstrapped(spark, monkeypatch)
    extra = {r.doc_id: [s for s in r.spans] for r in pii.find(df).collect() if len(r.spans) > r.n_card + r.n_ip + r.n_phone + r.n_email}
    assert list(extra) == [100] and [(s.kind, s.start, s.stop) for s in extra[100]] == [("card", 19, 35)]
    text = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(df).collect()}
    assert text[100] == ("Please charge card [CARD] today.", 32) and "[CARD]" in text[0][0] and text[200][0].startswith("serial 10")


def test_redact_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a@b.cd +1 (499) 555-6503", "q"), (1, None, "w"), (None, "", None), (2, "1.2.3.4 x", "e")], "doc_id long, text string, extra string")
    got = sorted(map(str, (tuple(r) for r in pii.redact(df).collect())))
    assert got == sorted(map(str, [(1, "[EMAIL] [PHONE]", "q"), (1, None, "w"), (None, "", None), (2, "[IP] x", "e")]))


def test_masked_overlap():
    assert pii.masked("abcdefgh", [("ip", 1, 4), ("card", 3, 6), ("phone", 7, 8)]) == "a[IP]g[PHONE]"


def test_context_finds_unseen_formats(spark):
    rows = [(i, f"Please call +1 (499) 555-65{i:02d} now. Write mail to person.{chr(97 + i % 26)}{i}@site.example for more.") for i in range(40)]
    unseen = ["(499) 555 0123", "499-555-0124", "0499 5550125"]
    rows += [(100 + i, f"Please call {x} now.") for i, x in enumerate(unseen)]
    forms = ["jo (at) site (dot) org", "jo.b at site dot example", "jo@localhost"]
    rows += [(200 + i, f"Write mail to {x} for more.") for i, x in enumerate(forms)]
    rows += [(300 + i, f"serial 55{i:02d} 1234 {i:03d} of look at figure.{i} here, part 49{i:02d}-555-0124 a") for i in range(30)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    got = {r.doc_id: {(s.kind, text[r.doc_id][s.start : s.stop]) for s in r.spans} for r in found if r.doc_id >= 100}
    want = {100 + i: {("phone", x)} for i, x in enumerate(unseen)} | {200 + i: {("email", x)} for i, x in enumerate(forms)}
    assert got == want | {i: set() for i in range(300, 330)}
