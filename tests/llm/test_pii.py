import hashlib
import re

import pytest

from skyledger.llm import pii
from tests.llm import odd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def keeps(kind, found):
    digits = [int(c) for c in found if c.isdigit() and c.isascii()]
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    text = text or ""
    return [
        (kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if keeps(kind, m[0])
    ]


CASES = [
    "a.b@c.de, x@y and @z.com a@b@c.org a@b.c@d.ee __%+-@-.-",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.000 1.2.3.4567 01.2.3.4x5.6.7.8",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111 0000000000000 12345",
    "+1 (555) 123-4567 +49 30 1234567 +1 2 +12345678901234567 ++1 234567890 +1((((((((9",
    "٤١١١ ٤٤٤ é@ü.de a@é.de ünï.user@host.org 😀 a@b.co",
    "write to IBAN GB82 WEST 1234 5698 7654 32 or DE89370400440532013000, not DE89370400440532013001",
    "my ssn is 123-45-6789; " + "filling words " * 5 + "part 123-45-6789 and 000-12-3456",
    "9" * 3000 + "@" * 50 + "+" * 3000 + "a" * 3000 + "." * 100,
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_equal_plain_patterns(text):
    assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE] == brute(text)


def test_added_kinds_need_checksum_or_context():
    found = pii.spans(CASES[5])
    assert [CASES[5][a:b] for kind, a, b, _ in found if kind == "iban"] == [
        "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000",
    ]
    assert [s[1] for s in pii.spans(CASES[6]) if s[0] == "ssn"] == [10]


def test_report_of_fixture_and_odd_rows(spark):
    for docs in (odd.fixture_documents(spark), odd.documents(spark), odd.documents(spark, list(enumerate(CASES)))):
        texts = sorted(((str(r.doc_id), r.text or "") for r in docs.collect()))
        rows = pii.report(docs).collect()
        expected = []
        for doc, text in texts:
            base = brute(text)
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
            expected.append((doc, *[sum(s[0] == k for s in base) for k in pii.BASE], digest))
        assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == sorted(expected)


def test_redaction_keeps_the_rest(spark):
    rows = [(1, "mail a@b.cd now"), (2, None), (3, "clean text, 12 items"), (4, "1.2.3.4 and 4111111111111111.")]
    docs = odd.documents(spark, rows)
    found = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert found[1].text == "mail [EMAIL] now" and found[1].n_chars == 16
    assert found[2].text is None and found[3].text == rows[2][1]
    assert found[4].text == "[IP] and [CARD]."
    assert pii.redact(docs).schema == docs.schema


def test_empty(spark):
    assert pii.report(odd.documents(spark, [])).count() == 0
