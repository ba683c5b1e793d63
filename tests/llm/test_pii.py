"""Personal data: base spans against the plain patterns, aggregation, redaction."""

import random
import re
import time

import pytest
import regex

from ledgerflow.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 16 <= len(digits) <= 19 and _luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


FIXED = [
    None, "", "nothing here", "a@b.cd@e.f.g", "a@b.cd_x@e.f.g", "x@y.z.%q@r.s a@b a@b. a@b..c a@.b c@d.e-", "🙂é a.b+c@d-e.fr é",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0003.255 1.2.3 999.1.2.3.4.5.6.7", "4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111110000000",
    "4111  111111111111 1 4111111111111111", "5 4111111111111111", "+1 (771) 555-1655 +1555 +12345678901234567890 +1-2", "+49 30 1234567. (771) 555-1655",
    "call 555-123-4567 or 555 123 4567", "SSN 123-45-6789 and 000-12-3456", "token = \"1eb9c654e721b4f812088970e66a6345cee33dd6\" end",
    "Dr. Anna Schmidt wrote to Maria Lopez", "IBAN DE89 3704 0044 0532 0130 00 ok", "a" * 30000 + "@", "1" * 30000, "1 " * 20000, "+1" + "(" * 20000,
    "x.1@m.example.com, " * 300, "9.9.9.9" * 50, "\u0000a@b.cd\n+12345678\t",
]


def _random_texts():
    rng, parts = random.Random(3), ["a", "b.", "@", "c.de", "1", "23", ".", "-", " ", "+4", "(5)", "4111111111111111", "4111 1111 1111 1111", "é", "_", "%", "255", "256", "\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def rows():
    texts = FIXED + _random_texts()
    return [(i if i else None, t, 1 if t is None else len(t), "s", 0, "b", "c", "h") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string, base int, b string, _cuts string, h_email string").repartition(4)


def test_base_spans_equal_plain_patterns(docs, rows):
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        want = _plain_spans(text)
        assert got[i]["base"] == ",".join(f"{k}:{s}:{e}" for k, s, e in want), text[:200]
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in want) for k in PLAIN]
        assert set(got[i]["base"].split(",")) - {""} <= set(got[i]["spans"].split(","))
        order = [(pii.KINDS.index(f["kind"]), f["start"]) for f in got[i]["found"]]
        assert order == sorted(order)


def test_redact(docs, rows):
    out = pii.redact(docs)
    assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    spans = {r["doc_id"]: r["found"] for r in pii.find(docs).collect()}
    got = {r["doc_id"]: r for r in out.collect()}
    for i, text, n, *_ in rows:
        want, at, clean = sorted((f["start"], -f["end"], f["kind"]) for f in spans[i]), 0, ""
        merged = []
        for s, e, k in want:
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], -e)
            else:
                merged.append([s, -e, k])
        if not merged:
            assert (got[i]["text"], got[i]["n_chars"]) == (text, n)
            continue
        for s, e, k in merged:
            clean += text[at:s] + f"[{k.upper()}]"
            at = e
        clean += text[at:]
        assert (got[i]["text"], got[i]["n_chars"]) == (clean, len(clean))


def test_estimate_finds_reliable_labelers():
    """Votes drawn with known reliabilities: the posterior recovers the hidden truth."""
    rng, hidden, counts = random.Random(1), {}, {}
    for _ in range(20000):
        truth = rng.random() < 0.4
        votes = []
        for right in (0.95, 0.9, 0.55, 0.8):
            votes.append(0 if rng.random() < 0.2 else (1 if truth == (rng.random() < right) else -1))
        key = ("name", *votes)
        counts[key] = counts.get(key, 0) + 1
        hidden.setdefault(key, []).append(truth)
    posterior = pii.estimate([(*k, n) for k, n in counts.items()])
    right = sum((posterior[k] >= 0.5) == t for k, ts in hidden.items() for t in ts)
    assert right / 20000 > 0.93


def test_train_follows_posteriors():
    rows = [(["kind:a", "size:1"], 0.95, 50), (["kind:b", "size:1"], 0.05, 50), (["kind:b", "size:2"], 0.9, 20)]
    w = pii.train(rows)
    for terms, p, _ in rows:
        assert (sum(w[t] for t in terms) > 0) == (p > 0.5)


def test_proposals(spark):
    texts = ["please call (771) 555-1655 now", "SSN 123-45-6789 here", "token = \"1eb9c654e721b4f812088970e66a6345cee33dd6\" x"] * 20
    texts += ["order 123-456-7890a" if i % 2 else "mail x@y.com, call +1 (771) 555-1655" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    assert got[0] == "phone:12:26" and got[1] == "ssn:4:15" and got[2].startswith("secret:0:")
    assert got[60] == "email:5:12,phone:19:36"  # the number inside the base span is not proposed again


def test_empty(spark, docs):
    assert pii.find(docs.limit(0)).count() == 0 and pii.redact(docs.limit(0)).count() == 0
    plain = spark.createDataFrame([(1, "no data"), (1, None)], "doc_id long, text string")
    assert [r["spans"] for r in pii.find(plain).collect()] == ["", ""]
    assert sorted(str(r["text"]) for r in pii.redact(plain).collect()) == ["None", "no data"]


def test_proposals_free_of_base_spans(spark):
    """Every proposal that meets no base span is a candidate, over hundreds of either."""
    rng = random.Random(9)
    parts = ["555-123-4567", "+1 555-123-4567", "x@y.com", "1.2.3.4", "4111 1111 1111 1111", "Dr. Anna Lee", "123-45-6789", "(771) 555-1655",
             "DE89 3704 0044 0532 0130 00", "a.b@c.de", "+49 (771) 555-1655", "é"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", ", ", "", "-"]) for _ in range(n)) for n in (1, 2, 3, 63, 64, 65, 127, 130, 700, *[9] * 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in pii.with_candidates(docs).select("text", "_found").collect():
        base = _plain_spans(r["text"])
        want = [m.span() for m in regex.finditer(pii.PROPOSED, r["text"])]
        want = [(s, e) for s, e in want if not any(s < f and b < e for _, b, f in base)]
        assert [(f["s"], f["e"]) for f in r["_found"] if not f["base"]] == want
        assert [(f["kind"], f["s"], f["e"]) for f in r["_found"] if f["base"]] == base


def test_many_hits_in_one_text(spark):
    """Forty thousand hits in one text: time in proportion to them, found and redacted."""
    n = 20_000
    docs = spark.createDataFrame([(1, "é call (771) 555-1655 x.1@m.example.com, " * n)], "doc_id long, text string")
    started = time.monotonic()
    row = pii.find(docs).select("n_email", "spans").first()
    assert row["n_email"] == n and row["spans"].count(",") == 2 * n - 1
    assert pii.redact(docs).first()["text"] == "é call [PHONE] [EMAIL], " * n
    assert time.monotonic() - started < 90
