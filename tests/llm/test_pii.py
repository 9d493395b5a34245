import hashlib
import random
import re

from millrace.llm import pii


def brute(text):
    """The base kinds by their plain patterns."""
    text = text or ""
    out = [("email", m.start(), m.end())
           for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_spans_equal_plain_patterns_on_random_texts():
    rng = random.Random(5)
    pieces = ["a@b.co", "x.y+1@m-1.ex.org", "@", "..", "_", "%", "1.2.3.4", "255.0.0.256", "1.2.3.4.5.6.7.8.9",
              "4111111111111111", "4111 1111-1111 1111", "+1 (234) 555-0000", "+", " ", "-", "é", "12", "7", "a", "\n",
              "0", "00001.2.3.4", "a@b", "@c.d", "-", "."]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE] == brute(text), text


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000,
                "a.b@" * 80_000):
        pii.spans(run)


def test_checksums_and_context():
    assert [s[0] for s in pii.spans("IBAN DE89 3704 0044 0532 0130 00 ok")] == ["iban"]
    assert pii.spans("code DE89 3704 0044 0532 0130 01 no") == []
    assert pii.spans("see 123-45-6789 here") == []
    assert [s[0] for s in pii.spans("ssn 123-45-6789 here")] == ["ssn"]
    assert pii.score("call +1 234 555 0000", ("phone", 5, 20)) > pii.score("and +1 234 555 0000", ("phone", 4, 19))


def test_ibans_end_where_their_country_says():
    plain, grouped = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for code in (plain, grouped, "NO9386011117947", "GB82 WEST 1234 5698 7654 32", "MT84MALT011000012345MTLCAST001S"):
        for before in ("", "IBAN ", "ID AB12 ", "REF99 "):
            for after in ("", " COBADEFFXXX", " BIC COBADEFF", " EUR 250", " 250", " 1234 5678 EUR", " Bank", " ok", "\n12",
                          f" {grouped}"):
                want = [code, *[grouped] * (after == f" {grouped}")]
                text = before + code + after
                assert [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"] == want, text
    assert pii.redacted(f"pay {grouped} COBADEFFXXX EUR 250") == "pay [IBAN] COBADEFFXXX EUR 250"
    # A country without known length: the whole run.
    assert [*pii.ibans("ZZ22 3704 0044 0532 0130 00 ok")] == [("iban", 0, 27)]
    assert not [*pii.ibans(f"{grouped[:-1]}1 EUR 250")] and not [*pii.ibans(f"x{plain}")] and not [*pii.ibans(f"{plain}x")]
    for run in ("AB12 " * 60_000, "DE12 " * 60_000, "DE12" * 60_000):
        assert sum(1 for _ in pii.ibans(run)) * 22 <= len(run)


def test_redacted_replaces_runs_of_spans():
    assert pii.redacted("to a@b.co, 1.2.3.4") == "to [EMAIL], [IP]"
    assert pii.redacted("none") == "none" and pii.redacted(None) is None and pii.redacted("") == ""


def test_query_and_operator_on_edge_rows(spark):
    rows = [(1, "a@b.co é +1 234 555 0000", "x"), (1, "a@b.co é +1 234 555 0000", "x"), (2, None, "x"),
            (None, "1.2.3.4", None), (4, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_email, r.n_ip, r.n_phone, r.base_sha256)
                  for r in pii.digest(docs).collect()))
    def sha(t):
        return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in brute(t)).encode()).hexdigest()
    want = sorted((k is None, k or 0, *(sum(s[0] == n for s in brute(t)) for n in ("email", "ip", "phone")), sha(t))
                  for k, t, _ in rows)
    assert got == want
    assert pii.digest(docs.limit(0)).count() == 0
    assert {len(r.spans) for r in pii.find_pii(docs).collect()} == {0, 1, 2}
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.filter("text is null").count() == 1
    assert clean.filter("doc_id = 1").first().text == "[EMAIL] é [PHONE]"
